"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every five-word shingle is hashed once; the top bits of the hash choose one of K bins and the
rest is its value there, of which a bin keeps the least. A bin that stays empty probes bins drawn
by a hash of its number and the attempt and takes the value of the first that is filled (optimal
densification: equal sets fill alike, and bins borrow independently). After a few attempts the
rest take the first filled bin in a random order of their own, which is the same draw without
repeats. Stored are the low B bits of each bin, as hex. Two fingerprints agree in a
bin by chance with probability 2**-B; the likeness estimate takes that out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, store

WORDS = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 8
ATTEMPTS = 4
BLANKS = r"[\x20\x09-\x0D]+"


def _filled_bins(text: Column) -> list[tuple[str, Column]]:
    """Steps, each a column on the ones before: words to hashes to the least hash of each bin.

    Hashes are unsigned 57-bit values below the bin number, so their order is bins first.
    """
    words = F.filter(F.split(F.lower(text), BLANKS), lambda w: w != "")
    n = F.size("mh_words")
    shingles = F.when(
        n < WORDS, F.array(F.xxhash64(F.array_join(F.transform("mh_words", F.hex), " ")))
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0), n - WORDS),
            lambda i: F.xxhash64(*[F.get(F.col("mh_words"), i + k) for k in range(WORDS)]),
        )
    )
    ordered = F.sort_array("mh_shingles")
    first = F.filter(
        F.col("mh_ordered"),
        lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(F.col("mh_ordered"), i - 1))),
    )
    return [
        ("mh_words", F.transform(words, lambda w: F.xxhash64(w))),
        ("mh_shingles", shingles), ("mh_ordered", ordered), ("mh_filled", first),
    ]


def _bin(h: Column) -> Column:
    """Top bits of a signed hash, from 0; grows with the hash."""
    return F.shiftright(h, 64 - BIN_BITS) + BINS // 2


def _own_bins() -> Column:
    """The value of every bin, null where it is empty."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        lambda j: F.get("mh_filled", F.array_position("mh_bins", j).cast("int") - 1),
    )


def _probed(values: str, attempt: int) -> Column:
    """Empty bins take the value of the bin that their hash for this attempt names, if filled."""
    return F.transform(values, lambda own, j: F.coalesce(own, F.get(
        F.col("mh_own"), F.pmod(F.xxhash64(j, F.lit(attempt)), F.lit(BINS)).cast("int")
    )))


def _borrowed(values: str) -> Column:
    """What no attempt filled takes the filled bin that is first in a random order of its own."""

    def first(j: Column) -> Column:
        # The order is in the high bits, the place in the list of filled bins in the low ones.
        ranked = F.transform(
            F.col("mh_bins"),
            lambda b, i: F.xxhash64(j, b).bitwiseAND(F.lit(-BINS)) + i,
        )
        return F.get("mh_filled", F.array_min(ranked).bitwiseAND(F.lit(BINS - 1)).cast("int"))

    return F.transform(values, lambda own, j: F.when(own.isNotNull(), own).otherwise(first(j)))


def with_fingerprint(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """Add the packed fingerprint of a text column; null counts as empty.

    An empty text, and one of fewer than five words, is a single shingle of what it has.
    """
    kept = df.columns
    out = df
    for step, column in _filled_bins(F.coalesce(F.col(text_col), F.lit(""))):
        out = out.select(*out.columns, column.alias(step))
    out = out.select(*kept, "mh_filled", F.transform("mh_filled", _bin).alias("mh_bins"))
    out = out.select(*kept, "mh_filled", "mh_bins", _own_bins().alias("mh_own"))
    out = out.withColumn("mh_probe0", F.col("mh_own"))
    for attempt in range(ATTEMPTS):
        out = out.withColumn(f"mh_probe{attempt + 1}", _probed(f"mh_probe{attempt}", attempt))
    out = out.select(*kept, _borrowed(f"mh_probe{ATTEMPTS}").alias("mh_values"))
    # One more bit above the low ones keeps leading zeros.
    low = F.transform(
        "mh_values",
        lambda h: F.substring(
            F.hex(h.bitwiseAND(F.lit((1 << LOW_BITS) - 1)) + (1 << LOW_BITS)), 2, LOW_BITS // 4
        ),
    )
    return out.select(*kept, F.lower(F.array_join(low, "")).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, chance agreement taken out, in [0, 1]."""
    width = LOW_BITS // 4
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0),
        lambda total, i: total + (
            F.substring(a, i * width + 1, F.lit(width)) == F.substring(b, i * width + 1, F.lit(width))
        ).cast("int"),
    )
    chance = 2.0 ** -LOW_BITS
    return F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row's whole text."""
    return with_fingerprint(id_and_text(docs, id_col, text_col), "text", "fingerprint").select(
        "doc_id", "fingerprint"
    )


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id): the next in descending order; after the last comes the first.

    `ids` holds distinct ids. They are cut into ranges, looked at range by range, and the least
    of each range gets the greatest of the next one from a table of one row per range.
    """
    ranged = ids.repartitionByRange(F.col("doc_id").desc()).select(
        "doc_id", F.spark_partition_id().alias("range_no")
    )
    # Written once: range bounds come from a sample, every reader must see the same.
    ranged = store(ranged, "id-ranges")
    inside = Window.partitionBy("range_no").orderBy(F.col("doc_id").desc())
    heads = ranged.groupBy("range_no").agg(F.max("doc_id").alias("head"))
    # One row per range; range 0 has the greatest ids.
    over_heads = Window.orderBy("range_no")
    whole = over_heads.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("range_no", F.coalesce(
        F.lead("head").over(over_heads), F.first("head").over(whole)
    ).alias("next_head"))
    return (
        ranged.select("doc_id", "range_no", F.lead("doc_id").over(inside).alias("inner_id"))
        .join(heads, "range_no")
        .select("doc_id", F.coalesce("inner_id", "next_head").alias("next_id"))
    )


def edited_fingerprints(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Every document with its edited text and how like the two and the next document are.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The
    edited text has the last floor(n_chars / 2) code points replaced by the first as many, or all,
    of the next document in descending doc_id; after the last comes the first, a lone document
    follows itself. Null texts are empty. Of rows that share an id the least text counts; rows
    without an id have no place in the order and are left out.
    """
    texts = (
        id_and_text(docs, id_col, text_col).where("doc_id IS NOT NULL")
        .groupBy("doc_id").agg(F.min("text").alias("text"))
    )
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL")
    order = store(next_ids(ids.distinct()), "next-ids")
    half = F.floor(F.length("text") / 2).cast("int")
    own = texts.join(order, "doc_id").select(
        "doc_id", "next_id", "text", F.length("text").alias("n_chars"), half.alias("half")
    )
    # What each document asks of the next: a number; what it gets: only that much text.
    asked = own.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("asker"), "half")
    given = texts.join(asked, "doc_id").select(
        F.col("asker").alias("doc_id"), F.substring("text", F.lit(1), F.col("half")).alias("tail")
    )
    pairs = own.join(given, "doc_id").select(
        "doc_id", "next_id", F.col("n_chars").cast("bigint").alias("n_chars"), "text",
        F.concat(
            F.substring("text", F.lit(1), F.col("n_chars") - F.col("half")), "tail"
        ).alias("edited"),
    )
    both = with_fingerprint(with_fingerprint(pairs, "text", "fingerprint"), "edited",
                            "edited_fingerprint")
    done = store(both.select(
        "doc_id", "next_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
    ), "edited-fingerprints")
    following = done.select(
        F.col("doc_id").alias("next_id"), F.col("fingerprint").alias("next_fingerprint")
    )
    return done.join(following, "next_id").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
