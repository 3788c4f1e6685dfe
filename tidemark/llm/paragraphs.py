"""Substring dedup: near-equal paragraphs by MinHash bands, exact Jaccard and components.

A text is cut at line ends; a line of `min_words` words or more is a paragraph. Equal paragraphs
are one content from the start. Contents meet where a band of five of their 80 MinHash values over
five-word shingles is equal; sixteen bands let a pair at Jaccard 0.8 meet with probability 0.998
(tuned for recall: what meets is verified). In a band every content is compared with a few members
drawn at random, which joins a family of near copies with a number of comparisons in proportion to
its size. Bands that still hold more than one component are then compared in blocks: a task gets
two blocks of contents, counts their shared shingles and returns only the links between
components, so pairs never become rows and no link between contents that meet is lost.

A passage that repeats inside longer, otherwise different lines is found by its pieces: paragraphs
are cut further before every word whose hash is the least of those around it, so equal passages are
cut alike wherever they stand. Lines shorter than a paragraph are pieces too. Pieces count as
repeated where their content is equal, whatever their length, and are reported where consecutive
repeated ones make up `min_words` words or more.

Words, contents and shingles are 64-bit polynomial hashes, worked out for a slice of texts at once.
Those of different contents are equal for one pair in 10^19.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, plain_strings, store, text_slices
from tidemark.llm.components import connected_components

MIN_WORDS = 20
# A word begins a piece if its hash is the least of this many on either side.
AROUND = 6
SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 5
DRAWN = 4
BLOCK = 128
SEED = 3
_RANDOM = np.random.default_rng(SEED)
FACTORS = _RANDOM.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
OFFSETS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
# Odd bases of the polynomial hashes: bytes of a word, words of a content, of a shingle.
BYTE_BASE, CONTENT_BASE, SHINGLE_BASE = (
    int(b) | 1 for b in _RANDOM.integers(1 << 40, 1 << 63, 3, dtype=np.uint64)
)
SHINGLES_AT_ONCE = 1 << 11
# Bytes of text that a task works on at once; every byte takes some tens of bytes of numbers.
SLICE_BYTES = 2 << 20
# Pairs of members counted at once.
PAIRS_AT_ONCE = 1 << 20
BLANKS = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def run_hashes(values: np.ndarray, first: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of each run values[first:end], equal for equal runs wherever they stand (mod 2**64)."""
    up = _powers(base, len(values))
    down = _powers(pow(base, -1, 1 << 64), len(values))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)])
    return _mixed((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64))


class Words:
    """The words of a slice of texts in order: text, line, places and hashes.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; places are code points in the text.
    """

    def __init__(self, texts: pa.Array):
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        raw, offsets = raw[offsets[0]:offsets[-1]], offsets - offsets[0]
        inside = ~BLANKS[raw]
        opens = np.zeros(len(raw) + 1, bool)
        opens[offsets] = True
        before = np.concatenate([[False], inside[:-1]]) & ~opens[:-1]
        start = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]]) & ~opens[1:]
        end = np.flatnonzero(inside & ~after) + 1
        self.raw, self.byte_start, self.byte_end = raw, start, end
        self.text = np.searchsorted(offsets, start, side="right") - 1
        point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        self.start, self.end = point[start] - point[offsets[self.text]], point[end] - point[offsets[self.text]]
        line = np.concatenate([[0], np.cumsum(raw == 10)])
        self.line = line[start] - line[offsets[self.text]]
        self.hash = run_hashes(LOWER[raw].astype(np.uint64) + np.uint64(1), start, end, BYTE_BASE)
        # First word of every line, and the end of the last.
        new = np.ones(len(start), bool)
        new[1:] = (np.diff(self.line) != 0) | (np.diff(self.text) != 0)
        self.line_first = np.flatnonzero(new)
        self.line_end = np.append(self.line_first[1:], len(start)) if len(start) else self.line_first

    def pieces(self, min_words: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and ends of the pieces of all lines, in order."""
        n = len(self.hash)
        cut = np.zeros(n, bool)
        if n > 2 * AROUND:
            windows = np.lib.stride_tricks.sliding_window_view(self.hash, AROUND).min(axis=1)
            at = np.arange(AROUND, n - AROUND)
            own = self.hash[at]
            size = self.line_end - self.line_first
            first, end = np.repeat(self.line_first, size)[at], np.repeat(self.line_end, size)[at]
            cut[at] = (
                (own < windows[at - AROUND]) & (own < windows[at + 1]) & (at - first >= AROUND)
                & (end - at > AROUND) & (end - first >= min_words)
            )
        cut[self.line_first] = True
        first = np.flatnonzero(cut)
        return first, np.append(first[1:], n) if n else first


def shingle_hashes(words: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, edges): five-word shingles of each run of words, of all words if they are fewer."""
    n = np.maximum(end - first - SHINGLE + 1, 1)
    edges = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(edges[-1]) - np.repeat(edges[:-1] - first, n)
    return run_hashes(words, at, np.minimum(at + SHINGLE, np.repeat(end, n)), SHINGLE_BASE), edges


def band_hashes(shingles: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One row of band hashes per run of shingles."""
    runs = len(edges) - 1
    least = np.full((runs, BANDS * ROWS), np.iinfo(np.uint64).max, np.uint64)
    run = np.repeat(np.arange(runs), np.diff(edges))
    for at in range(0, len(shingles), SHINGLES_AT_ONCE):
        some, of = shingles[at:at + SHINGLES_AT_ONCE], run[at:at + SHINGLES_AT_ONCE]
        # Shingles are well-mixed hashes already: a line through them is a random order.
        values = some[:, None] * FACTORS[None, :]
        values += OFFSETS[None, :]
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        part = np.minimum.reduceat(values, starts, axis=0)
        least[of[starts]] = np.minimum(least[of[starts]], part)
    out = np.zeros((runs, BANDS), np.uint64)
    for row in range(ROWS):
        out = _mixed(out * np.uint64(SHINGLE_BASE) + least[:, row::ROWS])
    return (out + np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(BYTE_BASE)).view(np.int64)


def jaccard(a: str, b: str) -> float:
    """Exact similarity of the shingle sets of two paragraphs, the plain way."""
    x, y = (
        {tuple(w[i:i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))}
        for w in (t.encode().lower().split() for t in (a, b))
    )
    return len(x & y) / len(x | y)


UNITS = (
    "doc_id bigint, text_no int, whole boolean, paragraph int, piece int, start int, end int, "
    "n_words int, key bigint, text string"
)


def units(docs: DataFrame, id_col="doc_id", text_col="text", min_words=MIN_WORDS) -> DataFrame:
    """Every paragraph (`whole`) and every piece of every row: place (end exclusive) and content.

    `text` is there for paragraphs, and null where the same content came before in the slice of
    texts that a task works on, so that a paragraph in a third of all rows is sent once a slice.
    `text_no` tells texts apart whose rows share an id.
    """
    names = [f.split()[0] for f in UNITS.split(", ")]

    def rows(words: Words, first, end, numbers, doc_ids, whole: bool, places, texts) -> pa.RecordBatch:
        text = words.text[first]
        return pa.RecordBatch.from_arrays([
            doc_ids.take(pa.array(text)), pa.array(numbers[text]), pa.array(np.full(len(first), whole)),
            pa.array(words.line[first], pa.int32()), pa.array(places, pa.int32()),
            pa.array(words.start[first], pa.int32()), pa.array(words.end[end - 1], pa.int32()),
            pa.array(end - first, pa.int32()), pa.array(content_keys(words, first, end)), texts,
        ], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=SLICE_BYTES):
            texts = plain_strings(part.column(1))
            words = Words(texts)
            if not len(words.hash):
                continue
            edges = np.searchsorted(words.text, np.arange(part.num_rows + 1))
            numbers = run_hashes(words.hash, edges[:-1], edges[1:], CONTENT_BASE).astype(np.int32)
            first, end = words.pieces(min_words)
            # Number of the piece in its text.
            number = np.arange(len(first)) - np.searchsorted(words.text[first], words.text[first])
            yield rows(
                words, first, end, numbers, part.column(0), False, number, pa.nulls(len(first), pa.string())
            )
            long = words.line_end - words.line_first >= min_words
            first, end = words.line_first[long], words.line_end[long]
            if not len(first):
                continue
            new = np.zeros(len(first), bool)
            new[np.unique(content_keys(words, first, end), return_index=True)[1]] = True
            raw = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(first), [None, *_spans(words, first, end)]
            )
            body = pc.if_else(pa.array(new), raw.cast(pa.large_string()), pa.scalar(None, pa.large_string()))
            yield rows(
                words, first, end, numbers, part.column(0), True, np.full(len(first), -1),
                body.cast(pa.string()),
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, UNITS)


def content_keys(words: Words, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    return run_hashes(words.hash, first, end, CONTENT_BASE).view(np.int64)


def _spans(words: Words, first: np.ndarray, end: np.ndarray) -> tuple[pa.Buffer, pa.Buffer]:
    """Offsets and bytes of runs of words with what stands between them."""
    begins, size = words.byte_start[first], words.byte_end[end - 1] - words.byte_start[first]
    edges = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    at = np.repeat(begins - edges[:-1], size) + np.arange(edges[-1])
    return pa.py_buffer(edges), pa.py_buffer(words.raw[at].tobytes())


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, edges): the distinct shingles of each paragraph, in order."""
    words = Words(plain_strings(texts))
    edges = np.searchsorted(words.text, np.arange(len(texts) + 1))
    hashes, of = shingle_hashes(words.hash, edges[:-1], edges[1:])
    run = np.repeat(np.arange(len(texts)), np.diff(of))
    order = np.lexsort((hashes, run))
    hashes, run = hashes[order], run[order]
    new = np.ones(len(run), bool)
    new[1:] = (np.diff(run) != 0) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.searchsorted(run[new], np.arange(len(texts) + 1))


def _bands(known: DataFrame) -> DataFrame:
    """(key, band): every band of every content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=SLICE_BYTES):
            if part.num_rows:
                bands = band_hashes(*shingle_sets(part.column(1)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(part.column(0).to_numpy(), BANDS)), pa.array(bands.ravel())
                ], ["key", "band"])

    return known.select("key", "text").mapInArrow(run, "key bigint, band bigint")


def _similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose texts are similar enough."""
    a = texts.select(F.col("key").alias("a"), F.col("text").alias("x"))
    b = texts.select(F.col("key").alias("b"), F.col("text").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, column=2, limit=SLICE_BYTES // 2):
            n = part.num_rows
            if not n:
                continue
            hashes, run_of, size = [], [], []
            for column in (2, 3):
                found, edges = shingle_sets(part.column(column))
                hashes.append(found)
                run_of.append(np.repeat(np.arange(n), np.diff(edges)))
                size.append(np.diff(edges))
            both, of = np.concatenate(hashes), np.concatenate(run_of)
            order = np.lexsort((both, of))
            twice = (both[order][1:] == both[order][:-1]) & (of[order][1:] == of[order][:-1])
            shared = np.bincount(of[order][1:][twice], minlength=n)
            near = pa.array(shared >= similarity * (size[0] + size[1] - shared))
            yield pa.RecordBatch.from_arrays([part.column(k).filter(near) for k in (0, 1)], ["a", "b"])

    both = pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a bigint, b bigint")


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of x shares with each set of y."""
    n, m = len(x), len(y)
    left, right = np.concatenate(x), np.concatenate(y)
    lx, ly = (np.repeat(np.arange(len(s)), [len(v) for v in s]) for s in (x, y))
    order_x, order_y = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    left, right, lx, ly = left[order_x], right[order_y], lx[order_x], ly[order_y]
    common = np.intersect1d(left, right)
    from_x, from_y = np.searchsorted(left, common), np.searchsorted(right, common)
    in_x = np.searchsorted(left, common, side="right") - from_x
    in_y = np.searchsorted(right, common, side="right") - from_y
    out = np.zeros(n * m, np.int64)
    # Every shingle stands for the pairs of those that have it; as many shingles as fit at a time.
    part = np.cumsum(in_x * in_y) // PAIRS_AT_ONCE
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for at, end in zip(edges, edges[1:]):
        pairs = (in_x * in_y)[at:end]
        of = np.repeat(np.arange(at, end), pairs)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        i, j = lx[from_x[of] + inside // in_y[of]], ly[from_y[of] + inside % in_y[of]]
        out += np.bincount(i * m + j, minlength=n * m)
    return out.reshape(n, m)


def _links_across(rest: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links between components among the members of each band, in pairs of blocks.

    `rest` is (band, key, component). A pair of contents that meets in several bands is looked at
    in each; what comes out are links only.
    """
    sized = rest.join(rest.groupBy("band").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")
    ), "band")
    own = F.pmod(F.xxhash64("key", F.lit(SEED)), F.col("blocks")).cast("int")
    placed = sized.withColumn("own", own).select(
        "band", "key", "component", "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).join(texts, "key")
    packed = placed.groupBy(
        "band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    ).agg(F.collect_list(F.struct("own", "key", "component", "text")).alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                members = batch.column("members")[row].values
                own, key, component = (
                    members.field(c).to_numpy(zero_copy_only=False) for c in ("own", "key", "component")
                )
                flat, edges = shingle_sets(members.field("text"))
                low, high = batch.column("low")[row].as_py(), batch.column("high")[row].as_py()
                x, y = np.flatnonzero(own == low), np.flatnonzero(own == high)
                if not len(x) or not len(y):
                    continue
                size = np.diff(edges)
                shared = shared_counts(
                    [flat[edges[k]:edges[k + 1]] for k in x], [flat[edges[k]:edges[k + 1]] for k in y]
                )
                near = shared >= similarity * (size[x][:, None] + size[y][None, :] - shared)
                near &= component[x][:, None] < component[y][None, :] if low == high else \
                    component[x][:, None] != component[y][None, :]
                a, b = np.nonzero(near)
                yield pa.RecordBatch.from_arrays([pa.array(key[x[a]]), pa.array(key[y[b]])], ["a", "b"])

    return packed.select("low", "high", "members").mapInArrow(run, "a bigint, b bigint")


def links(every: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b), keys of contents, with enough links between them to connect all that are similar.

    `every` has (key, text) as `units` gives them.
    """
    known = every.where("text IS NOT NULL").select("key", "text")
    bands = store(_bands(known), "all-bands")
    often = bands.groupBy("band").count().where("count > 1").select("band")
    met = store(bands.join(often, "band").distinct(), "bands")
    drawn = met.groupBy("band").agg(
        F.min("key").alias("low"), F.max("key").alias("high"),
        *[F.min_by("key", F.xxhash64("key", F.lit(k))).alias(f"drawn{k}") for k in range(DRAWN)],
    ).where("low <> high")
    drawn = drawn.select("band", F.array(*[f"drawn{k}" for k in range(DRAWN)]).alias("drawn"))
    shared = store(met.join(drawn, "band"), "shared-bands")
    texts = known.join(shared.select("key").distinct(), "key", "left_semi")
    texts = store(texts.groupBy("key").agg(F.first("text").alias("text")), "texts")
    stars = shared.select("key", F.explode("drawn").alias("other")).where(
        F.col("key") != F.col("other")
    ).select(*_pair(F.col("key"), F.col("other"))).distinct()
    near = store(_similar(stars, texts, similarity), "near-paragraphs")
    found = connected_components(near)
    placed = shared.select("band", "key").join(
        found, shared["key"] == found["node"], "left"
    ).select("band", "key", F.coalesce("component", "key").alias("component"))
    apart = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low <> high").select("band")
    rest = store(placed.join(apart, "band"), "apart")
    return near.union(_links_across(rest, texts, similarity))


def _rooted(every: DataFrame, similarity: float) -> DataFrame:
    """(whole, key, root): contents that occur again, exactly or nearly; `root` names the cluster.

    A piece is its own root; the root of a paragraph is the least key of its component.
    """
    counts = every.groupBy("whole", "key").agg(F.count(F.lit(1)).alias("n"))
    pieces = counts.where("NOT whole AND n > 1").select("whole", "key", F.col("key").alias("root"))
    joined = connected_components(links(every, similarity))
    rooted = store(counts.where("whole").join(joined, F.col("key") == joined["node"], "left").select(
        "whole", "key", "n", F.coalesce("component", "key").alias("root")
    ), "paragraph-roots")
    clusters = rooted.groupBy("root").agg(F.sum("n").alias("n")).where("n > 1").select("root")
    return rooted.join(clusters, "root", "left_semi").select("whole", "key", "root").unionByName(pieces)


def repeated_paragraphs(
    docs: DataFrame, id_col="doc_id", text_col="text", min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Every paragraph and passage that occurs again somewhere; the first of each is kept.

    (doc_id, paragraph, start, end, n_words, whole, first_doc_id, first_start, occurrences,
    removed): `paragraph` is the number of the line; `whole` rows are paragraphs, repeated exactly
    or nearly, the others pieces of longer repeated passages outside of those. A cluster is named
    by its first occurrence by id, then place. Null and empty texts have no paragraphs; rows
    without an id have a place but never come first unless there is no other. Rows that repeat, id
    included, repeat their paragraphs. An empty table gives no rows.
    """
    every = store(units(docs, id_col, text_col, min_words), "units", "zstd")
    found = every.drop("text").join(_rooted(every, similarity), ["whole", "key"])
    found = store(found.drop("key"), "repeated-units", "zstd")
    where = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "start")
    heads = found.groupBy("whole", "root").agg(
        F.count(F.lit(1)).alias("occurrences"), F.min(where).alias("head")
    )
    # Runs of consecutive repeated pieces of a text; rows that repeat share their numbers.
    text = ["doc_id", "text_no"]
    order = Window.partitionBy(*text, "whole").orderBy("piece")
    same = Window.partitionBy(*text, "whole", "piece", "start").orderBy("end")
    run = Window.partitionBy(*text, "whole", "run")
    runs = found.withColumns({
        "run": F.col("piece") - F.dense_rank().over(order), "copy": F.row_number().over(same)
    }).withColumns({
        "run_words": F.sum("n_words").over(run) / F.max("copy").over(run),
        "in_whole": F.max("whole").over(Window.partitionBy(*text, "paragraph")),
    })
    kept = runs.where(
        F.col("whole") | ((F.col("run_words") >= min_words) & ~F.col("in_whole"))
    ).join(heads, ["whole", "root"])
    return kept.select(
        "doc_id", "paragraph", F.col("start").cast("bigint").alias("start"),
        F.col("end").cast("bigint").alias("end"), "n_words", "whole",
        F.col("head.doc_id").alias("first_doc_id"), F.col("head.start").alias("first_start"),
        "occurrences",
        (~(
            F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
            & (F.col("start") == F.col("head.start"))
        )).alias("removed"),
    )
