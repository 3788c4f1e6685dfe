"""SimHash near-duplicates found through tables of distances to reference fingerprints.

A fingerprint has 64 bits in eight blocks of eight. The reference fingerprints are the eight Walsh
rows placed in each block, whose eight distances pin the content of that block, and eight random
fingerprints of full width. Two fingerprints at most two bits apart differ in at most two blocks,
so they agree in all distances to the references of some six blocks: those six tables of distances
are the cell in which pairs meet. A pair that meets is discarded if a distance to a full-width
reference differs by more than the bit distance allowed (triangle inequality), and verified
otherwise. No link is lost, and a cell holds at most 2**16 different fingerprints.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_merge, id_and_text, store, text_slices
from tidemark.llm.components import connected_components

HASH_SEED = 42
BLOCKS, BLOCK_BITS = 8, 8
WALSH = [
    sum((bin(row & bit).count("1") & 1) << bit for bit in range(BLOCK_BITS))
    for row in range(BLOCK_BITS)
]
# Seven bits hold a distance, so eight of them fit a bigint.
FULL_WIDTH = [random.Random(seed).getrandbits(63) for seed in range(8)]
HASHES_AT_ONCE = 1 << 16


def simhash(raw: bytes, width: int) -> int:
    """Fingerprint of UTF-8 text as a signed 64-bit integer; 0 without words.

    A-Z is lower-cased, words are split at ASCII white space, shingles of `width` words keep their
    repeats, a shorter text is one shingle. A bit is set if more than half of the hashes have it.
    """
    words = raw.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        spans = list(zip(starts[at:at + HASHES_AT_ONCE], ends[at:at + HASHES_AT_ONCE]))
        hashes = np.fromiter(
            (digest(text[s:e], HASH_SEED) for s, e in spans), "<u8", len(spans)
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, fp) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            raw = pc.fill_null(part.column(1).cast(pa.binary()), b"").to_pylist()
            found = pa.array([simhash(x, width) for x in raw], pa.int64())
            yield pa.record_batch([part.column(0), found], ["doc_id", "fp"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint")


def _block_table(fp: Column, block: int) -> Column:
    """The distances inside one block to its eight references, four bits each."""
    content = F.shiftrightunsigned(fp, BLOCK_BITS * block).bitwiseAND(F.lit(255))
    distances = [F.bit_count(content.bitwiseXOR(F.lit(row))).cast("bigint") for row in WALSH]
    return reduce(lambda x, y: x + y, [F.shiftleft(d, 4 * k) for k, d in enumerate(distances)])


def _far_table(fp: Column) -> Column:
    """The distances to the full-width references, seven bits each."""
    distances = [F.bit_count(fp.bitwiseXOR(F.lit(r))).cast("bigint") for r in FULL_WIDTH]
    return reduce(lambda x, y: x + y, [F.shiftleft(d, 7 * k) for k, d in enumerate(distances)])


def _largest_difference(a: Column, b: Column) -> Column:
    def part(x: Column, k: int) -> Column:
        return F.shiftright(x, 7 * k).bitwiseAND(F.lit(127))

    return F.greatest(*[F.abs(part(a, k) - part(b, k)) for k in range(len(FULL_WIDTH))])


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints at most `distance` (0 to 2) bits apart.

    `prints` has distinct fingerprints in `fp`. A fingerprint has at most 64 + 2,016 partners, so
    the result grows with the number of fingerprints, not with its square.
    """
    if not 0 <= distance <= 2:
        raise ValueError("cells of six blocks find distances of two bits at most")
    tables = prints.select("fp", _far_table(F.col("fp")).alias("far"), *[
        _block_table(F.col("fp"), b).alias(f"block{b}") for b in range(BLOCKS)
    ])
    cells = [
        F.xxhash64(F.lit(number), *[f"block{b}" for b in range(BLOCKS) if b not in pair])
        for number, pair in enumerate(combinations(range(BLOCKS), 2))
    ]
    met = tables.select("fp", "far", F.explode(F.array(*cells)).alias("cell"))
    a, b = met.alias("a"), met.alias("b")
    near = (
        (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (_largest_difference(F.col("a.far"), F.col("b.far")) <= distance)
        & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance)
    )
    return a.join(by_merge(b), near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, width: int = 3, distance: int = 2, id_col="doc_id", text_col="text"
) -> DataFrame:
    """(doc_id, fp, component_id): every row with the smallest id its fingerprint can reach.

    Rows of one fingerprint are one class from the start, so copies cost nothing further on.
    Empty and null texts have fingerprint 0 and link like any other. A null id keeps its row and
    is never a component id unless the component has no other. An empty table gives no rows.
    """
    prints = store(fingerprints(docs, width, id_col, text_col), "simhash")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    joined = connected_components(links(classes.select("fp"), distance))
    rooted = classes.join(by_merge(joined), classes.fp == joined.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    lookup = rooted.join(by_merge(least), "root").select("fp", "component_id")
    return prints.join(by_merge(lookup), "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
