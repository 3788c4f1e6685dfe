"""Hard negatives for contrastive training, read from Hilbert-ordered blocks with zone maps.

Candidates are put in order of label and of their place on a Hilbert curve through the dimensions
that vary most, and written as Parquet rows of BLOCK_ROWS vectors each. A zone map keeps the range
of every dimension and of the label of each block. Interval arithmetic on an anchor and a zone map
bounds the scores that a block can hold, and an anchor reads only blocks whose bounds meet its
windows: first the most promising block of each page of zone maps, which shows how high the scores
it looks for are at least, then every block that can still hold as high a score inside a window.
The first search, for positives, has one window without ends among rows of the anchor's own label;
the second has one window per positive among rows of other labels.

Anchors travel in blocks too, so a pair of blocks is one product of matrices and what moves is a
block of anchors per page and per block it has to read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import store

UNIT = 256
# Components up to this size keep every score, times a hundred, inside 64 bits.
LARGEST = 2.0 ** 15
BLOCK_ROWS = 256
# Blocks of a page that the first round reads per window.
FIRST_BLOCKS = 16
PAGE_BLOCKS = 256
CURVE_DIMENSIONS = 8
CURVE_BITS = 7
LOW_PERCENT, HIGH_PERCENT = 30, 90
POSITIVES, NEGATIVES = 5, 10
LOWEST, HIGHEST = -(2 ** 62), 2 ** 62


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points on a grid of 2**bits cells a side, one row per point."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    # From the most significant bit down: undo the turn that each quadrant of the curve makes.
    side = 1 << (bits - 1)
    while side > 1:
        for i in range(n):
            upper = (x[i] & side) > 0
            swap = np.where(upper, 0, (x[0] ^ x[i]) & (side - 1))
            x[0] = np.where(upper, x[0] ^ (side - 1), x[0] ^ swap)
            x[i] ^= swap
        side >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    side = 1 << (bits - 1)
    while side > 1:
        turn = np.where(x[n - 1] & side, turn ^ (side - 1), turn)
        side >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def integer_vectors(df: DataFrame, label: Column, id_col="vec_id", vector_col="embedding"):
    """(vec_id, label, v): components as floor(256 x).

    Rows take no part whose label, id or vector is null, whose vector is empty or holds null or
    non-finite components or one beyond 2**15 in size (no score would be sure to fit), or whose
    vector has another length than the commonest. Repeated rows count each.
    """
    v = F.col(vector_col).cast("array<double>")
    good = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))
    rows = df.select(
        F.col(id_col).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), v.alias("v")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & good)
    rows = rows.withColumn("v", F.transform("v", lambda c: F.floor(c * UNIT).cast("int")))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (sizes.d if sizes else 0))


def _matrix(column, d: int | None = None) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, d or 0), np.int32)


def with_curve(vectors: DataFrame) -> DataFrame:
    """Add `curve`: the place of v on a Hilbert curve through the dimensions of most variance."""
    spread = vectors.select(F.posexplode("v").alias("i", "c")).groupBy("i").agg(
        F.variance("c").alias("variance"), F.min("c").alias("low"), F.max("c").alias("high")
    ).orderBy(F.desc_nulls_last("variance"), "i").limit(CURVE_DIMENSIONS).collect()
    chosen = [r.i for r in spread]
    low = np.array([r.low for r in spread], float)
    width = np.maximum(np.array([r.high for r in spread], float) - low + 1, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = ((_matrix(batch.column("v"), len(chosen))[:, chosen] - low) / width * (1 << CURVE_BITS)) \
                if batch.num_rows else np.zeros((0, len(chosen)))
            key = pa.array(hilbert_key(cells, CURVE_BITS))
            yield pa.RecordBatch.from_arrays([*batch.columns, key], [*batch.schema.names, "curve"])

    return vectors.mapInArrow(run, "vec_id bigint, label bigint, v array<int>, curve bigint")


BLOCKS = (
    "block bigint, n int, label_low bigint, label_high bigint, low array<int>, high array<int>, "
    "ids array<bigint>, labels array<bigint>, vectors array<int>"
)


def blocks_of(vectors: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of up to `rows` vectors next to each other on the curve, with their zone maps.

    Ordered by label first, so that most blocks hold one label; copies of one vector are cut into
    as many blocks as they fill, and spread over partitions by their ids.
    """
    order = ["label", "curve", "vec_id"]
    laid = with_curve(vectors).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, []

        def packed(part: pa.Table) -> pa.RecordBatch:
            nonlocal number
            v = _matrix(part.column("v").combine_chunks())
            ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
            place, number = part.column("place")[0].as_py() * (1 << 32) + number, number + 1
            return pa.RecordBatch.from_pydict({
                "block": pa.array([place]), "n": pa.array([len(ids)], pa.int32()),
                "label_low": [labels.min()], "label_high": [labels.max()],
                "low": pa.array([v.min(axis=0)], pa.list_(pa.int32())),
                "high": pa.array([v.max(axis=0)], pa.list_(pa.int32())),
                "ids": [ids], "labels": [labels],
                "vectors": pa.array([v.ravel()], pa.list_(pa.int32())),
            })

        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= rows:
                table = pa.Table.from_batches(held)
                full = count - count % rows
                for at in range(0, full, rows):
                    yield packed(table.slice(at, rows))
                table = table.slice(full)
                held, count = table.to_batches(), table.num_rows
        if count:
            yield packed(pa.Table.from_batches(held))

    laid = laid.select("vec_id", "label", "v", F.spark_partition_id().alias("place"))
    return laid.mapInArrow(run, BLOCKS)


def pages_of(blocks: DataFrame, n_pages: int) -> DataFrame:
    """Zone maps dealt by a hash to pages of about PAGE_BLOCKS: one flat array per range."""
    zone = F.struct("block", "label_low", "label_high", "low", "high")
    dealt = blocks.groupBy(F.pmod(F.xxhash64("block"), F.lit(n_pages)).cast("int").alias("page")).agg(
        F.collect_list(zone).alias("zones")
    )
    return dealt.select("page", *[
        (F.flatten(f"zones.{c}") if c in ("low", "high") else F.col(f"zones.{c}")).alias(f"zone_{c}")
        for c in ("block", "label_low", "label_high", "low", "high")
    ])


def score_bounds(v: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each vector (row) with a point of each box (row)."""
    up, down = np.maximum(v, 0).astype(float), np.minimum(v, 0).astype(float)
    low, high = low.T.astype(float), high.T.astype(float)
    return up @ low + down @ high, up @ high + down @ low


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows; in floating point while every sum is exact there."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2 ** 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def _cell(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    """One array cell of a batch."""
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


class Asked:
    """A block of anchors: ids, labels, vectors, and windows (owner, low, high, k-th best so far)."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.ids, self.labels = _cell(batch, "ids", row), _cell(batch, "labels", row)
        self.v = _cell(batch, "vectors", row).astype(np.int64).reshape(len(self.ids), -1)
        self.owner, self.low, self.high, self.best = (
            _cell(batch, c, row) for c in ("owner", "window_low", "window_high", "best")
        )


def chosen_blocks(asked: Asked, low, high, label_low, label_high, same_label: bool, first: bool):
    """(window, zone) places that must be read: the most promising zones per window, or all that can
    hold a score inside the window and no lower than the best so far.

    Most promising are those whose middle scores nearest to the upper end of the window."""
    least, most = score_bounds(asked.v, low, high)
    label = asked.labels[:, None]
    if same_label:
        fits = (label_low <= label) & (label <= label_high)
    else:
        fits = (label_low != label) | (label_high != label)
    least, most, fits = least[asked.owner], most[asked.owner], fits[asked.owner]
    floor = np.maximum(asked.low, asked.best)[:, None]
    fits &= (most >= floor) & (least <= asked.high[:, None])
    if not first:
        return np.nonzero(fits)
    off = np.where(fits, np.abs((least + most) / 2 - asked.high[:, None]), np.inf)
    nearest = np.argsort(off, axis=1, kind="stable")[:, :FIRST_BLOCKS]
    window, place = np.nonzero(np.take_along_axis(fits, nearest, axis=1))
    return window, nearest[window, place]


def best_rows(asked: Asked, windows: np.ndarray, ids, labels, v, same_label: bool, k: int):
    """Columns FOUND: the k best rows of a block in each of the windows."""
    anchors, place = np.unique(asked.owner[windows], return_inverse=True)
    scores = exact_products(asked.v[anchors], v)
    equal = asked.labels[anchors][:, None] == labels[None, :]
    fits = equal & (asked.ids[anchors][:, None] != ids[None, :]) if same_label else ~equal
    for window, row in zip(windows, place):
        score = scores[row]
        floor = max(asked.low[window], asked.best[window])
        at = np.flatnonzero(fits[row] & (score >= floor) & (score <= asked.high[window]))
        at = at[np.lexsort((ids[at], -score[at]))[:k]]
        yield (
            np.full(len(at), asked.ids[asked.owner[window]]), np.full(len(at), asked.low[window]),
            np.full(len(at), asked.high[window]), ids[at], score[at],
        )


FOUND = ("anchor_id", "low", "high", "vec_id", "score")
ASKED = ("anchors", "ids", "labels", "vectors", "owner", "window_low", "window_high", "best")


def _packed(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """Blocks of anchors with their windows; those without a window are left out.

    `anchors`: (anchors, vec_id, label, v); `windows`: (anchor_id, low, high, best), few per anchor.
    """
    own = windows.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("low", "high", "best"))).alias("w")
    )
    rows = anchors.join(own, "vec_id").groupBy("anchors").agg(
        F.collect_list(F.struct("vec_id", "label", "v", "w")).alias("rows")
    )
    each = F.flatten("rows.w")
    owner = F.flatten(F.transform("rows", lambda r, i: F.transform(r["w"], lambda w: i)))
    return store(rows.select(
        "anchors", F.col("rows.vec_id").alias("ids"), F.col("rows.label").alias("labels"),
        F.flatten("rows.v").alias("vectors"), owner.alias("owner"), each["low"].alias("window_low"),
        each["high"].alias("window_high"), each["best"].alias("best"),
    ), "anchor-blocks")


def _read(asked: DataFrame, blocks: DataFrame, pages: DataFrame, n_pages: int, same_label, k, first):
    """The k best rows of every block that is read, per window: columns FOUND.

    Every block of anchors sees every page of zone maps; a block of candidates meets only the
    blocks of anchors with a window that has to read it.
    """
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                zones = _cell(batch, "zone_block", row)
                low, high = (
                    _cell(batch, c, row).reshape(len(zones), -1) for c in ("zone_low", "zone_high")
                )
                window, zone = chosen_blocks(
                    Asked(batch, row), low, high, _cell(batch, "zone_label_low", row),
                    _cell(batch, "zone_label_high", row), same_label, first,
                )
                order = np.argsort(zone, kind="stable")
                window, zone = window[order], zone[order]
                edges = np.flatnonzero(np.diff(zone, prepend=-1))
                if len(edges):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([batch.column("anchors")[row].as_py()] * len(edges), pa.int64()),
                        pa.array(zones[zone[edges]], pa.int64()),
                        pa.array(np.split(window, edges[1:]), pa.list_(pa.int64())),
                    ], ["anchors", "block", "chosen"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = _cell(batch, "block_ids", row), _cell(batch, "block_labels", row)
                v = _cell(batch, "block_vectors", row).astype(np.int64).reshape(len(ids), -1)
                found = best_rows(
                    Asked(batch, row), _cell(batch, "chosen", row), ids, labels, v, same_label, k
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)], list(FOUND)
                )

    spread = asked.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1))))
    chosen = spread.join(pages, "page").mapInArrow(
        choose, "anchors bigint, block bigint, chosen array<bigint>"
    )
    contents = blocks.select(
        "block", *[F.col(c).alias(f"block_{c}") for c in ("ids", "labels", "vectors")]
    )
    return chosen.join(asked, "anchors").join(contents, "block").mapInArrow(
        answer, ", ".join(f"{c} bigint" for c in FOUND)
    )


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best per window with their rank."""
    best = Window.partitionBy("anchor_id", "low", "high").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(anchors: DataFrame, windows: DataFrame, blocks: DataFrame, same_label: bool, k: int) -> DataFrame:
    """(anchor_id, low, high, vec_id, score, rank): the k best rows in each window of each anchor.

    `anchors` is (anchors, vec_id, label, v) with one row per id, `windows` is (anchor_id, low,
    high), `blocks` the candidates. Exact: the k-th best score found in the first round only rules
    out blocks that cannot reach it.
    """
    n_pages = max(1, -(-blocks.count() // PAGE_BLOCKS))
    pages = store(pages_of(blocks, n_pages), "zone-pages")
    asked = _packed(anchors, windows.withColumn("best", F.lit(LOWEST)))
    begun = _ranked(_read(asked, blocks, pages, n_pages, same_label, k, True), k)
    reached = begun.where(F.col("rank") == k).select(
        "anchor_id", "low", "high", F.col("score").alias("best")
    )
    known = windows.join(reached, ["anchor_id", "low", "high"], "left").fillna(LOWEST, ["best"])
    asked = _packed(anchors, known)
    return _ranked(_read(asked, blocks, pages, n_pages, same_label, k, False), k)


def _anchor_rows(blocks: DataFrame) -> DataFrame:
    """(anchors, vec_id, label, v) from blocks of anchors."""
    size = (F.size("vectors") / F.size("ids")).cast("int")
    return blocks.select(
        F.col("block").alias("anchors"), F.posexplode("ids").alias("at", "vec_id"),
        "labels", "vectors", size.alias("d"),
    ).select(
        "anchors", "vec_id", F.get("labels", F.col("at")).alias("label"),
        F.slice("vectors", F.col("at") * F.col("d") + 1, F.col("d")).alias("v"),
    )


def mine(
    df: DataFrame, label: Column | str = "label", anchor: Column | str = "vec_id % 100 = 0",
    positives: int = POSITIVES, negatives: int = NEGATIVES, id_col="vec_id", vector_col="embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `anchor` says by vec_id which rows are anchors. Rows left out are those of `integer_vectors`.
    A row is no partner of its own id. Of rows that share an anchor's id the one that is least in
    label and vector is the anchor; as candidates all of them count. A positive without a negative
    in its window gives no row, and so does an empty table.
    """
    label = F.col(label) if isinstance(label, str) else label
    vectors = store(integer_vectors(df, label, id_col, vector_col), "integer-vectors")
    blocks = store(blocks_of(vectors), "candidate-blocks")
    chosen = vectors.where(anchor).groupBy("vec_id").agg(F.min_by(
        F.struct("label", "v"), F.struct("label", "v")
    ).alias("row")).select("vec_id", "row.label", "row.v")
    anchors = store(_anchor_rows(blocks_of(chosen)), "anchors")
    everywhere = anchors.select(
        F.col("vec_id").alias("anchor_id"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high")
    )
    found = search(anchors, everywhere, blocks, True, positives)
    # 30 p <= 100 n <= 90 p, with whole n; a negative p leaves no room.
    pairs = store(found.select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.expr(f"(score * {LOW_PERCENT} + 99) div 100").alias("low"),
        F.expr(f"score * {HIGH_PERCENT} div 100").alias("high"),
    ).where("positive_score >= 0 AND low <= high"), "positives")
    inside = search(anchors, pairs.select("anchor_id", "low", "high").distinct(), blocks, False, negatives)
    return pairs.join(inside, ["anchor_id", "low", "high"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
