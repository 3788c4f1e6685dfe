import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every):
    """By definition, all against all. Rows are (vec_id, v, label), ids distinct."""
    v = {i: np.floor(256 * np.array(x, float)).astype(np.int64) for i, x, _ in rows}
    label = {i: c for i, _, c in rows}
    out = []
    for a in sorted(label):
        if a % every:
            continue
        scores = sorted(((-int(v[a] @ v[b]), b) for b in label if b != a))
        for p, positive in [s for s in scores if label[s[1]] == label[a]][:5]:
            fit = [(-n, b) for n, b in scores if label[b] != label[a] and 30 * -p <= 100 * -n <= 90 * -p]
            out += [(a, positive, k + 1, b, -p, n) for k, (n, b) in enumerate(fit[:10])]
    return sorted(out)


def mined(table, every, **more):
    out = hard.mine(table, anchor=f"vec_id % {every} = 0", **more)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()))


def random_rows(n, d, labels, seed, decimals=None):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(labels, d))
    label = draw.integers(0, labels, n)
    x = centres[label] * 0.5 + draw.normal(size=(n, d)) * 0.4
    x = x if decimals is None else np.round(x, decimals)
    return [(k, x[k].tolist(), int(label[k])) for k in range(n)]


@pytest.mark.parametrize("n, d, labels, decimals", [(300, 6, 4, None), (400, 3, 3, 0), (120, 12, 60, None), (30, 2, 1, 0)])
def test_against_all_pairs(spark, monkeypatch, n, d, labels, decimals):
    """Small blocks and pages, so that many are chosen from; whole numbers give many ties."""
    monkeypatch.setattr(hard, "PAGE_BLOCKS", 4)
    rows = random_rows(n, d, labels, n + d, decimals)
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert mined(table, 10) == plain(rows, 10)


def test_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = [
        (r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in table.collect()
    ]
    assert mined(table, 20, label=moved) == plain(rows, 20)


def test_hilbert_curve_visits_neighbours():
    """All cells in order of their key: every step goes to a cell beside the last one."""
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
        key = hard.hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score():
    draw = np.random.default_rng(9)
    v, points = draw.integers(-50, 50, (20, 5)), draw.integers(-50, 50, (12, 30, 5))
    least, most = hard.score_bounds(v, points.min(axis=1), points.max(axis=1))
    scores = np.einsum("ad,bpd->abp", v, points)
    assert (least <= scores.min(axis=2)).all() and (scores.max(axis=2) <= most).all()


def test_zone_maps_leave_blocks_unread(spark):
    """In few dimensions most blocks are ruled out for most anchors."""
    rows = random_rows(4_000, 3, 2, 1)
    vectors = hard.integer_vectors(spark.createDataFrame(rows, SCHEMA), F.col("label"))
    blocks = hard.blocks_of(vectors, 50).toPandas()
    assert sum(blocks.n) == 4_000 and (blocks.label_low == blocks.label_high).mean() > 0.9
    low, high = np.stack(blocks.low), np.stack(blocks.high)
    v = np.floor(256 * np.array([x for _, x, _ in rows[:100]])).astype(int)
    _, most = hard.score_bounds(v, low, high)
    fifth = np.sort(v @ np.floor(256 * np.array([x for _, x, _ in rows])).astype(int).T, axis=1)[:, -5]
    assert (most >= fifth[:, None]).mean() < 0.25


def test_exact_products_beyond_doubles():
    a = np.array([[2 ** 23, 1], [2 ** 23 - 1, 3]]) * 8
    want = [[int(x[0]) * int(y[0]) + int(x[1]) * int(y[1]) for y in a] for x in a]
    assert hard.exact_products(a, a).tolist() == want


def test_copies_and_ties(spark):
    """A third of all rows is one vector; ties go to the smaller id."""
    rows = random_rows(150, 4, 3, 8)
    rows = [(i, rows[2][1] if i % 3 == 0 else x, c) for i, x, c in rows]
    assert mined(spark.createDataFrame(rows, SCHEMA), 10) == plain(rows, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = random_rows(60, 3, 2, 4)
    odd = [
        (100, None, 1), (110, [1.0, None, 0.0], 1), (120, [nan, 0.0, 0.0], 1), (130, [inf, 0.0, 0.0], 1),
        (140, [1e9, 0.0, 0.0], 1), (150, [1.0], 1), (160, [], 1), (170, [1.0, 1.0, 1.0], None),
        (None, [1.0, 1.0, 1.0], 1),
    ]
    names = ("anchors", "block", "low", "score", "v", "n", "page", "rank")
    table = spark.createDataFrame(good + odd, SCHEMA).withColumns({c: F.lit(1) for c in names})
    assert mined(table, 10) == plain(good, 10)
    assert hard.mine(table.where("vec_id < 0")).count() == 0
    assert hard.mine(table.where("vec_id = 0")).count() == 0


def test_repeated_rows(spark):
    """A repeated row counts twice as a candidate, never for its own id, and is one anchor."""
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.5, 0.0], 1), (2, [0.5, 0.0], 1)]
    out = mined(spark.createDataFrame(rows, SCHEMA), 10)
    assert out == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 2, 65536, 32768)]
