import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def scatter(x):
    return (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))


def assert_spectrum(found, x):
    count, mean, poles, basis = found
    want = scatter(x)
    assert count == len(x)
    np.testing.assert_allclose(mean, x.mean(axis=0), rtol=1e-12, atol=1e-12)
    assert np.abs(basis.T @ basis - np.eye(len(basis))).max() < 1e-12
    assert np.abs(basis @ np.diag(poles) @ basis.T - want).max() <= 1e-11 * max(np.abs(want).max(), 1)


@pytest.mark.parametrize("rows, d, kinds", [
    (1, 4, 1), (2, 4, 2), (3, 8, 3), (300, 12, 300), (300, 12, 5), (40, 30, 40), (500, 1, 500), (200, 6, 1),
])
def test_spectrum_of_a_partition(rows, d, kinds):
    """Few kinds of rows: the scatter lacks rank, so most poles coincide at zero."""
    random = np.random.default_rng(rows + d)
    x = np.floor(random.normal(size=(kinds, d)) * np.linspace(1, 60, d))[random.integers(0, kinds, rows)]
    x = x + 1_000_000
    assert_spectrum(whitening.spectrum_of(iter(np.array_split(x, 3)), d), x)


def test_equal_poles_and_grid_data():
    """Many symmetric directions give poles that are equal without being zero."""
    x = np.vstack([np.eye(6), -np.eye(6)] * 20) * 16
    assert_spectrum(whitening.spectrum_of(iter([x[:100], x[100:]]), 6), x)
    grown = whitening.Spectra(1, 6)
    for row in x:  # one at a time, so nothing is counted together
        grown.add_rows(row[None], np.ones(1))
    assert_spectrum(grown.lane(0), x)


def test_combining_spectra():
    random = np.random.default_rng(2)
    x = np.floor(random.normal(size=(90, 7)) * 50)
    parts = [whitening.spectrum_of(iter([p]), 7) for p in np.array_split(x, 5)]
    assert_spectrum(whitening.combined(parts).lane(0), x)


def plain(vectors):
    """x, eigenvalues and vectors by a dense solver."""
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    values, basis = np.linalg.eigh(scatter(x) / len(x))
    return x, values[::-1], basis[:, ::-1]


def assert_rows(out, ids, vectors, components):
    x, values, basis = plain(vectors)
    n = len(x)
    got = out.orderBy("vec_id", "component").toPandas()
    assert len(got) == n * min(components, x.shape[1]) and (got.n == n).all()
    by_id = {i: row for i, row in zip(ids, x)}
    total = [sum(int(v) for v in column) for column in x.T]
    for vec_id, part in got.groupby("vec_id"):
        row = by_id[vec_id]
        assert set(part.deviation) == {sum((n * int(v) - s) ** 2 for v, s in zip(row, total))}
        assert list(part.component) == list(range(1, len(part) + 1))
        want = (row - x.mean(axis=0)) @ basis[:, :components] / np.sqrt(values[:components])
        np.testing.assert_allclose(np.abs(part.whitened), np.abs(want), rtol=1e-7, atol=1e-9)
        np.testing.assert_allclose(part.explained, values[:components] / values.sum(), rtol=1e-9)
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    covariance = (w - w.mean(axis=0)).T @ (w - w.mean(axis=0)) / n
    error = np.abs(covariance - np.eye(w.shape[1])).max()
    assert got.identity_error.nunique() == 1 and error < 1e-9 and got.identity_error[0] < 1e-9


def test_rows_against_a_dense_solver(spark):
    random = np.random.default_rng(4)
    vectors = (random.normal(size=(400, 10)) * np.linspace(0.1, 3, 10)).tolist()
    table = spark.createDataFrame([(k, v, 0) for k, v in enumerate(vectors)], SCHEMA)
    assert_rows(whitening.whitening(table.repartition(23), 6), range(400), vectors, 6)


def test_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    assert_rows(whitening.whitening(table), [r.vec_id for r in rows], [r.embedding for r in rows], 32)


def test_dealing_does_not_matter(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    a, b = (
        whitening.whitening(table.repartition(n, F.rand(n)), 8).orderBy("vec_id", "component").toPandas()
        for n in (1, 29)
    )
    np.testing.assert_allclose(a.whitened, b.whitened, rtol=1e-6, atol=1e-9)


def test_odd_rows(spark):
    """Nulls, non-finite and huge entries, other lengths and null vectors are left out; repeats stay."""
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [2.0, -1.0], [0.0, 0.5], [1.0, 2.0]]
    rows = [(k, v, None) for k, v in enumerate(good)] + [
        (None, [4.0, 4.0], 1), (7, None, 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1),
        (11, [1e300, 1.0], 1), (12, [1.0], 1), (13, [], 1), (3, [1.0, 2.0], 1),
    ]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("x", "component", "n", "place")})
    out = whitening.whitening(table)
    kept = sorted((r.vec_id is None, r.vec_id or 0) for r in out.where("component = 1").collect())
    assert kept == [(False, 0), (False, 1), (False, 2), (False, 3), (False, 3), (True, 0)]
    assert {r.n for r in out.select("n").collect()} == {6} and out.count() == 12
    assert out.first().identity_error < 1e-9


def test_no_variance_one_row_no_rows(spark):
    same = spark.createDataFrame([(k, [3.0, 4.0, 5.0], 0) for k in range(9)], SCHEMA)
    for table, n in ((same, 9), (same.where("vec_id = 1"), 1)):
        out = whitening.whitening(table).collect()
        assert len(out) == 3 * n
        assert {(r.whitened, r.explained, r.deviation, r.identity_error) for r in out} == {(0.0, 0.0, 0, 0.0)}
    assert whitening.whitening(same.where("vec_id < 0")).count() == 0


def test_deviation_beyond_64_bits(spark):
    rows = [(0, [2.0 ** 40, 0.0], 0), (1, [-(2.0 ** 40), 1.0], 0), (2, [0.0, 0.0], 0)]
    out = whitening.whitening(spark.createDataFrame(rows, SCHEMA)).where("component = 1").collect()
    x = {0: (2 ** 46, 0), 1: (-(2 ** 46), 64), 2: (0, 0)}
    want = {k: sum((3 * v - s) ** 2 for v, s in zip(row, (0, 64))) for k, row in x.items()}
    assert {r.vec_id: int(r.deviation_exact) for r in out} == want
    assert {r.vec_id: r.deviation for r in out} == {0: None, 1: None, 2: want[2]}
