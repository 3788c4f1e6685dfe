import numpy as np
from pyspark.sql import functions as F

from tests.conftest import month, rows
from tidemark.operators import joins, sets
from tidemark.plans import parity


def values(spark, **metrics):
    data = [(m, float(v)) for m, vs in metrics.items() for v in vs]
    return spark.createDataFrame(data, "metric string, value double")


def ks(a, b):
    points = np.concatenate([a, b])
    left = np.searchsorted(np.sort(a), points, side="right") / len(a)
    right = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return float(np.max(np.abs(left - right)))


def test_ks_statistic(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 40, 700), rng.integers(5, 50, 400)
    left = values(spark, annual_income=a, final_balance=[1, 1, 2], txn_count=[1, 2])
    right = values(spark, annual_income=b, final_balance=[1, 2, 1], txn_count=[8, 9])
    got = {r[0]: (r[1], r[2]) for r in rows(parity.parity_ks(left, right))}
    assert got["annual_income"] == (round(ks(a, b), 10), False)
    assert got["final_balance"] == (0.0, True)
    assert got["txn_count"] == (1.0, False)
    empty = rows(parity.parity_ks(values(spark, annual_income=[1, 2]), left.limit(0)))
    assert empty == [("annual_income", 1.0, False)]


def test_ks_statistic_of_many_values_and_few_ranges(spark):
    """The largest gap lies inside a range, at an end, or in a range of one heavy value."""
    rng = np.random.default_rng(8)
    cases = {
        "annual_income": (rng.normal(0, 1, 3_000), rng.normal(0.1, 1.2, 2_000)),
        "final_balance": (rng.normal(0, 1, 900), np.append(np.zeros(700), rng.normal(0, 1, 200))),
        "txn_count": (rng.integers(0, 9, 500), rng.integers(0, 9, 500)),
    }
    left = values(spark, **{m: a for m, (a, _) in cases.items()})
    right = values(spark, **{m: b for m, (_, b) in cases.items()})
    for ranges in (2, 5, 64):
        got = {r[0]: r[1] for r in rows(parity.parity_ks(left, right, ranges))}
        assert got == {m: round(ks(a, b), 10) for m, (a, b) in cases.items()}


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert rows(joins.orphans(child, "k", parent, "id")) == [(2, 2)]


def test_table_difference_counts_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k long, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k long, v string")
    assert rows(sets.table_difference(a, a)) == []
    assert sorted(rows(sets.table_difference(a, b)), key=str) == [(1, None, 1), (3, "y", -1)]


def test_disjoint_union_and_keep_first(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "k long, t string")
    b = spark.createDataFrame([(2, "b"), (3, "b")], "k long, t string")
    assert rows(sets.disjoint_union(a, b, ["k"]), "k") == [(1, "a"), (2, "a"), (3, "b")]
    df = spark.createDataFrame([(1, 5, "x"), (1, 2, "y"), (2, 9, "z")], "k long, p int, v string")
    assert rows(sets.keep_first(df, ["k"], ["p"]), "k") == [(1, 2, "y"), (2, 9, "z")]


def test_weighted_assignment_gives_every_row_one_choice(spark):
    customers = spark.range(20_000).withColumnRenamed("id", "customer_id")
    branches = spark.createDataFrame([("a", 1), ("b", 3)], "branch string, weight int")
    out = sets.weighted_assignment(customers, "customer_id", branches, "branch", "weight", 5)
    counts = dict(rows(out.groupBy("branch").count()))
    assert sum(counts.values()) == 20_000 and abs(counts["b"] / 20_000 - 0.75) < 0.02


def test_next_event_is_strictly_later(spark):
    df = spark.createDataFrame([(1, month(2)), (1, month(5)), (2, month(1))],
                               "customer_id long, m date")
    events = spark.createDataFrame(
        [(1, month(2), "e"), (1, month(4), "e"), (1, month(5), "e"), (2, month(9), "other")],
        "customer_id long, event_month date, event_type string")
    got = rows(joins.first_event_after(df, "m", events, "e"), "customer_id", "m")
    assert got == [(1, month(2), month(4)), (1, month(5), None), (2, month(1), None)]


def test_parity_columns_tolerates_small_differences(spark):
    a = spark.createDataFrame([(1, 1.0, "x", None), (2, 2.0, "y", 3.0), (3, 1.0, "z", 1.0)],
                              "k long, v double, s string, w double")
    b = spark.createDataFrame([(1, 1.0001, "x", None), (2, 2.01, None, None), (4, 1.0, "z", 1.0)],
                              "k long, v double, s string, w double")
    got = dict(rows(parity.parity_columns(a, b, ["k"])))
    assert got == {"unmatched_rows": 2, "v": 1, "s": 1, "w": 1}


def test_row_counts(spark, bank):
    half = bank.replace(customer_master=bank.customer_master.filter("customer_id % 4 <> 0"))
    got = rows(parity.parity_row_counts(bank, half, ("customer_master", "loan_master")), "table_name")
    assert got[0][4] == (got[0][3] <= 0.25) and 0.2 < got[0][3] < 0.3
    assert got[1][3] == 0.0 and got[1][4]
