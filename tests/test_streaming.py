import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import queries as Q
from tidemark.operators.aggregates import activity_rollup
from tidemark.session import folder_names
from tidemark.streaming import balance, monthly
from tidemark.streaming.runs import RunStore

COLUMNS = ["transaction_id", "account_id", "customer_id", "txn_timestamp", "txn_month",
           "direction", "channel", "merchant_name", "amount"]


def arrive(bank, path, start, end):
    inside = (F.col("txn_month") >= F.lit(start)) & (F.col("txn_month") < F.lit(end))
    part = bank.txns.select(*COLUMNS).filter(inside)
    part.repartition(2, "account_id").write.mode("append").parquet(path)


def stream(spark, bank, path):
    return monthly.read_txn_stream(spark, path, bank.txns.select(*COLUMNS).schema, 2)


HALVES = [(dt.date(2024, 1, 1), dt.date(2025, 1, 1)), (dt.date(2025, 1, 1), dt.date(2026, 1, 1))]


# -- the store of runs -----------------------------------------------------------------------


def counter(spark, root, fan=3):
    schema = spark.range(1).selectExpr("id AS key", "id AS n").schema
    return RunStore(spark, root, schema, lambda df: df.groupBy("key").agg(F.sum("n").alias("n")), fan)


def put(spark, store, batch_id, n=1):
    store.append(spark.range(4).selectExpr("id AS key", f"{n}L AS n"), batch_id)


def test_runs_merge_like_digits_and_keep_every_row(spark, tmp_path):
    store = counter(spark, str(tmp_path / "runs"))
    for batch in range(29):
        put(spark, store, batch)
        assert {r.n for r in store.read().collect()} == {batch + 1}
        assert len(store.runs()) <= 3 * 4
    assert (0, 27) in store.runs()
    assert len(folder_names(spark, store.root)) == len(store.runs())
    assert {r.n for r in store.read(before=27).collect()} == {27}


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    store = counter(spark, str(tmp_path / "runs"))
    for batch in (0, 1, 2, 3, 3, 4, 4, 4, 5, 6, 6):
        put(spark, store, batch)
    assert {r.n for r in store.read().collect()} == {7}
    # A merged run without its mark was cut off by a failure: the parts still count.
    failed = tmp_path / "runs" / "batch-000000000003-span-000000000003"
    assert failed.exists()
    (failed / "_SUCCESS").unlink()
    assert {r.n for r in store.read(before=3).collect()} == {3}


def test_an_empty_store(spark, tmp_path):
    store = counter(spark, str(tmp_path / "nothing"))
    assert store.runs() == [] and store.read().count() == 0


# -- month sink ------------------------------------------------------------------------------


def test_month_sink_continues_and_equals_batch(spark, bank, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for start, end in HALVES:
        arrive(bank, source, start, end)
        monthly.stream_month_sink(stream(spark, bank, source), root)
    expected = activity_rollup(bank.txns)
    stored = monthly.monthly_activity(spark, root).select(*expected.columns)
    assert Q.sets.table_difference(stored, expected).isEmpty()
    one = stored.filter(F.col("snapshot_month") == F.lit(dt.date(2025, 3, 1)))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan


def test_a_batch_writes_its_own_rows_only(spark, bank, tmp_path):
    """The second batch touches months that hold much already and still adds one small run."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    bank.txns.select(*COLUMNS).coalesce(1).write.mode("append").parquet(source)
    monthly.stream_month_sink(stream(spark, bank, source), root)
    bank.txns.select(*COLUMNS).limit(10).coalesce(1).write.mode("append").parquet(source)
    monthly.stream_month_sink(stream(spark, bank, source), root)
    store = monthly.month_store(spark, root)
    assert len(store.runs()) == 2
    small = store._stacked(store.runs()[1:])
    assert small.agg(F.sum(F.col("debits") + F.col("credits"))).first()[0] == 10


# -- event-time rollup -----------------------------------------------------------------------


def test_activity_stream_equals_batch(spark, bank, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for start, end in HALVES:
        arrive(bank, source, start, end)
        got = monthly.stream_activity_rollup(stream(spark, bank, source), root, "800 days")
    expected = activity_rollup(bank.txns).select(*got.columns)
    assert Q.sets.table_difference(got, expected).isEmpty()
    assert monthly.late_rows(spark, root, bank.txns.select(*COLUMNS).schema).isEmpty()


def test_rows_beyond_the_delay_go_to_the_side_table(spark, bank, tmp_path):
    """The later half comes first: the rest of a year ago is late, row by row, and not counted."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for start, end in reversed(HALVES):
        arrive(bank, source, start, end)
        got = monthly.stream_activity_rollup(stream(spark, bank, source), root, "31 days")
    txns = bank.txns.select(*COLUMNS)
    late = monthly.late_rows(spark, root, txns.schema)
    newest = txns.agg(F.max("txn_timestamp")).first()[0]
    watermark = newest - dt.timedelta(days=31)
    first_half = txns.filter(F.col("txn_month") < F.lit(HALVES[1][0]))
    expected_late = first_half.filter(
        F.date_trunc("day", "txn_timestamp") + F.expr("INTERVAL 1 DAY") <= F.lit(watermark))
    assert Q.sets.table_difference(late.drop("batch_id"), expected_late).isEmpty()
    counted = txns.join(expected_late.select("transaction_id"), "transaction_id", "left_anti")
    assert Q.sets.table_difference(got, activity_rollup(counted).select(*got.columns)).isEmpty()


def test_state_and_versions_stay_bounded_over_many_batches(spark, bank, tmp_path):
    """One day a micro-batch, 104 of them: state holds the days of the delay, versions are merged."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    days, per_day = 104, 12
    at = F.timestamp_add("DAY", F.floor(F.col("id") / per_day).cast("int"), F.lit(dt.datetime(2024, 1, 1, 12)))
    table = spark.range(days * per_day).select(
        F.col("id").alias("transaction_id"), F.lit(1).cast("bigint").alias("account_id"),
        F.col("id").alias("customer_id") % per_day, at.alias("txn_timestamp"),
        F.trunc(at, "MM").alias("txn_month"), F.lit("Debit").alias("direction"),
        F.lit("UPI").alias("channel"), F.lit("m").alias("merchant_name"),
        F.lit(1).cast("decimal(18,2)").alias("amount"),
    ).toDF(*COLUMNS)
    table.repartitionByRange(days, "txn_timestamp").sortWithinPartitions("txn_timestamp").write.parquet(source)
    # Files are taken in the order of their times; on one clock tick their names decide.
    for number, part in enumerate(sorted((tmp_path / "in").glob("part-*"))):
        stamp = 1_700_000_000 + number
        os.utime(part, (stamp, stamp))
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = monthly.read_txn_stream(spark, source, table.schema, 1)
        last = monthly.keep_versions(one, root, "5 days")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    assert last["batchId"] >= 100
    state = last["stateOperators"][0]
    assert 0 < state["numRowsTotal"] <= 8 * per_day
    assert state["numRowsDroppedByWatermark"] == 0
    store = monthly.version_store(spark, root)
    assert len(store.runs()) <= 3 * 8 and len(folder_names(spark, store.root)) == len(store.runs())
    got = monthly.activity_of(monthly.summed_partials(store.read()))
    assert Q.sets.table_difference(got, activity_rollup(table).select(*got.columns)).isEmpty()


# -- balances --------------------------------------------------------------------------------


@pytest.mark.parametrize("task_rows", [5_000_000, 20])
def test_balances_carry_over_batches(spark, bank, tmp_path, task_rows):
    """Also with accounts that are too busy for one task."""
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for start, end in HALVES:
        arrive(bank, source, start, end)
        got = balance.stream_running_balance(
            stream(spark, bank, source), bank.account_openings, root, task_rows)
    expected = bank.transaction_fact.select("transaction_id", "account_id", "balance_after_txn")
    assert Q.sets.table_difference(got.drop("out_of_order"), expected).isEmpty()
    assert got.filter("out_of_order").isEmpty()


def test_rows_out_of_order_are_flagged(spark, bank, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for start, end in reversed(HALVES):
        arrive(bank, source, start, end)
        got = balance.stream_running_balance(
            stream(spark, bank, source), bank.account_openings, root)
    assert got.count() == bank.txns.count()
    late = got.filter("out_of_order").join(bank.txns, "transaction_id")
    assert late.count() > 0
    assert rows(late.filter(F.col("txn_month") >= F.lit(dt.date(2025, 1, 1)))) == []
    # Flagged rows are added where they arrive: the last balance is the sum of everything.
    carried = balance.carry_store(spark, root).read()
    signed = F.when(F.col("direction") == "Credit", F.col("amount")).otherwise(-F.col("amount"))
    totals = bank.txns.groupBy("account_id").agg((F.sum(signed) * 100).cast("bigint").alias("moved"))
    ends = carried.join(totals, "account_id").join(bank.account_openings, "account_id", "left")
    opening = (F.coalesce("opening_balance", F.lit(0)) * 100).cast("bigint")
    assert ends.filter(F.col("cents") != F.col("moved") + opening).isEmpty()
    assert carried.count() == totals.count()
