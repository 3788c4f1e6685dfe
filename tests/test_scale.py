"""How tables are dealt over tasks and joined: what decides memory and time on large ones."""

import pytest

from tidemark.operators.slices import dealt
from tidemark.plans import features, quality
from tidemark.plans.parity import parity_columns
from tidemark.queries import LABEL_KEY, feature_snapshot, feature_snapshot_joins, written
from tidemark.session import CLEANUP, scratch_path, write_parquet
from tidemark.sources.bank import WrittenBank


@pytest.fixture(scope="module")
def stored(bank):
    return WrittenBank(bank)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_follow_from_the_rows_that_will_be_made(spark):
    rows = spark.range(1000)
    assert dealt(rows, "id", 1000, 96, made_rows=2000).rdd.getNumPartitions() == 48
    assert dealt(rows, "id", 1000, 1).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_customers_of_one_file_are_many_tasks_before_their_months(spark, bank):
    tasks = spark.sparkContext.defaultParallelism
    for name in ("product_holdings_monthly", "active_months", "customer_churn_label"):
        assert bank.table(name).rdd.getNumPartitions() >= tasks
    held = bank.product_holdings_monthly.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)])
    assert max(held.collect()) < bank.product_holdings_monthly.count() / 2


def test_no_table_is_broadcast_on_the_size_of_its_file(stored):
    """A few MB of written labels are hundreds of millions of rows on the driver."""
    wanted = features.feature_snapshot(stored)
    assert "BroadcastHashJoin" not in plan(wanted)
    assert "BroadcastHashJoin" not in plan(feature_snapshot_joins(stored))
    compared = parity_columns(wanted, feature_snapshot_joins(stored), list(LABEL_KEY))
    assert "BroadcastHashJoin" not in plan(compared)


def test_tables_are_made_of_those_written_before(bank, stored):
    stored.customer_monthly_activity.count()
    made = bank.derived("card_monthly_snapshot", stored._tables)
    assert any("/customer_monthly_activity/" in f for f in made.inputFiles())
    assert made.exceptAll(bank.card_monthly_snapshot).isEmpty()


def shuffle_files(spark) -> set[str]:
    found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {name for name in names if name.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    """They stayed until the driver collected its garbage, those of all tables at once."""
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    rows = spark.range(10_000).selectExpr("id % 100 AS k").groupBy("k").count().repartition(3, "k")
    stored = write_parquet(rows, scratch_path(spark, "counts"))
    assert not {name for name in shuffle_files(spark) - before if name.endswith(".data")}
    assert spark.conf.get(CLEANUP, None) == setting
    assert stored.count() == 100


def test_a_feature_table_read_once_is_not_made_whole(spark, bank):
    base = WrittenBank(bank)
    once = base.but("churn_feature_snapshot")
    report = quality.leak_label_boundary(once)
    assert "Window" not in plan(report) and "churn_feature_snapshot" not in base._tables
    mismatches = quality.complaint_window_mismatches(once)
    assert "churn_feature_snapshot" not in base._tables
    whole = base.churn_feature_snapshot
    assert report.collect() == quality.leak_label_boundary(base).collect()
    assert mismatches.count() == quality.complaint_window_mismatches(base).count()
    assert once.churn_feature_snapshot.columns == whole.columns
    assert base.but("churn_feature_snapshot").churn_feature_snapshot.exceptAll(whole).isEmpty()


def test_the_feature_table_is_made_of_written_sources(bank):
    files = feature_snapshot(bank).inputFiles()
    assert any("/account_monthly_snapshot/" in f for f in files)
    assert written(written(bank)) is written(bank)
