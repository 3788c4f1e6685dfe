import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import month, rows
from tidemark.session import shared_dir
from tidemark.sources import jdbc, parquet_io
from tidemark.sources.bank import ParquetBank
from tidemark.sources.schemas import FOREIGN_KEYS, LOAD_ORDER, PARTITION_COLUMN


def feedback(bank):
    return bank.customer_feedback


def test_rewriting_a_month_replaces_only_that_month(spark, bank, tmp_path):
    root, name = str(tmp_path), "customer_feedback"
    assert parquet_io.write_month_partitions(feedback(bank), root, name)
    before = feedback(bank).count()
    changed = feedback(bank).filter(F.col("feedback_month") == F.lit(month(3))).limit(2)
    parquet_io.write_month_partitions(changed, root, name)
    stored = parquet_io.scan_month_partitions(spark, root, name)
    march = feedback(bank).filter(F.col("feedback_month") == F.lit(month(3))).count()
    assert stored.count() == before - march + 2
    folders = {p.name for p in (tmp_path / name).iterdir() if "=" in p.name}
    assert "feedback_month=2024-03-01" in folders


def test_month_bounds_prune_folders(spark, bank, tmp_path):
    parquet_io.write_month_partitions(feedback(bank), str(tmp_path), "customer_feedback")
    part = parquet_io.scan_month_partitions(
        spark, str(tmp_path), "customer_feedback", month(2), month(3))
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "feedback_month" in filters
    assert {r[0] for r in rows(part.select("feedback_month").distinct())} == {month(2), month(3)}


def test_empty_tables_replace_what_was_there(spark, bank, tmp_path):
    root = str(tmp_path)
    names = ("branch_master", "loan_master", "customer_feedback")
    assert parquet_io.write_bank(bank, root, names) == list(names)
    emptied = bank.replace(**{n: bank.table(n).limit(0) for n in names[1:]})
    assert parquet_io.write_bank(emptied, root, names) == ["branch_master"]
    stored = ParquetBank(spark, root)
    for name in names[1:]:
        assert stored.table(name).count() == 0
        assert stored.table(name).columns == parquet_io.read_table(spark, root, name).columns


def test_merge_writes_months_and_refuses_copies_that_differ(spark, bank, tmp_path):
    names = ("branch_master", "customer_feedback")
    roots = []
    for k in range(2):
        chunk = bank.replace(customer_feedback=bank.customer_feedback.filter(
            F.col("customer_id") % 2 == k))
        roots.append(str(tmp_path / f"part{k}"))
        parquet_io.write_bank(chunk, roots[-1], names)
    whole = str(tmp_path / "whole")
    assert parquet_io.write_merged(spark, roots, whole, names) == list(names)
    stored = ParquetBank(spark, whole)
    assert stored.branch_master.count() == bank.branch_master.count()
    assert stored.customer_feedback.count() == bank.customer_feedback.count()
    assert any("=" in p.name for p in (tmp_path / "whole" / "customer_feedback").iterdir())
    other = bank.replace(branch_master=bank.branch_master.withColumn("city", F.lit("elsewhere")))
    parquet_io.write_bank(other, roots[1], names[:1])
    with pytest.raises(Exception, match="differ"):
        parquet_io.merge_chunk_outputs(spark, roots, "branch_master", "branch_code").collect()


def test_chunks_merge_to_the_whole(spark, bank, tmp_path):
    names = ("branch_master", "customer_master", "customer_complaints")
    roots = []
    for k in range(3):
        chunk = bank.replace(**{
            n: bank.table(n).filter(F.col("customer_id") % 3 == k) for n in names[1:]})
        roots.append(str(tmp_path / f"chunk{k}"))
        assert parquet_io.write_bank(chunk, roots[-1], names) == list(names)
    for name in names:
        key = "branch_code" if name == "branch_master" else None
        merged = parquet_io.merge_chunk_outputs(spark, roots, name, key)
        assert merged.count() == bank.table(name).count()
    stored = ParquetBank(spark, roots[0])
    assert stored.customer_master.count() + 0 == rows(
        bank.customer_master.filter("customer_id % 3 = 0").agg(F.count("*")))[0][0]


def test_load_order_puts_parents_first():
    for child, _, parent in FOREIGN_KEYS:
        assert LOAD_ORDER.index(parent) < LOAD_ORDER.index(child)
    assert jdbc.load_order({"loan_master", "branch_master"}) == ["branch_master", "loan_master"]
    assert len(LOAD_ORDER) == 17 and len(PARTITION_COLUMN) == 11


def test_unreachable_database_skips_every_table(bank):
    got = rows(jdbc.jdbc_load(bank, "jdbc:nothing:none", names=("customer_master", "branch_master")),
               "load_position")
    assert [(r[1], r[2]) for r in got] == [("branch_master", "skipped"),
                                           ("customer_master", "skipped")]


def test_one_failing_table_does_not_stop_the_load(spark, bank, monkeypatch):
    monkeypatch.setattr(jdbc, "reachable", lambda *a: None)
    other = bank.replace(card_portfolio=bank.card_portfolio.limit(0))
    got = rows(jdbc.jdbc_load(other, "jdbc:nothing:none", names=("branch_master", "card_portfolio")))
    assert [(r[1], r[2]) for r in got] == [("branch_master", "failed"), ("card_portfolio", "empty")]


def test_shared_folder_is_the_configured_one(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before is None:
        assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    else:
        assert shared_dir(spark) == before


@pytest.mark.parametrize("value", ["it's", "back\\slash", None, True, 2, 0.5])
def test_inline_values_survive(spark, value):
    from tidemark.session import inline_table

    assert inline_table(spark, ("v",), [(value,)]).first()[0] == value


def test_dates_in_months(bank):
    assert bank.first_month == dt.date(2024, 1, 1)
    assert rows(bank.txns.filter(F.trunc("txn_date", "MM") != F.col("txn_month"))) == []
