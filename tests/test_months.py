"""Quiet months, held cards, months around the calendar and independent draws."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import month, rows
from tidemark.functions.hashing import uniform_millionths
from tidemark.operators import aggregates, windows

TXN = (
    "customer_id long, txn_month date, txn_date date, direction string, channel string, "
    "amount decimal(18,2), merchant_name string"
)


def test_quiet_months_keep_rows_and_carry_dates(spark):
    txns = spark.sql("""SELECT 1L AS customer_id, DATE'2024-02-01' AS txn_month,
        DATE'2024-02-10' AS txn_date, 'Debit' AS direction, 'UPI' AS channel,
        CAST(5 AS DECIMAL(18,2)) AS amount, 'm' AS merchant_name""")
    active = spark.createDataFrame([(1, month(n)) for n in range(1, 7)],
                                   "customer_id long, snapshot_month date")
    table = aggregates.activity_table(txns, active)
    got = rows(table.select("snapshot_month", "debit_txn_count", "login_count",
                            "days_since_last_txn", "days_since_last_login"), "snapshot_month")
    ends = [dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2024, 4, 30),
            dt.date(2024, 5, 31), dt.date(2024, 6, 30)]
    since = [(end - dt.date(2024, 2, 10)).days for end in ends]
    assert got[0] == (month(1), 0, 0, 180, 180)
    assert [g[1:] for g in got[1:]] == [(1, 1, since[0], since[0])] + [(0, 0, d, d) for d in since[1:]]
    assert since[3] == 111
    last = rows(aggregates.digital_table(txns, active).select("snapshot_month", "last_login_date"),
                "snapshot_month")
    assert [d for _, d in last] == [None] + [dt.date(2024, 2, 10)] * 5


def test_dormancy_takes_values_between_a_month_and_the_default(bank):
    days = bank.customer_monthly_activity.select("days_since_last_txn")
    assert days.filter("days_since_last_txn BETWEEN 32 AND 179").count() > 0


def test_every_month_a_card_is_held_has_a_row(bank):
    held = bank.card_portfolio.select("card_id", "customer_id").join(
        bank.active_months, "customer_id")
    assert bank.card_monthly_snapshot.count() == held.count()
    unpaid = bank.card_months.filter("capacity = 'none' AND txn_count = 0")
    assert unpaid.count() > 0


def test_complaints_before_the_calendar_count(spark):
    calendar = spark.createDataFrame([(1, month(1)), (1, month(2))],
                                     "customer_id long, snapshot_month date")
    complaints = spark.createDataFrame(
        [(1, dt.date(2023, 7, 1)), (1, dt.date(2023, 12, 1)), (1, month(2))],
        "customer_id long, complaint_month date")
    got = rows(windows.complaints_trailing(calendar, complaints), "snapshot_month")
    assert [n for _, _, n in got] == [2, 2]


def test_draws_of_neighbouring_seeds_are_independent(spark):
    keys = spark.range(60_000).select(*[
        (uniform_millionths(F.col("id"), seed) < 125_000).cast("int").alias(f"s{seed}")
        for seed in (42, 43, 44)
    ])
    for a, b in (("s42", "s43"), ("s43", "s44"), ("s42", "s44")):
        for value in (0, 1):
            share = keys.filter(F.col(a) == value).agg(F.avg(b)).first()[0]
            assert abs(share - 0.125) < 0.01
