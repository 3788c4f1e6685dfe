import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import month, rows
from tidemark.operators import cards, loans, windows


def test_days_past_due_and_terminal_state(spark):
    paid = [1, 0, 0, 1, 0, 0, 0, 1]
    loan = spark.createDataFrame(
        [(1, 7, 100000.0, month(1), 12.0, 24, 4707.35)],
        "loan_id long, customer_id long, sanctioned_amount double, disbursement_date date, "
        "interest_rate double, tenure_months int, emi_amount double")
    facts = spark.createDataFrame(
        [(1, month(i + 1), bool(p)) for i, p in enumerate(paid)],
        "loan_id long, snapshot_month date, paid boolean")
    got = rows(loans.loan_dpd(loan, facts, month(1)), "snapshot_month")
    assert [r[5 + 1] for r in got] == [0, 30, 60, 0, 30, 60, 90, 90]
    assert [r[-1] for r in got][-3:] == ["Active", "Delinquent", "Delinquent"]
    balance = 100000.0
    for p, r in zip(paid, got):
        if p and r[-1] == "Active":
            balance -= 4707.35 - balance * 0.01
        assert abs(r[5] - balance) < 1e-6


def test_a_paid_off_loan_closes(spark):
    loan = spark.createDataFrame(
        [(1, 7, 1000.0, month(1), 0.0, 2, 500.0)],
        "loan_id long, customer_id long, sanctioned_amount double, disbursement_date date, "
        "interest_rate double, tenure_months int, emi_amount double")
    facts = spark.createDataFrame(
        [(1, month(i), True) for i in (1, 2, 3)], "loan_id long, snapshot_month date, paid boolean")
    got = rows(loans.loan_dpd(loan, facts, month(1)), "snapshot_month")
    assert [r[-1] for r in got] == ["Active", "Closed", "Closed"]
    schedule = rows(loans.loan_schedule(loan), "instalment")
    assert [(r[3], r[4]) for r in schedule] == [(500.0, 500.0), (500.0, 0.0)]


def test_card_balance(spark):
    months = spark.createDataFrame(
        [(1, month(1), 1000.0, "full", 2), (2, month(1), 1000.0, "min", 2),
         (3, month(1), 1000.0, "none", 2), (3, month(2), 0.0, "full", 0)],
        "card_id long, snapshot_month date, spend double, capacity string, txn_count long")
    got = {(r[0], r[1]): round(r[5], 6) for r in rows(cards.card_revolve(months))}
    assert got == {(1, month(1)): 0.0, (2, month(1)): 969.0, (3, month(1)): 1030.0,
                   (3, month(2)): 0.0}


def calendar(spark, ids, n):
    return windows.customer_calendar(
        spark.createDataFrame([(i,) for i in ids], "customer_id long"), month(1), n)


def test_leaky_counter(spark):
    fails = [1, 1, 1, 0, 1, 0, 0, 0]
    events = spark.createDataFrame(
        [(1, month(i + 1), "bank_service_failure") for i, f in enumerate(fails) if f],
        "customer_id long, event_month date, event_type string")
    got = rows(windows.service_failure_counter(calendar(spark, [1], 8), events), "snapshot_month")
    assert [r[2] for r in got] == [1, 2, 2, 1, 2, 1, 0, 0]


def test_salary_gap_only_counts_salary_accounts(spark):
    paid = spark.createDataFrame([(1, month(3)), (2, month(3))],
                                 "customer_id long, snapshot_month date")
    primary = spark.createDataFrame([(1, True), (2, False)],
                                    "customer_id long, salary_account_flag boolean")
    got = rows(windows.salary_gap_streak(calendar(spark, [1, 2, 3], 5), paid, primary),
               "customer_id", "snapshot_month")
    assert [r[2] for r in got] == [1, 2, 0, 1, 2] + [0] * 10


def test_trailing_complaints_include_both_ends(spark):
    filed = [month(2), month(3), month(8), month(9)]
    complaints = spark.createDataFrame([(1, m) for m in filed],
                                       "customer_id long, complaint_month date")
    got = dict((r[1], r[2]) for r in rows(
        windows.complaints_trailing(calendar(spark, [1], 10), complaints)))
    assert got[month(9)] == 3 and got[month(8)] == 3 and got[month(1)] == 0


def test_churn_month(spark):
    rows_in = [(1, month(i), i >= 3) for i in range(1, 6)] + [(2, month(i), False) for i in range(1, 6)]
    df = spark.createDataFrame(rows_in, "customer_id long, snapshot_month date, churned boolean")
    assert rows(windows.churn_month(df), "customer_id") == [(1, month(3), 3), (2, None, 5)]


def test_streak_matches_a_loop(spark):
    used = [(c, month(i)) for c in range(1, 8) for i in range(1, 13) if (c * i * 5) % 7 in (1, 2)]
    digital = spark.createDataFrame(used, "customer_id long, snapshot_month date").withColumns(
        {"mobile_app_active": F.lit(True), "web_sessions": F.lit(0)})
    got = {(r[0], r[1]): r[2] for r in rows(
        windows.digital_inactive_streak(calendar(spark, range(1, 8), 12), digital))}
    for c in range(1, 8):
        run = 0
        for i in range(1, 13):
            run = 0 if (c, month(i)) in used else run + 1
            assert got[(c, month(i))] == run


def test_counter_by_composed_steps_equals_a_loop(spark):
    """Any cap, histories longer than the calendar claims before the first month that counts."""
    import random

    draw = random.Random(4)
    hits = {c: [draw.random() < p for _ in range(37)] for c, p in enumerate((0.2, 0.5, 0.8, 1.0, 0.0))}
    table = spark.createDataFrame(
        [(c, m, h) for c, row in hits.items() for m, h in enumerate(row)],
        "customer_id long, month_idx int, hit boolean",
    )
    for cap in (1, 2, 5):
        got = {(r.customer_id, r.month_idx): r.level for r in windows.with_leaky_counter(
            table, F.col("hit"), "level", 37, cap).collect()}
        for c, row in hits.items():
            level = 0
            for m, hit in enumerate(row):
                level = min(cap, level + 1) if hit else max(0, level - 1)
                assert got[c, m] == level


def test_rows_after_the_churn_month_are_dropped(spark):
    table = spark.createDataFrame(
        [(c, month(m), churned) for c, m, churned in (
            (1, 1, False), (1, 2, True), (1, 3, False), (1, 4, True), (2, 1, False), (2, 2, None), (3, 1, True),
        )], "customer_id long, snapshot_month date, churned boolean",
    )
    kept = rows(windows.until_churn(table).select("customer_id", "snapshot_month"))
    assert kept == [(1, month(1)), (1, month(2)), (2, month(1)), (2, month(2)), (3, month(1))]
    got = {r.customer_id: (r.churn_month, r.active_months_generated)
           for r in windows.churn_month(table).collect()}
    assert got == {1: (month(2), 2), 2: (None, 2), 3: (month(1), 1)}
