import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import month, rows
from tidemark.operators import ledger
from tidemark.operators.slices import dense_ranks, ordered_slices

TXN = ("account_id long, transaction_id long, txn_timestamp timestamp, txn_month date, "
       "direction string, amount decimal(18,2), is_fee boolean, is_salary_credit boolean")


def txn(account, id_, day, amount, direction="Debit", fee=False, salary=False):
    when = dt.datetime.combine(day, dt.time(9))
    return (account, id_, when, day.replace(day=1), direction, Decimal(amount), fee, salary)


def openings(spark, **balances):
    return spark.createDataFrame(
        [(int(k[1:]), Decimal(v)) for k, v in balances.items()],
        "account_id long, opening_balance decimal(18,2)")


def test_ties_are_ordered_by_id(spark):
    day = dt.date(2024, 1, 5)
    txns = spark.createDataFrame(
        [txn(1, 11, day, "30"), txn(1, 10, day, "50", "Credit"), txn(1, 9, dt.date(2024, 1, 6), "5"),
         txn(2, 12, day, "7")], TXN)
    out = ledger.running_balance(txns, openings(spark, a1="100"))
    got = {i: b for i, b in rows(out.select("transaction_id", "balance_after_txn"))}
    assert got == {10: Decimal("150.00"), 11: Decimal("120.00"), 9: Decimal("115.00"),
                   12: Decimal("-7.00")}


def test_hot_accounts_take_the_sliced_path_and_agree(spark, bank):
    """A third of all rows on one account, forced over many slices, equals a plain loop."""
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).alias("account_id"),
        F.col("id").alias("transaction_id"),
        F.expr("timestamp'2024-01-01' + make_interval(0,0,0,cast(id * 7 % 90 as int))")
        .alias("txn_timestamp"),
        F.lit(dt.date(2024, 1, 1)).alias("txn_month"),
        F.when(F.col("id") % 2 == 0, "Credit").otherwise("Debit").alias("direction"),
        ((F.col("id") * 37) % 101).cast("decimal(18,2)").alias("amount"),
    )
    opening = openings(spark, a1="1000", a2="5")
    sliced = ordered_slices(base.filter("account_id = 1"), ["account_id", "transaction_id"], 200)
    sizes = [n for _, n in rows(sliced.groupBy("slice_id").count())]
    assert len(sizes) >= 5 and max(sizes) < 500
    out = ledger.running_balance(base, opening, task_rows=200)
    got = {i: b for i, b in rows(out.select("transaction_id", "balance_after_txn"))}
    balances = {1: Decimal(1000), 2: Decimal(5)}
    expected = {}
    for r in sorted(base.collect(), key=lambda r: (r.txn_timestamp, r.transaction_id)):
        sign = 1 if r.direction == "Credit" else -1
        balances[r.account_id] = balances.get(r.account_id, Decimal(0)) + sign * r.amount
        expected[r.transaction_id] = balances[r.account_id]
    assert got == expected


def test_months_without_transactions_carry_the_balance(spark):
    txns = spark.createDataFrame(
        [txn(1, 1, dt.date(2024, 2, 3), "40", fee=True),
         txn(1, 2, dt.date(2024, 2, 9), "100", "Credit", salary=True)], TXN)
    accounts = spark.createDataFrame(
        [(1, "Active", dt.date(2023, 5, 9), None)],
        "account_id long, account_status string, open_date date, account_close_date date")
    opening = openings(spark, a1="500")
    balances = ledger.running_balance(txns, opening)
    snap = ledger.account_snapshot(balances, accounts, opening, month(1), 3)
    got = rows(snap.select("snapshot_month", "current_balance", "average_monthly_balance",
                           "min_balance_30d", "max_balance_30d", "debit_txn_count",
                           "fee_charged_amount", "salary_credit_amount"), "snapshot_month")
    d = Decimal
    assert got == [
        (month(1), d("500.00"), d("500.00"), d("500.00"), d("500.00"), 0, d("0.00"), d("0.00")),
        (month(2), d("560.00"), d("510.00"), d("460.00"), d("560.00"), 1, d("40.00"), d("100.00")),
        (month(3), d("560.00"), d("560.00"), d("560.00"), d("560.00"), 0, d("0.00"), d("0.00")),
    ]


def test_primary_account_prefers_active_savings(spark):
    accounts = spark.createDataFrame(
        [(1, 10, "Current", "Active"), (1, 11, "Savings", "Active"), (1, 12, "Savings", "Active"),
         (2, 20, "Savings", "Dormant"), (2, 21, "Current", "Active"), (3, 30, "Savings", "Closed")],
        "customer_id long, account_id long, account_type string, account_status string",
    ).withColumns({"salary_account_flag": F.lit(False), "overdraft_limit": F.lit(0)})
    got = rows(ledger.primary_account(accounts).select("customer_id", "account_id"), "customer_id")
    assert got == [(1, 11), (2, 21)]


def test_dense_ranks_cover_every_row_once(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 100_003).alias("k"))
    got = rows(dense_ranks(df, ["k"], "n", 100), "k")
    assert [n for _, n in got] == list(range(100, 5100))
