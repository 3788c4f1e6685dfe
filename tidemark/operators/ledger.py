"""Account ledger: running balance, monthly account snapshot, primary account."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import month_floor, month_sequence
from tidemark.functions.money import exact_mean, money
from tidemark.operators.slices import TASK_ROWS, running_sums


def signed_amount():
    """Credits count up, everything else counts down."""
    amount = F.col("amount")
    return F.when(F.col("direction") == "Credit", amount).otherwise(-amount)


def running_balance(
    txns: DataFrame, openings: DataFrame, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Add balance_after_txn: opening balance plus signed amounts in (timestamp, id) order.

    Ordinary accounts need one shuffle on account_id, shared by the join and the window. Hot
    accounts are cut into slices and their opening balance is added to the offset of each slice.
    """
    summed = running_sums(
        txns, "account_id", ["txn_timestamp", "transaction_id"], {"moved": signed_amount()},
        openings.select("account_id", F.col("opening_balance").alias("moved")), task_rows,
    )
    return summed.select(*txns.columns, money(F.col("moved")).alias("balance_after_txn"))


def account_month_rollup(ledger: DataFrame) -> DataFrame:
    """Balances, counts and sums of each account and month that has transactions.

    The closing balance follows from the net amounts, so every aggregate here has a fixed-size
    buffer and the rows need no sorting.
    """
    credit = F.col("direction") == "Credit"
    n = F.count(F.lit(1))
    return ledger.groupBy("account_id", F.col("txn_month").alias("snapshot_month")).agg(
        F.sum(signed_amount()).alias("net"),
        exact_mean(F.sum("balance_after_txn"), n, 2).alias("mean_balance"),
        F.min("balance_after_txn").alias("min_balance"),
        F.max("balance_after_txn").alias("max_balance"),
        F.count_if(credit).alias("credits"),
        F.count_if(~credit).alias("debits"),
        F.sum(F.when(F.col("is_fee"), F.col("amount"))).alias("fees"),
        F.sum(F.when(F.col("is_salary_credit"), F.col("amount"))).alias("salary"),
    )


def account_calendar(
    accounts: DataFrame, openings: DataFrame, first: dt.date, n_months: int
) -> DataFrame:
    """One row per account and month it is open, with its status and opening balance."""
    months = accounts.join(openings, "account_id", "left").select(
        "account_id", "account_status", "open_date", "account_close_date",
        F.coalesce("opening_balance", F.lit(0).cast("decimal(18,2)")).alias("opening_balance"),
        F.explode(month_sequence(first, n_months)).alias("snapshot_month"),
    )
    opened = F.col("snapshot_month") >= month_floor(F.col("open_date"))
    closed = F.col("snapshot_month") > F.col("account_close_date")
    return months.filter(opened & ~F.coalesce(closed, F.lit(False))).select(
        "account_id", "snapshot_month", "account_status", "opening_balance"
    )


def account_snapshot(
    ledger: DataFrame, accounts: DataFrame, openings: DataFrame, first: dt.date, n_months: int
) -> DataFrame:
    """One row per account and month; a month without transactions carries the balance forward.

    The calendar and the rollup are stacked and regrouped by account, so filling the gaps and
    carrying forward share a single exchange.
    """
    calendar = account_calendar(accounts, openings, first, n_months)
    stacked = account_month_rollup(ledger).unionByName(calendar, allowMissingColumns=True)
    measures = [c for c in stacked.columns if c not in ("account_id", "snapshot_month")]
    monthly = (
        stacked.repartition("account_id")
        .groupBy("account_id", "snapshot_month")
        .agg(*[F.max(c).alias(c) for c in measures])
    )
    until_now = (
        Window.partitionBy("account_id")
        .orderBy("snapshot_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    moved = F.coalesce(F.sum("net").over(until_now), F.lit(0))
    filled = monthly.withColumn(
        "current_balance", money(F.col("opening_balance") + moved)
    ).filter(F.col("account_status").isNotNull())

    def or_current(column: str):
        return money(F.coalesce(F.col(column), F.col("current_balance")))

    def count(column: str):
        return F.coalesce(F.col(column), F.lit(0)).cast("int")

    return filled.select(
        "account_id",
        "snapshot_month",
        "current_balance",
        or_current("mean_balance").alias("average_monthly_balance"),
        or_current("min_balance").alias("min_balance_30d"),
        or_current("max_balance").alias("max_balance_30d"),
        count("credits").alias("deposit_count"),
        count("debits").alias("withdrawal_count"),
        count("debits").alias("debit_txn_count"),
        count("credits").alias("credit_txn_count"),
        money(F.coalesce("fees", F.lit(0))).alias("fee_charged_amount"),
        money(F.coalesce("salary", F.lit(0))).alias("salary_credit_amount"),
        "account_status",
    )


def primary_account(accounts: DataFrame) -> DataFrame:
    """Per customer the first active Savings account, else the first active account.

    A minimum over ordered structs combines map-side, so one customer with very many accounts
    costs no more than any other.
    """
    rank = F.struct(
        F.when(F.col("account_type") == "Savings", 0).otherwise(1).alias("preference"),
        "account_id", "account_type", "salary_account_flag", "overdraft_limit",
    )
    best = (
        accounts.filter(F.col("account_status") == "Active")
        .groupBy("customer_id")
        .agg(F.min(rank).alias("best"))
    )
    return best.select(
        "customer_id", "best.account_id", "best.account_type", "best.salary_account_flag",
        "best.overdraft_limit",
    )
