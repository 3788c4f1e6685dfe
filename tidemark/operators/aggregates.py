"""Grouped aggregates over transactions, snapshots, complaints and state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.money import exact_mean, money

CUSTOMER_MONTH = ("customer_id", "snapshot_month")


def products_count() -> Column:
    """Number of product flags set."""
    total = F.lit(0)
    for name in K.PRODUCT_FLAGS:
        total = total + F.col(name).cast("int")
    return total.cast("int")


def customer_month_balance(snapshots: DataFrame, accounts: DataFrame) -> DataFrame:
    """Mean balance over the accounts of a customer, per month."""
    owned = snapshots.join(accounts.select("account_id", "customer_id"), "account_id")
    total, n = F.sum("current_balance"), F.count("current_balance")
    return owned.groupBy(*CUSTOMER_MONTH).agg(
        (total.cast("double") / n.cast("double")).alias("avg_bal")
    )


def customer_month_emi(snapshots: DataFrame, loans: DataFrame) -> DataFrame:
    owned = snapshots.join(loans.select("loan_id", "customer_id"), "loan_id")
    return owned.groupBy(*CUSTOMER_MONTH).agg(money(F.sum("emi_amount")).alias("total_emi"))


def customer_month_utilization(snapshots: DataFrame, cards: DataFrame) -> DataFrame:
    """Mean utilization over the cards of a customer; debit cards count as 0."""
    owned = snapshots.join(cards.select("card_id", "customer_id"), "card_id")
    total, n = F.sum("utilization_rate"), F.count("utilization_rate")
    return owned.groupBy(*CUSTOMER_MONTH).agg(
        exact_mean(total, n, 4).cast("double").alias("avg_util")
    )


def channel_class(channel: Column) -> Column:
    return (
        F.when(channel.isin(*K.CASH_CHANNELS), "cash")
        .when(channel.isin(*K.CARD_PRESENT_CHANNELS), "card_present")
        .when(channel.isin(*K.CARD_NOT_PRESENT_CHANNELS), "card_not_present")
        .otherwise("other")
    )


def activity_rollup(txns: DataFrame) -> DataFrame:
    """Counts, sums, mean debit, distinct merchants and channel classes per customer and month."""
    debit = F.col("direction") == "Debit"
    kind = channel_class(F.col("channel"))
    debits, spent = F.count_if(debit), F.sum(F.when(debit, F.col("amount")))
    mean_debit = F.when(debits > 0, exact_mean(spent, debits, 2)).otherwise(F.lit(0))
    return txns.groupBy("customer_id", F.col("txn_month").alias("snapshot_month")).agg(
        debits.cast("int").alias("debit_txn_count"),
        F.count_if(~debit).cast("int").alias("credit_txn_count"),
        money(F.coalesce(spent, F.lit(0))).alias("total_debit_amount"),
        money(F.coalesce(F.sum(F.when(~debit, F.col("amount"))), F.lit(0)))
        .alias("total_credit_amount"),
        money(mean_debit).alias("avg_transaction_value"),
        F.count_distinct("merchant_name").cast("int").alias("unique_merchants"),
        F.count_if(kind == "cash").cast("int").alias("cash_withdrawal_count"),
        F.count_if(kind == "card_present").cast("int").alias("card_present_txn_count"),
        F.count_if(kind == "card_not_present").cast("int").alias("card_not_present_txn_count"),
    )


def _login() -> Column:
    return F.col("channel").isin(*K.CARD_NOT_PRESENT_CHANNELS)


def _with_active_months(txns: DataFrame, active: DataFrame) -> DataFrame:
    """Transactions stacked with the months a customer is active, so that quiet months stay."""
    facts = txns.select(
        "customer_id", F.col("txn_month").alias("snapshot_month"), "txn_date", "direction",
        "channel", "amount", "merchant_name",
    )
    months = active.select("customer_id", "snapshot_month", F.lit(True).alias("active"))
    return facts.unionByName(months, allowMissingColumns=True)


def _so_far(value: str) -> Column:
    """The latest date up to and including the month, carried over quiet months."""
    months = Window.partitionBy("customer_id").orderBy("snapshot_month").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return F.max(value).over(months)


def activity_table(txns: DataFrame, active: DataFrame) -> DataFrame:
    """The monthly activity table: the rollup plus logins, sessions and days since last use.

    One row per customer and month of `active` (customer_id, snapshot_month), zeros included. The
    last transaction and login are those of any month so far; days are the default only where
    there has been none.
    """
    kind = channel_class(F.col("channel"))
    debit = F.col("direction") == "Debit"
    spent, debits = F.sum(F.when(debit, F.col("amount"))), F.count_if(debit)
    month_end = F.last_day(F.col("snapshot_month"))

    def channel_count(name: str) -> Column:
        return F.count_if(F.col("channel") == name).cast("int")

    grouped = _with_active_months(txns, active).groupBy("customer_id", "snapshot_month").agg(
        F.count_if(_login()).cast("int").alias("login_count"),
        channel_count("Mobile App").alias("mobile_app_sessions"),
        channel_count("Internet Banking").alias("internet_banking_sessions"),
        channel_count("ATM").alias("atm_transactions"),
        debits.cast("int").alias("debit_txn_count"),
        F.count_if(~debit).cast("int").alias("credit_txn_count"),
        money(F.coalesce(spent, F.lit(0))).alias("total_debit_amount"),
        money(F.coalesce(F.sum(F.when(~debit, F.col("amount"))), F.lit(0)))
        .alias("total_credit_amount"),
        F.count_distinct("merchant_name").cast("int").alias("unique_merchants"),
        F.count_if(kind == "cash").cast("int").alias("cash_withdrawal_count"),
        F.count_if(kind == "card_present").cast("int").alias("card_present_txn_count"),
        F.count_if(kind == "card_not_present").cast("int").alias("card_not_present_txn_count"),
        F.max("txn_date").alias("last_txn"),
        F.max(F.when(_login(), F.col("txn_date"))).alias("last_login"),
        F.bool_or("active").alias("active"),
    )
    mean_debit = F.when(
        F.col("debit_txn_count") > 0,
        exact_mean(F.col("total_debit_amount"), F.col("debit_txn_count"), 2),
    ).otherwise(F.lit(0))
    carried = grouped.withColumns({n: _so_far(n) for n in ("last_txn", "last_login")})
    return carried.filter("active").select(
        "customer_id", "snapshot_month", "login_count", "mobile_app_sessions",
        "internet_banking_sessions", "atm_transactions", F.lit(0).alias("branch_visits"),
        "debit_txn_count", "credit_txn_count", "total_debit_amount", "total_credit_amount",
        money(mean_debit).alias("avg_transaction_value"),
        "unique_merchants", "cash_withdrawal_count", "card_present_txn_count",
        "card_not_present_txn_count",
        F.coalesce(F.date_diff(month_end, "last_txn"), F.lit(K.DEFAULT_DORMANT_DAYS))
        .alias("days_since_last_txn"),
        F.coalesce(F.date_diff(month_end, "last_login"), F.lit(K.DEFAULT_LOGIN_DAYS))
        .alias("days_since_last_login"),
    )


def digital_table(txns: DataFrame, active: DataFrame) -> DataFrame:
    """Monthly digital engagement observed in the transaction channels, quiet months included."""
    app = F.col("channel") == "Mobile App"
    responded = app & (F.col("direction") == "Credit")

    def zero(name: str) -> Column:
        return F.lit(0).alias(name)

    grouped = _with_active_months(txns, active).groupBy("customer_id", "snapshot_month").agg(
        (F.count_if(app) > 0).alias("mobile_app_active"),
        F.max(F.when(_login(), F.col("txn_date"))).alias("last_login_date"),
        F.count_if(app).cast("int").alias("campaigns_received"),
        F.count_if(responded).cast("int").alias("campaigns_responded"),
        F.count_if(F.col("channel") == "Internet Banking").cast("int").alias("web_sessions"),
        F.bool_or("active").alias("active"),
    )
    carried = grouped.withColumn("last_login_date", _so_far("last_login_date"))
    return carried.filter("active").select(
        "customer_id", "snapshot_month", "mobile_app_active", "last_login_date",
        zero("push_notifications_sent"), zero("push_notifications_opened"),
        zero("email_campaigns_sent"), zero("email_clicks"),
        "campaigns_received", "campaigns_responded", "web_sessions",
        F.lit(True).alias("notification_opt_in"), zero("app_crash_count"),
    )


def fee_and_salary_sums(txns: DataFrame) -> DataFrame:
    def total(condition: str) -> Column:
        return money(F.coalesce(F.sum(F.when(F.col(condition), F.col("amount"))), F.lit(0)))

    return txns.groupBy("account_id", F.col("txn_month").alias("snapshot_month")).agg(
        total("is_fee").alias("fee_charged_amount"),
        total("is_salary_credit").alias("salary_credit_amount"),
    )


def salary_months(snapshots: DataFrame, accounts: DataFrame) -> DataFrame:
    """Distinct months with a salary credit per customer."""
    paid = snapshots.filter(F.col("salary_credit_amount") > 0)
    owned = paid.join(accounts.select("account_id", "customer_id"), "account_id")
    return owned.groupBy("customer_id").agg(
        F.count_distinct("snapshot_month").alias("salary_months")
    )


def loan_worst_state(loan_states: DataFrame) -> DataFrame:
    """Highest days past due and whether any loan is delinquent, per customer and month."""
    return loan_states.groupBy("customer_id", "snapshot_month").agg(
        F.max("dpd_days").alias("max_dpd"),
        F.bool_or(F.col("loan_status") == "Delinquent").alias("any_delinquent"),
    )


def open_complaints(complaints: DataFrame) -> DataFrame:
    return complaints.groupBy("customer_id").agg(
        F.count_if(~F.col("resolved_flag")).alias("open_complaints"),
        F.count(F.lit(1)).alias("complaints"),
    )


def event_set(events: DataFrame) -> DataFrame:
    """The distinct events of a customer and month; at most the twelve known events."""
    return events.groupBy("customer_id", "event_month").agg(
        F.array_sort(F.collect_set("event_type")).alias("events")
    )


def txns_per_customer(txns: DataFrame) -> DataFrame:
    return txns.groupBy("customer_id").agg(F.count(F.lit(1)).alias("txn_count"))


def segment_rate(df: DataFrame, segment: str, flag: str) -> DataFrame:
    """Share of rows with a flag, per segment."""
    n = F.count(F.lit(1))
    hits = F.count_if(F.col(flag))
    return df.groupBy(segment).agg(
        n.alias("n"), (hits.cast("double") / n.cast("double")).alias("rate")
    )


def mean_where(condition: Column, value: Column) -> Column:
    """Mean of an integer value over the rows that satisfy a condition."""
    total, n = F.sum(F.when(condition, value)), F.count(F.when(condition, value))
    return F.try_divide(total.cast("double"), n.cast("double"))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key groups with more than one row."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return groups.agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_involved"),
    )
