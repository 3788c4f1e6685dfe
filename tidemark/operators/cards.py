"""Cards: revolving balance and monthly snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.money import money
from tidemark.session import inline_table


def _carry(balance: Column, month: Column) -> Column:
    """Balance after the month's spend and payment: full, minimum due, or nothing."""
    owed = balance + month["spend"]
    minimum = owed * K.MIN_DUE_RATE
    return (
        F.when(owed <= 0, owed)
        .when(month["capacity"] == "full", F.lit(0.0))
        .when(month["capacity"] == "min", (owed - minimum) * K.MIN_PAID_INTEREST)
        .otherwise(owed * K.UNPAID_INTEREST)
    )


def card_revolve(card_months: DataFrame) -> DataFrame:
    """Balance carried by each credit card after each month."""
    # Rows that repeat a month are one month, so a bill is paid once and the array stays bounded.
    single = card_months.groupBy("card_id", "snapshot_month").agg(
        F.sum("spend").alias("spend"), F.min("capacity").alias("capacity"),
        F.sum("txn_count").alias("txn_count"),
    )
    months = single.groupBy("card_id").agg(
        F.array_sort(
            F.collect_list(F.struct("snapshot_month", "spend", "capacity", "txn_count"))
        ).alias("months")
    )
    balances = F.aggregate(
        "months",
        F.array(F.lit(0.0)),
        lambda acc, month: F.concat(acc, F.array(_carry(F.element_at(acc, -1), month))),
    )
    rows = months.select("card_id", "months", balances.alias("balances")).select(
        "card_id",
        F.explode(
            F.arrays_zip(
                "months", F.slice("balances", F.lit(2), F.size("months")).alias("balance")
            )
        ).alias("m"),
    )
    return rows.select(
        "card_id",
        F.col("m.months.snapshot_month").alias("snapshot_month"),
        F.col("m.months.spend").alias("spend"),
        F.col("m.months.capacity").alias("capacity"),
        F.col("m.months.txn_count").alias("txn_count"),
        F.col("m.balance").alias("balance"),
    )


def _snapshot(rows: DataFrame, spend, count, utilization, due, paid, delinquent) -> DataFrame:
    return rows.select(
        "card_id", "snapshot_month",
        money(spend).alias("monthly_spend_amount"),
        count.cast("int").alias("monthly_txn_count"),
        money(F.lit(0)).alias("cash_advance_amount"),
        utilization.cast("decimal(10,4)").alias("utilization_rate"),
        money(due).alias("min_due_amount"),
        money(paid).alias("payment_made_amount"),
        F.lit(0).cast("bigint").alias("rewards_points_balance"),
        "card_status",
        delinquent.alias("delinquency_flag"),
    )


def card_snapshot(revolved: DataFrame, cards: DataFrame, activity: DataFrame) -> DataFrame:
    """Monthly card table: credit cards from the carried balance, debit cards from account debits.

    Utilization is measured after payment, so a card paid in full shows 0.
    """
    held = cards.select(
        "card_id", "customer_id", "card_type", "card_status", "credit_limit", "issue_date"
    )
    credit = revolved.join(held.filter(F.col("card_type") == "Credit"), "card_id")
    balance, limit = F.col("balance"), F.col("credit_limit").cast("double")
    credit_rows = _snapshot(
        credit,
        F.round(balance, 2),
        F.when(balance > 0, F.col("txn_count")).otherwise(0),
        F.round(F.when(limit > 0, balance / limit).otherwise(0.0), 4),
        F.round(balance * K.MIN_DUE_RATE, 2),
        F.round(F.greatest(balance, F.lit(0.0)), 2),
        balance > limit,
    )
    debit = activity.select(
        "customer_id", "snapshot_month", "total_debit_amount", "debit_txn_count"
    ).join(held.filter(F.col("card_type") == "Debit"), "customer_id").filter(
        F.col("snapshot_month") >= F.trunc("issue_date", "month")
    )
    zero = F.lit(0)
    share = F.lit(str(K.DEBIT_CARD_SPEND_SHARE)).cast("decimal(2,1)")
    debit_rows = _snapshot(
        debit, F.round(F.col("total_debit_amount") * share, 2), F.col("debit_txn_count"),
        zero, zero, zero, F.lit(False),
    )
    return credit_rows.unionByName(debit_rows)


def card_tier(cards: DataFrame, state: DataFrame) -> DataFrame:
    """Rewards programme and tier of each credit card from the holder's persona."""
    tiers = F.broadcast(inline_table(
        cards.sparkSession, ("persona", "programme", "tier"),
        [(p[0], p[6], p[7]) for p in K.PERSONAS if (p[6], p[7]) != K.DEFAULT_REWARDS],
    ))
    programme, tier = K.DEFAULT_REWARDS
    return (
        cards.filter(F.col("card_type") == "Credit")
        .join(state.select("customer_id", "persona"), "customer_id")
        .join(tiers, "persona", "left")
        .select(
            "card_id", "persona",
            F.coalesce("programme", F.lit(programme)).alias("rewards_program"),
            F.coalesce("tier", F.lit(tier)).alias("reward_tier"),
        )
    )
