"""The feature table in its join shape, as a cross-check of the window shape.

Each feature joins the spine to one monthly source over a calendar range. Sources are one row per
customer and month before they are joined, so a customer meets a bounded number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.calendar import tenure_months
from tidemark.functions.scores import floored_diff, ratio_change, safe_rate
from tidemark.operators import aggregates as A
from tidemark.operators.joins import join_month_lag, join_window, with_customer
from tidemark.plans.features import FEATURES, KEYS, eligible_spine, emi_ratio


def _monthly(df: DataFrame, month: str, *aggs) -> DataFrame:
    return df.groupBy("customer_id", F.col(month).alias("snapshot_month")).agg(*aggs)


def feature_snapshot_joins(bank) -> DataFrame:
    labels = bank.customer_churn_label
    spine = eligible_spine(labels, bank.first_month)
    balances = A.customer_month_balance(bank.account_monthly_snapshot, bank.account_master)
    activity = bank.customer_monthly_activity.select(
        "customer_id", "snapshot_month", "login_count", "days_since_last_txn",
        (F.col("debit_txn_count") + F.col("credit_txn_count")).alias("txns"),
    )
    digital = bank.digital_engagement_monthly
    complaints = _monthly(
        bank.customer_complaints, "complaint_month",
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("resolved_flag")).alias("open"),
    )
    surveys = _monthly(
        bank.customer_feedback.filter(F.col("nps_score").isNotNull()), "feedback_month",
        F.sum("nps_score").alias("s"), F.count(F.lit(1)).alias("n"),
    )
    salaries = _monthly(
        with_customer(bank.account_monthly_snapshot, bank.account_master, "account_id").filter(
            F.col("salary_credit_amount") > 0
        ),
        "snapshot_month", F.lit(1).alias("paid"),
    )
    utilization = A.customer_month_utilization(bank.card_monthly_snapshot, bank.card_portfolio)
    emi = A.customer_month_emi(bank.loan_monthly_snapshot, bank.loan_master)

    def mean(facts, column, back, until, name):
        return join_window(
            spine, facts, "snapshot_month", back, [F.avg(column).alias(name)], until=until
        )

    def sums(facts, back, **columns):
        aggs = [F.sum(source).alias(name) for name, source in columns.items()]
        return join_window(spine, facts, "snapshot_month", back, aggs)

    pieces = [
        mean(balances, "avg_bal", 3, 0, "bal_recent"),
        mean(balances, "avg_bal", 6, 3, "bal_prior"),
        mean(activity, "txns", 3, 0, "txn_recent"),
        mean(activity, "txns", 6, 3, "txn_prior"),
        mean(activity, "login_count", 6, 0, "login_recent"),
        mean(activity, "login_count", 12, 6, "login_prior"),
        sums(complaints, 6, complaints="n"),
        sums(complaints, None, open="open"),
        sums(surveys, 12, nps_sum="s", nps_n="n"),
        sums(salaries, 6, salary_months="paid"),
        sums(digital, 12, responded="campaigns_responded", received="campaigns_received"),
    ]
    # A customer's months are too many for a broadcast, whatever their files seem to hold.
    rows = spine
    for piece in pieces:
        rows = rows.join(piece.hint("merge"), list(KEYS), "left")
    holdings = bank.product_holdings_monthly
    for facts, lag, columns in (
        (holdings, 1, {"products_m1": "products_count"}),
        (holdings, 6, {"products_m6": "products_count"}),
        (digital, 1, {"last_login": "last_login_date"}),
        (activity, 1, {"dormant": "days_since_last_txn"}),
        (utilization, 1, {"avg_util": "avg_util"}),
        (emi, 1, {"total_emi": "total_emi"}),
    ):
        rows = join_month_lag(rows, facts.hint("merge"), lag, columns)
    rows = rows.join(
        bank.customer_master.select("customer_id", "customer_since", "annual_income"),
        "customer_id",
    )

    def count(name):
        return F.coalesce(F.col(name), F.lit(0)).cast("int")

    def rounded(value, default):
        return F.round(F.coalesce(value, F.lit(default)), 4)

    values = {
        "tenure_months": tenure_months(F.col("as_of_month"), F.col("customer_since")),
        "products_count": F.coalesce("products_m1", F.lit(K.DEFAULT_PRODUCTS)),
        "balance_change_3m": ratio_change(F.col("bal_recent"), F.col("bal_prior")),
        "txn_count_change_3m": ratio_change(F.col("txn_recent"), F.col("txn_prior")),
        "login_count_change_6m": ratio_change(F.col("login_recent"), F.col("login_prior")),
        "complaint_count_6m": count("complaints"),
        "unresolved_complaints": count("open"),
        "days_since_last_login": F.coalesce(
            F.date_diff("as_of_month", "last_login"), F.lit(K.DEFAULT_LOGIN_DAYS)
        ),
        "salary_credit_consistency": F.round(count("salary_months").cast("double") / 6.0, 4),
        "credit_utilization": F.coalesce("avg_util", F.lit(0.0)),
        "emi_to_income_ratio": emi_ratio(),
        "dormant_days": F.coalesce("dormant", F.lit(K.DEFAULT_DORMANT_DAYS)),
        "nps_avg_12m": rounded(safe_rate(F.col("nps_sum"), F.col("nps_n")), K.DEFAULT_NPS),
        "campaign_response_rate": rounded(
            safe_rate(F.col("responded"), F.col("received")), 0.0
        ),
        "product_acquisition_velocity_6m": floored_diff(
            F.coalesce("products_m1", F.lit(0)), F.coalesce("products_m6", F.lit(0))
        ),
    }
    features = rows.select(*KEYS, *[values[f].alias(f) for f in FEATURES])
    return labels.join(features, list(KEYS)).select(
        *KEYS, "prediction_horizon_months", *FEATURES, "churned", "churn_date", "churn_reason"
    )
