"""Named queries over a bank: one per operator, each a lazy DataFrame over whole tables."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions import calendar as C
from tidemark.functions import hashing, money, scores
from tidemark.operators import aggregates as A
from tidemark.operators import cards, joins, ledger, loans, sets
from tidemark.operators import windows as W
from tidemark.plans import behaviour, churn, features, labels, parity, quality
from tidemark.session import scratch_path
from tidemark.sources import parquet_io, schemas
from tidemark.sources.bank import Bank, WrittenBank
from tidemark.sources.star_bank import StarBank
from tidemark.streaming import balance as stream_balance
from tidemark.streaming import monthly as stream_monthly

MONTH = ("customer_id", "snapshot_month")
LABEL_KEY = ("customer_id", "as_of_month", "prediction_horizon_months")


@lru_cache(maxsize=8)
def _written(application: str, base: Bank) -> WrittenBank:
    return WrittenBank(base)


def written(bank: Bank) -> WrittenBank:
    """The bank with each table written once per session; for reports that scan many tables."""
    if isinstance(bank, WrittenBank):
        return bank
    return _written(bank.spark.sparkContext.applicationId, bank)


@lru_cache(maxsize=8)
def _star(application: str, spark, sf_dir: str) -> StarBank:
    return StarBank(spark, sf_dir)


def star_bank(spark, sf_dir: str) -> StarBank:
    return _star(spark.sparkContext.applicationId, spark, sf_dir)


def calendar(bank) -> DataFrame:
    return W.customer_calendar(bank.customer_master, bank.first_month, bank.n_months)


def spine(bank) -> DataFrame:
    return features.eligible_spine(bank.customer_churn_label, bank.first_month)


# -- scans and sinks -----------------------------------------------------------------------


def scan_master(bank):
    root = scratch_path(bank.spark, "scan-master")
    parquet_io.write_master(bank.customer_master, root, "customer_master")
    return parquet_io.scan_master(bank.spark, root, "customer_master").select(
        "customer_id", "cif_number", "annual_income", "customer_since", "city", "branch_code"
    )


def scan_month_partitions(bank):
    root = scratch_path(bank.spark, "scan-months")
    parquet_io.write_month_partitions(bank.customer_complaints, root, "customer_complaints")
    scanned = parquet_io.scan_month_partitions(
        bank.spark, root, "customer_complaints", dt.date(2024, 6, 1), dt.date(2025, 3, 1)
    )
    return scanned.select("complaint_id", "customer_id", "complaint_month", "severity")


def write_master(bank):
    root = scratch_path(bank.spark, "write-master")
    parquet_io.write_master(bank.account_master, root, "account_master")
    parquet_io.write_master(bank.account_master, root, "account_master")
    return parquet_io.scan_master(bank.spark, root, "account_master").select(
        "account_id", "customer_id", "account_type", "open_date", "account_status",
        "salary_account_flag", "overdraft_limit",
    )


def write_month_partitions(bank):
    """Writes everything, then two months again; the second write replaces only those."""
    root, name = scratch_path(bank.spark, "write-months"), "customer_feedback"
    parquet_io.write_month_partitions(bank.customer_feedback, root, name)
    again = bank.customer_feedback.filter(F.col("feedback_month") >= "2025-11-01")
    parquet_io.write_month_partitions(again, root, name)
    return parquet_io.scan_month_partitions(bank.spark, root, name).select(
        "feedback_id", "customer_id", "feedback_month", "nps_score"
    )


def merge_chunk_outputs(bank):
    names = ("branch_master", "customer_master", "customer_complaints")
    roots = []
    for parity_bit in (0, 1):
        chunk = bank.replace(**{
            n: bank.table(n).filter(F.col("customer_id") % 2 == parity_bit) for n in names[1:]
        })
        root = scratch_path(bank.spark, "chunk")
        parquet_io.write_bank(chunk, root, names)
        roots.append(root)

    root = scratch_path(bank.spark, "merged")
    parquet_io.write_merged(bank.spark, roots, root, names)
    # Each merged table with its key and some of what its rows hold.
    held = {
        "branch_master": ("branch_code", ("city", "state")),
        "customer_master": ("customer_id", ("customer_since", "branch_code", "annual_income")),
        "customer_complaints": (
            "complaint_id", ("complaint_month", "category", "severity", "resolved_flag")
        ),
    }
    return sets.union_tables([
        parquet_io.read_table(bank.spark, root, name).select(
            F.lit(name).alias("table_name"), F.col(key).cast("string").alias("id"),
            F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("content"),
        )
        for name, (key, columns) in held.items()
    ])


def schema_contract(bank):
    return quality.schema_contract(written(bank).but("churn_feature_snapshot"))


# -- expressions ---------------------------------------------------------------------------


def month_shift(bank):
    day = F.col("complaint_date")
    return bank.customer_complaints.select(
        "complaint_id",
        C.month_shift(day, 0).alias("month"),
        C.month_shift(day, -7).alias("back_7"),
        C.month_shift(day, 14).alias("ahead_14"),
    )


def month_calendar(bank):
    return calendar(bank).select(*MONTH)


def days_in_month(bank):
    return bank.txns.groupBy("txn_month").agg(
        F.count(F.lit(1)).alias("txns")
    ).select("txn_month", C.days_in_month(F.col("txn_month")).alias("days"), "txns")


def month_of(bank, number: int):
    """A month of the bank's window, from 0; -1 is the last."""
    return F.add_months(F.lit(bank.first_month), number % bank.n_months)


def tenure_months(bank):
    return bank.customer_master.select(
        "customer_id",
        C.tenure_months(month_of(bank, -1), F.col("customer_since")).alias("tenure_months"),
    )


def ratio_change(bank):
    second_year = F.col("txn_month") >= month_of(bank, bank.n_months // 2)
    counts = bank.txns.groupBy("customer_id").agg(
        F.count_if(second_year).cast("double").alias("recent"),
        F.count_if(~second_year).cast("double").alias("prior"),
    )
    return counts.select(
        "customer_id", scores.ratio_change(F.col("recent"), F.col("prior")).alias("change")
    )


def null_defaults(bank):
    """Every customer and month of the calendar, with what stands for missing values."""
    activity = bank.customer_monthly_activity.select(*MONTH, "days_since_last_txn")
    nps = bank.customer_feedback.groupBy("customer_id").agg(F.max("nps_score").alias("nps"))
    return (
        calendar(bank).select(*MONTH)
        .join(activity, list(MONTH), "left").join(nps, "customer_id", "left")
        .select(
            *MONTH,
            F.coalesce("days_since_last_txn", F.lit(K.DEFAULT_DORMANT_DAYS)).alias("dormant_days"),
            F.coalesce(F.col("nps").cast("double"), F.lit(K.DEFAULT_NPS)).alias("best_nps"),
        )
    )


def floored_diff(bank):
    def at(month):
        return F.max(F.when(F.col("snapshot_month") == F.lit(month), F.col("products_count")))

    counts = bank.product_holdings_monthly.groupBy("customer_id").agg(
        at(dt.date(2025, 11, 1)).alias("a"), at(dt.date(2025, 6, 1)).alias("b")
    )
    return counts.select(
        "customer_id", scores.floored_diff(F.col("a"), F.col("b")).alias("velocity")
    )


def safe_rate(bank):
    rate = scores.safe_rate(F.sum("campaigns_responded"), F.sum("campaigns_received"))
    return bank.digital_engagement_monthly.groupBy("customer_id").agg(
        F.round(rate, 6).alias("rate")
    )


def emi_amount(bank):
    return loans.loan_terms(bank.loan_master).select("loan_id", "emi_amount")


def maturity_date(bank):
    return loans.loan_terms(bank.loan_master).select("loan_id", "maturity_date")


def max_principal(bank):
    return loans.loan_affordability(bank.loan_master, bank.customer_master).select(
        "loan_id", "max_emi", "max_principal"
    )


def loan_affordability(bank):
    return loans.loan_affordability(bank.loan_master, bank.customer_master).select(
        "loan_id", "accepted", "granted_amount"
    )


def credit_limit(bank):
    return bank.customer_master.select(
        "customer_id", money.credit_limit(F.col("annual_income")).alias("credit_limit")
    )


def card_tier(bank):
    return cards.card_tier(bank.card_portfolio, bank.churn_simulation_state)


def plus_years_leap(bank):
    return bank.account_master.select(
        "account_id", C.plus_years_leap(F.col("open_date"), 5).alias("after_5_years")
    )


def logit_sigmoid(bank):
    debits, credits = F.col("debit_txn_count"), F.col("credit_txn_count")
    # A month without transactions has no share; it counts as even.
    share = F.coalesce(
        F.try_divide(credits.cast("double"), (debits + credits).cast("double")), F.lit(0.5)
    )
    return bank.customer_monthly_activity.select(
        *MONTH,
        F.round(scores.logit(share), 10).alias("logit"),
        F.round(scores.sigmoid((credits - debits).cast("double")), 10).alias("sigmoid"),
    )


def clip_score(bank):
    raw = F.col("nps_score") * 1.5 - 3.0
    return bank.customer_feedback.filter(F.col("nps_score").isNotNull()).select(
        "feedback_id", scores.clip_score(raw, 0, 10).alias("clipped")
    )


def products_count(bank):
    return bank.product_holdings_monthly.select(*MONTH, A.products_count().alias("products_count"))


def revoke_flag(bank):
    rejected = (
        loans.loan_affordability(bank.loan_master, bank.customer_master)
        .filter(~F.col("accepted"))
        .join(bank.loan_master.filter("loan_type = 'Home Loan'"), "loan_id")
    )
    return behaviour.revoke_flag(
        bank.product_holdings_monthly, rejected, "home_loan_flag"
    ).select(*MONTH, "home_loan_flag", "products_count")


def quarter_gate(bank):
    return bank.txns.filter(F.month("txn_month") % 3 == 0).select("transaction_id", "txn_month")


def channel_class(bank):
    return bank.txns.groupBy(
        "channel", A.channel_class(F.col("channel")).alias("channel_class")
    ).agg(F.count(F.lit(1)).alias("txns"))


def active_filter(bank):
    accounts = bank.account_master.filter(F.col("account_status") == "Active")
    complaints = bank.customer_complaints.filter(~F.col("resolved_flag"))
    salaries = bank.account_monthly_snapshot.filter(F.col("salary_credit_amount") > 0)
    return sets.union_tables([
        accounts.select(F.lit("account").alias("kind"), F.col("account_id").alias("id")),
        complaints.select(F.lit("complaint").alias("kind"), F.col("complaint_id").alias("id")),
        salaries.select(F.lit("salary month").alias("kind"), F.col("account_id").alias("id")),
    ])


def cast_contract(bank):
    return schemas.cast_contract(bank.customer_churn_label, "customer_churn_label")


# -- joins ---------------------------------------------------------------------------------


def join_dim_inner(bank):
    return joins.with_customer(
        bank.account_monthly_snapshot, bank.account_master, "account_id", "inner"
    ).select("customer_id", "account_id", "snapshot_month", "current_balance")


def join_dim_left(bank):
    return joins.with_customer(
        bank.card_monthly_snapshot, bank.card_portfolio, "card_id"
    ).select("customer_id", "card_id", "snapshot_month", "utilization_rate")


def join_month_lag(bank):
    holdings = bank.product_holdings_monthly
    rows = joins.join_month_lag(spine(bank), holdings, 1, {"products_m1": "products_count"})
    return joins.join_month_lag(rows, holdings, 6, {"products_m6": "products_count"})


def join_point_in_time(bank):
    rows = joins.join_month_lag(
        spine(bank), bank.digital_engagement_monthly, 1, {"last_login": "last_login_date"}
    )
    days = F.date_diff("as_of_month", "last_login")
    return rows.select(
        "customer_id", "as_of_month",
        F.coalesce(days, F.lit(K.DEFAULT_LOGIN_DAYS)).alias("days_since_last_login"),
    )


def complaint_months(bank):
    return bank.customer_complaints.groupBy("customer_id", "complaint_month").agg(
        F.count(F.lit(1)).alias("n")
    )


def join_half_open_range(bank):
    return joins.join_window(
        spine(bank), complaint_months(bank), "complaint_month", 6,
        [F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("complaints")],
    )


def join_filter_range(bank):
    monthly = bank.customer_feedback.filter(F.col("nps_score").isNotNull()).groupBy(
        "customer_id", "feedback_month"
    ).agg(F.sum("nps_score").alias("s"), F.count(F.lit(1)).alias("n"))
    return joins.join_window(
        spine(bank), monthly, "feedback_month", 12,
        [F.sum("s").alias("nps_sum"), F.sum("n").alias("nps_n")], "inner",
    )


def anti_join_orphans(bank):
    active = bank.account_master.filter(F.col("account_status") == "Active")
    return joins.orphans(bank.txns, "account_id", active, "account_id")


def semi_join_eligible(bank):
    filed = bank.customer_complaints.select("customer_id").distinct()
    return bank.customer_churn_label.join(filed, "customer_id", "left_semi").select(*LABEL_KEY)


def cross_join_spine(bank):
    return joins.spine(
        bank.customer_master.select("customer_id"), bank.first_month, bank.n_months, K.HORIZONS
    )


def correlated_count(bank):
    rows = features.eligible_rows(bank.customer_churn_label, bank.first_month)
    return W.trailing_count(
        rows, bank.customer_complaints, "complaint_month", 6
    ).withColumnRenamed("counted", "complaints")


def scalar_subquery_bound(bank):
    return bank.spark.sql(
        """
        SELECT customer_id, as_of_month, prediction_horizon_months FROM {labels}
        WHERE as_of_month >= (SELECT add_months(min(snapshot_month), 6) FROM {holdings})
        """,
        labels=bank.customer_churn_label, holdings=bank.product_holdings_monthly,
    )


def first_event_after(bank):
    return joins.first_event_after(
        bank.customer_complaints, "complaint_month", bank.hidden_events, "complaint_resolved"
    ).select("complaint_id", "next_event_month")


def first_branch_in_city(bank):
    # One row per city.
    firsts = F.broadcast(joins.first_branch_in_city(bank.branch_master))
    return bank.customer_master.select("customer_id", "city").join(firsts, "city")


def broadcast_config(bank):
    config = churn.persona_config(bank.spark).select("persona", "threshold", "base_min")
    return bank.churn_simulation_state.select("customer_id", "persona").join(config, "persona")


# -- aggregates ----------------------------------------------------------------------------


def customer_month_balance(bank):
    rows = A.customer_month_balance(bank.account_monthly_snapshot, bank.account_master)
    return rows.select(*MONTH, F.round("avg_bal", 4).alias("avg_bal"))


def customer_month_emi(bank):
    return A.customer_month_emi(bank.loan_monthly_snapshot, bank.loan_master)


def customer_month_utilization(bank):
    return A.customer_month_utilization(bank.card_monthly_snapshot, bank.card_portfolio)


def activity_rollup(bank):
    return A.activity_rollup(bank.txns)


def fee_and_salary_sums(bank):
    return A.fee_and_salary_sums(bank.txns)


def salary_months(bank):
    return A.salary_months(bank.account_monthly_snapshot, bank.account_master)


def loan_worst_state(bank):
    return A.loan_worst_state(bank.loan_states)


def open_complaints(bank):
    return A.open_complaints(bank.customer_complaints)


def event_set(bank):
    return A.event_set(bank.hidden_events).select(
        "customer_id", "event_month",
        F.array_join("events", ",").alias("events"), F.size("events").alias("n_events"),
    )


def txns_per_customer(bank):
    return A.txns_per_customer(bank.txns)


def segment_rate(bank):
    rates = A.segment_rate(bank.churn_simulation_state, "persona", "churned_flag")
    return rates.select("persona", "n", F.round("rate", 10).alias("rate"))


def conditional_means(bank):
    persona, churned = F.col("persona"), F.col("churned_flag").cast("int")
    low = F.col("low_sensitivity_segment")
    return bank.churn_simulation_state.agg(*[
        F.round(A.mean_where(condition, churned), 10).alias(name)
        for name, condition in {
            "complaint_prone": persona == "complaint_prone_churner",
            "salary_core": persona == "salary_core",
            "low_sensitivity": low,
            "normal": ~low,
        }.items()
    ])


def duplicate_groups(bank):
    """Customer months with more than one complaint."""
    return A.duplicate_groups(bank.customer_complaints, ["customer_id", "complaint_month"])


def extremes(bank):
    return bank.txns.agg(
        F.min("txn_month").alias("first_month"), F.max("txn_month").alias("last_month"),
        F.min("transaction_id").alias("first_id"), F.max("transaction_id").alias("last_id"),
    )


def distinct_spine(bank):
    return bank.customer_churn_label.select("customer_id", "as_of_month").distinct()


# -- windows and folds ---------------------------------------------------------------------


def running_balance(bank):
    return bank.transaction_fact.select("transaction_id", "account_id", "balance_after_txn")


def account_snapshot(bank):
    return bank.account_monthly_snapshot.select(
        "account_id", "snapshot_month", "current_balance", "average_monthly_balance",
        "min_balance_30d", "max_balance_30d", "debit_txn_count", "credit_txn_count",
        "fee_charged_amount", "salary_credit_amount", "account_status",
    )


def primary_account(bank):
    return ledger.primary_account(bank.account_master).select(
        "customer_id", "account_id", "account_type", "salary_account_flag"
    )


def salary_paid_months(bank):
    return bank.txns.filter("is_salary_credit").select(
        "customer_id", F.col("txn_month").alias("snapshot_month")
    )


def salary_gap_streak(bank):
    return W.salary_gap_streak(
        calendar(bank), salary_paid_months(bank), ledger.primary_account(bank.account_master)
    )


def digital_inactive_streak(bank):
    return W.digital_inactive_streak(calendar(bank), bank.digital_engagement_monthly)


def service_failure_counter(bank):
    return W.service_failure_counter(calendar(bank), bank.hidden_events, bank.n_months)


def product_drop(bank):
    return W.product_drop(bank.product_holdings_monthly)


def complaints_trailing(bank):
    return W.complaints_trailing(calendar(bank), bank.customer_complaints)


def loan_opening_balance(bank):
    rows = loans.loan_opening_balance(bank.loan_master, bank.first_month)
    return rows.select("loan_id", "elapsed_months", F.round("opening", 2).alias("opening"))


def loan_schedule(bank):
    return loans.loan_schedule(bank.loan_master)


def loan_dpd(bank):
    return bank.loan_states.select(
        "loan_id", "snapshot_month", F.round("outstanding", 2).alias("outstanding"),
        "dpd_days", "loan_status",
    )


def loan_snapshot(bank):
    return bank.loan_monthly_snapshot.select(
        "loan_id", "snapshot_month", "outstanding_balance", "emi_amount", "dpd_days",
        "overdue_amount", "principal_paid_amount", "interest_paid_amount",
        "installment_paid_amount", "loan_status",
    )


def card_revolve(bank):
    return bank.card_balances.select(
        "card_id", "snapshot_month", F.round("balance", 2).alias("balance")
    )


def card_snapshot(bank):
    return bank.card_monthly_snapshot.select(
        "card_id", "snapshot_month", "monthly_spend_amount", "monthly_txn_count",
        "utilization_rate", "min_due_amount", "delinquency_flag",
    )


def decisions(bank, mode="bernoulli"):
    return churn.churn_decision(churn.churn_score(churn.churn_signals(bank)), mode)


def churn_month(bank):
    return W.churn_month(decisions(bank)).select("customer_id", "churn_month")


def active_months(bank):
    return W.churn_month(decisions(bank)).select("customer_id", "active_months_generated")


# -- sets ----------------------------------------------------------------------------------


def ordered_output(bank):
    return bank.customer_complaints.select(
        "customer_id", "complaint_month", "complaint_id"
    ).orderBy("customer_id", "complaint_month", "complaint_id")


def sample_violations(bank):
    return sets.sample_violations(anti_join_orphans(bank), ["key_value"], 5)


def union_tables(bank):
    rows = bank.customer_complaints.select("complaint_id", "customer_id", "complaint_month")
    halves = [rows.filter(F.col("customer_id") % 2 == k) for k in (0, 1)]
    return sets.union_tables(halves)


def disjoint_union(bank):
    resolved = bank.customer_complaints.filter("resolved_flag").select("customer_id").distinct()
    surveyed = bank.customer_feedback.select("customer_id").distinct()
    return sets.disjoint_union(
        resolved.withColumn("topic", F.lit("Complaint Resolution")),
        surveyed.withColumn("topic", F.lit("General")), ["customer_id"],
    )


def dedupe_one_per_month(bank):
    priority = F.when(F.col("survey_topic") == "Complaint Resolution", 0).otherwise(1)
    rows = bank.customer_feedback.select(
        "customer_id", "feedback_month", priority.alias("priority"), "feedback_id", "survey_topic"
    )
    return sets.keep_first(
        rows, ["customer_id", "feedback_month"], ["priority", "feedback_id"]
    ).select("customer_id", "feedback_month", "feedback_id", "survey_topic")


def table_equality(bank):
    """The monthly fee table against itself rebuilt from halves, and against a changed copy."""
    whole = A.fee_and_salary_sums(bank.txns)
    halves = sets.union_tables([
        A.fee_and_salary_sums(bank.txns.filter(F.col("account_id") % 2 == k)) for k in (0, 1)
    ])
    changed = whole.filter(F.col("fee_charged_amount") == 0)
    cases = {"same": (whole, halves), "fees removed": (whole, changed)}
    return sets.union_tables([
        sets.table_difference(a, b).agg(F.count(F.lit(1)).alias("differing_rows"))
        .select(F.lit(case).alias("case_name"), "differing_rows",
                (F.col("differing_rows") == 0).alias("equal"))
        for case, (a, b) in cases.items()
    ])


def surrogate_keys(bank):
    rows = bank.customer_complaints.select("complaint_month", "complaint_id")
    return sets.surrogate_keys(rows, ["complaint_month", "complaint_id"], "new_id", 50_000_000)


def segment_assignment(bank):
    key = F.col("customer_id")
    rows = bank.customer_master.select(
        "customer_id",
        hashing.weighted_choice(key, 42, [(p, 1) for p in K.PERSONA_NAMES]).alias("persona"),
        (hashing.uniform_millionths(key, 43) < 125_000).alias("low_sensitivity"),
    )
    return sets.weighted_assignment(
        rows, "customer_id", bank.branch_master, "branch_code", "customer_weight", 44
    )


def stratified_sample(bank):
    rate = F.when(F.col("resolved_flag"), K.RESOLVED_SURVEY_RATE).otherwise(K.OTHER_SURVEY_RATE)
    return sets.stratified_sample(
        bank.customer_complaints, "complaint_id", rate, 42
    ).select("complaint_id", "resolved_flag")


# -- behaviour, scoring, labels, features ---------------------------------------------------


def event_mutual_exclusion(bank):
    return behaviour.event_mutual_exclusion(bank.hidden_events)


def conditional_event_gate(bank):
    return behaviour.conditional_event_gate(
        bank.hidden_events, bank.card_portfolio, bank.loan_states, bank.customer_complaints,
        bank.digital_engagement_monthly, bank.churn_simulation_state,
    )


def complaint_root_cause(bank):
    return behaviour.complaint_root_cause(bank.customer_complaints, bank.hidden_events).select(
        "complaint_id", "category", "root_cause", "severity"
    )


def complaint_resolution(bank):
    return behaviour.complaint_resolution(bank.customer_complaints, bank.hidden_events).select(
        "complaint_id", "resolved_month", "resolved_flag", "status"
    )


def resolutions(bank):
    return behaviour.resolution_months(bank.customer_complaints, bank.hidden_events)


def resolution_sla(bank):
    return behaviour.resolution_sla(bank.customer_complaints).select(
        "complaint_id", "severity", "resolution_days", "out_of_band"
    )


def targets(bank):
    return behaviour.survey_targets(
        resolutions(bank), bank.churn_simulation_state, bank.first_month, bank.n_months
    )


def survey_targets(bank):
    return targets(bank).select(*MONTH, "topic")


def expected_nps_csat(bank):
    balance = behaviour.complaint_balance(resolutions(bank), calendar(bank))
    return behaviour.expected_nps_csat(targets(bank), balance, bank.hidden_events)


def campaign_uptake(bank):
    return behaviour.campaign_uptake(
        bank.digital_engagement_monthly, bank.product_holdings_monthly
    )


def holdings_panel(bank):
    return behaviour.holdings_panel(
        bank.customer_master, bank.product_acquisitions, bank.first_month, bank.n_months
    )


SIGNAL_SCORES = (
    "base_rate", "event_score", "trend_score", "product_score", "complaint_score",
    "loan_stress_score", "digital_inactivity_score",
)


def churn_signals(bank):
    rows = churn.churn_signals(bank)
    return rows.select(*[
        F.round(c, 10).alias(c) if c in SIGNAL_SCORES else F.col(c) for c in rows.columns
    ])


def hard_triggers(bank):
    rows = churn.with_triggers(churn.churn_signals(bank))
    flags = churn.hard_triggers()
    return rows.select(
        *MONTH,
        *[flag.alias(name.lower().replace(" ", "_")) for name, flag in flags.items()],
        "hard_reason",
    )


def churn_score(bank):
    rows = churn.churn_score(churn.churn_signals(bank))
    return rows.select(
        *MONTH, F.round("churn_risk", 10).alias("churn_risk"),
        F.round("churn_prob", 10).alias("churn_prob"),
    )


def churn_decision(bank):
    by_score = decisions(bank, "threshold").select(
        *MONTH, "persona", "hard_reason", "churn_prob", F.col("churned").alias("above_threshold")
    )
    return churn.churn_decision(by_score, "bernoulli").select(
        *MONTH, "above_threshold", F.col("churned").alias("drawn")
    )


def churn_reason(bank):
    rows = churn.churn_reason(decisions(bank))
    soft = churn.first_reason(churn.soft_reasons())
    return rows.select(*MONTH, "churn_reason", soft.alias("soft_reason"))


def churn_state(bank):
    return churn.churn_state(decisions(bank), bank.churn_simulation_state)


def churn_label(bank):
    return bank.customer_churn_label


def monthly_panel(bank):
    panel = features.monthly_panel(bank, spine(bank))
    return panel.select(
        "customer_id", "month", F.coalesce("is_spine", F.lit(False)).alias("is_spine"),
        (F.col("bal_cents").cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("balance"),
        (F.col("emi_cents").cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("emi"),
        "txns", "logins", "dormant", "last_login", "received", "responded", "complaints",
        "unresolved", "nps_sum", "nps_n", "products",
    )


def feature_query(name: str):
    def query(bank):
        return features.single_feature(bank, name)

    query.__name__ = f"feat_{name}"
    return query


def feature_snapshot(bank):
    """Its sources are written one after another, so their shuffle files need not be kept together."""
    return features.feature_snapshot(written(bank))


def feature_snapshot_joins(bank):
    from tidemark.plans.features_joined import feature_snapshot_joins as joined

    return joined(bank)


def training_split(bank):
    rows = labels.training_split(features.feature_snapshot(written(bank)))
    return rows.select("customer_id", "as_of_month", "split", "products_count", "churned")


# -- quality, leakage, parity ---------------------------------------------------------------


def report_query(report):
    """A report over written tables; all checks at once read the feature table several times."""
    once = () if report is quality.validation_report else ("churn_feature_snapshot",)

    def query(bank):
        return report(written(bank).but(*once))

    query.__name__ = report.__name__
    return query


def leak_future_months(bank):
    """Every feature and as-of month, with one feature that is meant to be caught."""
    rows = quality.leak_future_months(written(bank))
    return rows.withColumn("largest_lead", F.col("largest_lead").cast("int"))


def halves(bank):
    """Two banks to compare: even and odd customers."""
    base = written(bank)
    owners = ("customer_master", "account_master", "churn_simulation_state",
              "customer_churn_label", "customer_complaints", "customer_feedback", "txns")

    def half(k):
        kept = {n: base.table(n).filter(F.col("customer_id") % 2 == k) for n in owners}
        snapshots = base.account_monthly_snapshot.join(
            kept["account_master"].select("account_id"), "account_id", "left_semi"
        )
        return base.replace(**kept, account_monthly_snapshot=snapshots)

    return half(0), half(1)


def parity_overall_rate(bank):
    left, right = halves(bank)
    return parity.parity_overall_rate(left.customer_churn_label, right.customer_churn_label)


def parity_segment_rate(bank):
    left, right = halves(bank)
    return parity.parity_segment_rate(
        left.customer_churn_label, right.customer_churn_label,
        left.churn_simulation_state, right.churn_simulation_state,
    )


def parity_ks(bank):
    left, right = halves(bank)
    return parity.parity_ks(parity.ks_metrics(left), parity.ks_metrics(right))


def parity_row_counts(bank):
    left, right = halves(bank)
    return parity.parity_row_counts(left, right, (
        "customer_master", "account_master", "customer_complaints", "customer_feedback",
        "customer_churn_label",
    ))


def parity_columns(bank):
    """Window features against the join-shaped build, column by column, with planted differences.

    In the joined build one feature of every fifth customer is off by one, and every eleventh
    customer is missing; nothing else may differ.
    """
    base = written(bank)
    off = F.when(F.col("customer_id") % 5 == 0, 1).otherwise(0)
    other = feature_snapshot_joins(base).filter(F.col("customer_id") % 11 != 0).withColumn(
        "products_count", (F.col("products_count") + off).cast("int")
    )
    return parity.parity_columns(features.feature_snapshot(base), other, list(LABEL_KEY))


# -- streams -------------------------------------------------------------------------------


def txn_stream(bank, name: str):
    """The transactions as files arriving quarter by quarter, read back as a stream.

    Quarters follow the window of the bank; what lies before or after it comes with its ends.
    """
    root = scratch_path(bank.spark, name)
    columns = ["transaction_id", "account_id", "customer_id", "txn_timestamp", "txn_month",
               "direction", "channel", "merchant_name", "amount"]
    rows = written(bank).txns.select(*columns)
    quarters = -(-bank.n_months // 3)
    at = C.month_index(F.col("txn_month")) - C.month_index(F.lit(bank.first_month))
    quarter_of = F.least(F.lit(quarters - 1), F.greatest(F.lit(0), F.floor(at / 3)))
    for quarter in range(quarters):
        inside = F.coalesce(quarter_of, F.lit(0)) == quarter
        part = rows.filter(inside).repartition("account_id")
        part.write.mode("append").parquet(f"{root}/arriving")
    return stream_monthly.read_txn_stream(bank.spark, f"{root}/arriving", rows.schema, 16), root


def stream_month_sink(bank):
    stream, root = txn_stream(bank, "stream-sink")
    return stream_monthly.stream_month_sink(stream, root).select(
        *MONTH, "debit_txn_count", "credit_txn_count", "total_debit_amount",
        "total_credit_amount", "unique_merchants",
    )


def stream_activity_rollup(bank):
    """Quarters arrive in order, so rows lie within a quarter (and a little) of the newest one."""
    stream, root = txn_stream(bank, "stream-activity")
    return stream_monthly.stream_activity_rollup(stream, root, "100 days").drop(
        "avg_transaction_value"
    )


def stream_running_balance(bank):
    stream, root = txn_stream(bank, "stream-balance")
    return stream_balance.stream_running_balance(stream, bank.account_openings, root)


QUERIES = {
    f.__name__: f
    for f in (
        scan_master, scan_month_partitions, write_master, write_month_partitions,
        merge_chunk_outputs, schema_contract,
        month_shift, month_calendar, days_in_month, tenure_months, ratio_change, null_defaults,
        floored_diff, safe_rate, emi_amount, maturity_date, max_principal, loan_affordability,
        credit_limit, card_tier, plus_years_leap, logit_sigmoid, clip_score, products_count,
        revoke_flag, quarter_gate, channel_class, active_filter, cast_contract,
        join_dim_inner, join_dim_left, join_month_lag, join_point_in_time, join_half_open_range,
        join_filter_range, anti_join_orphans, semi_join_eligible, cross_join_spine,
        correlated_count, scalar_subquery_bound, first_event_after, first_branch_in_city,
        broadcast_config,
        customer_month_balance, customer_month_emi, customer_month_utilization, activity_rollup,
        fee_and_salary_sums, salary_months, loan_worst_state, open_complaints, event_set,
        txns_per_customer, segment_rate, conditional_means, duplicate_groups, extremes,
        distinct_spine,
        running_balance, account_snapshot, primary_account, salary_gap_streak,
        digital_inactive_streak, service_failure_counter, product_drop, complaints_trailing,
        loan_opening_balance, loan_schedule, loan_dpd, loan_snapshot, card_revolve,
        card_snapshot, churn_month, active_months,
        ordered_output, sample_violations, union_tables, disjoint_union, dedupe_one_per_month,
        table_equality, surrogate_keys, segment_assignment, stratified_sample,
        event_mutual_exclusion, conditional_event_gate, complaint_root_cause,
        complaint_resolution, resolution_sla, survey_targets, expected_nps_csat,
        campaign_uptake, holdings_panel, churn_signals, hard_triggers, churn_score,
        churn_decision, churn_reason, churn_state, churn_label, monthly_panel,
        *[feature_query(name) for name in features.FEATURES],
        feature_snapshot, feature_snapshot_joins, training_split,
        *[report_query(report) for report in quality.REPORTS],
        leak_future_months, report_query(quality.validation_report),
        parity_overall_rate, parity_segment_rate, parity_ks, parity_row_counts, parity_columns,
        stream_month_sink, stream_activity_rollup, stream_running_balance,
    )
}
