"""Churn signals, triggers, score, decision, reason and the resulting state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.calendar import month_index, month_sequence
from tidemark.functions.hashing import uniform_millionths
from tidemark.functions.money import money
from tidemark.functions.scores import logit, sigmoid
from tidemark.operators.ledger import primary_account
from tidemark.operators.panel import stack_measures
from tidemark.operators.windows import by_month_index, streak, with_leaky_counter
from tidemark.session import inline_table


def persona_config(spark) -> DataFrame:
    """The six personas with their thresholds and base churn; constant, so safe to broadcast."""
    return F.broadcast(inline_table(spark, K.PERSONA_FIELDS, K.PERSONAS))


def _monthly(df: DataFrame, month: str, **columns) -> DataFrame:
    return df.select(
        "customer_id", F.col(month).alias("snapshot_month"),
        *[value.alias(name) for name, value in columns.items()],
    )


# Events that count only where something else holds, and what the others are called here.
GATED = {
    "card_decline_spike": "declines", "loan_delinquency_start": "delinquencies",
    "complaint_resolved": "resolutions", "campaign_exposure": "exposures",
}
FLAGGED = {
    "salary_job_change": "job_change", "salary_delay": "delay", "home_purchase": "home",
    "large_life_expense": "expense", "bank_service_failure": "failure",
}


def _signal_sources(bank) -> list[DataFrame]:
    """Everything the signals are made of, by customer and month.

    What holds for a customer as a whole is filed under the first month.
    """
    state = bank.churn_simulation_state
    calendar = state.select(
        "customer_id", "persona", "churn_month",
        F.explode(month_sequence(bank.first_month, bank.n_months)).alias("snapshot_month"),
    ).filter(
        F.col("churn_month").isNull() | (F.col("snapshot_month") <= F.col("churn_month"))
    )
    # A number instead of the name keeps the stacked aggregate on fixed-size buffers.
    persona_number = F.array_position(personas(), F.col("persona")).cast("int")
    first = F.lit(bank.first_month)
    owners = primary_account(bank.account_master).withColumn("snapshot_month", first)
    cards = bank.card_portfolio.filter(F.col("card_status") == "Active").select(
        "customer_id", first.alias("snapshot_month")
    )
    accounts = bank.account_monthly_snapshot.join(
        bank.account_master.select("account_id", "customer_id"), "account_id"
    )
    # A loan that was active at the end of the month before, or has just begun.
    before = F.lag("loan_status", 1, "Active").over(
        Window.partitionBy("loan_id").orderBy("snapshot_month")
    )
    loans = bank.loan_states.withColumn("at_start", before)
    event = F.col("event_type")
    gated = {name: F.when(event == kind, 1) for kind, name in GATED.items()}
    flagged = {name: event == kind for kind, name in FLAGGED.items()}
    return [
        _monthly(calendar, "snapshot_month", persona_number=persona_number),
        _monthly(owners, "snapshot_month", salary_account=F.col("salary_account_flag")),
        _monthly(cards, "snapshot_month", has_card=F.lit(True)),
        _monthly(accounts, "snapshot_month", balance=F.col("current_balance"),
                 salary=F.col("salary_credit_amount") > 0),
        _monthly(bank.hidden_events, "event_month", **gated, **flagged,
                 others=F.when(~event.isin(*GATED), 1)),
        _monthly(bank.product_holdings_monthly, "snapshot_month",
                 products=F.col("products_count")),
        _monthly(bank.customer_complaints, "complaint_month", filed=F.lit(1)),
        _monthly(loans, "snapshot_month", dpd=F.col("dpd_days"),
                 delinquent=F.col("loan_status") == "Delinquent",
                 has_loan=F.col("at_start") == "Active"),
        _monthly(bank.digital_engagement_monthly, "snapshot_month",
                 used=F.col("mobile_app_active") | (F.col("web_sessions") > 0)),
    ]


def personas() -> Column:
    return F.array(*[F.lit(name) for name in K.PERSONA_NAMES])


def _signal_panel(bank) -> DataFrame:
    """One row per customer and month with what happened in it."""
    def any_(name: str) -> Column:
        return F.coalesce(F.bool_or(name), F.lit(False))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    flags = (*FLAGGED.values(), "salary_account", "has_card", "salary", "has_loan", "used",
             "delinquent")
    panel = stack_measures(_signal_sources(bank), ["customer_id", "snapshot_month"], {
        "persona_number": F.max("persona_number"),
        **{name: any_(name) for name in flags},
        **{name: total(name) for name in ("balance", "filed", "others", *GATED.values())},
        "products": F.coalesce(F.max("products"), F.lit(0)),
        "dpd": F.coalesce(F.max("dpd"), F.lit(0)),
    })
    return panel.withColumns({
        "month_idx": month_index(F.col("snapshot_month")),
        "persona": F.element_at(personas(), F.col("persona_number")),
    })


def _framed(panel: DataFrame, n_months: int) -> DataFrame:
    """Streaks, trailing counts, lags, open complaints and gated events, in frames of one order.

    A resolution closes every complaint filed in an earlier month. What is open is therefore all
    that was filed, less what had been filed before the month of the last resolution.
    """
    inside = F.col("persona_number").isNotNull()
    order = by_month_index()
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("customer_id")
    rows = panel.select(
        "*", F.sum("filed").over(so_far).alias("filed_so_far"),
        F.coalesce(F.sum("filed").over(earlier), F.lit(0)).alias("filed_before"),
        F.max("has_card").over(whole).alias("owns_card"),
        F.max("salary_account").over(whole).alias("salaried"),
    )
    closed = F.when(F.col("resolutions") > 0, F.col("filed_before"))
    rows = rows.select(
        "*", F.coalesce(F.last(closed, True).over(so_far), F.lit(0)).alias("closed_so_far"),
        F.coalesce(F.last(closed, True).over(earlier), F.lit(0)).alias("closed_before"),
    )
    native = F.col("persona") == "digital_native"
    fired = F.col("others") + (
        F.when(F.col("owns_card"), F.col("declines")).otherwise(0)
        + F.when(F.col("has_loan"), F.col("delinquencies")).otherwise(0)
        + F.when(F.col("filed_before") > F.col("closed_before"), F.col("resolutions")).otherwise(0)
        + F.when(native | F.col("used"), F.col("exposures")).otherwise(0)
    )
    framed = rows.select(
        "*", fired.alias("events"),
        F.lag(F.when(inside, F.col("products"))).over(order).alias("products_before"),
        F.sum("filed").over(order.rangeBetween(-6, 0)).alias("complaint_count_6m"),
        (F.col("filed_so_far") - F.col("closed_so_far")).alias("unresolved_complaints"),
        streak(F.col("salary") | ~F.col("salaried") | ~inside).alias("months_without_salary"),
        streak(F.col("used") | ~inside).alias("digital_inactive_months"),
    )
    counted = with_leaky_counter(
        framed, F.col("failure") & inside, "service_failures_2m", n_months
    )
    return counted.filter(inside)


def churn_signals(bank) -> DataFrame:
    """Score components and trigger inputs for every customer and month up to the churn month.

    All facts are stacked onto a customer calendar and aggregated once; streaks, trailing counts,
    lags, counters, open complaints and the conditions of conditional events are frames of one
    window over that panel. Months outside the calendar are cut after the window, so complaints
    filed before it still count.
    """
    framed = _framed(_signal_panel(bank), bank.n_months)
    excluded = (F.col("job_change") & F.col("delay")).cast("int") + (
        F.col("home") & F.col("expense")
    ).cast("int")
    complaints, unresolved = F.col("complaint_count_6m"), F.col("unresolved_complaints")
    config = persona_config(bank.spark).select("persona", "base_min", "base_max")
    rows = framed.join(config, "persona")
    return rows.select(
        "customer_id", "snapshot_month", "persona",
        logit((F.col("base_min") + F.col("base_max")) / 2.0).alias("base_rate"),
        ((F.col("events") - excluded) * F.lit(0.1)).alias("event_score"),
        F.lit(0.0).alias("trend_score"),
        ((F.lit(10) - F.col("products")) / F.lit(10.0)).alias("product_score"),
        (complaints * F.lit(0.15) + unresolved * F.lit(0.25)).alias("complaint_score"),
        (F.col("dpd") / F.lit(90.0)).alias("loan_stress_score"),
        (F.col("digital_inactive_months") * F.lit(0.2)).alias("digital_inactivity_score"),
        F.col("dpd").alias("dpd_days"),
        F.when(F.col("delinquent"), "Delinquent").otherwise("Active").alias("loan_status"),
        complaints.cast("int").alias("complaint_count_6m"),
        unresolved.cast("int").alias("unresolved_complaints"),
        money(F.col("balance")).alias("current_balance"),
        "months_without_salary",
        "service_failures_2m",
        "digital_inactive_months",
        F.lit(False).alias("core_account_closed"),
        F.col("job_change").alias("recent_salary_job_change"),
        F.coalesce(F.col("products") < F.col("products_before"), F.lit(False))
        .alias("products_count_drop"),
        F.col("failure").alias("recent_service_failure"),
    )


def hard_triggers() -> dict[str, Column]:
    """The conditions that force churn, with their reason, in order of priority."""
    c = F.col
    return {
        "Loan default": (c("loan_status") == "Delinquent") & (c("dpd_days") >= 90),
        "Salary account lost": c("recent_salary_job_change") & (c("months_without_salary") >= 2),
        "Service dissatisfaction": (c("complaint_count_6m") >= 4)
        & (c("unresolved_complaints") >= 2),
        "Account dormancy": (c("current_balance") < 500) & (c("months_without_salary") >= 3),
        "Service failure": (c("service_failures_2m") >= 2) & (c("digital_inactive_months") >= 2),
        "Voluntary closure": c("core_account_closed"),
    }


def soft_reasons() -> dict[str, Column]:
    """Reasons for a churn decided by score, in order of priority; the last is the fallback."""
    c = F.col
    return {
        "Loan default": (c("dpd_days") >= 90) | (c("loan_status") == "Delinquent"),
        "Salary account lost": (c("months_without_salary") >= 2) & c("recent_salary_job_change"),
        "Service dissatisfaction": (c("unresolved_complaints") >= 1)
        | (c("complaint_count_6m") >= 2),
        "Account dormancy": (c("current_balance") < 500) | (c("digital_inactive_months") >= 2),
        "Product disengagement": c("products_count_drop"),
        "Service failure": c("recent_service_failure"),
        "Voluntary closure": F.lit(True),
    }


def first_reason(reasons: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(condition, reason) for reason, condition in reasons.items()])


def with_triggers(signals: DataFrame) -> DataFrame:
    return signals.withColumn("hard_reason", first_reason(hard_triggers()))


def churn_score(signals: DataFrame, noise: Column | None = None) -> DataFrame:
    """Risk and probability; a hard trigger overrides both. Noise is an input, 0 by default."""
    risk = F.col("base_rate")
    for component, weight in K.SCORE_WEIGHTS.items():
        risk = risk + F.col(component) * weight
    risk = risk + (F.lit(0.0) if noise is None else noise)
    scored = with_triggers(signals).withColumn("soft_risk", risk)
    hard = F.col("hard_reason").isNotNull()
    return scored.select(
        *signals.columns, "hard_reason",
        F.when(hard, K.HARD_TRIGGER_RISK).otherwise(F.col("soft_risk")).alias("churn_risk"),
        F.when(hard, 1.0).otherwise(sigmoid(F.col("soft_risk"))).alias("churn_prob"),
    )


def churn_decision(scored: DataFrame, mode: str = "bernoulli", seed: int = 42) -> DataFrame:
    """Add `churned`: probability above the persona threshold, or above a seeded uniform."""
    hard = F.col("hard_reason").isNotNull()
    if mode == "threshold":
        config = persona_config(scored.sparkSession).select("persona", "threshold")
        rows = scored.join(config, "persona")
        soft = F.col("churn_prob") > F.col("threshold")
    elif mode == "bernoulli":
        rows = scored
        key = F.col("customer_id") * 100_000 + month_index(F.col("snapshot_month"))
        soft = uniform_millionths(key, seed) < F.col("churn_prob") * 1_000_000
    else:
        raise ValueError(mode)
    return rows.select(*scored.columns, (hard | soft).alias("churned"))


def churn_reason(decided: DataFrame) -> DataFrame:
    soft = F.when(F.col("churned"), first_reason(soft_reasons()))
    return decided.withColumn("churn_reason", F.coalesce("hard_reason", soft))


def churn_state(decided: DataFrame, state: DataFrame) -> DataFrame:
    """One row per customer: first churn month with its reason, and months until then."""
    reasons = churn_reason(decided)
    month, churned = F.col("snapshot_month"), F.col("churned")
    grouped = reasons.groupBy("customer_id").agg(
        F.min(F.when(churned, F.struct(month, F.col("churn_reason")))).alias("first"),
        F.min(month).alias("first_month"),
        F.max(month).alias("last_month"),
    )
    end = F.coalesce(F.col("first.snapshot_month"), F.col("last_month"))
    rows = grouped.join(
        state.select("customer_id", "persona", "low_sensitivity_segment"), "customer_id"
    )
    return rows.select(
        "customer_id", "persona", "low_sensitivity_segment",
        F.col("first.snapshot_month").alias("churn_month"),
        F.col("first").isNotNull().alias("churned_flag"),
        F.col("first.churn_reason").alias("churn_reason"),
        (month_index(end) - month_index(F.col("first_month")) + 1).cast("int")
        .alias("active_months_generated"),
    )
