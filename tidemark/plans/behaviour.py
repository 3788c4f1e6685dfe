"""Customer behaviour: event rules, complaints, surveys, campaigns and product holdings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.calendar import month_index, month_sequence
from tidemark.functions.hashing import uniform_millionths
from tidemark.functions.scores import clip_score
from tidemark.operators.aggregates import products_count
from tidemark.operators.joins import first_event_after
from tidemark.operators.panel import stack_measures
from tidemark.session import inline_table


def has_event(name: str) -> Column:
    """Aggregate: whether a group of event rows contains an event."""
    return F.coalesce(F.bool_or(F.col("event_type") == name), F.lit(False))


def event_flags(events: DataFrame) -> DataFrame:
    """One row per customer and month with a flag per event the rules look at."""
    return events.groupBy("customer_id", "event_month").agg(
        has_event("bank_service_failure").alias("failure"),
        has_event("salary_delay").alias("delay"),
        has_event("fee_hike_or_service_charge").alias("fee"),
    )


def event_mutual_exclusion(events: DataFrame) -> DataFrame:
    """Drop a salary delay in a month of job change, and a large expense in one of home purchase.

    Events are distinct per customer and month, so a window group has at most twelve rows.
    """
    group = Window.partitionBy("customer_id", "event_month")
    event = F.col("event_type")

    def occurs(name: str) -> Column:
        return F.max(event == name).over(group)

    marked = events.withColumn("job_change", occurs("salary_job_change")).withColumn(
        "home", occurs("home_purchase")
    )
    dropped = (F.col("job_change") & (event == "salary_delay")) | (
        F.col("home") & (event == "large_life_expense")
    )
    return marked.filter(~dropped).select(*events.columns)


def _resolvable_months(events: DataFrame, complaints: DataFrame) -> DataFrame:
    """Months of resolution events that find a complaint filed earlier and still open.

    That is the case when the latest complaint before the event is no older than the previous
    resolution event, because an event closes everything filed strictly before it.
    """
    resolution = events.filter(F.col("event_type") == "complaint_resolved")
    monthly = stack_measures(
        [
            resolution.select("customer_id", F.col("event_month").alias("m"),
                              F.lit(True).alias("resolution")),
            complaints.select("customer_id", F.col("complaint_month").alias("m"),
                              F.lit(True).alias("filed")),
        ],
        ["customer_id", "m"],
        {"resolution": F.bool_or("resolution"), "filed": F.bool_or("filed")},
    )
    before = (
        Window.partitionBy("customer_id").orderBy("m")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    last_filed = F.max(F.when(F.col("filed"), F.col("m"))).over(before)
    last_resolution = F.max(F.when(F.col("resolution"), F.col("m"))).over(before)
    dated = monthly.select(
        "customer_id", F.col("m").alias("event_month"), "resolution",
        last_filed.alias("last_filed"), last_resolution.alias("last_resolution"),
    )
    still_open = F.col("last_resolution").isNull() | (
        F.col("last_filed") >= F.col("last_resolution")
    )
    return dated.filter(
        F.col("resolution") & F.col("last_filed").isNotNull() & still_open
    ).select("customer_id", "event_month")


def conditional_event_gate(
    events: DataFrame,
    cards: DataFrame,
    loan_states: DataFrame,
    complaints: DataFrame,
    digital: DataFrame,
    state: DataFrame,
) -> DataFrame:
    """Keep conditional events only where their precondition holds.

    Card decline needs an active card, delinquency a loan still active at the start of the month,
    resolution an open complaint, campaign exposure a digitally active customer; unconditional
    events pass. The preconditions are stacked into one flag row per customer and month, so the
    events are joined once per grain instead of once per rule.
    """
    month = ["customer_id", "event_month"]
    before = F.lag("loan_status", 1, "Active").over(
        Window.partitionBy("loan_id").orderBy("snapshot_month")
    )
    active_loans = (
        loan_states.withColumn("at_start", before)
        .filter(F.col("at_start") == "Active")
        .select("customer_id", F.col("snapshot_month").alias("event_month"),
                F.lit(True).alias("has_loan"))
    )
    used = F.col("mobile_app_active") | (F.col("web_sessions") > 0)
    online = digital.filter(used).select(
        "customer_id", F.col("snapshot_month").alias("event_month"), F.lit(True).alias("online")
    )
    resolvable = _resolvable_months(events, complaints).withColumn("resolvable", F.lit(True))
    monthly = stack_measures(
        [active_loans, online, resolvable], month,
        {n: F.bool_or(n) for n in ("has_loan", "online", "resolvable")},
    )
    customers = stack_measures(
        [
            cards.filter(F.col("card_status") == "Active").select(
                "customer_id", F.lit(True).alias("has_card")),
            state.filter(F.col("persona") == "digital_native").select(
                "customer_id", F.lit(True).alias("native")),
        ],
        ["customer_id"], {n: F.bool_or(n) for n in ("has_card", "native")},
    )
    event = F.col("event_type")
    passes = (
        F.when(event == "card_decline_spike", F.col("has_card"))
        .when(event == "loan_delinquency_start", F.col("has_loan"))
        .when(event == "complaint_resolved", F.col("resolvable"))
        .when(event == "campaign_exposure",
              F.coalesce("native", F.lit(False)) | F.coalesce("online", F.lit(False)))
        .otherwise(True)
    )
    rows = events.join(monthly, month, "left").join(customers, "customer_id", "left")
    return rows.filter(F.coalesce(passes, F.lit(False))).select(*events.columns)


def complaint_root_cause(complaints: DataFrame, events: DataFrame) -> DataFrame:
    """Category, root cause and severity implied by the month's events, in order of precedence."""
    flags = event_flags(events).withColumnRenamed("event_month", "complaint_month")
    rows = complaints.join(flags, ["customer_id", "complaint_month"], "left")

    def choose(failure, delay, fee, other) -> Column:
        return (
            F.when(F.col("failure"), failure).when(F.col("delay"), delay)
            .when(F.col("fee"), fee).otherwise(other)
        )

    severity = F.col("severity")
    delayed = F.when(severity == "High", "High").otherwise("Medium")
    return rows.select(
        "complaint_id", "customer_id", "complaint_month",
        choose("Tech Issue", "Transaction", "Billing", F.col("category")).alias("category"),
        choose("System Outage", "Delayed Salary Processing", "Excessive Charges",
               F.col("root_cause")).alias("root_cause"),
        choose("High", delayed, "Medium", severity).alias("severity"),
    )


def complaint_resolution(complaints: DataFrame, events: DataFrame) -> DataFrame:
    """Close each complaint at the customer's first resolution event in a later month."""
    dated = first_event_after(
        complaints.select("complaint_id", "customer_id", "complaint_month", "severity"),
        "complaint_month", events, "complaint_resolved",
    )
    resolved = F.col("next_event_month").isNotNull()
    return dated.select(
        "complaint_id", "customer_id", "complaint_month", "severity",
        F.col("next_event_month").alias("resolved_month"),
        resolved.alias("resolved_flag"),
        F.when(resolved, "Resolved").otherwise("Open").alias("status"),
    )


def resolution_months(complaints: DataFrame, events: DataFrame) -> DataFrame:
    """Complaints filed per customer and month, with the month that closes them all.

    Complaints of one customer and month share their resolution, so counts suffice wherever the
    single complaint does not matter; a customer with very many complaints stays small.
    """
    monthly = complaints.groupBy("customer_id", "complaint_month").agg(
        F.count(F.lit(1)).alias("n")
    )
    dated = first_event_after(monthly, "complaint_month", events, "complaint_resolved")
    return dated.select(
        "customer_id", "complaint_month", "n", F.col("next_event_month").alias("resolved_month")
    )


def resolution_sla(complaints: DataFrame) -> DataFrame:
    """Resolved complaints against the resolution time of their severity."""
    bands = F.broadcast(inline_table(
        complaints.sparkSession, ("severity", "low_days", "high_days"), K.RESOLUTION_DAYS
    ))
    days = F.col("resolution_days")
    return (
        complaints.filter(days.isNotNull())
        .join(bands, "severity", "left")
        .select(
            "complaint_id", "severity", "resolution_days", "low_days", "high_days",
            (~F.coalesce(days.between(F.col("low_days"), F.col("high_days")), F.lit(False)))
            .alias("out_of_band"),
        )
    )


def complaint_balance(resolutions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per calendar month: complaints filed, complaints closed, and open at the month's end."""
    monthly = stack_measures(
        [
            calendar.select("customer_id", "snapshot_month", F.lit(True).alias("wanted")),
            resolutions.select("customer_id", F.col("complaint_month").alias("snapshot_month"),
                               F.col("n").alias("filed")),
            resolutions.filter(F.col("resolved_month").isNotNull()).select(
                "customer_id", F.col("resolved_month").alias("snapshot_month"),
                F.col("n").alias("closed")),
        ],
        ["customer_id", "snapshot_month"],
        {"wanted": F.bool_or("wanted"), "filed": F.coalesce(F.sum("filed"), F.lit(0)),
         "closed": F.coalesce(F.sum("closed"), F.lit(0))},
    )
    so_far = (
        Window.partitionBy("customer_id").orderBy("snapshot_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    open_now = F.sum(F.col("filed") - F.col("closed")).over(so_far)
    return monthly.withColumn("open_now", open_now).filter("wanted").drop("wanted")


def active_calendar(state: DataFrame, first: dt.date, n_months: int) -> DataFrame:
    """Customer months up to and including the churn month."""
    rows = state.select(
        "customer_id", "persona", "churn_month",
        F.explode(month_sequence(first, n_months)).alias("snapshot_month"),
    )
    alive = F.col("churn_month").isNull() | (F.col("snapshot_month") <= F.col("churn_month"))
    return rows.filter(alive).select("customer_id", "persona", "snapshot_month")


def survey_targets(
    resolved: DataFrame, state: DataFrame, first: dt.date, n_months: int, seed: int = 42
) -> DataFrame:
    """Customers surveyed per month: a sample of those with a complaint resolved in the month,
    and a smaller sample of everybody else; at most one survey per customer and month."""
    closed = (
        resolved.filter(F.col("resolved_month").isNotNull())
        .select("customer_id", F.col("resolved_month").alias("snapshot_month"))
        .distinct()
        .withColumn("closed", F.lit(True))
    )
    rows = active_calendar(state, first, n_months).join(
        closed, ["customer_id", "snapshot_month"], "left"
    )
    key = F.col("customer_id") * 100_000 + month_index(F.col("snapshot_month"))
    after_resolution = F.coalesce(F.col("closed"), F.lit(False)) & (
        uniform_millionths(key, seed) < K.RESOLVED_SURVEY_RATE
    )
    at_random = uniform_millionths(key, seed + 1) < K.OTHER_SURVEY_RATE
    even = uniform_millionths(key, seed + 2) < 500_000
    topic = (
        F.when(after_resolution, "Complaint Resolution")
        .when(at_random & even, "General")
        .when(at_random, "Digital Experience")
    )
    return rows.select("customer_id", "persona", "snapshot_month", topic.alias("topic")).filter(
        F.col("topic").isNotNull()
    )


def expected_nps_csat(
    targets: DataFrame, balance: DataFrame, events: DataFrame
) -> DataFrame:
    """Scores a surveyed customer is expected to give: persona baseline plus modifiers."""
    baseline = F.broadcast(inline_table(
        targets.sparkSession, ("persona", "nps_base", "csat_base"),
        [(p[0], p[4], p[5]) for p in K.PERSONAS],
    ))
    month = ["customer_id", "snapshot_month"]
    flags = event_flags(events).withColumnRenamed("event_month", "snapshot_month")
    rows = (
        targets.join(balance.select(*month, "open_now"), month, "left")
        .join(flags, month, "left")
        .join(baseline, "persona")
    )
    open_now = F.coalesce(F.col("open_now"), F.lit(0)).cast("double")

    def score(base: str, cap, per_open, failure, fee, resolved) -> Column:
        return (
            F.col(base)
            - F.least(F.lit(cap), open_now * per_open)
            - F.when(F.col("failure"), failure).otherwise(0.0)
            - F.when(F.col("fee"), fee).otherwise(0.0)
            + F.when(F.col("topic") == "Complaint Resolution", resolved).otherwise(0.0)
        )

    # Cap, points per open complaint, service failure, fee, resolution bonus.
    nps = score("nps_base", 4.0, 1.5, 3.5, 1.5, 1.0)
    csat = score("csat_base", 2.0, 0.7, 1.8, 0.8, 0.5)
    return rows.select(
        *month, "topic",
        clip_score(nps, 0, 10).alias("nps_score"), clip_score(csat, 1, 5).alias("csat_score"),
    )


def campaign_uptake(digital: DataFrame, holdings: DataFrame) -> DataFrame:
    """Product gains in customer months by campaign exposure and response."""
    before = F.lag("products_count").over(
        Window.partitionBy("customer_id").orderBy("snapshot_month")
    )
    gains = (
        holdings.select("customer_id", "snapshot_month", "products_count", before.alias("before"))
        .filter(F.col("before").isNotNull())
        .withColumn("gain", F.greatest(F.lit(0), F.col("products_count") - F.col("before")))
    )
    exposure = digital.select(
        "customer_id", "snapshot_month",
        F.when(F.col("campaigns_responded") > 0, "responded")
        .when(F.col("campaigns_received") > 0, "received").alias("exposure"),
    )
    rows = gains.join(exposure, ["customer_id", "snapshot_month"], "left")
    n, total = F.count(F.lit(1)), F.sum("gain")
    return rows.groupBy(F.coalesce("exposure", F.lit("none")).alias("exposure")).agg(
        n.alias("customer_months"),
        total.alias("products_gained"),
        F.round(total.cast("double") / n.cast("double"), 6).alias("mean_gain"),
    )


def holdings_panel(
    customers: DataFrame, acquisitions: DataFrame, first: dt.date, n_months: int
) -> DataFrame:
    """Product flags and their count per customer and month, from acquisition dates."""
    since = acquisitions.groupBy("customer_id").agg(*[
        F.min(F.when(F.col("product") == p, F.col("acquired_month"))).alias(p)
        for p in K.PRODUCT_FLAGS
    ])
    months = customers.select("customer_id").join(since, "customer_id", "left").select(
        "*", F.explode(month_sequence(first, n_months)).alias("snapshot_month")
    )
    rows = months.select("customer_id", "snapshot_month", *[
        F.coalesce(F.col(p) <= F.col("snapshot_month"), F.lit(False)).alias(p)
        for p in K.PRODUCT_FLAGS
    ])
    return rows.withColumn("products_count", products_count())


def revoke_flag(holdings: DataFrame, rejected: DataFrame, flag: str) -> DataFrame:
    """Take a product away from rejected customers and recount."""
    marks = rejected.select("customer_id").distinct().withColumn("revoked", F.lit(True))
    rows = holdings.join(marks, "customer_id", "left")
    kept = F.col(flag) & F.col("revoked").isNull()
    return rows.withColumn(flag, kept).withColumn("products_count", products_count()).select(
        *holdings.columns
    )
