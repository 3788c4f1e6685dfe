from pyspark.sql import functions as F

from tests.conftest import month, rows
from tidemark.plans import behaviour

EVENT = "customer_id long, event_month date, event_type string"


def test_mutual_exclusion(spark):
    events = spark.createDataFrame(
        [(1, month(1), e) for e in
         ("salary_delay", "salary_job_change", "home_purchase", "large_life_expense", "relocation")]
        + [(1, month(2), "salary_delay"), (2, month(1), "large_life_expense")], EVENT)
    got = {(c, m, e) for c, m, e in rows(behaviour.event_mutual_exclusion(events))}
    assert got == {(1, month(1), "salary_job_change"), (1, month(1), "home_purchase"),
                   (1, month(1), "relocation"), (1, month(2), "salary_delay"),
                   (2, month(1), "large_life_expense")}


def complaints(spark, *items):
    return spark.createDataFrame(
        [(i, c, m, s, "Service", "Staff Behavior") for i, (c, m, s) in enumerate(items)],
        "complaint_id long, customer_id long, complaint_month date, severity string, "
        "category string, root_cause string")


def test_resolution_needs_a_later_month(spark):
    events = spark.createDataFrame(
        [(1, month(m), "complaint_resolved") for m in (2, 3)], EVENT)
    filed = complaints(spark, (1, month(2), "Low"), (1, month(1), "Low"), (1, month(3), "Low"))
    got = rows(behaviour.complaint_resolution(filed, events), "complaint_id")
    assert [r[4] for r in got] == [month(3), month(2), None]
    assert [r[6] for r in got] == ["Resolved", "Resolved", "Open"]


def test_root_cause_precedence(spark):
    events = spark.createDataFrame(
        [(1, month(1), e) for e in
         ("bank_service_failure", "salary_delay", "fee_hike_or_service_charge")]
        + [(2, month(1), "salary_delay"), (3, month(1), "fee_hike_or_service_charge")], EVENT)
    filed = complaints(spark, (1, month(1), "Low"), (2, month(1), "Low"), (3, month(1), "High"),
                       (4, month(1), "High"))
    got = rows(behaviour.complaint_root_cause(filed, events), "complaint_id")
    assert [r[3:] for r in got] == [
        ("Tech Issue", "System Outage", "High"),
        ("Transaction", "Delayed Salary Processing", "Medium"),
        ("Billing", "Excessive Charges", "Medium"), ("Service", "Staff Behavior", "High")]


def test_resolution_bands(spark):
    df = spark.createDataFrame(
        [(1, "Low", 7), (2, "Low", 26), (3, "High", 34), (4, "High", 75), (5, "Odd", 9),
         (6, "Low", None)], "complaint_id long, severity string, resolution_days int")
    got = rows(behaviour.resolution_sla(df).select("complaint_id", "out_of_band"), "complaint_id")
    assert got == [(1, False), (2, True), (3, True), (4, False), (5, True)]


def test_surveys_once_per_month_and_by_rate(spark):
    state = spark.range(4000).select(
        F.col("id").alias("customer_id"), F.lit("salary_core").alias("persona"),
        F.lit(month(3)).alias("churn_month"))
    resolved = spark.range(2000).select(
        F.col("id").alias("customer_id"), F.lit(month(2)).alias("resolved_month"))
    targets = behaviour.survey_targets(resolved, state, month(1), 6)
    assert targets.groupBy("customer_id", "snapshot_month").count().filter("count > 1").isEmpty()
    assert targets.filter(F.col("snapshot_month") > month(3)).isEmpty()
    after = targets.filter("topic = 'Complaint Resolution'")
    assert after.filter(F.col("snapshot_month") != month(2)).isEmpty()
    assert 330 < after.count() < 470
    assert 150 < targets.filter("topic <> 'Complaint Resolution'").count() < 330


def test_expected_scores(spark):
    targets = spark.createDataFrame(
        [(1, "salary_core", month(1), "General"), (2, "affluent_multi_product", month(1),
                                                  "Complaint Resolution"),
         (3, "complaint_prone_churner", month(1), "General")],
        "customer_id long, persona string, snapshot_month date, topic string")
    balance = spark.createDataFrame([(1, month(1), 1), (3, month(1), 9)],
                                    "customer_id long, snapshot_month date, open_now long")
    events = spark.createDataFrame([(3, month(1), "bank_service_failure")], EVENT)
    got = rows(behaviour.expected_nps_csat(targets, balance, events), "customer_id")
    assert [r[3:] for r in got] == [(6, 3), (10, 5), (0, 1)]


def test_resolution_gate_matches_a_loop(spark):
    resolutions = [3, 4, 7]
    filed = [1, 4, 5]
    events = spark.createDataFrame(
        [(1, month(m), "complaint_resolved") for m in resolutions], EVENT)
    df = complaints(spark, *[(1, month(m), "Low") for m in filed])
    got = {r[1] for r in rows(behaviour._resolvable_months(events, df))}
    expected, closed = set(), set()
    for m in resolutions:
        open_ = {f for f in filed if f < m} - closed
        if open_:
            expected.add(month(m))
        closed |= open_
    assert got == expected


def test_holdings_follow_acquisitions(spark):
    customers = spark.createDataFrame([(1,), (2,)], "customer_id long")
    acquired = spark.createDataFrame(
        [(1, "savings_account_flag", month(1)), (1, "insurance_flag", month(3))],
        "customer_id long, product string, acquired_month date")
    got = rows(behaviour.holdings_panel(customers, acquired, month(1), 3)
               .select("customer_id", "products_count"), "customer_id", "snapshot_month")
    assert [r[1] for r in got] == [1, 1, 2, 0, 0, 0]
