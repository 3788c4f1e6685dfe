import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import month, rows
from tidemark.plans import features, labels, parity, quality
from tidemark.plans.features_joined import feature_snapshot_joins
from tidemark.sources.bank import Bank
from tidemark.sources.schemas import SCHEMAS


class TinyBank(Bank):
    """One customer without any rows, unless a table is given."""

    def build(self, name):
        if name == "hidden_events":
            return self.spark.createDataFrame(
                [], "customer_id long, event_month date, event_type string")
        return self.spark.createDataFrame([], SCHEMAS[name])


def frame(spark, name, *records):
    schema = SCHEMAS[name]
    filled = [tuple(r.get(f.name) for f in schema) for r in records]
    loose = type(schema)([type(f)(f.name, f.dataType, True) for f in schema])
    return spark.createDataFrame(filled, loose)


def tiny(spark, as_of=month(8), **tables):
    base = {
        "customer_master": frame(spark, "customer_master", {
            "customer_id": 1, "annual_income": Decimal("120000"), "customer_since": month(1)}),
        "customer_churn_label": frame(spark, "customer_churn_label", {
            "customer_id": 1, "as_of_month": as_of, "prediction_horizon_months": 3,
            "churned": False}),
    }
    for name, records in tables.items():
        base[name] = frame(spark, name, *[{"customer_id": 1, **r} for r in records])
    return TinyBank(spark).replace(**base)


def only(bank, strict=False):
    got = features.feature_snapshot(bank, strict).collect()
    assert len(got) == 1
    return got[0]


def test_defaults_without_any_rows(spark):
    row = only(tiny(spark))
    assert (row.products_count, row.dormant_days, row.days_since_last_login) == (1, 180, 180)
    assert row.nps_avg_12m == 8.0 and row.tenure_months == 7
    rest = ("balance_change_3m", "txn_count_change_3m", "complaint_count_6m",
            "unresolved_complaints", "salary_credit_consistency", "credit_utilization",
            "emi_to_income_ratio", "campaign_response_rate", "product_acquisition_velocity_6m")
    assert all(row[name] == 0 for name in rest)


def test_half_open_complaint_window(spark):
    filed = [{"complaint_id": i, "complaint_month": month(m), "resolved_flag": m != 7}
             for i, m in enumerate((1, 2, 7, 8))]
    row = only(tiny(spark, customer_complaints=filed))
    assert row.complaint_count_6m == 2 and row.unresolved_complaints == 1


def test_activity_that_stopped_counts_as_minus_one(spark):
    months = [{"snapshot_month": month(3), "debit_txn_count": 4, "credit_txn_count": 0,
               "login_count": 0, "days_since_last_txn": 3}]
    row = only(tiny(spark, customer_monthly_activity=months))
    assert row.txn_count_change_3m == -1.0 and row.dormant_days == 180


def test_velocity_never_negative(spark):
    held = [{"snapshot_month": month(m), "products_count": n} for m, n in ((2, 5), (7, 3))]
    row = only(tiny(spark, product_holdings_monthly=held))
    assert (row.products_count, row.product_acquisition_velocity_6m) == (3, 0)


def test_strict_mode_sees_a_complaint_as_open_until_it_is_closed(spark):
    filed = [{"complaint_id": 1, "complaint_month": month(6), "resolved_flag": True}]
    bank = tiny(spark, customer_complaints=filed)
    events = spark.createDataFrame([(1, month(9), "complaint_resolved")],
                                   "customer_id long, event_month date, event_type string")
    bank = bank.replace(**bank._tables, hidden_events=events)
    assert only(bank).unresolved_complaints == 0
    assert only(bank, strict=True).unresolved_complaints == 1


def test_label_boundaries(spark):
    state = spark.createDataFrame([(1, month(10), "x"), (2, None, None)],
                                  "customer_id long, churn_month date, churn_reason string")
    got = {(r[0], r[1], r[2]): r[3] for r in rows(labels.churn_label(state, month(1), 12))}
    assert got[1, month(9), 1] and got[1, month(7), 3] and not got[1, month(6), 3]
    assert (1, month(10), 1) not in got and (2, month(12), 12) in got
    full = labels.churn_label(state, month(1), 12, require_full_horizon=True)
    assert full.filter((F.col("customer_id") == 2) & (F.col("prediction_horizon_months") == 12)).isEmpty()


def test_window_and_join_shapes_agree(spark, bank):
    got = dict(rows(parity.parity_columns(
        features.feature_snapshot(bank), feature_snapshot_joins(bank),
        ["customer_id", "as_of_month", "prediction_horizon_months"])))
    assert len(got) == 19 and set(got.values()) == {0}


def test_later_facts_do_not_change_features(spark, bank):
    leaks = quality.changed_by_later_facts(bank, features.feature_rows, dt.date(2025, 3, 1))
    assert leaks.isEmpty()


def test_removed_facts_show_a_peeking_feature(spark, bank):
    def peeking(b):
        now = b.customer_complaints.groupBy(
            "customer_id", F.col("complaint_month").alias("as_of_month")).count()
        return now

    assert not quality.changed_by_later_facts(bank, peeking, dt.date(2025, 3, 1)).isEmpty()


def test_sources_of_every_month_lie_before_it(spark, bank):
    """Only the planted feature and the final resolved flag look ahead, and in many months."""
    report = rows(quality.leak_future_months(bank).select(
        "feature", "as_of_month", "n_leaking", "largest_lead"))
    leaking = {r[0] for r in report if r[2]}
    assert leaking == {"planted_current_month", "unresolved_complaints"}
    assert len({r[1] for r in report}) == 18
    assert {r[3] for r in report if r[0] == "planted_current_month"} == {0}
    assert all(r[3] < 0 for r in report if r[0] == "unresolved_complaints_strict" and r[3] is not None)
    clean = quality.leak_future_months(bank, {})
    assert clean.filter("feature = 'planted_current_month'").isEmpty()


def test_source_month_follows_the_fact(spark):
    """A complaint of month 6 closed in month 9: its final flag is later than as-of month 8."""
    filed = [{"complaint_id": 1, "complaint_month": month(6), "resolved_flag": True}]
    held = [{"snapshot_month": month(m), "products_count": 1} for m in (2, 7, 8)]
    bank = tiny(spark, customer_complaints=filed, product_holdings_monthly=held)
    events = spark.createDataFrame([(1, month(9), "complaint_resolved")],
                                   "customer_id long, event_month date, event_type string")
    bank = bank.replace(**bank._tables, hidden_events=events)
    got = {r.feature: r.largest_lead for r in quality.leak_future_months(bank).collect()}
    assert got["unresolved_complaints"] == 1 and got["unresolved_complaints_strict"] == -2
    assert got["products_count"] == -1 and got["complaint_count_6m"] == -2
    assert got["dormant_days"] is None


def test_all_keys_in_one_grouping_equal_the_single_reports(spark, bank):
    """Also with keys that are null, repeated or without a parent, and with an empty table."""
    customers = bank.customer_master
    no_id = customers.limit(2).withColumn("customer_id", F.lit(None).cast("bigint"))
    snapshots = bank.product_holdings_monthly
    broken = bank.replace(
        customer_master=customers.filter("customer_id % 7 <> 0").unionAll(no_id).unionAll(customers.limit(3)),
        product_holdings_monthly=snapshots.unionAll(snapshots.limit(5)),
        card_portfolio=bank.card_portfolio.limit(0),
    )
    for some in (bank, broken):
        alone = [r(some) for r in (quality.dq_single_pk, quality.dq_composite_grain, quality.dq_foreign_keys)]
        want = sorted(row for report in alone for row in rows(report))
        assert rows(quality.all_keys(some), "check_name") == want
    assert sum(not r[1] for r in want) >= 5


def test_schema_contract_reports_problems(spark):
    good = frame(spark, "customer_feedback", {
        "feedback_id": 1, "customer_id": 1, "feedback_date": month(1), "feedback_month": month(1),
        "survey_channel": "SMS", "survey_topic": "General"})
    bad = (good.withColumn("survey_channel", F.lit("x" * 51))
           .withColumn("survey_topic", F.lit(None).cast("string"))
           .withColumn("nps_score", F.lit(1.5)).drop("csat_score").withColumn("more", F.lit(1)))

    def status(df):
        report = quality.schema_contract(
            TinyBank(spark).replace(customer_feedback=df), ("customer_feedback",))
        return dict(rows(report.select("column_name", "status")))

    assert set(status(good).values()) == {"ok"}
    found = {k: v for k, v in status(bad).items() if v != "ok"}
    assert found == {"survey_channel": "text too long", "survey_topic": "nulls not allowed",
                     "nps_score": "type mismatch", "csat_score": "missing column",
                     "more": "extra column"}


@pytest.mark.parametrize("name", ["customer_churn_label", "customer_monthly_activity"])
def test_tables_have_the_declared_types(bank, name):
    declared = [(f.name, f.dataType) for f in SCHEMAS[name]]
    assert [(f.name, f.dataType) for f in bank.table(name).schema] == declared
