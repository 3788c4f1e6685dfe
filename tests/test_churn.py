import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import month, rows
from tidemark import constants as K
from tidemark.plans import churn

DEFAULTS = {
    "persona": "salary_core", "base_rate": -4.0, "event_score": 0.0, "trend_score": 0.0,
    "product_score": 0.0, "complaint_score": 0.0, "loan_stress_score": 0.0,
    "digital_inactivity_score": 0.0, "dpd_days": 0, "loan_status": "Active",
    "complaint_count_6m": 0, "unresolved_complaints": 0, "current_balance": Decimal("1000.00"),
    "months_without_salary": 0, "service_failures_2m": 0, "digital_inactive_months": 0,
    "core_account_closed": False, "recent_salary_job_change": False,
    "products_count_drop": False, "recent_service_failure": False,
}


def signals(spark, *cases):
    data = [{"customer_id": i, "snapshot_month": month(1), **DEFAULTS, **c}
            for i, c in enumerate(cases)]
    return spark.createDataFrame(data)


def reasons(spark, *cases):
    return [r[1] for r in rows(
        churn.with_triggers(signals(spark, *cases)).select("customer_id", "hard_reason"),
        "customer_id")]


DEFAULT_LOAN = {"loan_status": "Delinquent", "dpd_days": 90}
LOST = {"recent_salary_job_change": True, "months_without_salary": 2}
UNHAPPY = {"complaint_count_6m": 4, "unresolved_complaints": 2}
DORMANT = {"current_balance": Decimal("499.99"), "months_without_salary": 3}
FAILED = {"service_failures_2m": 2, "digital_inactive_months": 2}
CLOSED = {"core_account_closed": True}


def test_each_hard_trigger_and_its_boundary(spark):
    assert reasons(spark, DEFAULT_LOAN, LOST, UNHAPPY, DORMANT, FAILED, CLOSED) == [
        "Loan default", "Salary account lost", "Service dissatisfaction", "Account dormancy",
        "Service failure", "Voluntary closure"]
    assert reasons(
        spark, {"dpd_days": 90}, {**LOST, "months_without_salary": 1},
        {**UNHAPPY, "complaint_count_6m": 3}, {**DORMANT, "current_balance": Decimal("500.00")},
        {**FAILED, "digital_inactive_months": 1}, {},
    ) == [None] * 6


def test_triggers_are_tried_in_order(spark):
    everything = [DEFAULT_LOAN, LOST, UNHAPPY, DORMANT, FAILED, CLOSED]
    cases = []
    for first in range(len(everything)):
        case = {}
        for trigger in reversed(everything[first:]):
            case.update(trigger)
        cases.append(case)
    got = reasons(spark, *cases)
    assert got[0] == "Loan default" and got[2] == "Service dissatisfaction"
    assert got[4] == "Service failure" and got[5] == "Voluntary closure"


def test_a_trigger_overrides_the_score(spark):
    scored = churn.churn_score(signals(spark, DEFAULT_LOAN, {}))
    got = rows(scored.select("churn_risk", "churn_prob"), "customer_id")
    assert got[0] == (K.HARD_TRIGGER_RISK, 1.0)
    assert got[1][0] == -4.0 and abs(got[1][1] - 0.0179862) < 1e-6


def test_score_weights(spark):
    case = {"base_rate": 0.0, "event_score": 1.0, "product_score": 1.0, "complaint_score": 2.0,
            "loan_stress_score": 0.5, "digital_inactivity_score": 1.0, "trend_score": 1.0}
    scored = churn.churn_score(signals(spark, case), F.lit(0.05)).first()
    assert abs(scored.churn_risk - (0.30 - 0.10 + 0.50 + 0.10 + 0.15 + 0.15 + 0.05)) < 1e-12


def test_threshold_decision_depends_on_persona(spark):
    cases = [{"base_rate": 0.5, "persona": p} for p in ("salary_core", "complaint_prone_churner")]
    decided = churn.churn_decision(churn.churn_score(signals(spark, *cases)), "threshold")
    assert dict(rows(decided.select("persona", "churned"))) == {
        "salary_core": False, "complaint_prone_churner": True}


def test_bernoulli_frequency(spark):
    df = signals(spark, {"base_rate": 0.0}).drop("customer_id").crossJoin(
        spark.range(5000).withColumnRenamed("id", "customer_id"))
    decided = churn.churn_decision(churn.churn_score(df))
    assert 0.47 < decided.filter("churned").count() / 5000 < 0.53


def test_soft_reasons(spark):
    cases = [
        {"dpd_days": 90}, {"months_without_salary": 2, "recent_salary_job_change": True},
        {"unresolved_complaints": 1}, {"complaint_count_6m": 2},
        {"digital_inactive_months": 2}, {"products_count_drop": True},
        {"recent_service_failure": True}, {},
    ]
    soft = signals(spark, *cases).select(
        "customer_id", churn.first_reason(churn.soft_reasons()).alias("r"))
    assert [r[1] for r in rows(soft, "customer_id")] == [
        "Loan default", "Salary account lost", "Service dissatisfaction",
        "Service dissatisfaction", "Account dormancy", "Product disengagement",
        "Service failure", "Voluntary closure"]


def test_state_keeps_the_first_churn(spark):
    df = spark.createDataFrame([
        {**DEFAULTS, "customer_id": 1, "snapshot_month": month(m), "hard_reason": r, "churned": c}
        for m, r, c in ((1, None, False), (2, "Service failure", True), (3, "Loan default", True))
    ], schema=None)
    state = spark.createDataFrame([(1, "salary_core", True)],
                                  "customer_id long, persona string, low_sensitivity_segment boolean")
    got = churn.churn_state(df, state).first()
    assert (got.churn_month, got.churn_reason, got.active_months_generated) == (
        dt.date(2024, 2, 1), "Service failure", 2)
