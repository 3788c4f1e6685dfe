"""Declared contracts of the 17 bank tables: columns, types, nullability, keys, partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import constants as K

MONEY = T.DecimalType(18, 2)


def _fields(names: str, dtype: T.DataType, nullable: bool = False) -> list[T.StructField]:
    return [T.StructField(name, dtype, nullable) for name in names.split()]


def ids(names: str, nullable: bool = False):
    return _fields(names, T.LongType(), nullable)


def ints(names: str, nullable: bool = False):
    return _fields(names, T.IntegerType(), nullable)


def dates(names: str, nullable: bool = False):
    return _fields(names, T.DateType(), nullable)


def flags(names: str):
    return _fields(names, T.BooleanType())


def amounts(names: str):
    return _fields(names, MONEY)


def ratios(names: str):
    return _fields(names, T.DoubleType(), True)


def text(limit: int, names: str, nullable: bool = False):
    return [
        T.StructField(name, T.StringType(), nullable, {"max_length": limit})
        for name in names.split()
    ]


_LABEL_KEY = [*ids("customer_id"), *dates("as_of_month"), *ints("prediction_horizon_months")]
_LABEL = [*flags("churned"), *dates("churn_date", True), *text(100, "churn_reason", True)]

# Column names, types and lengths of each table, in load order.
SCHEMAS: dict[str, T.StructType] = {
    "branch_master": T.StructType([
        *text(20, "branch_code"), *text(100, "branch_name city state"), *text(50, "region"),
        *text(30, "branch_type"), *dates("open_date"), *dates("closure_date", True),
        *ints("customer_weight"),
    ]),
    "customer_master": T.StructType([
        *ids("customer_id"), *text(20, "cif_number"), *text(100, "first_name last_name"),
        *dates("date_of_birth"), *text(20, "gender marital_status"), *text(100, "occupation"),
        *text(50, "employment_type"), *amounts("annual_income"), *dates("customer_since"),
        *text(100, "city state country"), *text(20, "kyc_status"), *flags("is_active"),
        *text(20, "branch_code", True),
    ]),
    "account_master": T.StructType([
        *ids("account_id"), *ids("customer_id", True), *text(20, "branch_code", True),
        *text(50, "account_type"), *dates("open_date"), *text(20, "account_status"),
        *text(3, "account_currency"), *flags("salary_account_flag"), *amounts("overdraft_limit"),
        *dates("account_close_date", True),
    ]),
    "card_portfolio": T.StructType([
        *ids("card_id"), *ids("customer_id", True), *text(20, "card_type network"),
        *dates("issue_date expiry_date"), *text(20, "card_status"), *flags("primary_card_flag"),
        *amounts("credit_limit"), *text(50, "rewards_program"), *text(20, "reward_tier"),
    ]),
    "loan_master": T.StructType([
        *ids("loan_id"), *ids("customer_id", True), *text(20, "branch_code", True),
        *text(50, "loan_type"), *amounts("sanctioned_amount"), *dates("disbursement_date"),
        *_fields("interest_rate", T.DecimalType(6, 3)), *ints("tenure_months"),
        *amounts("emi_amount"), *text(100, "loan_purpose"), *text(50, "origination_channel"),
        *text(20, "loan_status"), *dates("maturity_date"),
    ]),
    "account_monthly_snapshot": T.StructType([
        *ids("account_id"), *dates("snapshot_month"),
        *amounts("current_balance average_monthly_balance min_balance_30d max_balance_30d"),
        *ints("deposit_count withdrawal_count debit_txn_count credit_txn_count"),
        *amounts("fee_charged_amount salary_credit_amount"), *text(20, "account_status"),
    ]),
    "card_monthly_snapshot": T.StructType([
        *ids("card_id"), *dates("snapshot_month"), *amounts("monthly_spend_amount"),
        *ints("monthly_txn_count"), *amounts("cash_advance_amount"),
        *_fields("utilization_rate", T.DecimalType(10, 4)),
        *amounts("min_due_amount payment_made_amount"), *ids("rewards_points_balance"),
        *text(20, "card_status"), *flags("delinquency_flag"),
    ]),
    "loan_monthly_snapshot": T.StructType([
        *ids("loan_id"), *dates("snapshot_month"), *amounts("outstanding_balance emi_amount"),
        *ints("dpd_days"),
        *amounts("overdue_amount principal_paid_amount interest_paid_amount"),
        *amounts("installment_due_amount installment_paid_amount"), *text(20, "loan_status"),
        *flags("restructuring_flag"),
    ]),
    "product_holdings_monthly": T.StructType([
        *ids("customer_id"), *dates("snapshot_month"), *flags(" ".join(K.PRODUCT_FLAGS)),
        *ints("products_count"),
    ]),
    "transaction_fact": T.StructType([
        *ids("transaction_id"), *ids("account_id customer_id", True),
        *_fields("txn_timestamp", T.TimestampType()), *dates("txn_date txn_month"),
        *text(50, "txn_type"), *text(10, "direction"), *text(30, "channel"), *amounts("amount"),
        *text(3, "currency"), *text(100, "merchant_category"), *text(150, "merchant_name"),
        *text(50, "counterparty_type"), *text(100, "city state"),
        *flags("is_salary_credit is_fee is_reversal"), *amounts("balance_after_txn"),
    ]),
    "customer_monthly_activity": T.StructType([
        *ids("customer_id"), *dates("snapshot_month"),
        *ints("login_count mobile_app_sessions internet_banking_sessions atm_transactions"),
        *ints("branch_visits debit_txn_count credit_txn_count"),
        *amounts("total_debit_amount total_credit_amount avg_transaction_value"),
        *ints("unique_merchants cash_withdrawal_count card_present_txn_count"),
        *ints("card_not_present_txn_count days_since_last_txn days_since_last_login"),
    ]),
    "digital_engagement_monthly": T.StructType([
        *ids("customer_id"), *dates("snapshot_month"), *flags("mobile_app_active"),
        *dates("last_login_date", True),
        *ints("push_notifications_sent push_notifications_opened email_campaigns_sent"),
        *ints("email_clicks campaigns_received campaigns_responded web_sessions"),
        *flags("notification_opt_in"), *ints("app_crash_count"),
    ]),
    "customer_complaints": T.StructType([
        *ids("complaint_id"), *ids("customer_id", True), *dates("complaint_date complaint_month"),
        *text(50, "channel"), *text(100, "category"), *text(20, "severity"),
        *ints("resolution_days", True), *flags("resolved_flag escalated_flag"),
        *ints("csat_score", True), *text(100, "root_cause"), *text(20, "status"),
    ]),
    "customer_feedback": T.StructType([
        *ids("feedback_id"), *ids("customer_id", True), *dates("feedback_date feedback_month"),
        *text(50, "survey_channel"), *text(100, "survey_topic"),
        *ints("nps_score csat_score", True),
    ]),
    "churn_simulation_state": T.StructType([
        *ids("customer_id"), *text(50, "persona"), *flags("low_sensitivity_segment"),
        *dates("churn_month", True), *flags("churned_flag"), *text(100, "churn_reason", True),
        *ints("active_months_generated"),
    ]),
    "customer_churn_label": T.StructType([*_LABEL_KEY, *_LABEL]),
    "churn_feature_snapshot": T.StructType([
        *_LABEL_KEY, *ints("tenure_months products_count"),
        *ratios("balance_change_3m txn_count_change_3m login_count_change_6m"),
        *ints("complaint_count_6m unresolved_complaints days_since_last_login"),
        *ratios("salary_credit_consistency credit_utilization emi_to_income_ratio"),
        *ints("dormant_days"), *ratios("nps_avg_12m campaign_response_rate"),
        *ints("product_acquisition_velocity_6m"), *_LABEL,
    ]),
}

LOAD_ORDER = tuple(SCHEMAS)


def cast_contract(df: DataFrame, name: str) -> DataFrame:
    """Columns of a table in declared order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]])


# Partition column of each monthly table; the rest are static.
PARTITION_COLUMN = {
    "account_monthly_snapshot": "snapshot_month",
    "card_monthly_snapshot": "snapshot_month",
    "loan_monthly_snapshot": "snapshot_month",
    "product_holdings_monthly": "snapshot_month",
    "transaction_fact": "txn_month",
    "customer_monthly_activity": "snapshot_month",
    "digital_engagement_monthly": "snapshot_month",
    "customer_complaints": "complaint_month",
    "customer_feedback": "feedback_month",
    "customer_churn_label": "as_of_month",
    "churn_feature_snapshot": "as_of_month",
}
STATIC_TABLES = tuple(t for t in SCHEMAS if t not in PARTITION_COLUMN)

# Keys.
SINGLE_KEYS = {
    "branch_master": "branch_code",
    "customer_master": "customer_id",
    "account_master": "account_id",
    "card_portfolio": "card_id",
    "loan_master": "loan_id",
    "churn_simulation_state": "customer_id",
    "transaction_fact": "transaction_id",
    "customer_complaints": "complaint_id",
    "customer_feedback": "feedback_id",
}
COMPOSITE_KEYS = {
    "account_monthly_snapshot": ("account_id", "snapshot_month"),
    "card_monthly_snapshot": ("card_id", "snapshot_month"),
    "loan_monthly_snapshot": ("loan_id", "snapshot_month"),
    "product_holdings_monthly": ("customer_id", "snapshot_month"),
    "customer_monthly_activity": ("customer_id", "snapshot_month"),
    "digital_engagement_monthly": ("customer_id", "snapshot_month"),
    "customer_churn_label": ("customer_id", "as_of_month", "prediction_horizon_months"),
    "churn_feature_snapshot": ("customer_id", "as_of_month", "prediction_horizon_months"),
}
FOREIGN_KEYS = (
    ("account_master", "customer_id", "customer_master"),
    ("account_master", "branch_code", "branch_master"),
    ("account_monthly_snapshot", "account_id", "account_master"),
    ("card_portfolio", "customer_id", "customer_master"),
    ("card_monthly_snapshot", "card_id", "card_portfolio"),
    ("loan_master", "customer_id", "customer_master"),
    ("loan_master", "branch_code", "branch_master"),
    ("loan_monthly_snapshot", "loan_id", "loan_master"),
    ("product_holdings_monthly", "customer_id", "customer_master"),
    ("transaction_fact", "customer_id", "customer_master"),
    ("transaction_fact", "account_id", "account_master"),
    ("customer_monthly_activity", "customer_id", "customer_master"),
    ("digital_engagement_monthly", "customer_id", "customer_master"),
    ("customer_complaints", "customer_id", "customer_master"),
    ("customer_feedback", "customer_id", "customer_master"),
    ("churn_simulation_state", "customer_id", "customer_master"),
    ("customer_churn_label", "customer_id", "customer_master"),
    ("churn_feature_snapshot", "customer_id", "customer_master"),
)
