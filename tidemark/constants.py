"""Fixed values.

Everything below must hold exactly these values for results to be right: names, thresholds,
weights and limits of the banking domain. Nothing here is derived.
"""

from __future__ import annotations

import datetime as dt

# First month and length of the observation window.
FIRST_MONTH = dt.date(2024, 1, 1)
N_MONTHS = 24

# Label horizons in months, first as-of month with features, last training month.
HORIZONS = (1, 3, 6, 12)
WARM_UP_MONTHS = 6
LAST_TRAIN_MONTH = dt.date(2025, 6, 1)
TRAIN_HORIZON = 3

# First id of each entity.
CUSTOMER_ID_START = 1_000_000
ACCOUNT_ID_START = 10_000_000
CARD_ID_START = 20_000_000
LOAN_ID_START = 30_000_000

# Fixed values per persona: churn threshold, base monthly churn range, NPS and CSAT baseline,
# card rewards programme and tier.
PERSONA_FIELDS = (
    "persona", "threshold", "base_min", "base_max", "nps_base", "csat_base", "programme", "tier",
)
PERSONAS = (
    ("salary_core", 0.72, 0.003, 0.010, 8.0, 4.0, "Cashback Plus", "Silver"),
    ("affluent_multi_product", 0.78, 0.001, 0.004, 8.5, 4.2, "Premium Travel", "Platinum"),
    ("digital_native", 0.70, 0.001, 0.005, 8.2, 4.1, "Online Shopper", "Gold"),
    ("credit_stressed", 0.58, 0.005, 0.015, 6.0, 3.0, "Basic Cashback", "Classic"),
    ("dormant_wealthy", 0.74, 0.004, 0.015, 7.0, 3.5, "Premium Rewards", "Platinum"),
    ("complaint_prone_churner", 0.55, 0.010, 0.025, 5.0, 2.5, "Standard Cashback", "Silver"),
)
PERSONA_NAMES = tuple(p[0] for p in PERSONAS)
DEFAULT_REWARDS = ("Basic Cashback", "Classic")

# Hidden customer events.
EVENTS = (
    "salary_job_change", "salary_delay", "large_life_expense", "home_purchase",
    "marriage_or_family_change", "relocation", "bank_service_failure",
    "fee_hike_or_service_charge", "card_decline_spike", "campaign_exposure",
    "loan_delinquency_start", "complaint_resolved",
)

# Weights of the churn score.
SCORE_WEIGHTS = {
    "event_score": 0.30,
    "trend_score": 0.15,
    "product_score": -0.10,
    "complaint_score": 0.25,
    "loan_stress_score": 0.20,
    "digital_inactivity_score": 0.15,
}
HARD_TRIGGER_RISK = 999.0

# Churn reasons.
CHURN_REASONS = (
    "Loan default", "Salary account lost", "Service dissatisfaction", "Account dormancy",
    "Product disengagement", "Service failure", "Voluntary closure",
)

# Share of income that instalments may take, smallest loan, rounding step.
LOAN_TYPES = (
    ("Personal Loan", 0.40, 50_000.0, 1_000.0),
    ("Home Loan", 0.50, 2_000_000.0, 10_000.0),
)

# Credit limit is a multiple of monthly income, never below the floor.
CREDIT_LIMIT_MULTIPLIER = 3.0
CREDIT_LIMIT_FLOOR = 10_000.0

# Card repayment: minimum due, interest after the minimum, interest after nothing.
MIN_DUE_RATE = 0.05
MIN_PAID_INTEREST = 1.02
UNPAID_INTEREST = 1.03
DEBIT_CARD_SPEND_SHARE = 0.3

# Days past due step and terminal value.
DPD_STEP = 30
DPD_TERMINAL = 90

# Resolution days allowed per complaint severity.
RESOLUTION_DAYS = (("Low", 7, 25), ("Medium", 20, 45), ("High", 35, 75))

# Complaint channel, category and root cause names.
COMPLAINT_CHANNELS = ("Call Center", "Mobile App", "Branch", "Web")
COMPLAINT_CATEGORIES = ("Billing", "Service", "Transaction", "Tech Issue", "Account Access")
COMPLAINT_ROOT_CAUSES = (
    "Unclear Charge Description", "Staff Behavior", "UI Glitch", "Wrong Statement",
    "Slow Response Time",
)

# Transaction channels and their class.
TXN_CHANNELS = (
    "Transfer", "UPI", "POS", "ATM", "Mobile App", "Internet Banking", "System",
)
CASH_CHANNELS = ("ATM",)
CARD_PRESENT_CHANNELS = ("POS",)
CARD_NOT_PRESENT_CHANNELS = ("UPI", "Internet Banking", "Mobile App")

# Product flags that make up products_count (the debit card is not one of them).
PRODUCT_FLAGS = (
    "savings_account_flag", "current_account_flag", "credit_card_flag", "personal_loan_flag",
    "home_loan_flag", "fixed_deposit_flag", "insurance_flag", "mutual_fund_flag",
    "demat_account_flag", "wealth_management_flag",
)

# Feature defaults where a customer has no rows.
DEFAULT_PRODUCTS = 1
DEFAULT_DORMANT_DAYS = 180
DEFAULT_LOGIN_DAYS = 180
DEFAULT_NPS = 8.0

# Parity tolerances.
OVERALL_RATE_TOLERANCE = 0.01
SEGMENT_RATE_TOLERANCE = 0.02
KS_TOLERANCE = {"annual_income": 0.05, "final_balance": 0.07, "txn_count": 0.05}
ROW_COUNT_TOLERANCE = 0.25
FLOAT_TOLERANCE = 2e-4

# Survey sampling rates in millionths: customers with a resolved complaint, everybody else.
RESOLVED_SURVEY_RATE = 200_000
OTHER_SURVEY_RATE = 20_000
