"""Point-in-time features per customer and as-of month.

Every source is reduced to one row per customer and month and stacked into a single panel; all
fifteen features are then window frames over that panel, so they share one exchange and sort.
A frame [-k, -1] on month_idx is the half-open calendar window [as_of - k, as_of).
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.calendar import month_index, tenure_months
from tidemark.functions.scores import floored_diff, ratio_change, safe_rate
from tidemark.operators.joins import with_customer
from tidemark.operators.panel import stack_measures
from tidemark.plans.behaviour import resolution_months

KEYS = ("customer_id", "as_of_month")

# Features in the order of the output table.
FEATURES = (
    "tenure_months", "products_count", "balance_change_3m", "txn_count_change_3m",
    "login_count_change_6m", "complaint_count_6m", "unresolved_complaints",
    "days_since_last_login", "salary_credit_consistency", "credit_utilization",
    "emi_to_income_ratio", "dormant_days", "nps_avg_12m", "campaign_response_rate",
    "product_acquisition_velocity_6m",
)

MEASURES = {
    "is_spine": F.bool_or,
    "bal_cents": F.sum, "bal_n": F.sum, "salaried": F.max,
    "util_units": F.sum, "util_n": F.sum,
    "emi_cents": F.sum,
    "txns": F.sum, "logins": F.sum, "dormant": F.min,
    "last_login": F.max, "received": F.sum, "responded": F.sum,
    "complaints": F.sum, "unresolved": F.sum,
    "nps_sum": F.sum, "nps_n": F.sum,
    "products": F.max,
}


# Amounts travel through the panel as whole cents and utilization as ten-thousandths: 64-bit sums
# are exact and stay on the fast path of the aggregate, which wide decimals leave.
def _units(amount: str, scale: int) -> Column:
    return (F.col(amount) * scale).cast("bigint")


def _source(df: DataFrame, month: str, **columns) -> DataFrame:
    return df.select(
        "customer_id", F.col(month).alias("month"),
        *[value.alias(name) for name, value in columns.items()],
    )


def _one(condition: Column | None = None) -> Column:
    one = F.lit(1).cast("bigint")
    return one if condition is None else F.when(condition, one)


def panel_sources(bank) -> dict[str, DataFrame]:
    """The monthly measures of each table, still at the table's own grain."""
    accounts = with_customer(bank.account_monthly_snapshot, bank.account_master, "account_id")
    cards = with_customer(bank.card_monthly_snapshot, bank.card_portfolio, "card_id")
    loans = with_customer(bank.loan_monthly_snapshot, bank.loan_master, "loan_id")
    activity, digital = bank.customer_monthly_activity, bank.digital_engagement_monthly
    nps = F.col("nps_score")
    return {
        "accounts": _source(
            accounts, "snapshot_month",
            bal_cents=_units("current_balance", 100), bal_n=_one(),
            salaried=F.when(F.col("salary_credit_amount") > 0, 1),
        ),
        "cards": _source(
            cards, "snapshot_month",
            util_units=_units("utilization_rate", 10_000), util_n=_one(),
        ),
        "loans": _source(loans, "snapshot_month", emi_cents=_units("emi_amount", 100)),
        "activity": _source(
            activity, "snapshot_month",
            txns=(F.col("debit_txn_count") + F.col("credit_txn_count")).cast("bigint"),
            logins=F.col("login_count").cast("bigint"),
            dormant=F.col("days_since_last_txn"),
        ),
        "digital": _source(
            digital, "snapshot_month",
            last_login=F.col("last_login_date"),
            received=F.col("campaigns_received").cast("bigint"),
            responded=F.col("campaigns_responded").cast("bigint"),
        ),
        "complaints": _source(
            bank.customer_complaints, "complaint_month",
            complaints=_one(), unresolved=_one(~F.col("resolved_flag")),
        ),
        "feedback": _source(
            bank.customer_feedback.filter(nps.isNotNull()), "feedback_month",
            nps_sum=nps.cast("bigint"), nps_n=_one(),
        ),
        "holdings": _source(
            bank.product_holdings_monthly, "snapshot_month", products=F.col("products_count")
        ),
    }


def monthly_panel(bank, spine: DataFrame | None = None, only: tuple[str, ...] = ()) -> DataFrame:
    """One row per customer and month with all monthly measures.

    Spine rows are stacked in as well, so a month without any activity keeps its row.
    """
    sources = panel_sources(bank)
    chosen = [df for name, df in sources.items() if not only or name in only]
    if spine is not None:
        chosen.append(_source(spine, "as_of_month", is_spine=F.lit(True)))
    available = {c for df in chosen for c in df.columns}
    measures = {name: agg(name) for name, agg in MEASURES.items() if name in available}
    panel = stack_measures(chosen, ["customer_id", "month"], measures)
    return panel.withColumn("month_idx", month_index(F.col("month")))


def _frame(start: int | None, end: int):
    order = Window.partitionBy("customer_id").orderBy("month_idx")
    return order.rangeBetween(Window.unboundedPreceding if start is None else start, end)


class Frame(NamedTuple):
    """An aggregate of one monthly measure over months start..end from the as-of month."""

    aggregate: Callable[[str], Column]
    measure: str
    start: int | None
    end: int

    def value(self) -> Column:
        return self.aggregate(self.measure).over(_frame(self.start, self.end))

    def latest_source(self) -> Column:
        """Latest month that anything in the frame was taken from, over the very same months."""
        seen = f"seen_{MEAN_OF.get(self.measure, self.measure)}"
        return F.max(seen).over(_frame(self.start, self.end))


# Measures that are means of others.
MEAN_OF = {"avg_bal": "bal_cents", "avg_util": "util_units"}


def _at(measure: str, lag: int) -> Frame:
    """The value of the single panel row `lag` months back."""
    return Frame(F.max, measure, -lag, -lag)


# Every window aggregate the features use, each computed once.
FRAMES = {
    "products_m1": _at("products", 1),
    "products_m6": _at("products", 6),
    "bal_recent": Frame(F.avg, "avg_bal", -3, -1),
    "bal_prior": Frame(F.avg, "avg_bal", -6, -4),
    "txn_recent": Frame(F.avg, "txns", -3, -1),
    "txn_prior": Frame(F.avg, "txns", -6, -4),
    "login_recent": Frame(F.avg, "logins", -6, -1),
    "login_prior": Frame(F.avg, "logins", -12, -7),
    "complaints_6m": Frame(F.sum, "complaints", -6, -1),
    "unresolved_before": Frame(F.sum, "unresolved", None, -1),
    "last_login_m1": _at("last_login", 1),
    "salary_months": Frame(F.sum, "salaried", -6, -1),
    "util_m1": _at("avg_util", 1),
    "emi_m1": _at("emi_cents", 1),
    "dormant_m1": _at("dormant", 1),
    "nps_sum_12m": Frame(F.sum, "nps_sum", -12, -1),
    "nps_n_12m": Frame(F.sum, "nps_n", -12, -1),
    "responded_12m": Frame(F.sum, "responded", -12, -1),
    "received_12m": Frame(F.sum, "received", -12, -1),
}


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("int")


def _days_since_login() -> Column:
    days = F.date_diff(F.col("month"), F.col("last_login_m1"))
    return F.coalesce(days, F.lit(K.DEFAULT_LOGIN_DAYS)).cast("int")


def _rate(numerator: str, denominator: str, default: float) -> Column:
    rate = safe_rate(F.col(numerator), F.col(denominator))
    return F.round(F.coalesce(rate, F.lit(default)), 4)


def _change(recent: str, prior: str):
    return lambda: ratio_change(F.col(recent), F.col(prior))


# Each feature with the sources and frames it needs and its expression over the frames. The EMI
# feature leaves the panel as an amount because the income it is divided by is not monthly.
WINDOW_FEATURES = {
    "products_count": (
        ("holdings",), ("products_m1",),
        lambda: F.coalesce("products_m1", F.lit(K.DEFAULT_PRODUCTS)).cast("int"),
    ),
    "balance_change_3m": (
        ("accounts",), ("bal_recent", "bal_prior"), _change("bal_recent", "bal_prior")
    ),
    "txn_count_change_3m": (
        ("activity",), ("txn_recent", "txn_prior"), _change("txn_recent", "txn_prior")
    ),
    "login_count_change_6m": (
        ("activity",), ("login_recent", "login_prior"), _change("login_recent", "login_prior")
    ),
    "complaint_count_6m": (
        ("complaints",), ("complaints_6m",), lambda: _count("complaints_6m")
    ),
    "unresolved_complaints": (
        ("complaints",), ("unresolved_before",), lambda: _count("unresolved_before")
    ),
    "days_since_last_login": (("digital",), ("last_login_m1",), _days_since_login),
    "salary_credit_consistency": (
        ("accounts",), ("salary_months",),
        lambda: F.round(_count("salary_months").cast("double") / 6.0, 4),
    ),
    "credit_utilization": (
        ("cards",), ("util_m1",), lambda: F.coalesce("util_m1", F.lit(0.0))
    ),
    "total_emi": (("loans",), ("emi_m1",), lambda: F.col("emi_m1") / F.lit(100.0)),
    "dormant_days": (
        ("activity",), ("dormant_m1",),
        lambda: F.coalesce("dormant_m1", F.lit(K.DEFAULT_DORMANT_DAYS)).cast("int"),
    ),
    "nps_avg_12m": (
        ("feedback",), ("nps_sum_12m", "nps_n_12m"),
        lambda: _rate("nps_sum_12m", "nps_n_12m", K.DEFAULT_NPS),
    ),
    "campaign_response_rate": (
        ("digital",), ("responded_12m", "received_12m"),
        lambda: _rate("responded_12m", "received_12m", 0.0),
    ),
    "product_acquisition_velocity_6m": (
        ("holdings",), ("products_m1", "products_m6"),
        lambda: floored_diff(
            F.coalesce("products_m1", F.lit(0)), F.coalesce("products_m6", F.lit(0))
        ),
    ),
}


def eligible_rows(labels: DataFrame, first_month) -> DataFrame:
    """(customer, as-of) of every eligible label, repeated per horizon."""
    start = F.add_months(F.lit(first_month), K.WARM_UP_MONTHS)
    return labels.filter(F.col("as_of_month") >= start).select(*KEYS)


def eligible_spine(labels: DataFrame, first_month) -> DataFrame:
    """Distinct (customer, as-of) pairs of the labels, from the end of the warm-up on."""
    return eligible_rows(labels, first_month).distinct()


# Complaints filed less complaints closed, up to the as-of month.
OPEN_SO_FAR = Frame(F.sum, "delta", None, -1)


def _open_changes(resolved: DataFrame) -> DataFrame:
    """(customer_id, month, delta): complaints filed in the month, less those closed in it."""
    return resolved.select(
        "customer_id", F.col("complaint_month").alias("month"), F.col("n").alias("delta")
    ).unionByName(
        resolved.filter(F.col("resolved_month").isNotNull()).select(
            "customer_id", F.col("resolved_month").alias("month"), (-F.col("n")).alias("delta")
        )
    )


def _strict_open(panel_rows: DataFrame, complaints: DataFrame, events: DataFrame) -> DataFrame:
    """Replace unresolved_complaints by what was open at the as-of month, seen from then."""
    changes = _open_changes(resolution_months(complaints, events))
    marks = panel_rows.select("customer_id", F.col("as_of_month").alias("month"))
    monthly = stack_measures(
        [changes, marks.withColumn("wanted", F.lit(True))],
        ["customer_id", "month"],
        {"delta": F.sum("delta"), "wanted": F.bool_or("wanted")},
    ).withColumn("month_idx", month_index(F.col("month")))
    so_far = F.coalesce(OPEN_SO_FAR.value(), F.lit(0)).cast("int")
    opened = monthly.withColumn("open_now", so_far).filter("wanted")
    fixed = opened.select("customer_id", F.col("month").alias("as_of_month"), "open_now")
    return (
        panel_rows.drop("unresolved_complaints")
        .join(fixed, list(KEYS))
        .withColumnRenamed("open_now", "unresolved_complaints")
    )


def window_features(
    bank, spine: DataFrame, names: tuple[str, ...] = tuple(WINDOW_FEATURES)
) -> DataFrame:
    """The chosen window features for every spine row; spine rows may repeat."""
    only = tuple(dict.fromkeys(s for name in names for s in WINDOW_FEATURES[name][0]))
    frames = tuple(dict.fromkeys(f for name in names for f in WINDOW_FEATURES[name][1]))
    panel = monthly_panel(bank, spine, only)
    means = {}
    if "bal_cents" in panel.columns:
        means["avg_bal"] = F.col("bal_cents") / F.lit(100.0) / F.col("bal_n").cast("double")
    if "util_units" in panel.columns:
        half_up = F.expr("(2 * util_units + util_n) div (2 * util_n)")
        means["avg_util"] = half_up / F.lit(10_000.0)
    framed = panel.withColumns(means).select(
        "customer_id", "month", "is_spine", *[FRAMES[f].value().alias(f) for f in frames]
    )
    return framed.filter("is_spine").select(
        "customer_id", F.col("month").alias("as_of_month"),
        *[WINDOW_FEATURES[name][2]().alias(name) for name in names],
    )


# What a deliberately wrong feature would read: the as-of month itself.
PLANTED_LEAK = {"planted_current_month": (("activity",), (Frame(F.avg, "txns", -2, 0),))}


def _with_seen(source: DataFrame) -> DataFrame:
    """Each measure of a source replaced by the month it comes from, where it has a value.

    A login is as late as its date says, whatever month it is reported in.
    """
    def seen(measure: str) -> Column:
        month = month_index(F.col("month"))
        if measure == "last_login":
            month = F.greatest(month, month_index(F.col("last_login")))
        return F.when(F.col(measure).isNotNull(), month).alias(f"seen_{measure}")

    return source.select(
        "customer_id", "month", *[seen(c) for c in source.columns if c not in ("customer_id", "month")]
    )


def source_months(bank, planted: dict = PLANTED_LEAK) -> DataFrame:
    """(customer_id, as_of_month, month_idx, one column per feature): its latest source month.

    The months travel beside the measures: every source row marks the month its values come from,
    marks are maximised through the same panel and the same frames that compute the features, and
    a feature takes the latest of its frames. Null where a feature had no source. The final
    resolved flag of a complaint is known from the month that closed it, so that is its month.
    `unresolved_complaints_strict` is the feature of `as_of_strict`; `planted` adds more.
    """
    resolved = resolution_months(bank.customer_complaints, bank.hidden_events)
    flags = resolved.select("customer_id", F.col("complaint_month").alias("month"), F.greatest(
        month_index(F.col("complaint_month")), month_index(F.col("resolved_month"))
    ).alias("seen_unresolved"))
    sources = [
        _with_seen(df.drop("unresolved") if name == "complaints" else df)
        for name, df in panel_sources(bank).items()
    ]
    sources += [flags, _with_seen(_open_changes(resolved))]
    spine = eligible_rows(bank.customer_churn_label, bank.first_month)
    sources.append(_source(spine, "as_of_month", is_spine=F.lit(True)))
    marks = {c for df in sources for c in df.columns if c.startswith("seen_")}
    panel = stack_measures(
        sources, ["customer_id", "month"],
        {"is_spine": F.bool_or("is_spine"), **{m: F.max(m) for m in sorted(marks)}},
    ).withColumn("month_idx", month_index(F.col("month")))
    frames = {
        name: [FRAMES[f] for f in used] for name, (_, used, _) in WINDOW_FEATURES.items()
    }
    frames["unresolved_complaints_strict"] = [OPEN_SO_FAR]
    frames |= {name: list(used) for name, (_, used) in planted.items()}

    def latest(used: list[Frame]) -> Column:
        months = [f.latest_source() for f in used]
        return F.greatest(*months) if len(months) > 1 else months[0]

    framed = panel.select(
        "customer_id", F.col("month").alias("as_of_month"), "month_idx", "is_spine",
        *[latest(used).alias(name) for name, used in frames.items()],
    )
    return framed.filter("is_spine").drop("is_spine")


def emi_ratio() -> Column:
    monthly_income = F.col("annual_income").cast("double") / 12.0
    ratio = safe_rate(F.col("total_emi"), monthly_income)
    return F.round(F.coalesce(ratio, F.lit(0.0)), 4)


def feature_rows(bank, as_of_strict: bool = False) -> DataFrame:
    """All fifteen features, one row per eligible customer and as-of month."""
    rows = window_features(bank, eligible_rows(bank.customer_churn_label, bank.first_month))
    if as_of_strict:
        rows = _strict_open(rows, bank.customer_complaints, bank.hidden_events)
    customers = bank.customer_master.select("customer_id", "customer_since", "annual_income")
    rows = rows.join(customers, "customer_id")
    derived = {
        "tenure_months": tenure_months(F.col("as_of_month"), F.col("customer_since")),
        "emi_to_income_ratio": emi_ratio(),
    }
    return rows.select(*KEYS, *[derived.get(f, F.col(f)).alias(f) for f in FEATURES])


def feature_snapshot(bank, as_of_strict: bool = False) -> DataFrame:
    """The feature table: one row per label from the end of the warm-up on."""
    rows = feature_rows(bank, as_of_strict)
    labels = bank.customer_churn_label
    joined = labels.join(rows, list(KEYS))
    return joined.select(
        *KEYS, "prediction_horizon_months", *FEATURES, "churned", "churn_date", "churn_reason"
    )


def single_feature(bank, name: str) -> DataFrame:
    """One feature on its own, reading only the tables it needs."""
    spine = eligible_rows(bank.customer_churn_label, bank.first_month)
    customers = bank.customer_master
    if name == "tenure_months":
        rows = spine.distinct().join(customers.select("customer_id", "customer_since"), "customer_id")
        value = tenure_months(F.col("as_of_month"), F.col("customer_since"))
    elif name == "emi_to_income_ratio":
        rows = window_features(bank, spine, ("total_emi",)).join(
            customers.select("customer_id", "annual_income"), "customer_id"
        )
        value = emi_ratio()
    else:
        rows, value = window_features(bank, spine, (name,)), F.col(name)
    return rows.select(*KEYS, value.alias(name))
