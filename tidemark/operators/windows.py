"""Order-dependent operators over one row per customer and month."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.calendar import month_index, month_sequence
from tidemark.operators.panel import stack_measures


def by_month(month: str = "snapshot_month", key: str = "customer_id"):
    return Window.partitionBy(key).orderBy(month)


def by_month_index(key: str = "customer_id"):
    return Window.partitionBy(key).orderBy("month_idx")


def streak(reset: Column, index: str = "month_idx", key: str = "customer_id") -> Column:
    """Months since the last reset on a gap-free calendar: distance to the latest reset row."""
    order = Window.partitionBy(key).orderBy(index)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last_reset = F.max(F.when(reset, F.col(index))).over(so_far)
    before_first = F.min(F.col(index)).over(so_far) - 1
    return (F.col(index) - F.coalesce(last_reset, before_first)).cast("int")


def customer_calendar(customers: DataFrame, first: dt.date, n_months: int) -> DataFrame:
    months = customers.select(
        "customer_id", F.explode(month_sequence(first, n_months)).alias("snapshot_month")
    )
    return months.withColumn("month_idx", month_index(F.col("snapshot_month")))


def salary_gap_streak(
    calendar: DataFrame, paid_months: DataFrame, primary: DataFrame
) -> DataFrame:
    """Months in a row without salary on a salary account; 0 for everybody else."""
    paid = paid_months.select("customer_id", "snapshot_month").distinct().withColumn(
        "paid", F.lit(True)
    )
    salaried = primary.select("customer_id", "salary_account_flag")
    rows = calendar.join(paid, ["customer_id", "snapshot_month"], "left").join(
        salaried, "customer_id", "left"
    )
    reset = F.coalesce(F.col("paid"), F.lit(False)) | ~F.coalesce(
        F.col("salary_account_flag"), F.lit(False)
    )
    return rows.select(
        "customer_id", "snapshot_month", streak(reset).alias("months_without_salary")
    )


def digital_inactive_streak(calendar: DataFrame, digital: DataFrame) -> DataFrame:
    """Months in a row with no app activity and no web session."""
    used = digital.select(
        "customer_id", "snapshot_month",
        (F.col("mobile_app_active") | (F.col("web_sessions") > 0)).alias("used"),
    )
    rows = calendar.join(used, ["customer_id", "snapshot_month"], "left")
    return rows.select(
        "customer_id", "snapshot_month",
        streak(F.coalesce(F.col("used"), F.lit(False))).alias("digital_inactive_months"),
    )


class ClampedStep(NamedTuple):
    """The map x -> min(high, max(low, x + shift)); such maps compose to such maps."""

    low: Column
    high: Column
    shift: Column

    def __call__(self, level: Column) -> Column:
        return F.least(self.high, F.greatest(self.low, level + self.shift))

    def after(self, first: "ClampedStep") -> "ClampedStep":
        """This map applied to the outcome of another."""
        return ClampedStep(self(first.low), self(first.high), self.shift + first.shift)


def with_leaky_counter(
    rows: DataFrame, hit: Column, name: str, months: int, cap: int = 2, index: str = "month_idx"
) -> DataFrame:
    """Add a counter per customer: +1 up to `cap` on a hit, else -1 down to 0, from 0.

    Each month is a clamped step. A round composes a step with those 1, 2 and 3 strides back, the
    next stride is four times as long, so after the logarithm of `months` rounds each row holds the
    composition of everything before it. All rounds share one exchange and sort, and a row carries
    three numbers however long the history. `months` is the number of rows, before which the
    counter is known to be 0.
    """
    order = Window.partitionBy("customer_id").orderBy(index)
    names = ["step_low", "step_high", "step_shift"]
    shift = F.when(F.coalesce(hit, F.lit(False)), F.lit(1)).otherwise(F.lit(-1))
    out = rows.select("*", F.lit(0).alias(names[0]), F.lit(cap).alias(names[1]), shift.alias(names[2]))
    stride = 1
    while stride < months:
        out = out.select("*", *[
            F.lag(n, k * stride).over(order).alias(f"{n}_{k}") for k in (1, 2, 3) for n in names
        ])
        for k in (1, 2, 3):
            here = ClampedStep(*[F.col(n) for n in names])
            both = here.after(ClampedStep(*[F.col(f"{n}_{k}") for n in names]))
            out = out.withColumns({
                n: F.when(F.col(f"{n}_{k}").isNull(), F.col(n)).otherwise(value)
                for n, value in zip(names, both)
            })
        out = out.select(*rows.columns, *names)
        stride *= 4
    final = ClampedStep(*[F.col(n) for n in names])
    return out.select(*rows.columns, final(F.lit(0)).alias(name))


def service_failure_counter(
    calendar: DataFrame, events: DataFrame, months: int = K.N_MONTHS
) -> DataFrame:
    """Counter of months with a service failure; `months` is the length of the calendar."""
    failed = (
        events.filter(F.col("event_type") == "bank_service_failure")
        .select("customer_id", F.col("event_month").alias("snapshot_month"))
        .distinct()
        .withColumn("failed", F.lit(True))
    )
    rows = calendar.join(failed, ["customer_id", "snapshot_month"], "left")
    return with_leaky_counter(rows, F.col("failed"), "service_failures_2m", months).select(
        "customer_id", "snapshot_month", "service_failures_2m"
    )


def product_drop(holdings: DataFrame) -> DataFrame:
    before = F.lag("products_count").over(by_month())
    return holdings.select(
        "customer_id", "snapshot_month", "products_count",
        F.coalesce(F.col("products_count") < before, F.lit(False)).alias("products_count_drop"),
    )


def complaints_trailing(calendar: DataFrame, complaints: DataFrame) -> DataFrame:
    """Complaints of the month and the six before it (seven months, both ends included)."""
    monthly = stack_measures(
        [
            complaints.select("customer_id", F.col("complaint_month").alias("snapshot_month"),
                              F.lit(1).alias("n")),
            calendar.select("customer_id", "snapshot_month", F.lit(True).alias("wanted")),
        ],
        ["customer_id", "snapshot_month"],
        {"n": F.coalesce(F.sum("n"), F.lit(0)), "wanted": F.bool_or("wanted")},
    ).withColumn("month_idx", month_index(F.col("snapshot_month")))
    trailing = F.sum("n").over(by_month_index().rangeBetween(-6, 0)).cast("bigint")
    # The calendar is applied after the window: complaints before it count.
    return monthly.withColumn("complaints_trailing", trailing).filter("wanted").select(
        "customer_id", "snapshot_month", "complaints_trailing"
    )


def trailing_count(spine: DataFrame, facts: DataFrame, month: str, back: int) -> DataFrame:
    """Facts with month in [as_of - back, as_of) per spine row: a correlated count, decorrelated.

    Facts are counted per month, stacked with the spine and summed over a calendar window. One
    exchange per step and no pairing of spine rows with facts, however many a customer has.
    """
    monthly = stack_measures(
        [
            facts.select("customer_id", F.col(month).alias("m"), F.lit(1).alias("n")),
            spine.select("customer_id", F.col("as_of_month").alias("m"),
                         F.lit(True).alias("wanted")),
        ],
        ["customer_id", "m"],
        {"n": F.coalesce(F.sum("n"), F.lit(0)), "wanted": F.bool_or("wanted")},
    ).withColumn("month_idx", month_index(F.col("m")))
    inside = by_month_index().rangeBetween(-back, -1)
    counted = monthly.withColumn("counted", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return counted.filter("wanted").select(
        "customer_id", F.col("m").alias("as_of_month"), "counted"
    )


def until_churn(decisions: DataFrame) -> DataFrame:
    """Rows up to and including the first month a customer churns; later ones are dropped."""
    so_far = by_month().rowsBetween(Window.unboundedPreceding, -1)
    gone = F.max(F.coalesce("churned", F.lit(False))).over(so_far)
    kept = decisions.withColumn("already_gone", F.coalesce(gone, F.lit(False)))
    return kept.filter(~F.col("already_gone")).drop("already_gone")


def churn_month(decisions: DataFrame) -> DataFrame:
    """First month a customer churns and the months generated up to and including it."""
    kept = until_churn(decisions)
    return kept.groupBy("customer_id").agg(
        F.max(F.when(F.col("churned"), F.col("snapshot_month"))).alias("churn_month"),
        F.count(F.lit(1)).cast("int").alias("active_months_generated"),
    )
