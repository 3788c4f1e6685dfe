"""Join shapes: dimension, lag, point in time, half-open ranges, anti and semi joins, spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import month_sequence


def with_customer(snapshots: DataFrame, master: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Add customer_id from the master unless the snapshot already carries it."""
    if "customer_id" in snapshots.columns:
        return snapshots
    return snapshots.join(master.select(key, "customer_id"), key, how)


def join_month_lag(
    spine: DataFrame, facts: DataFrame, months: int, columns: dict[str, str]
) -> DataFrame:
    """Facts of exactly `months` before the as-of month, as an equi join on the shifted month."""
    shifted = facts.select(
        "customer_id",
        F.add_months("snapshot_month", months).alias("as_of_month"),
        *[F.col(source).alias(name) for name, source in columns.items()],
    )
    return spine.join(shifted, ["customer_id", "as_of_month"], "left")


def join_window(
    spine: DataFrame, facts: DataFrame, month: str, back: int | None, aggs: list[Column],
    how: str = "left", until: int = 0,
) -> DataFrame:
    """Aggregate facts with month in [as_of - back, as_of - until) for every spine row.

    The customer is the equi key and the range a residual condition, so facts should be at most
    one row per customer and month: a customer then meets a bounded number of rows.
    """
    s, f = spine.alias("s"), facts.alias("f")
    at = F.col(f"f.{month}")
    inside = at < F.add_months("s.as_of_month", -until)
    if back is not None:
        inside = inside & (at >= F.add_months("s.as_of_month", -back))
    same = F.col("s.customer_id") == F.col("f.customer_id")
    joined = s.join(f, same & inside, how)
    return joined.groupBy(F.col("s.customer_id"), F.col("s.as_of_month")).agg(*aggs)


def orphans(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str,
    tags: list[str] | None = None,
) -> DataFrame:
    """Child key values that the parent lacks, with their row counts; null keys are exempt.

    Children are counted per key (and per tag) before the join, so a hot key travels as one row
    per task.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(*(tags or []), F.col(column).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("orphan_rows"))
    )
    known = parent.select(F.col(parent_column).alias("key_value"))
    return keys.join(known, "key_value", "left_anti")


def spine(
    customers: DataFrame, first: dt.date, n_months: int, horizons: tuple[int, ...] = ()
) -> DataFrame:
    """Customers by months (by horizons), expanded in place instead of by a cross join."""
    months = customers.select(
        *customers.columns, F.explode(month_sequence(first, n_months)).alias("as_of_month")
    )
    if not horizons:
        return months
    return months.select(
        "*",
        F.explode(F.array(*[F.lit(h) for h in horizons])).alias("prediction_horizon_months"),
    )


def first_event_after(
    rows: DataFrame, month: str, events: DataFrame, event_type: str
) -> DataFrame:
    """Add next_event_month: the earliest event of a type strictly after the row's month.

    Rows and events are first reduced to one row per (customer, month), which the calendar
    bounds; a forward-looking window finds the next event and the answer is joined back.
    """
    wanted = events.filter(F.col("event_type") == event_type)
    stacked = rows.select("customer_id", F.col(month).alias("m"), F.lit(False).alias("is_event"))
    stacked = stacked.unionByName(
        wanted.select("customer_id", F.col("event_month").alias("m"), F.lit(True).alias("is_event"))
    )
    months = stacked.groupBy("customer_id", "m").agg(F.bool_or("is_event").alias("is_event"))
    later = (
        Window.partitionBy("customer_id").orderBy("m")
        .rowsBetween(1, Window.unboundedFollowing)
    )
    firsts = months.select(
        "customer_id", F.col("m").alias(month),
        F.min(F.when(F.col("is_event"), F.col("m"))).over(later).alias("next_event_month"),
    )
    return rows.join(firsts, ["customer_id", month], "left")


def first_branch_in_city(branches: DataFrame) -> DataFrame:
    return branches.groupBy("city").agg(F.min("branch_code").alias("first_branch"))
