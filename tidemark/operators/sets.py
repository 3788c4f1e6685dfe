"""Ordering, sampling, key assignment, set operations and table equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import uniform_millionths
from tidemark.operators.slices import dense_ranks


def sample_violations(df: DataFrame, order: list[str], k: int) -> DataFrame:
    """The first k rows in a total order, for a report."""
    return df.orderBy(*order).limit(k)


def union_tables(parts: list[DataFrame]) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def disjoint_union(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """All of the first group, then those of the second whose key the first lacks."""
    return first.unionByName(second.join(first.select(*keys), keys, "left_anti"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest in `order`; a struct minimum that combines map-side."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("best"))
    return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in [*order, *rest]])


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, as a signed count; empty when the tables are equal.

    One grouping over the stacked tables replaces two EXCEPT ALL passes.
    """
    columns = left.columns
    stacked = left.withColumn("side", F.lit(1)).unionByName(
        right.select(*columns).withColumn("side", F.lit(-1))
    )
    return stacked.groupBy(*columns).agg(F.sum("side").alias("surplus")).filter("surplus <> 0")


def surrogate_keys(df: DataFrame, order: list[str], name: str, start: int) -> DataFrame:
    return dense_ranks(df, order, name, start)


def stratified_sample(df: DataFrame, key: str, rate_millionths: Column, seed: int) -> DataFrame:
    """Keep each row with the rate of its stratum, decided by a hash of its key."""
    return df.filter(uniform_millionths(F.col(key), seed) < rate_millionths)


def weighted_assignment(
    df: DataFrame, key: str, choices: DataFrame, value: str, weight: str, seed: int
) -> DataFrame:
    """Give every row one choice, with probability proportional to the choice's weight.

    Each choice fills as many numbered slots as its weight; a row draws a slot from the hash of
    its key, which makes the lookup an equi join.
    """
    filled = choices.select(value, F.explode(F.sequence(F.lit(1), F.col(weight))).alias("copy"))
    slots = dense_ranks(filled, [value, "copy"], "slot", 0).select("slot", value)
    n_slots = slots.agg(F.count(F.lit(1))).scalar()
    draw = F.floor(uniform_millionths(F.col(key), seed) * n_slots / 1_000_000)
    return df.withColumn("slot", draw.cast("bigint")).join(slots, "slot").drop("slot")
