"""Ordered work that must not sit in one task: range slices, prefix offsets, running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import reliable

# Most rows of one key that a single task may order.
TASK_ROWS = 5_000_000
# Rows that a task should make of what it is dealt.
MADE_ROWS = 1_000_000


def dealt(
    df: DataFrame, key: str, n_rows: int, each: int, fewest: int = 1, made_rows: int = MADE_ROWS
) -> DataFrame:
    """`n_rows` rows dealt by a key over so many tasks that none makes many more than `made_rows`.

    For a table whose rows become up to `each` rows later on, such as a customer's months: its
    file may be a few MB, hence a single task, and Spark would deal out what comes of it only
    after that task has grouped or sorted it all. The number of tasks is set, so it stays.
    """
    fewest = max(fewest, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(max(fewest, -(-n_rows * each // made_rows)), key)


def ordered_slices(
    df: DataFrame, order: list[str], task_rows: int = TASK_ROWS, n_rows: int | None = None
) -> DataFrame:
    """Range-partition rows on `order` and tag each with its slice number.

    A slice lies wholly before the next one in `order`, and a hot key is cut over as many slices
    as its share of the rows; their number follows from the rows (`n_rows` if known). Range bounds come from a sample,
    so the tagged rows are written to the shared folder once: every later reader then sees the
    same slices.
    """
    fewest = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_rows = df.count() if n_rows is None else n_rows
    slices = max(fewest, -(-n_rows // task_rows))
    ranged = df.repartitionByRange(slices, *order).withColumn("slice_id", F.spark_partition_id())
    return reliable(ranged)


def _slice_offsets(
    sliced: DataFrame, keys: list[str], sums: dict[str, Column], start: DataFrame | None
) -> DataFrame:
    """Sum of everything of the same key in earlier slices; one row per (key, slice).

    `start` (keys, one column per sum) is what a key has before its first row.
    """
    totals = sliced.groupBy(*keys, "slice_id").agg(
        *[F.sum(value).alias(name) for name, value in sums.items()]
    )
    begin = dict.fromkeys(sums, F.lit(0))
    if start is not None:
        totals = totals.join(
            start.select(*keys, *[F.col(n).alias(f"{n}__start") for n in sums]), keys, "left"
        )
        begin = {n: F.coalesce(F.col(f"{n}__start"), F.lit(0)) for n in sums}
    before = (
        Window.partitionBy(*keys).orderBy("slice_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        *keys, "slice_id",
        *[
            (F.coalesce(F.sum(name).over(before), F.lit(0)) + begin[name])
            .alias(f"{name}__before")
            for name in sums
        ],
    )


def sliced_running_sums(
    df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column],
    start: DataFrame | None = None, task_rows: int = TASK_ROWS, n_rows: int | None = None,
) -> DataFrame:
    """Running sums per key in `order`, computed slice by slice plus an offset per slice."""
    sliced = ordered_slices(df, [*keys, *order], task_rows, n_rows)
    within = (
        Window.partitionBy(*keys, "slice_id")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = sliced.select(*sliced.columns, *[
        F.sum(value).over(within).alias(f"{name}__local") for name, value in sums.items()
    ])
    joined = local.join(_slice_offsets(sliced, keys, sums, start), [*keys, "slice_id"])
    return joined.select(*df.columns, *[
        (F.col(f"{name}__before") + F.col(f"{name}__local")).alias(name) for name in sums
    ])


def running_sums(
    df: DataFrame,
    key: str,
    order: list[str],
    sums: dict[str, Column],
    start: DataFrame | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Running sums per key in `order`, on top of what `start` has for the key.

    Keys with more rows than one task may order are found by a count, which reads the key alone;
    there are at most rows / task_rows of them, so they come to the driver. Without any, one
    shuffle on the key serves the join with `start` and the window and nothing is written. Hot
    keys, if there are some, are sliced.
    """
    counted = df.groupBy(key).count().filter(F.col("count") > task_rows)
    counted = counted.select(F.col(key).alias("hot"), "count")
    found = counted.collect()
    hot = df.sparkSession.createDataFrame(found, counted.schema).drop("count")
    is_hot = F.col(key) == F.col("hot")
    rows = df.join(F.broadcast(hot), is_hot, "left_anti") if found else df
    window = (
        Window.partitionBy(key)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cold = rows.select(*df.columns, *[
        F.sum(value).over(window).alias(name) for name, value in sums.items()
    ])
    if start is not None:
        opened = start.select(key, *[F.col(n).alias(f"{n}__start") for n in sums])
        cold = cold.join(opened, key, "left").select(*df.columns, *[
            (F.col(n) + F.coalesce(F.col(f"{n}__start"), F.lit(0))).alias(n) for n in sums
        ])
    if not found:
        return cold
    busy = df.join(F.broadcast(hot), is_hot, "left_semi")
    n_rows = sum(r["count"] for r in found)
    sliced = sliced_running_sums(busy, [key], order, sums, start, task_rows, n_rows)
    return cold.unionByName(sliced)


def dense_ranks(df: DataFrame, order: list[str], name: str, start: int) -> DataFrame:
    """Gap-free numbers from `start` in the order of a unique key, without a global sort task."""
    sliced = ordered_slices(df, order)
    counts = sliced.groupBy("slice_id").agg(F.count(F.lit(1)).alias("n"))
    # One row per slice, so this unpartitioned window sees as many rows as there are partitions.
    before = Window.orderBy("slice_id").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "slice_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before")
    )
    within = Window.partitionBy("slice_id").orderBy(*order)
    ranked = sliced.withColumn("rank_in_slice", F.row_number().over(within))
    number = F.lit(start - 1) + F.col("rows_before") + F.col("rank_in_slice")
    return ranked.join(offsets, "slice_id").select(*df.columns, number.cast("bigint").alias(name))
