"""Streams of transactions into monthly tables that equal their batch counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregates import channel_class, exact_mean, money
from tidemark.streaming.runs import RunStore

MEASURES = (
    "debits", "credits", "debit_amount", "credit_amount", "cash", "present", "not_present",
)
PARTIAL = T.StructType([
    T.StructField("txn_month", T.DateType()), T.StructField("customer_id", T.LongType()),
    T.StructField("merchant_name", T.StringType()),
    *[
        T.StructField(m, T.DecimalType(28, 2) if m.endswith("amount") else T.LongType())
        for m in MEASURES
    ],
])
VERSION = T.StructType([
    T.StructField("day", T.TimestampType()), *PARTIAL, T.StructField("batch_id", T.LongType()),
])
DAY = "1 day"


def read_txn_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 8
) -> DataFrame:
    """Transactions arriving as Parquet files, a bounded number of files per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def run_available(stream: DataFrame, checkpoint: str, write_batch, mode: str = "append") -> dict | None:
    """Process everything that has arrived, one foreachBatch call per micro-batch, then stop.

    Returns the last progress report, None if nothing ran.
    """
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write_batch)
        .start()
    )
    query.awaitTermination()
    return query.lastProgress


def partial_sums() -> list:
    """What transactions of one customer, month and merchant add up to; sums of sums stay exact."""
    debit = F.col("direction") == "Debit"
    kind = channel_class(F.col("channel"))
    zero = F.lit(0).cast("decimal(18,2)")
    return [
        F.count_if(debit).alias("debits"), F.count_if(~debit).alias("credits"),
        F.sum(F.when(debit, F.col("amount")).otherwise(zero)).alias("debit_amount"),
        F.sum(F.when(~debit, F.col("amount")).otherwise(zero)).alias("credit_amount"),
        F.count_if(kind == "cash").alias("cash"),
        F.count_if(kind == "card_present").alias("present"),
        F.count_if(kind == "card_not_present").alias("not_present"),
    ]


def summed_partials(rows: DataFrame) -> DataFrame:
    """One row per customer, month and merchant."""
    return rows.groupBy("txn_month", "customer_id", "merchant_name").agg(*[
        F.sum(m).cast(PARTIAL[m].dataType).alias(m) for m in MEASURES
    ])


def activity_of(partials: DataFrame) -> DataFrame:
    """The monthly activity from rows per customer, month and merchant.

    With the merchant in the key, distinct merchants are a count of rows and no entry ever holds a
    set, and a busy customer spreads over merchants.
    """
    debits, spent = F.sum("debits"), F.sum("debit_amount")
    return partials.groupBy("customer_id", F.col("txn_month").alias("snapshot_month")).agg(
        debits.cast("int").alias("debit_txn_count"),
        F.sum("credits").cast("int").alias("credit_txn_count"),
        money(spent).alias("total_debit_amount"),
        money(F.sum("credit_amount")).alias("total_credit_amount"),
        money(F.when(debits > 0, exact_mean(spent, debits, 2)).otherwise(F.lit(0)))
        .alias("avg_transaction_value"),
        F.count("merchant_name").cast("int").alias("unique_merchants"),
        F.sum("cash").cast("int").alias("cash_withdrawal_count"),
        F.sum("present").cast("int").alias("card_present_txn_count"),
        F.sum("not_present").cast("int").alias("card_not_present_txn_count"),
    )


def month_store(spark: SparkSession, root: str) -> RunStore:
    """The partial rollups of a month sink, in folders per month within each run."""
    return RunStore(spark, f"{root}/partials", PARTIAL, summed_partials, partition_by=("txn_month",))


def monthly_activity(spark: SparkSession, root: str) -> DataFrame:
    """The table a month sink keeps, as of now; a filter on the month reads that month's folders."""
    return activity_of(month_store(spark, root).read())


def stream_month_sink(stream: DataFrame, root: str) -> DataFrame:
    """Keep a monthly rollup current while transactions arrive; returns the table as of now.

    A micro-batch is reduced to one row per customer, month and merchant and stored; stored runs
    are merged a few at a time. What a batch costs depends on its own rows and not on what the
    months it touches hold already. A batch that runs again replaces itself.
    """
    spark = stream.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy("txn_month", "customer_id", "merchant_name").agg(*partial_sums())
        store = month_store(batch.sparkSession, root)
        store.append(
            sums.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PARTIAL])
            .hint("rebalance", F.col("txn_month")), batch_id,
        )

    run_available(stream, f"{root}/checkpoint", write_batch)
    return monthly_activity(spark, root)


BOUND = T.StructType([T.StructField("newest", T.TimestampType())])


def admit(stream: DataFrame, root: str, delay: str) -> None:
    """Sort arriving rows into `root/on_time` and, by batch, `root/late`.

    The watermark of a batch is the newest event time of the batches before it, less `delay`. A row
    is late if its day ended by then, or if it has no event time: the state of that day may be gone.
    """
    def newest_of(rows: DataFrame) -> DataFrame:
        return rows.agg(F.max("newest").alias("newest"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        bounds = RunStore(batch.sparkSession, f"{root}/newest", BOUND, newest_of)
        newest = bounds.read(before=batch_id).select(
            (F.col("newest") - F.expr(f"INTERVAL {delay}")).alias("watermark")
        )
        day_end = F.date_trunc("day", "txn_timestamp") + F.expr(f"INTERVAL {DAY}")
        # One row, from an aggregate without keys.
        marked = batch.crossJoin(F.broadcast(newest)).withColumn("is_late", F.coalesce(
            day_end <= F.col("watermark"), F.col("txn_timestamp").isNull()
        )).drop("watermark")
        for folder, late in (("on_time", False), ("late", True)):
            marked.where(F.col("is_late") == late).drop("is_late").write.mode("overwrite").parquet(
                f"{root}/{folder}/batch_id={batch_id}"
            )
        bounds.append(batch.select(F.col("txn_timestamp").alias("newest")).agg(
            F.max("newest").alias("newest")
        ), batch_id)

    run_available(stream, f"{root}/checkpoint-admit", write_batch)


def daily_rollup(stream: DataFrame, delay: str) -> DataFrame:
    """Running totals per day, customer, month and merchant, with event-time state.

    The watermark follows the event time; the state of a day is dropped `delay` after it ended.
    """
    day = F.window("txn_timestamp", DAY)
    return (
        stream.withWatermark("txn_timestamp", delay)
        .groupBy(day.alias("day"), "txn_month", "customer_id", "merchant_name")
        .agg(*partial_sums())
    )


def newest_versions(rows: DataFrame) -> DataFrame:
    """The last version of every key."""
    keys = ["day", "txn_month", "customer_id", "merchant_name"]
    newest = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*MEASURES, "batch_id"), "batch_id").alias("v")
    )
    return newest.select(*keys, *[f"v.{m}" for m in MEASURES], "v.batch_id")


def version_store(spark: SparkSession, root: str) -> RunStore:
    return RunStore(spark, f"{root}/versions", VERSION, newest_versions)


def keep_versions(on_time: DataFrame, root: str, delay: str) -> dict | None:
    """Run the stateful rollup and store the groups each micro-batch changed; the last progress."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({
            "day": F.col("day.start"), "batch_id": F.lit(batch_id).cast("bigint")
        })
        version_store(batch.sparkSession, root).append(
            rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in VERSION]), batch_id
        )

    return run_available(daily_rollup(on_time, delay), f"{root}/checkpoint", write_batch, "update")


def late_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows that came later than the delay allows, with the number of the batch they came in."""
    wide = T.StructType([*schema, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(wide).parquet(f"{root}/late")


def stream_activity_rollup(
    stream: DataFrame, root: str, delay: str, files_per_batch: int = 64
) -> DataFrame:
    """Monthly activity maintained by a stateful stream; returns the table as of now.

    Rows later than `delay` go to a side table (`late_rows`) and are counted there instead of
    vanishing. Update mode emits a group again whenever it changes; versions are stored by batch
    and merged to the newest of each group as they pile up. State holds the days of the last
    `delay` only.
    """
    spark = stream.sparkSession
    admit(stream, root, delay)
    on_time = read_txn_stream(spark, f"{root}/on_time/*", stream.schema, files_per_batch)
    keep_versions(on_time, root, delay)
    return activity_of(summed_partials(version_store(spark, root).read()))
