"""Running account balance carried across micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.slices import TASK_ROWS, running_sums
from tidemark.streaming.monthly import run_available
from tidemark.streaming.runs import RunStore

CARRY = T.StructType([
    T.StructField("account_id", T.LongType()), T.StructField("cents", T.LongType()),
    T.StructField("last_time", T.TimestampType()), T.StructField("last_id", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])
ORDER = ["txn_timestamp", "transaction_id"]


def newest_carry(rows: DataFrame) -> DataFrame:
    """What each account carries on: its last balance and the newest transaction counted."""
    newest = rows.groupBy("account_id").agg(
        F.max_by(F.struct("cents", "last_time", "last_id", "batch_id"), "batch_id").alias("v")
    )
    return newest.select("account_id", "v.*")


def carry_store(spark, root: str) -> RunStore:
    return RunStore(spark, f"{root}/carried", CARRY, newest_carry)


def balances_of_batch(
    rows: DataFrame, carried: DataFrame, openings: DataFrame, task_rows: int = TASK_ROWS
) -> DataFrame:
    """`rows` with `cents` after each and whether it came out of order.

    An account goes on from what it carries, or from its opening balance. Rows of the batch are
    put in time order by Spark's own sort, which spills; accounts with more rows than one task may
    order are cut into slices. A row older than the last one counted in an earlier batch is added
    where it arrives and flagged.
    """
    known = rows.select("account_id").distinct()
    before = carried.join(known, "account_id", "left_semi")
    opened = openings.select(
        "account_id", (F.coalesce("opening_balance", F.lit(0)) * 100).cast("bigint").alias("opening")
    ).join(known, "account_id", "left_semi")
    start = known.join(before, "account_id", "left").join(opened, "account_id", "left").select(
        "account_id", F.coalesce("cents", "opening", F.lit(0)).alias("cents"), "last_time", "last_id"
    )
    running = running_sums(
        rows, "account_id", ORDER, {"cents": F.col("signed_cents")},
        start=start.select("account_id", "cents"), task_rows=task_rows,
    )
    last = start.where(F.col("last_time").isNotNull()).select("account_id", "last_time", "last_id")
    late = F.struct(*ORDER) < F.struct("last_time", "last_id")
    return running.join(last, "account_id", "left").withColumn(
        "out_of_order", F.coalesce(F.col("last_time").isNotNull() & late, F.lit(False))
    )


def carry_of(balances: DataFrame, batch_id: int) -> DataFrame:
    """What the accounts of a batch carry on after it."""
    newest = F.struct(F.col("txn_timestamp").alias("last_time"), F.col("transaction_id").alias("last_id"))
    ends = balances.groupBy("account_id").agg(
        F.max_by("cents", F.struct(*ORDER)).alias("cents"),
        F.greatest(F.max(newest), F.max(F.when(
            F.col("last_time").isNotNull(), F.struct("last_time", "last_id")
        ))).alias("last"),
    )
    return ends.select(
        "account_id", "cents", "last.last_time", "last.last_id",
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def stream_running_balance(
    stream: DataFrame, openings: DataFrame, root: str, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Balance after every streamed transaction; returns the rows written so far.

    Batches are ordered work on what each account carried before them, so memory does not grow
    with the rows an account has in a batch. Carried balances are stored by batch and merged to
    the newest of each account; a batch that runs again starts from the same ones and replaces its
    own rows.
    """
    signed = F.when(F.col("direction") == "Credit", F.col("amount")).otherwise(-F.col("amount"))
    rows = stream.select(
        "account_id", "transaction_id", "txn_timestamp", "txn_month",
        (signed * 100).cast("bigint").alias("signed_cents"),
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        store = carry_store(batch.sparkSession, root)
        path = f"{root}/rows/batch_id={batch_id}"
        balances_of_batch(batch, store.read(before=batch_id), openings, task_rows).write.mode(
            "overwrite"
        ).parquet(path)
        store.append(carry_of(batch.sparkSession.read.parquet(path), batch_id), batch_id)

    run_available(rows, f"{root}/checkpoint", write_batch)
    written = stream.sparkSession.read.parquet(f"{root}/rows")
    balance = (F.col("cents").cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    return written.select(
        "transaction_id", "account_id", balance.alias("balance_after_txn"), "out_of_order"
    )
