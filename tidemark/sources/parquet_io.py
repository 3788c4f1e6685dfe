"""Parquet scans and sinks: static masters, month-partitioned tables, chunk merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.schemas import PARTITION_COLUMN, SCHEMAS


def _readable(schema: T.StructType) -> T.StructType:
    """Files may hold nulls whatever the contract says; the contract check reports them."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def scan_master(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One static table, with its declared schema instead of an inferred one."""
    return spark.read.schema(_readable(SCHEMAS[name])).parquet(f"{root}/{name}.parquet")


def scan_month_partitions(
    spark: SparkSession, root: str, name: str, first=None, last=None
) -> DataFrame:
    """A month-partitioned table; the bounds prune whole folders before any file is opened."""
    df = spark.read.schema(_readable(SCHEMAS[name])).parquet(f"{root}/{name}")
    month = F.col(PARTITION_COLUMN[name])
    if first is not None:
        df = df.filter(month >= F.lit(first))
    if last is not None:
        df = df.filter(month <= F.lit(last))
    return df.select(*[f.name for f in SCHEMAS[name]])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    if name in PARTITION_COLUMN:
        return scan_month_partitions(spark, root, name)
    return scan_master(spark, root, name)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, counted while they are written, so the plan runs once."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_master(df: DataFrame, root: str, name: str) -> bool:
    """Replace a static table, with an empty one too; whether it had rows."""
    rows, seen = _counted(df)
    rows.write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    return seen.get["rows"] > 0


def write_month_partitions(df: DataFrame, root: str, name: str, whole: bool = False) -> bool:
    """One folder per month; writing a month again replaces exactly that month.

    With `whole` the table becomes what is written, so months it lacks go, all of them if it is
    empty. The rebalance hint gathers a month into few files and still splits a month that is too
    big for one task. Returns whether there were rows.
    """
    column = PARTITION_COLUMN[name]
    rows, seen = _counted(df)
    (
        rows.hint("rebalance", F.col(column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(column)
        .parquet(f"{root}/{name}")
    )
    return seen.get["rows"] > 0


def write_table(df: DataFrame, root: str, name: str) -> bool:
    """Make the stored table what is given."""
    if name in PARTITION_COLUMN:
        return write_month_partitions(df, root, name, whole=True)
    return write_master(df, root, name)


def write_bank(bank, root: str, names=tuple(SCHEMAS)) -> list[str]:
    """Write tables of a bank in load order; returns the names that had rows.

    Every table is written, so an empty one can be read back and leaves nothing of an older bank.
    """
    return [name for name in names if write_table(bank.table(name), root, name)]


def merge_chunk_outputs(
    spark: SparkSession, roots: list[str], name: str, shared_key: str | None = None
) -> DataFrame:
    """One table from several chunk folders that hold disjoint customers.

    Every chunk carries its own copy of a table all chunks share (the branches); `shared_key`
    names its key. Equal copies become one, copies that differ are an error.
    """
    merged = read_table(spark, roots[0], name)
    for root in roots[1:]:
        merged = merged.unionByName(read_table(spark, root, name))
    if not shared_key:
        return merged
    different = merged.distinct()
    counts = different.groupBy(shared_key).agg(F.count(F.lit(1)).alias("copies"))
    checked = different.join(counts, shared_key).filter(
        F.assert_true(F.col("copies") == 1, f"copies of one {shared_key} differ").isNull()
    )
    return checked.select(*merged.columns)


def write_merged(spark: SparkSession, roots: list[str], root: str, names=tuple(SCHEMAS),
                 shared: dict[str, str] | None = None) -> list[str]:
    """Merge chunk folders into a bank on disk, month by month where a table has months.

    `shared` names the key of each table that all chunks hold a copy of. Returns the tables that
    had rows.
    """
    keys = {"branch_master": "branch_code"} if shared is None else shared
    return [
        name for name in names
        if write_table(merge_chunk_outputs(spark, roots, name, keys.get(name)), root, name)
    ]
