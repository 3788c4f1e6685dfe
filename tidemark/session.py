"""Spark session and the shared folder for checkpoints and written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Small local files are split over the cores instead of packed into one task.
        .config("spark.sql.files.openCostInBytes", "262144")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        context = spark.sparkContext
        folder = context.getCheckpointDir()
        if folder is None:
            # Executors of a local cluster are processes like any other.
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tidemark-", dir="/tmp")
            context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for one written table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of a folder wherever the session's file systems reach it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside a folder; none if it does not exist."""
    files, at = _file_system(spark, path)
    if not files.exists(at):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(at) if s.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end."""
    files, at = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(at)


def delete_folder(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at, True)


# Spark keeps the shuffle files of a finished query until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_parquet(df: DataFrame, path: str, codec: str = "zstd") -> DataFrame:
    """Write a table that only this run reads, drop the shuffle files that made it, and read it."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path, compression=codec)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def reliable(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and continue from there; survives executor loss."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def inline_table(spark: SparkSession, columns: tuple[str, ...], rows) -> DataFrame:
    """A constant table as a JVM-side local relation, so its size is known to the optimizer."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, float):
            return f"{value!r}D"
        if isinstance(value, int):
            return str(value)
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
