"""What the operators share: reading tables, stored intermediate tables, Arrow slices, splits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# Bytes of text that a task works on at once; bounds its memory whatever the batch holds.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def store(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write to the shared folder and go on from there, so that nothing upstream runs again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def by_merge(df: DataFrame) -> DataFrame:
    """The table for a join by merge: what is as long as the input must not go to the driver.

    Spark takes the size of a file for that of the rows read from it, also where they are expanded
    on the way, and broadcasts what seems to be small.
    """
    return df.hint("merge")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so clashing names elsewhere don't matter."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def crc_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; null keys give null."""
    return F.crc32(key.cast("string")) % modulus


def text_slices(
    batches: Iterator[pa.RecordBatch], column: int = 1, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Rows in order, in pieces of about `limit` bytes of text; a longer text is a piece alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        piece = np.cumsum(lengths) // limit
        starts = np.flatnonzero(np.diff(piece, prepend=-1)) if len(piece) else []
        for start, end in zip(starts, [*starts[1:], len(piece)]):
            yield batch.slice(start, end - start)


def plain_strings(column: pa.Array) -> pa.Array:
    """The column with offsets from zero and empty texts for nulls."""
    return pa.concat_arrays([pc.fill_null(column.cast(pa.large_string()), "")])


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per word its text number and its place in the array of distinct words.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z is lower-cased.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets, values = split.offsets.to_numpy(), split.values
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    values = values.slice(offsets[0], offsets[-1] - offsets[0])
    filled = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
    encoded = values.filter(pa.array(filled)).dictionary_encode()
    return owner[filled], encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
