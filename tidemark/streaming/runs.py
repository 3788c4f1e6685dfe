"""A store of mergeable rows, one run per micro-batch, merged in powers of a fan-in.

Batch N first merges what it completes: every `fan` runs of a level become one run of the next,
like the digits of a counter. A row is therefore written once per level, whatever the store holds
already, and a reader sees at most fan - 1 runs a level. A run counts from the moment its writer
has marked it complete, merged runs hide those inside them, and these are deleted only afterwards,
so a batch that runs again after a failure finds or makes the same runs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.session import delete_folder, folder_names, is_complete

FAN = 8


class RunStore:
    """Rows of `schema` under `root`; `merge` reduces stacked rows to one per key."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType,
        merge: Callable[[DataFrame], DataFrame], fan: int = FAN, partition_by: tuple[str, ...] = (),
    ):
        self.spark, self.root, self.schema, self.merge = spark, root, schema, merge
        self.fan, self.partition_by = fan, partition_by

    def _path(self, first: int, span: int) -> str:
        return f"{self.root}/batch-{first:012d}-span-{span:012d}"

    def runs(self, start: int = 0, end: int | None = None) -> list[tuple[int, int]]:
        """(first batch, batches) of the complete runs inside [start, end) that no other hides."""
        found = []
        for name in folder_names(self.spark, self.root):
            _, first, _, span = name.split("-")
            found.append((int(first), int(span)))
        kept: list[tuple[int, int]] = []
        for first, span in sorted(found, key=lambda run: (-run[1], run[0])):
            inside = first >= start and (end is None or first + span <= end)
            hidden = any(a <= first and first + span <= a + n for a, n in kept)
            if inside and not hidden and is_complete(self.spark, self._path(first, span)):
                kept.append((first, span))
        return sorted(kept)

    def _stacked(self, runs: list[tuple[int, int]]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        parts = [self.spark.read.schema(self.schema).parquet(self._path(*run)) for run in runs]
        return reduce(DataFrame.unionByName, parts).select(self.schema.names)

    def _write(self, rows: DataFrame, first: int, span: int) -> None:
        writer = rows.select(self.schema.names).write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(self._path(first, span))

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Add a batch; all batches before it are complete. A batch that comes again replaces itself."""
        span = self.fan
        while batch_id and batch_id % span == 0:
            first = batch_id - span
            inside = self.runs(first, batch_id)
            if inside and inside != [(first, span)]:
                self._write(self.merge(self._stacked(inside)), first, span)
            span *= self.fan
        self._write(rows, batch_id, 1)
        # What a merged run hides, left by this batch or by one that failed before it deleted.
        visible = set(self.runs())
        for name in folder_names(self.spark, self.root):
            _, first, _, span_text = name.split("-")
            run = (int(first), int(span_text))
            if run not in visible and any(a <= run[0] and sum(run) <= a + n for a, n in visible):
                delete_folder(self.spark, self._path(*run))

    def read(self, before: int | None = None) -> DataFrame:
        """One row per key of all batches, or of those before a batch."""
        return self.merge(self._stacked(self.runs(0, before)))
