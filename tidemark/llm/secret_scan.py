"""Secret scans over a ledger of blobs.

A version of a file is known by the sha256 of its content. The ledger holds which blob has been
scanned under which version of the rules and what was found. A scan reads only pairs that the
ledger lacks, each blob once however many paths and versions share it, and joins the findings back
to all paths. Contents are compressed before they are shuffled to be told apart by their blob.
Every batch writes a folder of its own, so a batch that runs again replaces itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.llm.common import by_merge, text_slices

SPANS = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>"
FOUND = f"blob string, rule_version string, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches; one fails whose measured group is too short."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules in their order, then those that the method adds.
RULES = (
    Rule(
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
    # Only where no letter of its own stands before, so that a long run is looked at once.
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE_KINDS = 3
RULE_VERSION = "1"


def find_spans(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int, str]]:
    """(start, rule number, end, kind) by start, then rule; code points, end exclusive."""
    found = []
    for number, rule in enumerate(rules):
        for match in re.finditer(rule.pattern, text):
            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                found.append((match.start(), number, match.end(), rule.kind))
    return sorted(found)


class BlobLedger:
    """Folder of scanned pairs and their findings, one subfolder per batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def scanned(self, rule_version: str, but: str | None = None) -> DataFrame:
        """(blob, spans) of all pairs with this rule version; none before the first batch.

        The folder of the batch `but` is not read.
        """
        folders = [f"{self.folder}/batch-*"] if but is None else self._folders(but)
        try:
            rows = self.spark.read.schema(FOUND).parquet(*folders) if folders else None
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = None
        if rows is None:
            rows = self.spark.createDataFrame([], FOUND)
        return rows.where(F.col("rule_version") == rule_version).select("blob", "spans")

    def _folders(self, but: str) -> list[str]:
        """Folders of all batches other than this one."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batch-*")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [(s.getPath().getName(), s.getPath().toString()) for s in files.globStatus(path) or ()]
        return [folder for name, folder in found if name != f"batch-{but}"]

    def append(self, batch: str, found: DataFrame) -> None:
        found.write.mode("overwrite").parquet(f"{self.folder}/batch-{batch}")


def _scan(blobs: DataFrame, rules: tuple[Rule, ...], rule_version: str) -> DataFrame:
    spans_type = pa.list_(pa.struct([
        ("start", pa.int64()), ("kind_no", pa.int32()), ("end", pa.int64()), ("kind", pa.string())
    ]))
    names = [field.name for field in spans_type.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            spans = [
                [dict(zip(names, span)) for span in find_spans(_unpack(packed), rules)]
                for packed in part.column(1).to_pylist()
            ]
            yield pa.record_batch([
                part.column(0), pa.array([rule_version] * len(spans), pa.string()),
                pa.array(spans, spans_type),
            ], ["blob", "rule_version", "spans"])

    return blobs.select("blob", "packed").mapInArrow(run, FOUND)


def _unpack(packed: bytes) -> str:
    return zlib.decompress(packed).decode()


def _packed(versions: DataFrame, text_col: str) -> DataFrame:
    """(blob, packed) of every row: the sha256 of its content and the content compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            packed = [zlib.compress(text.encode(), 1) for text in part.column(1).to_pylist()]
            yield pa.record_batch(
                [part.column(0), pa.array(packed, pa.binary())], ["blob", "packed"]
            )

    content = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    texts = versions.select(content).select(F.sha2("text", 256).alias("blob"), "text")
    return texts.mapInArrow(run, "blob string, packed binary")


def scan_unseen(
    versions: DataFrame, ledger: BlobLedger, batch: str, text_col: str = "text",
    rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION,
) -> DataFrame:
    """Scan the blobs that the ledger lacks; (blob, spans) of all blobs with findings in it.

    What the batch itself wrote before counts as lacking, since this run replaces it.
    """
    others = ledger.scanned(rule_version, but=batch)
    unseen = (
        _packed(versions, text_col).join(by_merge(others), "blob", "left_anti")
        .groupBy("blob").agg(F.first("packed").alias("packed"))
    )
    ledger.append(batch, _scan(unseen, rules, rule_version))
    return ledger.scanned(rule_version).where(F.size("spans") > 0)


def scan_versions(
    versions: DataFrame, ledger: BlobLedger, batch: str, path_col: str = "path",
    text_col: str = "text", rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION,
) -> DataFrame:
    """(path, blob, spans) of every row of `versions`, after bringing the ledger up to date.

    A null text counts as empty, a null path keeps its row, repeated rows repeat, and an empty
    table adds nothing to the ledger. `spans` is empty where nothing was found.
    """
    hits = scan_unseen(versions, ledger, batch, text_col, rules, rule_version)
    content = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    at = versions.select(F.col(path_col).alias("path"), F.sha2(content, 256).alias("blob"))
    return at.join(by_merge(hits), "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast(SPANS)).alias("spans")
    )


def count_of(spans: Column, kind: str) -> Column:
    """How many of the spans are of the kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def digest(spans: Column) -> Column:
    """kind:start:end of the spans in their order, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by its first kind."""

    @F.pandas_udf("string")
    def replace(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for body, marks in zip(texts, found):
            if body is None or marks is None or not len(marks):
                out.append(body)
                continue
            parts, at = [], 0
            for mark in marks:
                if mark["start"] >= at:
                    parts += [body[at:mark["start"]], f"[{mark['kind']}]"]
                at = max(at, mark["end"])
            out.append("".join([*parts, body[at:]]))
        return pd.Series(out, dtype="object")

    return replace(text, spans)
