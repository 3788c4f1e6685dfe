"""The corpus pipeline: quality, near-duplicates, secrets, mixing, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the caller writes as Parquet
and reads back as the next one's `docs`; `run` does so in the shared folder. A stage keeps all
columns of what it is given, whatever else they are called, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, quality, secret_scan, sentencepiece_codec, simhash
from tidemark.llm.common import by_merge, read, store
from tidemark.llm.queries import QUALITY_BAR, TARGETS, tokenizer_file
from tidemark.session import scratch_path

# Columns are added under names that no table has.
OWN = "__tidemark_"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels there are, scores at the bar or more."""
    model = quality.fit(quality.statistics(docs), read(spark, sf_dir, "labels"))
    return docs.where(quality.text_score(model, F.col("text")) >= QUALITY_BAR)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id.

    Rows that share that id count as one document; documents without an id are not compared.
    """
    found = simhash.near_duplicates(docs, width=3, distance=2)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(f"{OWN}id")).distinct()
    chosen = docs.join(by_merge(kept), docs["doc_id"] == kept[f"{OWN}id"]).select(*docs.columns)
    return chosen.dropDuplicates(["doc_id"]).union(docs.where(F.col("doc_id").isNull()))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets replaced by their kind and n_chars set to the new length."""
    ledger = secret_scan.BlobLedger(spark, scratch_path(spark, "blob-ledger"))
    spans = secret_scan.scan_unseen(docs, ledger, "0")
    spans = spans.select(F.col("blob").alias(f"{OWN}blob"), F.col("spans").alias(f"{OWN}spans"))
    blob = F.sha2(F.coalesce("text", F.lit("")), 256)
    marked = docs.join(by_merge(spans), blob == F.col(f"{OWN}blob"), "left")
    text = secret_scan.masked(F.col("text"), F.col(f"{OWN}spans"))
    changed = F.col(f"{OWN}spans").isNotNull()
    return marked.withColumn("text", text).withColumn(
        "n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at their fitted rates, each at most once; clean ones have rate 1."""
    model = mixing.fit_classifier(docs, mixing.label_domains(read(spark, sf_dir, "labels")))
    members = mixing.memberships(docs, model)
    rated = mixing.fit_rates(members, model.names, TARGETS, "clean", max_rate=1.0)
    left_out = rated.where(mixing.copies(F.col("rate"), F.col("doc_id")) == 0)
    left_out = left_out.select(F.col("doc_id").alias(f"{OWN}id")).distinct()
    return docs.join(by_merge(left_out), docs["doc_id"] == left_out[f"{OWN}id"], "left_anti")


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids) of every document's whole text."""
    ids = sentencepiece_codec.encode(docs, tokenizer_file())
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("mix_to_targets", mix_to_targets),
    ("sentencepiece_ids", sentencepiece_ids),
]
# Kernel features, SimHash and Viterbi are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
