"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    ann, decision_list, hard_negatives, licences, minhash, mixing, paragraphs, pitman_yor, quality, secret_scan, sentencepiece_codec, simhash, whitening,
)
from tidemark.llm.common import crc_remainder, read
from tidemark.session import scratch_path

QUALITY_BAR = 0.7
# Shares of the tokens that the domains of the label table should have.
TARGETS = {"clean": 0.93, "toxic": 0.03, "junk": 0.04}


def tokenizer_file() -> str:
    """The SentencePiece model; TIDEMARK_SENTENCEPIECE_MODEL names another."""
    return os.environ.get("TIDEMARK_SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_remainder(F.col("doc_id"), 5) == 1
    return pitman_yor.score(read(spark, sf_dir, "documents"), held_out, stored=True)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = quality.statistics(read(spark, sf_dir, "documents"))
    labels = read(spark, sf_dir, "labels")
    model = quality.fit(x, labels.where(crc_remainder(F.col("doc_id"), 4) != 2))
    return quality.scored(x, model).select(
        "doc_id", (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= QUALITY_BAR).cast("int").alias("predicted"),
    )


def op3_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(read(spark, sf_dir, "documents"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files source/lang/doc_id; what is null is an empty step, and a null id none."""
    docs = read(spark, sf_dir, "documents")
    steps = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang", "doc_id")]
    found = licences.scan(docs.select(F.concat_ws("/", *steps).alias("path"), "text"))
    name = F.element_at(F.split("path", "/"), -1)
    return found.select(F.nullif(name, F.lit("")).cast("bigint").alias("doc_id"), "*")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secret_scan.BlobLedger(spark, scratch_path(spark, "blob-ledger"))
    docs = read(spark, sf_dir, "documents")
    found = secret_scan.scan_versions(docs, ledger, "0", path_col="doc_id")
    kinds = [rule.kind for rule in secret_scan.RULES[:secret_scan.BASE_KINDS]]
    base = F.filter("spans", lambda s: s["kind_no"] < secret_scan.BASE_KINDS)
    return found.select(
        F.col("path").alias("doc_id"),
        *[secret_scan.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(secret_scan.digest(base), 256).alias("base_sha256"),
        secret_scan.digest(F.col("spans")).alias("spans"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = mixing.fit_classifier(docs, mixing.label_domains(read(spark, sf_dir, "labels")))
    rated = mixing.fit_rates(mixing.memberships(docs, model), model.names, TARGETS, "clean")
    return rated.select(
        "doc_id", "n_tokens",
        *[F.col("posterior")[k].alias(f"p_{name}") for k, name in enumerate(model.names)],
        "rate", mixing.copies(F.col("rate"), F.col("doc_id")).alias("copies"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), width=3, distance=2)
    return found.select(
        "doc_id", simhash.hex_fingerprint(found.fp).alias("fingerprint"), "component_id"
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_codec.encode(read(spark, sf_dir, "documents"), tokenizer_file())
    back = sentencepiece_codec.decoded(encoded, tokenizer_file())
    return back.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids",
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_fingerprints(read(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), every=20, k=20)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening(read(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), moved)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decision_list.quality_rules(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    )
    return found.select("doc_id", *decision_list.COUNTS, "base_failed", "rule", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pitman_yor": op1_pitman_yor,
    "op2_quality": op2_quality,
    "op3_paragraphs": op3_paragraphs,
    "op4_licences": op4_licences,
    "op5_secrets": op5_secrets,
    "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_minhash": op9_minhash,
    "op10_neighbours": op10_neighbours,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_quality_rules": op13_quality_rules,
}
ORACLES: dict[str, str] = {}
