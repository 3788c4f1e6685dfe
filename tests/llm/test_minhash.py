import hashlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import edited, words
from tidemark.llm import minhash


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def similarity(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def test_likeness_is_nearly_jaccard_without_bias(spark):
    rows = []
    for k in range(150):
        base = words(8 + 3 * k, k, 5_000)
        rows.append((k, " ".join(base), " ".join(edited(base, 0.03 * (k % 5), k))))
    df = spark.createDataFrame(rows, "k long, a string, b string")
    df = minhash.with_fingerprint(minhash.with_fingerprint(df, "a", "fa"), "b", "fb")
    found = df.select("a", "b", minhash.likeness(df.fa, df.fb).alias("s"), "fa").collect()
    error = np.array([r.s - similarity(r.a, r.b) for r in found])
    assert abs(error.mean()) < 0.015 and np.sqrt((error ** 2).mean()) < 0.06
    assert {len(r.fa) for r in found} == {minhash.BINS * minhash.LOW_BITS // 4}


def test_unrelated_texts_have_likeness_near_zero(spark):
    rows = [(k, " ".join(words(300, k, 90_000)), " ".join(words(300, k + 500, 90_000)))
            for k in range(60)]
    df = spark.createDataFrame(rows, "k long, a string, b string")
    df = minhash.with_fingerprint(minhash.with_fingerprint(df, "a", "fa"), "b", "fb")
    assert np.mean([r.s for r in df.select(minhash.likeness(df.fa, df.fb).alias("s")).collect()]) < 0.01


def test_edited_texts_against_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    rows = minhash.edited_fingerprints(docs.repartition(5)).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    prints = {r.doc_id: r.fingerprint for r in rows}
    for r in rows:
        text, n = texts[r.doc_id], len(texts[r.doc_id])
        new = text[:n - n // 2] + texts[following[r.doc_id]][:n // 2]
        assert r.n_chars == n
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert abs(r.near_edited - similarity(text, new)) < 0.2
        assert (r.near_next == 1) == (prints[r.doc_id] == prints[following[r.doc_id]])


def test_plan_has_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = minhash.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_rows(spark, odd_docs, no_docs):
    rows = {r.doc_id: r for r in minhash.edited_fingerprints(odd_docs).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7]
    assert rows[2].n_chars == 0 and rows[2].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[2].fingerprint == rows[3].fingerprint == rows[4].fingerprint
    assert rows[6].fingerprint == rows[5].fingerprint and rows[6].near_next == 1
    assert minhash.edited_fingerprints(no_docs).count() == 0
    alone = minhash.edited_fingerprints(odd_docs.where("doc_id = 7")).first()
    assert alone.near_next == 1


def test_five_words_are_a_shingle_like_any_other(spark):
    """One shingle, shared with its extension by a word: the true similarity is a half."""
    rows = [(k, f"a{k} b c d e", f"a{k} b c d e f") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, x string, y string")
    both = minhash.with_fingerprint(minhash.with_fingerprint(df, "x", "fx"), "y", "fy")
    near = both.select(minhash.likeness(F.col("fx"), F.col("fy")).alias("n")).agg(F.avg("n")).first()[0]
    assert 0.4 < near < 0.6
