import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.llm import quality, stats
from tidemark.llm.common import crc_remainder
from tidemark.llm.queries import op2_quality


def test_pooling_is_the_isotonic_fit():
    ones, rows = np.array([1.0, 0, 3, 1, 5]), np.array([2.0, 2, 4, 4, 5])
    fit = quality._pooled(ones, rows)
    assert (np.diff(fit) >= 0).all()
    np.testing.assert_allclose(fit, [0.25, 0.25, 0.5, 0.5, 1.0])


def test_features_approximate_the_kernel():
    random = np.random.default_rng(1)
    n_stats = len(stats.FULL)
    model = quality.Model(
        np.zeros(n_stats), np.ones(n_stats), random.normal(size=(n_stats, 20_000)) / n_stats ** 0.5,
        random.uniform(0, 2 * np.pi, 20_000), np.zeros(20_001), np.zeros(2),
    )
    x = random.normal(size=(6, n_stats))
    phi = model.features(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.testing.assert_allclose(phi @ phi.T, np.exp(-distance / (2 * n_stats)), atol=0.04)


def test_held_out_accuracy_and_no_use_of_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    scored = op2_quality(spark, sf).toPandas()
    assert len(scored) == 10_000 and scored.score.between(0, 1).all()
    both = scored[scored.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both.quality).mean() > 0.97
    good = both[both.quality == 1]
    assert (good.predicted == 1).mean() > 0.98


def test_sums_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scores = []
    for n in (1, 7):
        x = quality.statistics(docs.repartition(n))
        model = quality.fit(x, labels.where(crc_remainder(F.col("doc_id"), 4) != 2))
        scores.append(quality.scored(x, model).toPandas().sort_values("doc_id").score.to_numpy())
    np.testing.assert_allclose(scores[0], scores[1], atol=1e-6)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (5, 0), (2, None), (None, 1)], "doc_id long, quality int"
    )
    x = quality.statistics(odd_docs)
    model = quality.fit(x, labels)
    rows = quality.scored(x, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = odd_docs.select("doc_id", quality.text_score(model, F.col("text")).alias("s")).collect()
    for r in by_text:
        assert any(q.doc_id == r.doc_id and abs(q.score - r.s) < 1e-9 for q in rows)
    unlabelled = quality.fit(x, labels.limit(0))
    assert {r.score for r in quality.scored(x, unlabelled).collect()} == {0.5}
    nothing = quality.statistics(no_docs)
    assert quality.scored(nothing, quality.fit(nothing, labels)).count() == 0


def test_statistics_of_known_texts():
    import pyarrow as pa

    x, _ = stats.vectors(pa.array(["Ab! 12 ab!\nab!", None, ""]))
    row = pd.Series(x[0], stats.FULL)
    assert row["upper"] == 1 / 14 and row["digit"] == 2 / 14 and row["line end"] == 1 / 14
    assert row["distinct words"] == 2 / 4 and row["commonest word"] == 3 / 4
    assert (x[1:] == 0).all() or np.isfinite(x).all()
