import numpy as np

from tidemark.llm import mixing
from tidemark.llm.queries import TARGETS, op6_mixing


def members(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, posterior array<double>")


def test_expected_totals_meet_targets(spark):
    random = np.random.default_rng(2)
    p = random.dirichlet((4, 1, 1), 300)
    rows = [(i, int(n), list(map(float, q))) for i, (n, q) in enumerate(zip(random.integers(1, 900, 300), p))]
    rated = mixing.fit_rates(
        members(spark, rows), ["a", "b", "c"], {"a": 0.8, "b": 0.15, "c": 0.05}, "a"
    ).collect()
    held = sum(r.rate * r.n_tokens * np.array(r.posterior) for r in rated)
    np.testing.assert_allclose(held / held.sum(), [0.8, 0.15, 0.05], atol=1e-6)
    kept = sum(n * q[0] for _, n, q in rows)
    assert abs(held[0] - kept) < 1e-6 * held.sum()
    assert min(r.rate for r in rated) >= 0


def test_box_and_targets_out_of_reach(spark):
    rows = [(1, 10, [1.0, 0.0]), (2, 10, [0.0, 1.0]), (3, 0, [0.5, 0.5])]
    rated = mixing.fit_rates(members(spark, rows), ["a", "b"], {"b": 1.0}, "a", max_rate=1.0)
    by_id = {r.doc_id: r.rate for r in rated.collect()}
    assert by_id[1] == 0 and by_id[3] == 1 and 0 <= by_id[2] <= 1
    assert mixing.fit_rates(members(spark, []), ["a", "b"], TARGETS, "a").count() == 0


def nearest_totals(n, p, want, max_rate):
    """Least squares over the box by many plain projected steps, in double precision."""
    a = (n[:, None] * p).T
    rate = np.full(len(n), min(1.0, max_rate))
    step = 1 / np.linalg.norm(a, 2) ** 2
    ahead = rate
    for t in range(60_000):
        new = np.clip(ahead - step * (a.T @ (a @ ahead - want)), 0, max_rate)
        ahead = new + t / (t + 3) * (new - rate)
        rate = new
    return a @ rate


def test_rates_against_plain_least_squares(spark):
    """Targets in and out of reach: totals are those of the nearest point, which is unique."""
    random = np.random.default_rng(7)
    names = ["a", "b", "c", "d"]
    for max_rate, targets in (
        (1.0, {"a": 0.1, "b": 0.1, "c": 0.1, "d": 0.7}), (2.0, {"a": 0.9, "d": 0.1}),
        (float("inf"), {"b": 0.4, "c": 0.6}),
    ):
        p = random.dirichlet((3, 1, 1, 0.5), 60)
        n = random.integers(1, 50, 60)
        rows = [(i, int(m), list(map(float, q))) for i, (m, q) in enumerate(zip(n, p))]
        rated = mixing.fit_rates(members(spark, rows), names, targets, "none", max_rate).collect()
        rate = np.array([r.rate for r in sorted(rated)])
        assert rate.min() >= 0 and rate.max() <= max_rate
        total = float((n[:, None] * p).sum())
        want = np.array([targets.get(x, 0.0) for x in names]) * total
        got = ((rate * n)[:, None] * p).sum(axis=0)
        best = nearest_totals(n, p, want, max_rate)
        assert np.square(got - want).sum() <= np.square(best - want).sum() + 1e-6 * total ** 2
        np.testing.assert_allclose(got / total, best / total, atol=2e-4)


def test_table_meets_its_targets(spark):
    rated = op6_mixing(spark, "/root/testdata/sf0.1").toPandas()
    held = {d: (rated.rate * rated.n_tokens * rated[f"p_{d}"]).sum() for d in TARGETS}
    for domain, share in TARGETS.items():
        assert abs(held[domain] / sum(held.values()) - share) < 1e-4
    clean = (rated.n_tokens * rated.p_clean).sum()
    assert abs(held["clean"] / clean - 1) < 1e-4


def test_copies_have_the_rate_as_their_mean(spark):
    df = spark.range(20_000).selectExpr("id", "1.3D AS rate")
    n = df.select(mixing.copies(df.rate, df.id).alias("n")).groupBy().sum("n").first()[0]
    assert abs(n / 20_000 - 1.3) < 0.015


def test_held_out_posteriors(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = mixing.label_domains(spark.read.parquet(f"{sf}/labels.parquet"))
    model = mixing.fit_classifier(docs, labels.where("doc_id % 3 > 0"))
    found = mixing.memberships(docs, model).toPandas()
    truth = labels.where("doc_id % 3 = 0").toPandas().merge(found, on="doc_id")
    guess = np.array(model.names)[np.stack(truth.posterior.to_numpy()).argmax(axis=1)]
    assert (guess == truth.domain).mean() > 0.93
    clean = truth.domain == "clean"
    assert (guess[clean] == "clean").mean() > 0.97
    assert (guess[~clean] != "clean").mean() > 0.7


def test_odd_rows(spark, odd_docs, no_docs):
    labelled = spark.createDataFrame(
        [(1, "a"), (5, "b"), (None, "a"), (6, None)], "doc_id long, domain string"
    )
    model = mixing.fit_classifier(odd_docs, labelled)
    assert model.names == ["a", "b"]
    found = mixing.memberships(odd_docs, model)
    rated = mixing.fit_rates(found, model.names, {"a": 0.5, "b": 0.5}, "a").collect()
    assert len(rated) == odd_docs.count()
    assert all(abs(sum(r.posterior) - 1) < 1e-9 for r in rated)
    model = mixing.fit_classifier(no_docs, labelled)
    assert model.names == ["all"] and mixing.memberships(no_docs, model).count() == 0
    assert mixing.memberships(odd_docs, model).count() == odd_docs.count()
    empty = mixing.memberships(odd_docs, model).where("doc_id IN (2, 3)").collect()
    assert [r.n_tokens for r in empty] == [0, 0]


def test_query_columns(spark):
    df = op6_mixing(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "n_tokens", "p_clean", "rate", "copies"} <= set(df.columns)
    assert df.count() == 200
