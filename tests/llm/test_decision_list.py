import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import decision_list as rules

LABELS = "doc_id long, quality int, toxic int"


def plain_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by their definitions."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen, covered, lines, repeated = Counter(windows), set(), set(), 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            covered.update(range(at, at + 8))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in lines
            lines.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered)


def assert_counts(docs):
    got = rules.with_statistics(docs.select("doc_id", "text")).select("doc_id", *rules.COUNTS)
    want = [(r.doc_id, *plain_counts(r.text)) for r in docs.collect()]
    key = lambda row: tuple((x is None, x) for x in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_counts_of_odd_texts(odd_docs, no_docs):
    assert_counts(odd_docs)
    assert_counts(no_docs)


def test_counts_of_repeats(spark):
    draw = random.Random(3)
    texts = []
    for _ in range(150):
        run = [f"w{draw.randrange(4)}" for _ in range(draw.randrange(1, 60))]
        text = "".join(w + draw.choice([" ", "\n", "\t ", "\x0b", "  ", " ", "#", "\r\n"]) for w in run)
        texts.append(text * draw.choice([1, 1, 2, 3]))
    texts += ["a " * 7, "a " * 8, "a " * 9, "x\n" * 40, " \n \n", "\n\n", "|<>|"]
    assert_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_counts_of_a_table(spark):
    assert_counts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def fake(spark, rows):
    """Statistics of words and symbol share; the rest zero."""
    df = spark.createDataFrame(rows, "doc_id long, n_words long, symbol_share double, distinct_share double")
    rest = [c for c in (*rules.COUNTS, *rules.SHARES) if c not in df.columns]
    return df.withColumns({c: F.lit(0).cast("bigint" if c in rules.COUNTS else "double") for c in rest})


def test_learns_a_conjunction_and_orders_rules(spark):
    """Bad: many symbols in a text of few words, or few distinct words. Nothing else."""
    draw = random.Random(5)
    rows, labels = [], []
    for k in range(3_000):
        words, symbols, distinct = draw.randrange(20, 400), draw.random(), draw.random()
        rows.append((k, words, symbols, distinct))
        bad = (symbols > 0.6 and words < 200) or distinct < 0.1
        labels.append((k, int(not bad), 0))
    statistics = fake(spark, rows)
    found = rules.learn(statistics, spark.createDataFrame(labels, LABELS))
    judged = {r.doc_id: r.kept for r in rules.judged(statistics, found).collect()}
    agreed = sum(judged[k] == bool(good) for k, good, _ in labels) / len(labels)
    assert len(found.rules) >= 2 and any(len(rule) >= 2 for rule in found.rules)
    assert agreed > 0.93
    assert str(found).endswith("otherwise: good")
    dropped = [k for k, good, _ in labels if not judged[k]]
    assert sum(labels[k][1] for k in dropped) <= 0.08 * len(dropped)


def test_noise_teaches_nothing(spark):
    draw = random.Random(6)
    rows = [(k, draw.randrange(20, 400), draw.random(), draw.random()) for k in range(900)]
    labels = [(k, int(draw.random() < 0.8), 0) for k in range(900)]
    found = rules.learn(fake(spark, rows), spark.createDataFrame(labels, LABELS))
    assert found.rules == []


def test_candidate_counts_equal_plain_ones(spark):
    draw = random.Random(7)
    rows = [(k, draw.randrange(20, 60), draw.choice([0.0, 0.1, 0.1, 0.5]), 0.0) for k in range(300)]
    table = fake(spark, rows).withColumn("bad", (F.col("doc_id") % 3 == 0).cast("int"))
    thresholds = rules._thresholds(table)
    for condition, bad, good in rules._candidates(table, thresholds):
        if condition.statistic in ("n_words", "symbol_share"):
            at = {"n_words": 1, "symbol_share": 2}[condition.statistic]
            held = [r[0] % 3 == 0 for r in rows if (r[at] > condition.threshold) == condition.above]
            assert (bad, good) == (sum(held), len(held) - sum(held))


def test_labels_of_one_kind_empty_tables_and_null_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], LABELS)
    odd = spark.createDataFrame([(1, 0, 0), (1, None, None), (None, 1, 0), (5, 0, 1)], LABELS)
    for labels in (none, odd):
        out = rules.quality_rules(odd_docs, labels).collect()
        assert len(out) == odd_docs.count()
        assert all(r.kept == (not r.base_failed) for r in out if r.rule is None)
        assert {r.kept for r in out if not r.n_words} == {False}
    assert rules.quality_rules(no_docs, none).count() == 0


def test_held_out_verdicts(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = rules.quality_rules(docs, labels.where("doc_id % 2 = 0"))
    held = found.where("doc_id % 2 = 1").join(labels, "doc_id").where("NOT base_failed")
    counts = {(r.quality, r.kept): r["count"] for r in held.groupBy("quality", "kept").count().collect()}
    good, bad = counts.get((1, True), 0), counts.get((0, False), 0)
    assert good >= 0.99 * (good + counts.get((1, False), 0))
    assert bad >= 0.9 * (bad + counts.get((0, True), 0))


def test_native_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = rules.with_statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|MapIn", plan)
