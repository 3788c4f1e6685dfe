import corpus_pipeline as pipeline
from tests.llm.conftest import MODEL
from tests.llm.test_sentencepiece_codec import merges_of
from tidemark.llm import secret_scan, sentencepiece_codec
from tidemark.llm.common import store

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    steps = [docs]
    for name, stage in pipeline.STAGES:
        steps.append(store(stage(spark, steps[-1], SF), name))
    for before, after in zip(steps[:-1], steps[1:-1]):
        assert after.columns == docs.columns
        assert after.select("doc_id").subtract(before.select("doc_id")).count() == 0
    ids = [[r.doc_id for r in s.select("doc_id").collect()] for s in steps]
    good = {i for i, (quality, _) in labels.items() if quality == 1}
    junk = {i for i, (quality, _) in labels.items() if quality == 0}
    assert len(good & set(ids[1])) > 0.97 * len(good)
    assert len(junk & set(ids[1])) < 0.05 * len(junk)
    assert len(set(ids[2])) == len(ids[2])
    clean_texts = [r.text for r in steps[3].collect()]
    assert ids[3] and sorted(ids[3]) == sorted(ids[2])
    assert not any(secret_scan.find_spans(t) for t in clean_texts)
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())
    clean = {i for i in ids[3] if labels.get(i) == (1, 0)}
    toxic = {i for i in ids[3] if labels.get(i) == (1, 1)}
    assert len(clean & set(ids[4])) > 0.97 * len(clean)
    assert len(toxic & set(ids[4])) < 0.8 * len(toxic)
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    rows = steps[5].collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    vocabulary = sentencepiece_codec.Vocabulary.load(MODEL)
    for r in rows:
        assert sentencepiece_codec.decode(r.ids, vocabulary) == texts[r.doc_id]
    assert list(rows[0].ids) == merges_of(texts[rows[0].doc_id], vocabulary)


def test_odd_rows_go_through_every_stage(spark, odd_docs, no_docs):
    for name, stage in pipeline.STAGES:
        out = stage(spark, odd_docs, SF)
        assert out.count() <= odd_docs.count()
        if stage is not pipeline.STAGES[-1][1]:
            assert out.columns == odd_docs.columns
        assert stage(spark, no_docs, SF).count() == 0
