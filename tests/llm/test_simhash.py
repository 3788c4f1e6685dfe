import random

import pytest
import xxhash

import corpus_pipeline as pipeline
from tests.llm.conftest import edited, words
from tidemark.llm import components, secret_scan, simhash
from tidemark.llm.components import connected_components
from tidemark.session import scratch_path

MASK = (1 << 64) - 1


def plain_simhash(text, width=3):
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    n = max(1, len(tokens) - width + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i:i + width]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def least_reachable(nodes, near):
    """Smallest node that each can reach, by repeated spreading."""
    label = {n: n for n in nodes}
    while True:
        new = {n: min([label[n]] + [label[m] for m in near[n]]) for n in nodes}
        if new == label:
            return label
        label = new


def test_fingerprint_is_the_majority_of_bits():
    for text in ("", "one", "A b", "A b c", "the End\tof it\x0ball " * 9, "é ü " * 70_000):
        assert simhash.simhash(text.encode(), 3) & MASK == plain_simhash(text)


def test_links_are_all_pairs_within_two_bits(spark):
    draw = random.Random(4)
    prints = set()
    for _ in range(60):
        base = draw.getrandbits(64)
        prints.add(base)
        for _ in range(12):
            base ^= 1 << draw.randrange(64)
            prints.add(base)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = {
        (r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    }
    wanted = {
        (a, b) for a in signed for b in signed
        if a < b and ((a ^ b) & MASK).bit_count() <= 2
    }
    assert found == wanted
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_groups_against_all_pairs(spark):
    texts = {}
    for base in range(25):
        tokens = words(150, base)
        for k in range(6):
            texts[100 * base + k] = " ".join(edited(tokens, 0.004 * k, 7 * base + k))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = simhash.near_duplicates(docs).collect()
    prints = {i: plain_simhash(t) for i, t in texts.items()}
    assert {r.doc_id: r.fp & MASK for r in rows} == prints
    near = {i: [j for j in texts if (prints[i] ^ prints[j]).bit_count() <= 2] for i in texts}
    assert {r.doc_id: r.component_id for r in rows} == least_reachable(texts, near)
    assert len({r.component_id for r in rows}) < len(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(odd_docs).collect()]
    assert len(rows) == odd_docs.count()
    by_id = {r[0]: r for r in rows}
    assert by_id[2][1:] == by_id[3][1:] == by_id[4][1:] == (0, 2)
    assert by_id[6][2] == by_id[5][2] == 5
    assert by_id[None][2] is None
    assert simhash.near_duplicates(no_docs).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 160)] + [
        (100, 100), (None, 3), (5, None), (7, 6),
    ]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        **{n: 0 for n in range(41)}, **{n: 100 for n in range(100, 160)}
    }
    assert len(found) == 41 + 60
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_grows_with_the_documents_is_not_broadcast(spark):
    """A few MB of fingerprints are 28 cells each: hundreds of MB on the driver, then its end."""
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id long, text string")
    prints = spark.createDataFrame([(1,), (3,), (7,)], "fp long")
    assert "BroadcastHashJoin" not in plan(simhash.links(prints))
    edges = spark.createDataFrame([(2, 1), (3, 2)], "high long, low long")
    assert "BroadcastHashJoin" not in plan(components._small_star(components._large_star(edges)))
    assert "BroadcastHashJoin" not in plan(simhash.near_duplicates(docs))
    assert "BroadcastHashJoin" not in plan(pipeline.simhash_near_dedup(spark, docs, ""))
    assert "BroadcastHashJoin" not in plan(secret_scan.scan_versions(
        docs, secret_scan.BlobLedger(spark, scratch_path(spark, "ledger")), "0", "doc_id"
    ))
