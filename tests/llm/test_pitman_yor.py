import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import pitman_yor as model
from tidemark.llm.queries import op1_pitman_yor

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def test_strings_of_texts():
    texts = ["  Ab c\n\n d ", None, "", "x", " \t", "É\x00 z"]
    found, owner, n_tokens = model.strings(pa.array(texts))
    for i, text in enumerate(texts):
        body = " ".join(tokens(text)).encode() + b"\n"
        padded = bytes(6) + body
        wanted = [int.from_bytes(padded[k:k + 7], "big") for k in range(len(body))]
        assert [int(f) for f in found[owner == i]] == wanted
        assert n_tokens[i] == len(tokens(text)) + 1
    assert (model.unpack(model.pack(np.unique(found))) == np.unique(found)).all()


def test_probabilities_sum_to_one_and_seating_is_consistent():
    random = np.random.default_rng(1)
    text = random.integers(97, 101, 3_000).astype(np.uint64)
    keys = np.zeros(len(text), np.uint64)
    for back in range(model.ORDER):
        keys[back:] |= text[:len(text) - back] << np.uint64(8 * back)
    seen, count = np.unique(keys[8:], return_counts=True)
    # Every byte after every context of the trained strings, most of them never seen.
    contexts = np.unique(seen >> np.uint64(8))
    every = (contexts[:, None] << np.uint64(8) | np.arange(256, dtype=np.uint64)[None]).ravel()
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, seen)] = count
    tree = model.Tree(every, range(model.ORDER, model.SHARED - 1, -1), 3)
    above = np.full(len(tree.levels[-1].c), 1 / 256)
    tree.start(counts, above)
    p = tree.averaged(above)
    np.testing.assert_allclose(p.reshape(-1, 256).sum(axis=1), 1)
    assert (tree.levels[0].c == counts).all()
    for level, up in zip(tree.levels, tree.levels[1:]):
        assert (np.bincount(level.parent, level.t, len(up.c)) == up.c).all()
        assert (level.t <= level.c).all() and ((level.t > 0) == (level.c > 0)).all()
        assert (np.bincount(level.owner, level.size, len(level.c)) == level.c).all()


def test_gibbs_finds_the_stationary_number_of_tables():
    """One row of c customers: the sampled mean of t against the exact distribution."""
    c, d, p = 12, 0.5, 0.3
    # weight[t] = generalized Stirling number(c, t) * rising (s|d)_t * p**t
    stirling = np.zeros((c + 1, c + 1))
    stirling[1, 1] = 1
    for n in range(1, c):
        for t in range(1, n + 2):
            stirling[n + 1, t] = stirling[n, t - 1] + (n - d * t) * stirling[n, t]
    rising = np.cumprod([1.0] + [model.STRENGTH + d * k for k in range(c)])
    weight = np.array([stirling[c, t] * rising[t] * p ** t for t in range(c + 1)])
    exact = (weight * np.arange(c + 1)).sum() / weight.sum()
    random = np.random.default_rng(5)
    copies = 400  # independent restaurants of one row each
    seating = model.Seating(np.arange(copies), np.zeros(copies, int), d)
    seating.open(np.full(copies, c), np.ones(copies, np.int64), random)
    above, means = np.full(copies, p), []
    for sweep in range(700):
        seating.reseat(above, random)
        if sweep >= 200:
            means.append(seating.t.mean())
    assert np.mean(means) == pytest.approx(exact, rel=0.03)


def mean_tables(c, d, p):
    """Of one row of c customers in a restaurant of its own, by the recursion of the weights."""
    log = np.full(c + 2, -np.inf)
    log[1] = 0
    t = np.arange(1, c + 2)
    with np.errstate(divide="ignore"):
        for n in range(1, c):
            stay = np.log(np.maximum(n - d * t, 0)) + log[1:]
            log[1:] = np.logaddexp(log[:-1], stay)
    log = log[1:c + 1] + np.cumsum(np.log(model.STRENGTH + d * np.arange(c))) + t[:c] * math.log(p)
    weight = np.exp(log - log.max())
    return (weight * t[:c]).sum() / weight.sum()


@pytest.mark.parametrize("c, d, p", [(2, 0.8, 0.5), (32, 0.7, 0.2), (40, 0.8, 0.9), (500, 0.75, 0.4), (3000, 0.6, 0.5)])
def test_a_few_sweeps_move_every_customer(c, d, p):
    """Rows that start at one table; one customer a sweep left the large ones there."""
    random = np.random.default_rng(5)
    copies = 3000
    seating = model.Seating(np.arange(copies), np.zeros(copies, int), d)
    seating.open(np.full(copies, c), np.ones(copies, np.int64), random)
    above, means = np.full(copies, p), []
    for sweep in range(30):
        seating.reseat(above, random)
        if sweep >= model.BURN_IN:
            means.append(seating.t.mean())
    assert np.mean(means) == pytest.approx(mean_tables(c, d, p), rel=0.03)


def test_rows_of_a_restaurant_are_sampled_together():
    """Two rows of one restaurant against all pairs of their tables."""
    c, d, p = (6, 9), 0.6, (0.5, 0.2)
    ways = [np.exp(model._exact_ways(d)[n, :n + 1]) for n in c]
    rising = np.cumprod([1.0] + [model.STRENGTH + d * k for k in range(sum(c))])
    joint = np.array([[
        ways[0][a] * ways[1][b] * p[0] ** a * p[1] ** b * rising[a + b] for b in range(c[1] + 1)
    ] for a in range(c[0] + 1)])
    joint /= joint.sum()
    wanted = [(joint.sum(axis=1 - k) * np.arange(c[k] + 1)).sum() for k in (0, 1)]
    random, copies = np.random.default_rng(7), 1000
    seating = model.Seating(np.repeat(np.arange(copies), 2), np.zeros(2 * copies, int), d)
    seating.open(np.tile(c, copies), np.ones(2 * copies, np.int64), random)
    above, means = np.tile(p, copies), []
    for sweep in range(120):
        seating.reseat(above, random)
        if sweep >= 20:
            means.append(seating.t.reshape(-1, 2).mean(axis=0))
    assert np.mean(means, axis=0) == pytest.approx(wanted, rel=0.02)


def test_base_and_counts_against_plain_python(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    train = Counter()
    for i, text in docs.items():
        if not held[i]:
            train.update(tokens(text) + ["\n"])
    n, v = sum(train.values()), len(train)
    rows = op1_pitman_yor(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        own = tokens(docs[r.doc_id]) + ["\n"]
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(own), n)
        assert r.n_known == sum(train[w] > 0 for w in own)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0


def test_held_out_perplexity_beats_the_base(spark):
    scored = op1_pitman_yor(spark, "/root/testdata/sf0.01")
    sides = {r.held_out: r for r in model.perplexity(scored).collect()}
    assert sides[True].perplexity < sides[True].base_perplexity
    assert sides[False].perplexity < sides[True].perplexity


def test_odd_rows(odd_docs, no_docs):
    held_out = F.col("doc_id") == 6
    rows = model.score(odd_docs, held_out).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_tokens == by_id[3].n_tokens == by_id[4].n_tokens == 1
    assert by_id[2].score == by_id[4].score
    assert by_id[6].held_out and not by_id[None].held_out
    assert by_id[5].score == by_id[6].score
    assert model.score(no_docs, held_out).count() == 0
    alone = model.score(odd_docs.where("doc_id = 6"), held_out).first()
    assert alone.train_tokens == 0 and alone.n_known == 0 and math.isfinite(alone.score)


def test_trunk_and_buckets_are_seated_in_turn(spark, odd_docs, monkeypatch):
    """The trunk's customers are tables that were seated under the trunk, not only a uniform one."""
    under, seated = [], []
    customers, seat = model._trunk_customers, model.seat_trunk
    monkeypatch.setattr(model, "_trunk_customers", lambda p, t: under.append(t) or customers(p, t))
    monkeypatch.setattr(model, "seat_trunk", lambda *a: seated.append(seat(*a)) or seated[-1])
    model.score(odd_docs, F.col("doc_id") == 6).collect()
    assert len(under) == len(seated) > 1
    assert (under[0] == 1 / 256).all() and (under[1] == seated[0]).all()


def test_trunk_is_sampled():
    """Each seating gives probabilities of its own; a row without customers has those above it."""
    keys = np.arange(97, 123, dtype=np.int64)
    trunk = model.seat_trunk(np.concatenate([keys * 256 + 97, keys + 97 * 256]), np.arange(1, 53))
    assert trunk.shape == (model.SAMPLES, 1 << 16)
    np.testing.assert_allclose(trunk.reshape(-1, 256).sum(axis=1), 1)
    assert not (trunk[0] == trunk[1]).all()
    numbers = np.unique(np.array([5, 6, 261, 262, 70000], np.uint64))
    assert model.Tree(numbers, range(3, 1, -1), 1).levels[0].restaurant.tolist() == [0, 0, 1, 1, 2]


def test_words_have_one_key_each():
    texts = ["  Ab c\n\n d ab", None, "", "x", " \t", "\u00c9\x00 z c ba \x00 \x00\x00", "AB aB", "ab" * 50_000 + " d"]
    random = np.random.default_rng(2)
    texts += [" ".join("".join(chr(97 + b) for b in random.integers(0, 3, k % 7)) for k in range(300))]
    column = pa.array(["left out", *texts])[1:]
    keys, owner = model.word_keys(column)
    words = [w for text in texts for w in tokens(text)]
    ends = np.flatnonzero(keys == model.END_WORD)
    assert owner[ends].tolist() == list(range(len(texts)))
    assert [int(o) for o in owner[:len(words)]] == [i for i, t in enumerate(texts) for _ in tokens(t)]
    by_word = {}
    for word, key in zip(words, keys.tolist()):
        assert by_word.setdefault(word, key) == key
    assert len(set(by_word.values())) == len(by_word) and min(by_word.values()) > 0
    assert len(keys) == len(words) + len(texts)


class Stage:
    """Catches the function that a stage would run."""

    def mapInArrow(self, run, schema):
        return run


def test_a_chunk_holds_little_more_than_its_distinct_strings():
    """4 MB of text took 250 MB, and each of an executor's cores runs such a chunk."""
    random = np.random.default_rng(5)
    letters = random.integers(97, 123, (200, 10_000), dtype=np.uint8)
    letters[:, ::6] = 32
    texts = [bytes(row).decode() for row in letters] * 2
    n = len(texts)
    batch = pa.record_batch([
        pa.array(range(n)), pa.array(texts), pa.array([i % 5 != 1 for i in range(n)]),
        pa.array([0] * n, pa.int32()),
    ], ["doc_id", "text", "trained", "chunk"])
    run = model._chunk_parts(Stage(), 8)
    tracemalloc.start()
    parts = list(run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 180 << 20, peak >> 20
    # Whatever was merged on the way, every string is there once, with its count.
    wanted = Counter()
    for i, text in enumerate(texts):
        found = model.strings(pa.array([text]))[0]
        for key in found.tolist():
            wanted[key] += i % 5 != 1
    got = {}
    for part in parts:
        row = part.to_pylist()[0]
        if row["kind"] == model.STRINGS:
            counts = np.frombuffer(zlib.decompress(row["counts"]), "<i8")
            for key, count in zip(model.unpack(row["keys"]).tolist(), counts.tolist()):
                assert key not in got
                got[key] = count
    assert got == wanted
