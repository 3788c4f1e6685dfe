import random
import re

import pyarrow as pa

from tests.llm.conftest import edited, words
from tests.llm.test_simhash import least_reachable
from tidemark.llm import paragraphs as dedup


def line(n, seed):
    return " ".join(words(n, seed, 9_000))


def test_against_all_pairs(spark):
    rows = []
    for family in range(12):
        base = words(70, family, 9_000)
        for k in range(7):
            body = " ".join(edited(base, 0.01 * k, 50 * family + k))
            rows.append((100 * family + k, f"{line(25, family * 31 + k)}\nshort line\n{body}\n"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.start): r for r in dedup.repeated_paragraphs(docs).collect() if r.whole}
    every = [
        (i, text.index(part), part) for i, text in rows for part in text.split("\n")
        if len(part.split()) >= dedup.MIN_WORDS
    ]
    at = {(i, s): t for i, s, t in every}
    near = {a: [b for b in at if dedup.jaccard(at[a], at[b]) >= 0.8] for a in at}
    label = least_reachable(at, near)
    sizes = {root: list(label.values()).count(root) for root in label.values()}
    wanted = {a: root for a, root in label.items() if sizes[root] > 1}
    assert {a: (r.first_doc_id, r.first_start) for a, r in found.items()} == wanted
    for a, r in found.items():
        assert r.occurrences == sizes[wanted[a]] and r.removed == (a != wanted[a])
        assert dict(rows)[r.doc_id][r.start:r.end] == at[a]


def test_chain_whose_ends_differ_is_one_cluster(spark):
    base = words(80, 3, 9_000)
    rows = [(k, " ".join(["q"] * 0 + base[k * 4:k * 4 + 60])) for k in range(5)]
    assert dedup.jaccard(rows[0][1], rows[4][1]) < 0.8 <= dedup.jaccard(rows[0][1], rows[1][1])
    found = dedup.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.first_doc_id) for r in found.collect()} == {(k, 0) for k in range(5)}


def hashed(*texts):
    """Band hashes of each text and its shingle sets, as a slice of texts gives them."""
    words = dedup.Words(pa.array(texts, pa.large_string()))
    shingles, edges = dedup.shingle_hashes(words.hash, words.line_first, words.line_end)
    return dedup.band_hashes(shingles, edges), [
        set(shingles[a:b].tolist()) for a, b in zip(edges, edges[1:])
    ]


def test_bands_have_the_recall_they_are_tuned_for():
    missed = 0
    for k in range(300):
        base = words(100, k, 9_000)
        other = edited(base, 0.015, k)
        bands, _ = hashed(" ".join(base), " ".join(other))
        if dedup.jaccard(" ".join(base), " ".join(other)) >= 0.8:
            missed += not (bands[0] == bands[1]).any()
    assert missed <= 2


def test_shingle_sets_have_the_plain_similarity():
    draw = random.Random(3)
    texts = []
    for k in range(60):
        base = words(draw.randrange(1, 40), k % 9, 30)
        texts.append("\t ".join(edited(base, 0.1, k)).title())
    _, sets = hashed(*texts)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(sets[i] & sets[j]) / len(sets[i] | sets[j]) == dedup.jaccard(a, b)


def test_words_lines_and_places_equal_plain_ones(odd_docs):
    texts = [r.text or "" for r in odd_docs.collect()] + ["", "\n\n a\x0bb\r\n ÀÉ  z\n", "x", "é\ny é"]
    found = dedup.Words(pa.array(texts, pa.large_string()))
    got = list(zip(found.text, found.line, found.start, found.end))
    want = [
        (t, text.count("\n", 0, m.start()), m.start(), m.end())
        for t, text in enumerate(texts) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)
    ]
    assert got == want
    spelt = [re.sub("[A-Z]", lambda m: m.group().lower(), texts[t][a:b]) for t, _, a, b in want]
    by_hash = dict(zip(found.hash.tolist(), spelt))
    assert [by_hash[h] for h in found.hash.tolist()] == spelt and len(by_hash) == len(set(spelt))


def test_passages_inside_different_lines(spark):
    """A run of 60 words stands anywhere inside longer lines that are different otherwise."""
    draw, rows, planted = random.Random(9), [], {}
    passages = [words(60, 900 + k, 9_000) for k in range(20)]
    for doc in range(200):
        own = words(200, doc, 90_000)
        if doc < 100:
            at = draw.randrange(10, 190)
            own[at:at] = passages[doc % 20]
            planted[doc] = " ".join(passages[doc % 20])
        rows.append((doc, " ".join(own)))
    found = dedup.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    docs = {r.doc_id for r in found}
    assert len(docs & set(planted)) >= 0.97 * len(planted) and docs <= set(planted)
    texts = dict(rows)
    for r in found:
        piece = texts[r.doc_id][r.start:r.end]
        first = texts[r.first_doc_id]
        assert piece in planted[r.doc_id] and first[r.first_start:r.first_start + len(piece)] == piece
        # Within a few words of the ends of a passage, cuts depend on what stands around it.
        assert 2 <= r.occurrences <= 5 and r.removed == (r.doc_id != r.first_doc_id) and not r.whole
    assert sum(r.occurrences == 5 for r in found) > 0.6 * len(found)


def test_short_lines_count_together(spark):
    """A boilerplate line alone is left; lines that repeat one after the other make a passage."""
    banner, notice = " ".join(words(8, 1, 9_000)), [" ".join(words(9, k, 9_000)) for k in (2, 3, 4)]
    rows = [(k, f"{line(30, 70 + k)}\n{banner}\n{line(30, 170 + k)}") for k in range(5)]
    rows += [(10 + k, line(30, 270 + k) + "\n" + "\n".join(notice)) for k in range(3)]
    found = dedup.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.paragraph) for r in found) == [(10 + k, p) for k in range(3) for p in (1, 2, 3)]
    assert {(r.first_doc_id, r.occurrences) for r in found} == {(10, 3)}


def test_blocks_find_every_link_between_components(spark, monkeypatch):
    """Members of one band, most of them unlike: all links come out, whatever the blocks."""
    monkeypatch.setattr(dedup, "BLOCK", 7)
    texts = {k: " ".join(words(60, k, 9_000)) for k in range(50)}
    for k in range(50, 62):
        texts[k] = " ".join(edited(texts[k - 50].split(), 0.02, k))
    table = spark.createDataFrame(list(texts.items()), "key long, text string")
    rest = table.selectExpr("1L AS band", "key", "key % 45 AS component")
    got = {tuple(sorted(r)) for r in dedup._links_across(rest, table, 0.8).collect()}
    want = {
        (a, b) for a in texts for b in texts if a < b and a % 45 != b % 45
        and dedup.jaccard(texts[a], texts[b]) >= 0.8
    }
    assert got == want and len(want) >= 5


def test_odd_rows(spark, odd_docs, no_docs):
    rows = dedup.repeated_paragraphs(odd_docs).collect()
    assert {(r.doc_id, r.first_doc_id, r.removed) for r in rows} == {(5, 5, False), (6, 5, True)}
    twice = odd_docs.where("doc_id = 5").union(odd_docs.where("doc_id = 5"))
    assert dedup.repeated_paragraphs(twice).count() == 2
    assert dedup.repeated_paragraphs(no_docs).count() == 0
    one = spark.createDataFrame([(1, line(30, 1) + "\n" + line(30, 2))], "doc_id long, text string")
    assert dedup.repeated_paragraphs(one).count() == 0
