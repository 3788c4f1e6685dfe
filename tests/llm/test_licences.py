import math
from collections import Counter

import pytest

from tidemark.llm import licences
from tidemark.llm.queries import op4_licences

APACHE = "Licensed under the Apache License, Version 2.0."
PROSE = "Then the story goes on and on about nothing in particular at all."


def test_headers_files_and_inheritance(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x.txt", PROSE),
        ("a/b/y.txt", f"{PROSE}\n{APACHE}\n{PROSE}"), ("a/b/z.txt", PROSE), ("c/w.txt", PROSE),
        ("a/b/c/COPYING", APACHE), ("a/b/c/d/deep.txt", PROSE), ("top.txt", "my license is mine"),
        (None, APACHE), ("e/x.txt", None), ("a/x.txt", PROSE),
    ]
    files = spark.createDataFrame(rows, "path string, text string")
    found = licences.scan(files).collect()
    assert len(found) == len(rows)
    got = {r.path: (r.licence, r.inherited_from) for r in found}
    assert got == {
        "a/LICENSE": ("MIT", None), "a/x.txt": ("MIT", "a"), "a/b/y.txt": ("Apache-2.0", None),
        "a/b/z.txt": ("MIT", "a"), "c/w.txt": (None, None), "a/b/c/COPYING": ("Apache-2.0", None),
        "a/b/c/d/deep.txt": ("Apache-2.0", "a/b/c"), "top.txt": (None, None),
        None: ("Apache-2.0", None), "e/x.txt": (None, None),
    }
    header = next(r for r in found if r.path == "a/b/y.txt")
    assert rows[2][1][header.start:header.end] == APACHE and header.score == pytest.approx(1)


def test_cosine_against_plain_python(spark):
    rows = [(f"f{k}", text) for k, text in enumerate([
        APACHE, "This work is licensed under the GNU General Public License, version 3. Really.",
        PROSE, "license license apache", "public domain",
    ])]
    files = spark.createDataFrame(rows, "path string, text string")
    n = len(rows)
    df = Counter(t for _, text in rows for t in set(licences.terms(text)))
    known = {t for _, text in licences.TEMPLATES for t in licences.terms(text)}

    def vector(text):
        return {
            t: k * (math.log((n + 1) / (df[t] + 1)) + 1 if t in known else math.log(n + 1) + 1)
            for t, k in Counter(licences.terms(text)).items()
        }

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(a[t] * b.get(t, 0) for t in a) / norm

    for r in licences.matches(files).collect():
        own = vector(dict(rows)[r.path])
        scores = [(-cosine(own, vector(text)), name) for name, text in licences.TEMPLATES]
        assert (-r.score, r.licence) == (pytest.approx(min(scores)[0]), min(scores)[1])


MIT_FILE = """MIT License

Copyright (c) 2019 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
GPL_HEAD = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Everyone is permitted to copy and distribute verbatim copies
 of this document, but changing it is not allowed.
"""
WRAPPED = """# Copyright 2020 Some Body
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
import os
"""


def test_licence_files_tags_and_wrapped_headers(spark):
    rows = [
        ("m/LICENSE", MIT_FILE), ("m/x.py", PROSE), ("g/COPYING", GPL_HEAD), ("g/x.py", PROSE),
        ("s/a.c", f"// SPDX-License-Identifier: MIT\n{PROSE}"),
        ("s/b.c", f"/* SPDX-License-Identifier: GPL-2.0-or-later */\n{PROSE}"),
        ("w/x.py", WRAPPED), ("n/x.py", PROSE),
    ] + [(f"n/{k}.txt", PROSE) for k in range(40)]
    found = licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()
    got = {r.path: r.licence for r in found}
    assert [got[p] for p, _ in rows[:8]] == [
        "MIT", "MIT", "GPL-3.0", "GPL-3.0", "MIT", "GPL-2.0", "Apache-2.0", None
    ]
    assert all(r.score is None or r.score <= 1 for r in found)
    wrapped = next(r for r in found if r.path == "w/x.py")
    assert WRAPPED[wrapped.start:wrapped.end].startswith("# Licensed") and wrapped.score > 0.9


def test_copies_score_like_one(spark):
    """Repeated rows, and other texts under the same path, don't change a score."""
    weak = "A permission may be given by the domain under some license of the MIT kind or another."
    one = spark.createDataFrame([("x/a", weak), ("y/b", APACHE)], "path string, text string")
    again = spark.createDataFrame([("x/a", weak)] * 5 + [("x/a", PROSE), ("y/b", APACHE)], "path string, text string")
    few = {(r.path, r.part): r.licence for r in licences.matches(one).collect()}
    many = [((r.path, r.part), r.licence) for r in licences.matches(again).collect()]
    assert dict(many) == few and len(many) == len(few)
    assert {r.licence for r in licences.scan(again).where("path = 'x/a'").collect()} == {None}


def test_null_ids_in_the_query(spark, odd_docs, tmp_path):
    for table in (odd_docs, odd_docs.limit(0)):
        table.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        found = op4_licences(spark, str(tmp_path)).collect()
        assert len(found) == table.count()
        assert sorted(r.doc_id or 0 for r in found) == sorted(r.doc_id or 0 for r in table.collect())


def test_lines_of_a_table(spark):
    found = op4_licences(spark, "/root/testdata/sf0.1").where("licence IS NOT NULL").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").toPandas().set_index("doc_id")
    own = found[found.inherited_from.isna()].set_index("doc_id")
    for phrase, name in (
        ("under the MIT License", "MIT"), ("Apache License, Version 2.0", "Apache-2.0"),
        ("GNU General Public License, version 3", "GPL-3.0"), ("under CC BY-NC 4.0", "CC-BY-NC-4.0"),
    ):
        has = docs.index[docs.text.str.contains(phrase, regex=False)]
        assert len(has) and (own.loc[has].licence == name).all()
    assert len(own) == docs.text.str.contains("icensed under|under the MIT").sum()


def test_odd_rows(odd_docs, no_docs):
    assert licences.scan(odd_docs).count() == odd_docs.count()
    assert licences.scan(no_docs, path_col="source").count() == 0
