"""Licence scans: sparse TF-IDF cosine to templates, then the nearest ancestor directory's licence.

A file declares a licence by a header, a line of its text, or by being a licence file, a file whose
whole text is like a template. Weights are term frequency times an idf counted over all files for
the terms of the templates; other terms count as ones of a single file. Only lines that share a
naming term with a template can reach the bar; the cosine of those is a join of sparse vectors.
Files without a header of their own take the licence of the nearest directory above them that has
a licence file, by joins on the paths of the directories.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import plain_strings, store, text_slices, words_of

# SPDX identifiers with the phrases that state the licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
     "use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "This work is subject to the terms of the Mozilla Public License, version 2.0."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# The texts of short licence files, and the heads of long ones.
MIT_BODY = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files (the \"Software\"), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the "
    "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
    "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
ISC_BODY = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
    "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
    "in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH "
    "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
    "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
WHOLE_TEXTS = (
    ("MIT", MIT_BODY), ("MIT", "MIT License " + MIT_BODY), ("ISC", ISC_BODY),
    ("ISC", "ISC License " + ISC_BODY),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
)
# Endings that a tag may give to an identifier.
TAG = "SPDX-License-Identifier:"
TAG_ENDINGS = ("", "-only", "-or-later")
TEMPLATES += WHOLE_TEXTS + tuple(
    (name, f"{TAG} {name}{ending}") for name in sorted({name for name, _ in TEMPLATES})
    for ending in (TAG_ENDINGS if "GPL" in name else TAG_ENDINGS[:1])
)
# Every template has one of these.
NAMING = (
    "spdx-license-identifier", "license", "licensed", "licence", "licenced", "permission", "domain",
)
TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
HEADER_BAR, FILE_BAR = 0.75, 0.5
# How notices begin that are often wrapped, over at most so many lines.
WRAPS = (
    "licensed under", "permission", "this work is", "this is free", "released under",
    "general public license", "apache license", "mozilla public license", "mit license", "isc license",
)
WRAPPED_LINES = 24
LICENCE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense)(\.[a-z]+)?$"


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


def _of_template() -> list[str]:
    return sorted({t for _, text in TEMPLATES for t in terms(text)})


def file_counts(files: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of files, and in how many each template term occurs: a bounded table of counts."""
    wanted = pa.array(_of_template())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            owner, place, distinct = words_of(plain_strings(part.column(1)))
            # A word counts by its terms, so "License," is "license".
            of_word = {
                i: [t for t in set(terms(w)) if t in known]
                for i, w in enumerate(distinct.to_pylist()) if hint.search(w)
            }
            counts = Counter({"": part.num_rows})
            for doc_terms in {
                (int(d), t) for d, i in zip(owner[mask(place, of_word)], place[mask(place, of_word)])
                for t in of_word[int(i)]
            }:
                counts[doc_terms[1]] += 1
            yield pa.record_batch(
                [pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())],
                ["term", "n"],
            )

    known = set(wanted.to_pylist())
    hint = re.compile("|".join(sorted((re.escape(t) for t in known), key=len, reverse=True)))

    def mask(place, of_word):
        chosen = np.zeros(int(place.max(initial=-1)) + 1, bool)
        chosen[[i for i, t in of_word.items() if t]] = True
        return chosen[place] if len(place) else np.zeros(0, bool)

    rows = files.select("path", "text").mapInArrow(run, "term string, n bigint").groupBy("term")
    counts = {r.term: r.n for r in rows.agg(F.sum("n").alias("n")).collect()}
    return counts.pop("", 0), counts


def candidate_parts(files: DataFrame) -> DataFrame:
    """(path, text_no, part, start, end, term, tf) of parts of files that have a naming term.

    `part` is the number of the line, -1 for the whole file; a notice that is wrapped over several
    lines has the number of its first. `text_no` tells texts of one path apart.
    """
    naming = "(?i)" + "|".join(NAMING)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = plain_strings(part.column(1))
            hits = pc.match_substring_regex(texts, naming)
            rows = []
            for path, text in zip(
                part.column(0).filter(hits).to_pylist(), texts.filter(hits).to_pylist()
            ):
                pieces = [(-1, 0, len(text), text)]
                lines = list(re.finditer("[^\n]+", text))
                pieces += [(k, m.start(), m.end(), m.group()) for k, m in enumerate(lines)]
                # A notice that is wrapped: a line with those after it, as many as still help.
                for k in range(len(lines)):
                    if wrapped.search(lines[k].group()):
                        for last in range(k + 1, min(k + WRAPPED_LINES, len(lines))):
                            start, end = lines[k].start(), lines[last].end()
                            pieces.append((k, start, end, text[start:end]))
                text_no = xxhash.xxh64_intdigest(text) - (1 << 63)
                for number, start, end, body in pieces:
                    tf = Counter(terms(body))
                    if any(t in tf for t in NAMING):
                        rows += [(path, text_no, number, start, end, t, n) for t, n in tf.items()]
            columns = list(zip(*rows)) or [[]] * 7
            types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["path", "text_no", "part", "start", "end", "term", "tf"],
            )

    wrapped = re.compile("(?i)" + "|".join(WRAPS))
    # Rows that repeat, path and text, are one.
    return files.select("path", "text").mapInArrow(
        run, "path string, text_no bigint, part int, start bigint, end bigint, term string, tf int"
    ).distinct()


def matches(files: DataFrame) -> DataFrame:
    """(path, part, start, end, licence, score): each candidate's best template, by cosine.

    Ties go to the first licence by name.
    """
    n, counts = file_counts(files)
    idf = {t: float(np.log((n + 1) / (counts.get(t, 0) + 1)) + 1) for t in _of_template()}
    rare = float(np.log(n + 1) + 1)
    rows = []
    for number, (licence, text) in enumerate(TEMPLATES):
        weights = {t: k * idf[t] for t, k in Counter(terms(text)).items()}
        norm = sum(w * w for w in weights.values()) ** 0.5
        rows += [(number, licence, t, w / norm) for t, w in weights.items()]
    spark = files.sparkSession
    # One row per template and term: fixed by the code.
    templates = F.broadcast(spark.createDataFrame(
        rows, "template int, licence string, term string, weight double"
    ))
    idfs = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))
    parts = store(candidate_parts(files), "licence-parts")
    weighted = parts.join(idfs, "term", "left").withColumn(
        "w", F.col("tf") * F.coalesce("idf", F.lit(rare))
    )
    key = ["path", "text_no", "part", "start", "end"]
    norms = weighted.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighted.join(templates, "term").groupBy(*key, "template", "licence").agg(
        F.sum(F.col("w") * F.col("weight")).alias("dot")
    )
    best = dots.groupBy(*key).agg(F.min(F.struct((-F.col("dot")).alias("d"), "licence")).alias("b"))
    same = [best[c].eqNullSafe(norms[c]) for c in key]
    return best.join(norms, same).select(
        *[best[c] for c in key], F.col("b.licence").alias("licence"),
        F.least(F.lit(1.0), -F.col("b.d") / F.col("norm")).alias("score"),
    )


def directories(path: Column) -> Column:
    """All directories above a path, nearest first, the top one being empty."""
    steps = F.split(path, "/")
    return F.transform(
        F.sequence(F.size(steps) - 1, F.lit(0), F.lit(-1)),
        lambda k: F.concat_ws("/", F.slice(steps, F.lit(1), k)),
    )


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, licence, score, start, end, inherited_from) of every row.

    A header counts from `HEADER_BAR`, a licence file from `FILE_BAR`, or from the header's bar if
    its name says that it is one. The best header of a file is taken, of equals the first in the
    text. `inherited_from` is the directory that a licence comes from, null for a file's own.
    Null and empty texts declare nothing; a null path inherits nothing; rows that share a path
    share what they declare. Several licence files in a directory: the first licence by name.
    """
    all_files = files.select(
        F.col(path_col).cast("string").alias("path"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    found = store(matches(all_files), "licence-matches")
    headers = found.where((F.col("part") >= 0) & (F.col("score") >= HEADER_BAR)).groupBy("path").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "start", "end", "licence")).alias("own")
    )
    named = F.col("path").rlike(LICENCE_NAME)
    licence_files = found.where(
        ((F.col("part") < 0) & (F.col("score") >= FILE_BAR))
        | (named & (F.col("part") >= 0) & (F.col("score") >= HEADER_BAR))
    )
    by_directory = licence_files.where("path IS NOT NULL").select(
        directories(F.col("path"))[0].alias("directory"), "licence"
    ).groupBy("directory").agg(F.min("licence").alias("given"))
    paths = all_files.select("path").distinct()
    above = paths.where("path IS NOT NULL").select(
        "path", F.posexplode(directories(F.col("path"))).alias("steps_up", "directory")
    )
    nearest = above.join(by_directory, "directory").groupBy("path").agg(
        F.min(F.struct("steps_up", "directory", "given")).alias("from")
    )
    out = all_files.select("path").join(
        headers.withColumnRenamed("path", "own_path"),
        F.col("path").eqNullSafe(F.col("own_path")), "left",
    ).join(nearest, "path", "left")
    own = F.col("own").isNotNull()
    return out.select(
        "path", F.coalesce("own.licence", "from.given").alias("licence"),
        (-F.col("own.s")).alias("score"), F.col("own.start").alias("start"),
        F.col("own.end").alias("end"),
        F.when(~own, F.col("from.directory")).alias("inherited_from"),
    )
