"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import id_key, id_out, map_batches, materialize, table, text_of

_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_GNU = (
    "you can redistribute it and/or modify it under the terms of the GNU {name} General Public License as published by the Free Software Foundation, "
    "either version {version} of the License, or (at your option) any later version."
)
_GNU_REST = (
    " This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
    "or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} General Public License for more details."
)


def _gnu(spdx: str, name: str, version: str, what: str) -> list[str]:
    """Notice, header, whole header and identifiers of a licence of the GNU family."""
    header = f"This {what} is free software: " + _GNU.format(name=name, version=version).replace("  ", " ")
    return [
        f"This work is licensed under the GNU {name} General Public License, version {version}.".replace("  ", " "),
        header,
        header + _GNU_REST.format(name=name, what=what).replace("  ", " "),
        *(f"SPDX-License-Identifier: {spdx}{end}" for end in ("", "-only", "-or-later")),
    ]


#: Notices, standard headers and whole short licences as their publishers give them.
TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": _gnu("AGPL-3.0", "Affero", "3", "program"),
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": ["SPDX-License-Identifier: BSD-2-Clause", _BSD_2 + _AS_IS],
    "BSD-3-Clause": ["Released under the BSD License.", "SPDX-License-Identifier: BSD-3-Clause", _BSD_2 + _BSD_3 + _AS_IS],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "GPL-2.0": _gnu("GPL-2.0", "", "2", "program"),
    "GPL-3.0": _gnu("GPL-3.0", "", "3", "program"),
    "ISC": [
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "LGPL-2.1": _gnu("LGPL-2.1", "Lesser", "2.1", "library"),
    "LGPL-3.0": _gnu("LGPL-3.0", "Lesser", "3", "library"),
    "MIT": [
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        _MIT_GRANT,
        _MIT_GRANT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "MPL-2.0": [
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Proprietary": ["All rights reserved."],
    "Unlicense": [
        "SPDX-License-Identifier: Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}
#: What tells neighbours apart: a passage needs a term of every group and none of the banned ones.
VARIANTS: dict[str, tuple[tuple[frozenset[str], ...], frozenset[str]]] = {
    name: (tuple(frozenset(group.split()) for group in needed), frozenset(banned.split()))
    for name, (needed, banned) in {
        "AGPL-3.0": (["affero agpl agpl-3.0 agpl-3.0-only agpl-3.0-or-later", "3 3.0 v3 agpl-3.0 agpl-3.0-only agpl-3.0-or-later"], ""),
        "Apache-2.0": (["apache apache-2.0"], "1.0 1.1"),
        "BSD-2-Clause": (["redistributions bsd-2-clause"], "endorse bsd-3-clause bsd-4-clause"),
        "BSD-3-Clause": (["bsd bsd-3-clause endorse"], "bsd-2-clause bsd-4-clause"),
        "CC-BY-4.0": (["cc creative", "4.0"], "by-nc by-sa by-nd by-nc-sa by-nc-nd noncommercial attribution-noncommercial attribution-sharealike"),
        "CC-BY-NC-4.0": (["by-nc noncommercial attribution-noncommercial", "4.0"], "by-nc-sa by-nc-nd sharealike noderivatives"),
        "GPL-2.0": (["general gpl gpl-2.0 gpl-2.0-only gpl-2.0-or-later", "2 2.0 v2 gpl-2.0 gpl-2.0-only gpl-2.0-or-later"], "lesser library affero"),
        "GPL-3.0": (["general gpl gpl-3.0 gpl-3.0-only gpl-3.0-or-later", "3 3.0 v3 gpl-3.0 gpl-3.0-only gpl-3.0-or-later"], "lesser library affero"),
        "ISC": (["isc fee"], ""),
        "LGPL-2.1": (["lesser library lgpl lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later", "2.1 v2.1 lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later"], ""),
        "LGPL-3.0": (["lesser lgpl lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later", "3 3.0 v3 lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later"], ""),
        "MIT": (["mit sublicense"], ""),
        "MPL-2.0": (["mozilla mpl mpl-2.0", "2.0 mpl-2.0"], "1.1"),
        "Unlicense": (["unlicense unencumbered"], ""),
    }.items()
}
#: Cosine from which a passage counts as a licence, and a whole file as a licence file.
LEAST = 0.6
#: Terms weigh as in a table of so many lines with the same shares, so a notice scores the same in one of any size.
REFERENCE_LINES = 3_000
#: Terms held by a smaller share of lines weigh, outside the templates, as ones that no line holds. Their
#: number is at most the mean number of terms in a line divided by this share, however large the corpus.
FREQUENT = 1 / 1_000
#: A whole file is a licence file if its template has so many terms, or if its name says so.
TEXT_TERMS = 20
LICENCE_NAME = r"(?i)(^|/)(un)?(licen[cs]e|copying)([.-][^/]*)?$"
#: Directories that hold more than this share of all files, fewer than its inverse, are looked up by broadcast.
HOT_DIR = 1 / 1_000
TERM = re.compile(r"\w+(?:[.-]\w+)*")
COMMENT = re.compile(r"\s*(?:#|//|/?\*|--|;|%|<!--)")
SENTENCE_END = re.compile(r"(?<=[.!?;])\s+")


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


@dataclass
class Index:
    """Templates as sparse unit vectors, by term. A rare term outside them weighs as one that no line has."""

    weight: dict[str, float]
    foreign: float
    postings: dict[str, list[tuple[int, float]]]
    names: list[str]
    sizes: list[int]
    anchors: frozenset[str]
    least: float

    def best(self, counts: Counter[str]) -> tuple[float, float, int | None]:
        """Largest cosine, what it explains (matched weight squared, times the cosine) and its template.

        Of equals it is the first by name. Templates below ``least``, or whose variant terms do
        not agree with the passage, are passed over; without a match there is no template.
        """
        dots: dict[int, float] = {}
        norm = 0.0
        for term, n in sorted(counts.items()):
            w = n * self.weight.get(term, self.foreign)
            norm += w * w
            for template, share in self.postings.get(term, ()):
                dots[template] = dots.get(template, 0.0) + w * share
        near = [(dot, -t) for t, dot in dots.items() if dot >= self.least * norm**0.5]
        for dot, minus in sorted(near, reverse=True):
            needed, banned = VARIANTS.get(self.names[-minus], ((), frozenset()))
            if banned.isdisjoint(counts) and not any(group.isdisjoint(counts) for group in needed):
                return dot / norm**0.5, dot**3 / norm**0.5, -minus
        return 0.0, 0.0, None


def build_index(frequency: dict[str, int], lines: int, templates: dict[str, list[str]] = TEMPLATES, least: float = LEAST) -> Index:
    """``frequency``: lines of the corpus that hold a term, for the terms of the templates and all frequent ones.

    The most frequent terms of a template whose weights alone stay below ``least`` of its length
    cannot make a match; a passage must hold one of the others, the anchors.
    """
    idf = lambda n: float(np.log((1 + REFERENCE_LINES) / (1 + REFERENCE_LINES * n / max(1, lines))) + 1)
    pairs = sorted((name, text) for name, texts in templates.items() for text in texts)
    vectors = [Counter(terms(text)) for _, text in pairs]
    weight = {t: idf(frequency.get(t, 0)) for t in {*frequency, *(t for v in vectors for t in v)}}
    postings: dict[str, list[tuple[int, float]]] = {}
    anchors: set[str] = set()
    for at, vector in enumerate(vectors):
        raw = {t: n * weight[t] for t, n in vector.items()}
        norm = sum(w * w for w in raw.values()) ** 0.5
        light = 0.0
        for t, w in sorted(raw.items(), key=lambda x: (weight[x[0]], x)):
            postings.setdefault(t, []).append((at, w / norm))
            light += (w / norm) ** 2
            if light**0.5 >= least * (1 - 1e-9):
                anchors.add(t)
    return Index(weight, idf(0), postings, [name for name, _ in pairs], [v.total() for v in vectors], frozenset(anchors), least)


def line_frequency(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> tuple[dict[str, int], int]:
    """In how many lines each term of the templates and each frequent term stands, and the number of lines with a term.

    All terms of all lines are counted, per batch first; only the said ones reach the driver.
    """

    def step(batch: pa.RecordBatch) -> dict:
        found: Counter[str] = Counter()
        for text in batch.column("text").to_pylist():
            for line in text.lower().split("\n"):
                words = TERM.findall(line)
                if words:
                    found[""] += 1
                    found.update(set(words))
        return {"term": list(found), "n": list(found.values())}

    counted = materialize(map_batches(files.select("text"), "term string, n long", step).groupBy("term").agg(F.sum("n").alias("n")))
    lines = counted.filter("term = ''").agg(F.sum("n")).first()[0] or 0
    vocabulary = sorted({t for texts in templates.values() for text in texts for t in terms(text)})
    wanted = counted.filter((F.col("term") != "") & ((F.col("n") >= lines * FREQUENT) | F.col("term").isin(vocabulary)))
    return {r["term"]: r["n"] for r in wanted.collect()}, lines


def passages(lines: list[str]) -> tuple[list[tuple[int, str]], list[tuple[int, int]]]:
    """((line, sentence) in order, (first, last sentence) of what is held against the templates).

    That is the whole, each paragraph, comment block, line and sentence: any two of them lie
    apart or one holds the other.
    """
    units: list[tuple[int, str]] = []
    begin = []
    for at, line in enumerate(lines):
        begin.append(len(units))
        units += [(at, part) for part in SENTENCE_END.split(line)]
    begin.append(len(units))
    blocks = {(0, len(lines) - 1)} | {(i, i) for i, line in enumerate(lines) if line.strip()}
    for inside in (lambda line: bool(line.strip()), lambda line: bool(COMMENT.match(line))):
        start = None
        for at, line in enumerate([*lines, None]):
            within = line is not None and inside(line)
            if within and start is None:
                start = at
            elif not within and start is not None:
                blocks.add((start, at - 1))
                start = None
    ranges = {(begin[a], begin[b + 1] - 1) for a, b in blocks} | {(i, i) for i, (_, part) in enumerate(units) if part.strip()}
    return units, sorted(ranges)


def scan_text(text: str, index: Index) -> list[tuple[str, float, int, int, bool, int]]:
    """(licence, cosine, first line, last line, whether it holds all words, terms of the template), best first.

    Of all passages that match those are taken that lie apart and together explain
    the most; the best one explains most by itself, the first among equals.
    """
    lines = text.split("\n")
    counts = {i: Counter(words) for i, line in enumerate(lines) if (words := terms(line))}
    if all(index.anchors.isdisjoint(c) for c in counts.values()):
        return []
    units, ranges = passages(lines)
    held = [Counter(terms(part)) for _, part in units]
    hot = [i for i, c in enumerate(held) if not index.anchors.isdisjoint(c)]
    found = []
    for first, last in ranges:
        at = bisect_left(hot, first)
        if at < len(hot) and hot[at] <= last:
            inside: Counter[str] = Counter()
            for i in range(first, last + 1):
                inside.update(held[i])
            score, explained, template = index.best(inside)
            if template is not None:
                found.append((first, last, score, explained, template))
    chosen = sorted(_apart(found), key=lambda f: (-round(f[3], 9), f[0]))
    worded = [i for i, c in enumerate(held) if c]
    return [(index.names[t], score, units[a][0], units[b][0], a <= worded[0] and b >= worded[-1], index.sizes[t]) for a, b, score, _, t in chosen]


def _apart(found: list[tuple[int, int, float, float, int]]) -> list[tuple[int, int, float, float, int]]:
    """The passages that lie apart and explain the most together; one passage rather than several that explain as much."""
    ordered = sorted(found, key=lambda f: (f[1], f[0]))
    ends = [f[1] for f in ordered]
    best: list[float] = [0.0]
    for first, _, _, explained, _ in ordered:
        best.append(max(best[-1], best[bisect_left(ends, first, 0, len(best) - 1)] + explained))
    chosen, at = [], len(ordered)
    while at:
        first, _, _, explained, _ = ordered[at - 1]
        before = bisect_left(ends, first, 0, at - 1)
        if best[before] + explained >= best[at - 1]:
            chosen.append(ordered[at - 1])
            at = before
        else:
            at -= 1
    return chosen


def scan_files(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(path, id, own, score, first_line, last_line, licences, licence_file) of every file (path, id, text).

    ``own`` is the licence of the best passage, ``licences`` names those of all passages in the
    order of their lines, each once; a file without one has nulls and a score of 0. An empty text
    has none; texts are read whole; each row is scanned by itself, so repeated rows get equal
    results; an empty table gives no rows.
    """
    index = build_index(*line_frequency(files, templates), templates, least)
    named = re.compile(LICENCE_NAME)

    def step(batch: pa.RecordBatch) -> dict:
        paths = batch.column("path").to_pylist()
        found = [scan_text(t, index) for t in batch.column("text").to_pylist()]
        tops = [f[0] if f else (None, 0.0, None, None, False, 0) for f in found]
        own, score, first, last, whole, size = map(list, zip(*tops, strict=True))
        return {
            "path": batch.column("path"), "id": batch.column("id"), "own": own, "score": score, "first_line": first, "last_line": last,
            "licences": [list(dict.fromkeys(f[0] for f in sorted(fs, key=lambda f: (f[2], f[3])))) for fs in found],
            "licence_file": [w and (n >= TEXT_TERMS or bool(named.search(p or ""))) for w, n, p in zip(whole, size, paths, strict=True)],
        }

    schema = "path string, id long, own string, score double, first_line int, last_line int, licences array<string>, licence_file boolean"
    return map_batches(files, schema, step)


def inherit(scanned: DataFrame) -> DataFrame:
    """``scanned`` with ``licence`` and ``licence_dir``: a file's own, else that of the nearest directory above it.

    A directory's licence is that of its licence file with the highest score, the first path
    among equals. Each directory, not each file, is joined with all its ancestors by equal
    paths; files then look up their directory, those of a hot directory on the map side. Files
    without a path inherit nothing; repeated rows stay; an empty table gives no rows.
    """
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    known = materialize(scanned.withColumn("dir", F.when(F.col("path").isNotNull(), folder)))
    best = known.filter("licence_file AND dir IS NOT NULL").groupBy("dir").agg(F.min_by("own", F.struct(-F.col("score"), "path", "id")).alias("licence"))
    names = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(names)), lambda n: F.array_join(F.slice(names, F.lit(1), n), "/"))
    sizes = materialize(known.filter("dir IS NOT NULL").groupBy("dir").agg(F.count(F.lit(1)).alias("n")))
    climbs = sizes.select("dir", F.explode(F.array_distinct(above)).alias("ancestor"))
    nearest = materialize(
        climbs.join(best.select(F.col("dir").alias("ancestor"), "licence"), "ancestor")
        .groupBy("dir")
        .agg(F.max_by(F.struct("licence", "ancestor"), F.length("ancestor")).alias("near"))
    )
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = materialize(sizes.filter(F.col("n") > F.lit(total * HOT_DIR)).join(nearest, "dir", "left").select("dir", "near"))
    looked = (
        known.join(F.broadcast(hot), "dir")
        .unionByName(known.filter("dir IS NOT NULL").join(F.broadcast(hot.select("dir")), "dir", "left_anti").join(nearest, "dir", "left"))
        .unionByName(known.filter("dir IS NULL").withColumn("near", F.lit(None).cast(nearest.schema["near"].dataType)))
    )
    return looked.select(
        *scanned.columns,
        F.coalesce("own", "near.licence").alias("licence"),
        F.when(F.col("own").isNull(), F.col("near.ancestor")).alias("licence_dir"),
    )


def documents_as_files(docs: DataFrame) -> DataFrame:
    """(path, id, text): each document as the file ``source/lang/doc_id``; null parts are empty names."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(F.concat_ws("/", part("source"), part("lang"), part("doc_id")).alias("path"), id_key().alias("id"), text_of().alias("text"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its best licence passage with cosine and lines, all its licences, and the licence that holds for it.

    A null text is empty and has none of its own; null ids, sources and languages are empty names
    in the path. Repeated rows are files of their own; equal scores go to the first name.
    """
    found = inherit(scan_files(documents_as_files(table(spark, sf_dir, "documents"))))
    listed = F.array_join("licences", ";").alias("licences")
    return found.select(
        id_out("id").alias("doc_id"), "path", "own", F.round("score", 6).alias("score"), "first_line", "last_line", listed, "licence_file", "licence", "licence_dir"
    )
