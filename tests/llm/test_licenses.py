import math
from collections import Counter
from itertools import combinations

import pytest
from tenderlake.llm import licenses

HEADER = licenses.TEMPLATES["Apache-2.0"][2]
FILES = [
    ("LICENSE", licenses.TEMPLATES["MIT"][2]),
    ("src/a.py", "import os\nprint(1)"),
    ("src/b.py", "# " + HEADER.replace(". ", ".\n# ") + "\nimport sys\n" + "x = 1\n" * 50),
    ("src/deep/er/c.py", "nothing to see in here"),
    ("vendor/COPYING", licenses.TEMPLATES["GPL-3.0"][2]),
    ("vendor/lib/d.c", "int main() { return 0; }"),
    ("vendor/lib/e.c", "text before\nReleased under the MIT License.\ntext after it"),
    ("vendored/f.c", "not below vendor"),
    ("g.txt", "This one is licensed to fly under the radar of all rights"),
    (None, "All rights reserved."),
    ("h.txt", None),
    ("h.txt", None),
]


def frame(spark):
    return spark.createDataFrame([(p, i, t or "") for i, (p, t) in enumerate(FILES)], "path string, id long, text string")


def dense_scan(text, weights, foreign, least):
    """All passages against all templates with dense vectors, then every set of passages that lie apart."""
    units, ranges = licenses.passages(text.split("\n"))
    found = []
    for first, last in ranges:
        held = Counter(licenses.terms("\n".join(part for _, part in units[first : last + 1])))
        norm = math.sqrt(sum((n * weights.get(t, foreign)) ** 2 for t, n in held.items()))
        options = []
        for name, texts in licenses.TEMPLATES.items():
            needed, banned = licenses.VARIANTS.get(name, ((), ()))
            if not all(set(held) & group for group in needed) or set(held) & set(banned):
                continue
            for template in texts:
                other = Counter(licenses.terms(template))
                size = math.sqrt(sum((n * weights[t]) ** 2 for t, n in other.items()))
                dot = sum(n * held[t] * weights[t] ** 2 for t, n in other.items()) / size
                if norm and dot / norm >= least:
                    options.append((dot / norm, dot**3 / norm, name))
        if options:
            found.append((first, last, *max(options)))
    assert len(found) < 16
    sets = [c for k in range(len(found) + 1) for c in combinations(found, k) if all(a[1] < b[0] or b[1] < a[0] for a, b in combinations(c, 2))]
    return max(sets, key=lambda c: (round(sum(f[3] for f in c), 6), -len(c)))


def test_scan_against_dense_vectors(spark):
    files = frame(spark)
    frequency, lines = licenses.line_frequency(files)
    texts = [t or "" for _, t in FILES]
    held = [set(licenses.terms(line)) for t in texts for line in t.split("\n") if licenses.terms(line)]
    assert lines == len(held)
    assert frequency == Counter(t for h in held for t in h)  # of so few lines every term is in more than a thousandth
    index = licenses.build_index(frequency, lines)
    for row in licenses.scan_files(files).collect():
        chosen = dense_scan(texts[row.id], index.weight, index.foreign, licenses.LEAST)
        assert set(row.licences) == {f[4] for f in chosen}
        if chosen:
            best = max(chosen, key=lambda f: (round(f[3], 6), -f[0]))
            assert row.own == best[4] and abs(row.score - best[2]) < 1e-9
        else:
            assert row.own is None and row.score == 0


def test_rare_foreign_terms_stay_with_the_executors(spark):
    text = "\n".join(["often held words"] * 2000 + ["seldom", "All rights reserved."])
    frequency, lines = licenses.line_frequency(spark.createDataFrame([("a", 1, text)], "path string, id long, text string"))
    assert lines == 2002 and frequency == {"often": 2000, "held": 2000, "words": 2000, "all": 1, "rights": 1, "reserved": 1}


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_templates_name_their_licence(name):
    index = licenses.build_index({}, 0)
    for text in licenses.TEMPLATES[name]:
        assert [f[0] for f in licenses.scan_text(text, index)][:1] == [name]


def test_neighbours_are_told_apart():
    index = licenses.build_index({"the": 900, "of": 800, "and": 700}, 1000)
    names = lambda text: [f[0] for f in licenses.scan_text(text, index)]
    assert names("SPDX-License-Identifier: GPL-2.0-only") == ["GPL-2.0"]
    assert names("SPDX-License-Identifier: Zlib") == []
    assert names("Released under the Zlib License.") == []
    assert names("Licensed under CC BY-SA 4.0.") == []
    assert names("Copyright (c) 2020 by Foo Bar Inc and its contributors. All rights reserved.") == ["Proprietary"]
    assert sorted(names("Released under the MIT License.\nand\nLicensed under the Apache License, Version 2.0.")) == ["Apache-2.0", "MIT"]
    bsd = "Copyright (c) 2020, Foo\nAll rights reserved.\n\n" + licenses.TEMPLATES["BSD-2-Clause"][-1].replace(". ", ".\n")
    assert names(bsd) == ["BSD-2-Clause"]
    assert names("x\n" * 20_000 + licenses.TEMPLATES["ISC"][-1] + "\ny" * 20_000) == ["ISC"]


def test_a_notice_is_no_licence_file(spark):
    files = [("a/1", "Released under the MIT License."), ("a/2", "x"), ("b/COPYING", "Released under the MIT License."), ("b/2", "x")]
    files += [("c/1", licenses.TEMPLATES["ISC"][-1]), ("c/2", "x")]
    scanned = licenses.scan_files(spark.createDataFrame([(p, i, t) for i, (p, t) in enumerate(files)], "path string, id long, text string"))
    found = {r.path: r.licence for r in licenses.inherit(scanned).collect()}
    assert found == {"a/1": "MIT", "a/2": None, "b/COPYING": "MIT", "b/2": "MIT", "c/1": "ISC", "c/2": "ISC"}


def test_equal_scores_go_to_the_first_name():
    index = licenses.build_index({}, 0, {"B": ["some words here"], "A": ["some words here"]})
    assert [f[0] for f in licenses.scan_text("some words here", index)] == ["A"]


def test_nearest_directory_wins(spark):
    found = {r.path: (r.licence, r.licence_dir) for r in licenses.inherit(licenses.scan_files(frame(spark))).collect()}
    assert found == {
        "LICENSE": ("MIT", None),
        "src/a.py": ("MIT", ""),
        "src/b.py": ("Apache-2.0", None),
        "src/deep/er/c.py": ("MIT", ""),
        "vendor/COPYING": ("GPL-3.0", None),
        "vendor/lib/d.c": ("GPL-3.0", "vendor"),
        "vendor/lib/e.c": ("MIT", None),
        "vendored/f.c": ("MIT", ""),
        "g.txt": ("MIT", ""),
        None: ("Proprietary", None),
        "h.txt": ("MIT", ""),
    }
    assert licenses.inherit(licenses.scan_files(frame(spark))).count() == len(FILES)


def test_anchors_lose_no_match():
    index = licenses.build_index({"the": 900, "of": 800, "license": 3}, 1000)
    for texts in licenses.TEMPLATES.values():
        for text in texts:
            assert index.best(Counter(t for t in licenses.terms(text) if t not in index.anchors))[0] < licenses.LEAST


def test_documents_and_empty_table(corpus, no_docs, odd_docs):
    docs, rows = corpus
    assert licenses.inherit(licenses.scan_files(licenses.documents_as_files(docs))).count() == len(rows)
    assert licenses.inherit(licenses.scan_files(licenses.documents_as_files(no_docs))).count() == 0
    assert licenses.inherit(licenses.scan_files(licenses.documents_as_files(odd_docs))).count() == 6


def test_a_notice_scores_the_same_in_a_larger_corpus():
    notice = "Copyright 2020 Foo. All rights reserved."
    share = {"all": 0.02, "rights": 0.004, "reserved": 0.004}
    found = []
    for lines in (5_000, 500_000, 150_000_000):
        index = licenses.build_index({t: round(s * lines) for t, s in share.items()}, lines)
        found.append(licenses.scan_text(notice, index)[0][:2])
    assert {name for name, _ in found} == {found[0][0]} and max(s for _, s in found) - min(s for _, s in found) < 1e-9
