"""Licences against a plain computation, and inheritance along paths."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from faultline.llm import licenses
from tests.helpers import plan
from tests.llm.fixtures import LONG

TEMPLATES = {"A": ["Released under the Alpha License."], "B": ["Beta License, version 2.0", "Permission of Beta"]}
FILES = [
    (1, "a/LICENSE", "Released under the Alpha License."),
    (2, "a/b/c.py", "hello"),
    (3, "z.py", "some code\nreleased under the alpha license\r\nmore code and words that are not there"),
    (4, None, None),
    (5, "a/b/COPYING", "Beta License, version 2.0"),
    (6, "a/b/d/e.py", LONG),
    (7, "a/b/d/f.py", LONG + "\nBeta License, version 2.0!"),
    (None, "a/q", None),
    (8, "a/q", ""),
    (8, "a/q", ""),
    (9, "x/y.py", "the license of the version"),
]


def files(spark, rows=None):
    wide = [(d, p, t, "x", 1.0, "y") for d, p, t in (FILES if rows is None else rows)]
    return spark.createDataFrame(wide, "doc_id long, path string, text string, license string, score double, directory string")


def cut(text):
    return licenses.template_words(text or "")


def cosine(left, right, df, n):
    """TF-IDF cosine of two lists of terms, with true counts."""
    a, b = Counter(left), Counter(right)
    idf = lambda t: math.log((1 + n) / (1 + df[t])) + 1
    length = lambda c: math.sqrt(sum((c[t] * idf(t)) ** 2 for t in c))
    return sum(a[t] * b[t] * idf(t) ** 2 for t in a) / length(a) / length(b) if a and b else 0.0


def brute_force(rows, templates, bodies, threshold, whole):
    """By (doc_id, path, text) the best header and whole match: every line, every window laid by a heavy term, the whole text."""
    texts = [t or "" for _, _, t in rows]
    df, n = Counter(t for x in texts for t in set(cut(x))), len(rows)
    out = {}
    for doc, path, text in rows:
        terms = cut(text)
        parts = [cut(x) for x in re.split("\r\n|[\n\r]", text or "")]
        header, entire = (0.0, ""), (0.0, "")
        for name, sides in templates.items():
            for side in map(cut, sides):
                heavy = licenses.heavy_terms({t: (c * (math.log((1 + n) / (1 + df[t])) + 1)) ** 2 for t, c in Counter(side).items()}, threshold)
                fits = lambda i: any(t in heavy and 0 <= i + j < len(terms) and terms[i + j] == t for j, t in enumerate(side))
                laid = [terms[max(i, 0) : i + len(side)] for i in range(-len(side) + 1, len(terms)) if fits(i)]
                score = round(max((cosine(x, side, df, n) for x in parts + laid), default=0.0), 6)
                header = min(header, (-score, name))
        for group in (templates, bodies):
            for name, sides in group.items():
                for side in map(cut, sides):
                    entire = min(entire, (-round(cosine(terms, side, df, n), 6), name))
        out[doc, path, text] = (
            (-header[0], header[1]) if -header[0] >= threshold else None,
            (-entire[0], entire[1]) if -entire[0] >= whole else None,
        )
    return out


def test_scan(spark):
    found = {(r["doc_id"], r["path"]): r for r in licenses.scan(files(spark), TEMPLATES).collect()}
    assert licenses.scan(files(spark), TEMPLATES).count() == len(FILES)
    got = {k: (r["license"], r["origin"], r["license_path"]) for k, r in found.items()}
    assert got == {
        (1, "a/LICENSE"): ("A", "file", "a/LICENSE"),
        (2, "a/b/c.py"): ("B", "inherited", "a/b/COPYING"),
        (3, "z.py"): ("A", "header", "z.py"),
        (4, ""): (None, None, None),
        (5, "a/b/COPYING"): ("B", "file", "a/b/COPYING"),
        (6, "a/b/d/e.py"): ("B", "inherited", "a/b/COPYING"),
        (7, "a/b/d/f.py"): ("B", "header", "a/b/d/f.py"),
        (None, "a/q"): ("A", "inherited", "a/LICENSE"),
        (8, "a/q"): ("A", "inherited", "a/LICENSE"),
        (9, "x/y.py"): (None, None, None),
    }
    expected = brute_force(FILES, TEMPLATES, {}, 0.6, 0.9)
    assert abs(found[3, "z.py"]["score"] - expected[FILES[2]][0][0]) < 1e-5


def test_passing_lines_over_is_exact():
    """Texts without a heavy term stay below the threshold with every template."""
    for texts in TEMPLATES.values():
        for text in texts:
            square = {w: n * n * float(i + 1) for i, (w, n) in enumerate(sorted(Counter(cut(text)).items()))}
            heavy = licenses.heavy_terms(square, 0.6)
            assert sum(v for w, v in square.items() if w not in heavy) < 0.36 * sum(square.values())


def test_scan_runs_no_python_and_an_empty_table_gives_no_rows(spark):
    result = licenses.scan(files(spark), TEMPLATES)
    assert "Python" not in plan(result) and "Arrow" not in plan(result) and "Cartesian" not in plan(result)
    assert licenses.scan(files(spark, []), TEMPLATES).collect() == []


def test_query_finds_the_licence_lines(spark, sf_dir):
    from faultline.llm import queries

    rows = queries.QUERIES["op5_licenses"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    named = {r["doc_id"]: r["license"] for r in rows if r["origin"] in ("header", "file")}
    expected = {d["doc_id"]: {lines[x] for x in d["text"].split("\n") if x in lines} for d in docs}
    assert all(named[d] in found for d, found in expected.items() if found)
    assert set(named) == {d for d, found in expected.items() if found}


MIT_BODY = licenses.BODIES["MIT"][0]
APACHE = "\n    Apache License\n  Version 2.0, January 2004\n http://www.apache.org/licenses/\n\nTERMS AND CONDITIONS FOR USE\n\n1. Definitions.\n" + LONG
REAL = [
    (1, "a/one.c", "// Copyright (c) 2020 Acme Inc. All rights reserved. Licensed under the Apache License, Version 2.0.\nint x;"),
    (2, "b/two.py", "This file is released under the MIT License, see the LICENSE file for details."),
    (3, "c/LICENSE", APACHE),
    (4, "c/d/three.py", "import os"),
    (5, "e/TERMS", "The MIT License\n\nCopyright 2021 Some One\n\n" + MIT_BODY),
    (6, "e/f/four.py", "x = 1"),
    (7, "g/five.py", "# Copyright 2020 The Foo Authors. Released under\n# the MIT License."),
    (8, "g/six.py", "the version of this license is not said here, nor is it released"),
    (9, "h/seven.py", "Licensed under the terms of the Apache License, Version 2.0"),
    (10, "h/eight.py", LONG),
]


def test_real_headers_and_licence_files(spark):
    rows = {r["doc_id"]: (r["license"], r["origin"], r["license_path"]) for r in licenses.scan(files(spark, REAL)).collect()}
    assert rows == {
        1: ("Apache-2.0", "header", "a/one.c"),
        2: ("MIT", "header", "b/two.py"),
        3: ("Apache-2.0", "file", "c/LICENSE"),
        4: ("Apache-2.0", "inherited", "c/LICENSE"),
        5: ("MIT", "file", "e/TERMS"),
        6: ("MIT", "inherited", "e/TERMS"),
        7: ("MIT", "header", "g/five.py"),
        8: (None, None, None),
        9: ("Apache-2.0", "header", "h/seven.py"),
        10: (None, None, None),
    }


def test_scores_equal_brute_force_over_all_windows(spark, monkeypatch):
    monkeypatch.setattr(licenses, "CHUNK", 7)
    texts = ["这个 项目 在 许可 之下 发布 Released under the Alpha License", "été à la forêt, released under the Alpha License", "Beta License, version 2.0",
             "Beta License, version 2 or 0", "beta beta beta license", "a version 2.0 of some kind\nPermission", "Released\nunder an alpha\nlicense", "permission " * 40]
    rows = [(i, f"{i}.py", t) for i, t in enumerate(texts)] + [r for r in FILES if r[2] != LONG]
    rows = [(d, p or "", t) for d, p, t in rows]
    templates = {**TEMPLATES, "C": ["Лицензия Гамма 1.0", "..."]}
    rows.append((77, "u.py", "лицензия гамма 1.0 и другое"))
    for threshold in (0.3, 0.6):
        expected = brute_force(rows, templates, {"B": ["permission permission"]}, threshold, 0.9)
        got = licenses.scan(files(spark, rows), templates, threshold, 0.9, {"B": ["permission permission"]}).collect()
        own = {(r["doc_id"], r["path"]): r for r in got if r["origin"] in ("header", "file")}
        for (doc, path, _), (header, entire) in expected.items():
            match = header or entire
            if match is None:
                assert (doc, path) not in own
            else:
                assert (own[doc, path]["license"], round(own[doc, path]["score"], 5)) == (match[1], round(match[0], 5)), (doc, path)


def test_terms_are_the_same_on_both_sides(spark):
    texts = ["CC BY-NC 4.0, 3-Clause.", "Лицензия №5 -- ÉTÉ_x ..a.. 許可", "İI ΣΑΣ 1.0.", "a\u0301b"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in table.select("i", licenses.pieces(F.col("text")).alias("terms")).collect():
        assert r["terms"] == licenses.template_words(texts[r["i"]])
    assert licenses.template_words(texts[0]) == ["cc", "by-nc", "4.0", "3-clause"]
