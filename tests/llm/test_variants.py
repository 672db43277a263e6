"""Spelling variants against a plain comparison of all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from faultline.llm import variants
from faultline.llm.queries import ORACLES, QUERIES
from tests.llm.fixtures import AWKWARD, documents, empty_documents
from tests.oracle import connect, difference


def near(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts: dict[str, int], ratio: int = 5) -> set[tuple]:
    forms, found = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
        found[w] = len(others)
    out = set()
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, forms[w], root, n, found[w], counts.get(forms[w])))
    return out


def rows_of(df) -> list[tuple]:
    return [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()]


def words(rng: random.Random, count: int, letters: str = "abÀé") -> dict[str, int]:
    return {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))): 5 ** rng.randint(0, 6) * rng.randint(1, 9) for _ in range(count)}


def test_equals_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    counts = words(rng, 500) | {"a": 1, "aa": 5, "aaa": 25, "aaab": 130, "aaaab": 700, "x" * 3_000: 9, "x" * 2_999: 45, "x" * 2_998 + "y": 45}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    expected = plain(counts)
    for together in (50_000, 40):  # one range, and many that share prefixes
        monkeypatch.setattr(variants, "RANGE", together)
        found = rows_of(variants.variants(table))
        assert len(found) == len(expected) and set(found) == expected


def test_nodes_of_ranges_agree(spark, monkeypatch):
    monkeypatch.setattr(variants, "RANGE", 7)
    rng = random.Random(6)
    counts = words(rng, 300, "ab")
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    nodes: dict[str, int] = {}
    for r in variants._nodes(variants._ranged(table, "word", "test-ranges")).collect():
        for i, node in enumerate(r["nodes"]):
            assert nodes.setdefault(r["word"][:i], node) == node
    assert len(set(nodes.values())) == len(nodes)


def test_vocabulary_with_noise(spark):
    rng = random.Random(7)
    rows = [(rng.choice([1, 2, 3, None]), " ".join(rng.choice(["abcdefg", "ABCdefg", "abcdef", "Éclaire", "éclaire", "x1abcdefgh2", "××÷÷××", "ab"]) for _ in range(30))) for _ in range(60)]
    rows += [(4, None), (5, ""), (6, "abcdefg")]
    for noise in (None, 3, 199):
        counts: Counter = Counter()
        for d, t in rows:
            for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
                run = run.translate({c: c + 32 for c in range(65, 91)})
                h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
                counts[run[: h % len(run)] + run[h % len(run) + 1 :] if noise and h % noise == 0 else run] += 1
        expected = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
        found = variants.vocabulary(spark.createDataFrame(rows, "doc_id long, text string"), noise=noise)
        assert {r["word"]: r["n"] for r in found.collect()} == expected


def test_query_equals_sql(spark, sf_dir):
    name = "op12_spelling_variants"
    problem = difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert problem is None, problem


def test_awkward_rows_and_empty_tables(spark):
    found = rows_of(variants.variants(variants.vocabulary(documents(spark, AWKWARD * 5))))
    assert ("x" * 20_000, None, "x" * 20_000, 5, 0, None) in found
    assert rows_of(variants.variants(variants.vocabulary(empty_documents(spark)))) == []
