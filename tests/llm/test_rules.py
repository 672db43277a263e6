"""Quality rules: measures by a plain count, exact tails, the guarantee, awkward rows."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from faultline.llm import rules
from faultline.llm.queries import QUERIES
from tests.llm.fixtures import AWKWARD, documents, empty_documents, labels


def plain(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    repeated = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), repeated, len(marked), len(lines)


def made(rng: random.Random) -> str:
    return "".join(rng.choice(["a", "b", "cé", " ", " ", "\n", "\x0b", "\x1c", "\xa0", "#", "%>", "漢"]) for _ in range(rng.randint(0, 60)))


def test_measures_equal_a_plain_count(monkeypatch):
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "a a a a", "a b c a b c", "x\n\nx\r\nx", *(made(rng) for _ in range(800))]
    for text in texts:
        assert rules.measure(text) == plain(text), repr(text)
    monkeypatch.setattr(rules, "MANY_WORDS", 0)
    for text in texts:
        assert rules.measure(text) == plain(text), repr(text)


def test_query_measures_the_whole_table(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op13_quality_rules"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        words = (docs[r["doc_id"]] or "").split()
        if len(words) < 3_000:
            assert tuple(r[m] for m in rules.MEASURES) == plain(docs[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and not r["broken"])


def test_tail_is_exact():
    for n, k, p in ((10, 0, 0.1), (10, 3, 0.2), (40, 5, 0.05), (7, 7, 0.5), (0, 0, 0.5)):
        exact = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
        assert rules.rejected_at_most(k, n, p) == pytest.approx(exact)


def test_cutoff_stops_at_the_first_that_fails():
    grid = (30, 20, 10)
    # 1,000 good documents; 2 reach 20, 400 reach 10
    values = {35: [0, 50], 20: [2, 50], 10: [398, 0], 0: [600, 0]}
    assert rules.proven(values, grid, 0.02, 0.01) == 20
    assert rules.proven(values, grid, 0.002, 0.01) is None  # too few documents for so small a share
    assert rules.proven({k: [g, 0] for k, (g, _) in values.items()}, grid, 0.02, 0.01) is None  # nothing to gain
    # a failure ends the walk, though a later cutoff would be taken alone
    assert rules.proven({30: [100, 0], 10: [900, 9]}, grid, 0.02, 0.01) is None


def test_false_rejections_stay_limited():
    """Over many drawn holdouts the chosen cutoff loses more than its share in at most `level` of them."""
    rng = random.Random(8)
    grid, share, level, bad = tuple(range(100, 0, -5)), 0.05, 0.1, 0
    for _ in range(300):
        values: dict[int, list[int]] = {}
        for _ in range(400):
            values.setdefault(5 * rng.randint(0, 19), [0, 0])[0] += 1  # a good document reaches cutoff c with (100 - c) / 100
        values.setdefault(95, [0, 0])[1] += 500
        values.setdefault(60, [0, 0])[1] += 500
        cutoff = rules.proven(values, grid, share, level)
        bad += cutoff is not None and (100 - cutoff) / 100 > share
    assert bad <= 300 * level


def test_steps_equal_comparison_with_every_cutoff(spark):
    for rule in rules.RULES:
        spread = [*rule.grid[:3], rule.grid[-1], rule.grid[-1] - 1, rule.grid[0] + 7, 0, -5_000, 5_000, rule.grid[2] + 1, rule.grid[2] - 1]
        rows = spark.createDataFrame([(v,) for v in spread], "v long").select("v", rules._step(F.col("v"), rule.grid).alias("step")).collect()
        for r in rows:
            assert [r["v"] >= c for c in rule.grid] == [r["step"] >= c for c in rule.grid]


def prose(rng: random.Random, n: int = 80) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(n))


def test_strata_have_their_own_cutoffs(spark):
    rng = random.Random(5)
    rows, known = [], []
    for i in range(3_000):
        lang, y = ("aa", "bb", None)[i % 3], int(rng.random() < 0.8)
        text = prose(rng)
        if not y or lang == "bb":  # in bb good documents hold signs as well
            text = text.replace("a", "#")
        rows.append((i, text, lang))
        known.append((i, y, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = labels(spark, [*known, (None, 1, 0), (5, None, 0), (9_999, 1, 0)])
    out = {r["doc_id"]: r for r in rules.judge(docs, held, "quality", "lang").collect()}
    for i, y, _ in known:
        r = out[i]
        assert r["stratum"] == ("aa", "bb", None)[i % 3]
        assert r["kept"] == (True if r["stratum"] == "bb" else bool(y))
    few = rules.judge(docs, held, "quality", "lang", most=1).select("stratum").distinct().collect()
    assert {r[0] for r in few} == {"aa", None}


def test_awkward_rows_and_empty_tables(spark):
    held = labels(spark, [(1, 1, 0)])
    rows = rules.judge(documents(spark), held, "quality", "lang").collect()
    assert sorted((r["doc_id"] or 0, *(r[m] for m in rules.MEASURES[:4])) for r in rows) == sorted((d or 0, *plain(t)[:4]) for d, t in AWKWARD)
    assert all(r["kept"] == (not r["base_failed"]) for r in rows)  # nothing is proven from one label
    none = labels(spark, []).limit(0)
    assert len(rules.judge(documents(spark), none, "quality", "lang").collect()) == len(AWKWARD)
    assert rules.judge(empty_documents(spark), held, "quality", "lang").collect() == []
