"""Exact and approximate search against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from faultline.llm import ann, queries, topk
from tests.oracle import connect, difference

SCHEMA = "vec_id long, embedding array<float>, rank int, score double, query_id string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, "x") for i, v in rows], SCHEMA)


AWKWARD = [
    (0, [1.0, 0.5]), (20, [0.25, -1.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, []), (5, [None, 1.0]),
    (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [0.0, 0.0]), (9, [1.0]), (None, [1.0, 1.0]), (11, [-3.0, 2.0]), (20, [0.25, -1.0]),
]


def plain(rows, k, scale, zero=True):
    fine = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    fine = [(i, [math.floor(scale * x) if scale else x for x in v]) for i, v in fine if zero or any(v)]
    out = []
    for q, a in fine:
        if q % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_exact_on_awkward_rows(spark):
    found = topk.exact_top_k(vectors(spark, AWKWARD), F.col("vec_id") % 20 == 0, 3).collect()
    assert sorted(map(tuple, found)) == plain(AWKWARD, 3, 1024)


def test_exact_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "SHARD_ROWS", 10)
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5]) for _ in range(3)]) for i in range(400)]
    found = topk.exact_top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, 7).collect()
    assert sorted(map(tuple, found)) == plain(rows, 7, 1024)


def test_scores_of_huge_components_are_exact_or_held():
    a = np.array([[2.0**40, 2.0**20], [2.0**62, 2.0**62]])
    assert topk._scores(a, np.array([[2.0**20, -3.0], [2.0**62, 2.0**62]])).tolist() == [
        [2**60 - 3 * 2**20, 2**63 - 1],
        [2**63 - 1, 2**63 - 1],
    ]


def test_empty_tables(spark):
    none = vectors(spark, AWKWARD).limit(0)
    assert topk.exact_top_k(none, F.col("vec_id") % 20 == 0, 3).collect() == []
    assert ann.search(none, F.col("vec_id") % 20 == 0, 3).collect() == []


def test_exact_query_equals_sql(spark, sf_dir):
    name = "op8_exact_top_k"
    assert difference(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) is None


def test_adaptive_scan_on_awkward_rows(spark):
    # so few vectors make one list, in which nothing that may come first is abandoned
    found = ann.search(vectors(spark, AWKWARD), F.col("vec_id") % 20 == 0, 3).collect()
    assert sorted(map(tuple, found)) == plain(AWKWARD, 3, None, zero=False)


def test_adaptive_scan_reaches_its_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    truth = plain([(r["vec_id"], r["embedding"]) for r in rows], 20, None)
    found = ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20).collect()
    scores = {(q, i): s for q, _, i, s in truth}
    assert len({(r["query_id"], r["vec_id"]) for r in found} & set(scores)) >= 0.9 * len(truth)
    assert all(abs(scores[r["query_id"], r["vec_id"]] - r["score"]) < 1e-9 for r in found if (r["query_id"], r["vec_id"]) in scores)
    for q in {r["query_id"] for r in found}:
        own = sorted((r["rank"], -r["score"], r["vec_id"]) for r in found if r["query_id"] == q)
        assert [r for r, _, _ in own] == list(range(1, 21)) and own == sorted(own, key=lambda x: (x[1], x[2]))


def test_equal_vectors_come_in_the_order_of_their_ids(spark):
    """Hundreds of copies among others, far apart in the table: equal scores, ties to the smaller id."""
    rng = np.random.default_rng(4)
    one = rng.normal(size=61).tolist()
    rows = [(i, one if i % 3 == 0 else rng.normal(size=61).tolist()) for i in range(900)]
    found = ann.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20).collect()
    copies = [i for i, v in rows if v is one]
    for q in (q for q in copies if q % 20 == 0):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert len({s for _, _, s in own}) == 1
        assert [i for _, i, _ in own] == [i for i in copies if i != q][:20]


def test_queries_of_a_group_are_dealt_in_blocks(spark, sf_dir, monkeypatch):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    is_query = F.col("vec_id") % 4 == 0
    order = lambda rows: sorted(map(tuple, rows))
    expected = order(ann.search(table, is_query, 5).collect())
    most = spark.sparkContext.accumulator(0)
    plain = ann._task

    def watched(index, k):
        work = plain(index, k)

        def inner(key, queries, rows):
            if len(queries) > 64:
                most.add(1)
            return work(key, queries, rows)

        return inner

    monkeypatch.setattr(ann, "QUERY_ROWS", 16, raising=False)
    monkeypatch.setattr(ann, "SLICE_ROWS", 200)
    monkeypatch.setattr(ann, "_task", watched)
    assert order(ann.search(table, is_query, 5).collect()) == expected
    assert most.value == 0
