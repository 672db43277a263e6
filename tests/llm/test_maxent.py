"""The language model: counts against a plain computation, probabilities that add up to one."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from faultline.llm import maxent, queries
from tests.llm.fixtures import AWKWARD, documents, empty_documents


def plain(rows, held):
    texts = [(d, (t or "").encode().lower().split() + [b""]) for d, t in rows]
    counts = Counter(w for d, ws in texts if not held(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [
        (d, held(d), len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for d, ws in texts
    ]


def agree(found, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    found = sorted((tuple(r)[:6] for r in found), key=key)
    assert len(found) == len(expected)
    for a, b in zip(found, sorted(expected, key=key)):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) <= 1e-9 * abs(b[5])


def test_awkward_rows(spark):
    rows = maxent.score(documents(spark), F.coalesce(F.col("doc_id") == 2, F.lit(False))).collect()
    agree(rows, plain(AWKWARD, lambda d: d == 2))
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_without_training_texts_or_rows(spark):
    rows = maxent.score(documents(spark), F.lit(True)).collect()
    agree(rows, plain(AWKWARD, lambda d: True))
    assert maxent.score(empty_documents(spark), F.lit(False)).collect() == []


def test_query_learns_more_than_single_words(spark, sf_dir):
    rows = queries.QUERIES["op7_maxent_lm"](spark, sf_dir).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    agree(rows, plain(docs, lambda d: zlib.crc32(str(d).encode()) % 7 == 2))
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_the_probabilities_of_all_tokens_add_up_to_one():
    """Over the known tokens and, once for each class, an unseen one."""
    vocabulary = [b"", b"the", b"of", b"cat", b"dog", b"bird"]
    c = np.array([5.0, 9, 7, 2, 1, 1])
    code = maxent._code({b"the": 1, b"of": 2})
    codes = np.array([code(w) for w in vocabulary])
    kinds = codes // maxent.BUCKETS
    corpus = maxent.Corpus(25, 6, np.bincount(kinds, c, maxent.CLASSES).astype(int), np.bincount(kinds, minlength=maxent.CLASSES))
    weights = np.random.default_rng(0).normal(0, 0.5, (maxent.ROWS, maxent.CLASSES)).astype(np.float32)
    history = [1, 3]
    total = 0.0
    for k in range(len(vocabulary)):
        ids = np.array([*history, k], dtype=np.int32)
        _, _, longer = maxent.score_block([ids], c, codes, corpus, weights)
        _, _, shorter = maxent.score_block([ids[:-1]], c, codes, corpus, weights)
        total += 10 ** (longer[0] - shorter[0])
    rows = maxent.histories(codes[np.array([*history, 0])], np.array([0]))
    by_class = maxent._softmax(weights, rows)[-1]
    unseen = sum(p / (t + d + 1) for p, t, d in zip(by_class, corpus.class_tokens, corpus.class_distinct))
    assert abs(total + unseen - 1) < 1e-5


def test_gradient_steps_lower_the_loss():
    rng = np.random.default_rng(1)
    codes = np.array([(1 + i % 3) * maxent.BUCKETS + 7 * (i % 3) for i in range(3_000)])
    codes[::50] = 0
    starts = np.concatenate([[0], np.nonzero(codes == 0)[0][:-1] + 1])
    learner = maxent.Learner(rng.normal(0, 0.01, (maxent.ROWS, maxent.CLASSES)).astype(np.float32))
    rows, target = maxent.histories(codes, starts), codes // maxent.BUCKETS
    loss = lambda: -np.log(maxent._softmax(learner.weights, rows)[np.arange(len(target)), target]).mean()
    before = loss()
    for _ in range(5):
        learner.learn(codes, starts)
    assert loss() < 0.5 * before


def test_blocks_do_not_change_scores(spark, monkeypatch):
    docs = [(i, f"a b c d{i % 5} e{i % 3}") for i in range(40)]
    agree(maxent.score(documents(spark, docs).coalesce(1), F.col("doc_id") % 4 == 0).collect(), plain(docs, lambda d: d % 4 == 0))
    monkeypatch.setattr(maxent, "BLOCK_BYTES", 30)
    agree(maxent.score(documents(spark, docs).coalesce(1), F.col("doc_id") % 4 == 0).collect(), plain(docs, lambda d: d % 4 == 0))


def test_few_and_many_rows_add_up_as_reduceat_has_them(monkeypatch):
    """Bit by bit, and only the groups of many rows are left to reduceat, which takes its time for each."""
    rng = np.random.default_rng(3)
    key = np.sort(rng.zipf(1.6, 3_000) % 700)
    order = rng.permutation(len(key))
    values = rng.normal(0, 1, (len(key), maxent.CLASSES)).astype(np.float32)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    assert {1, 2, 3} <= set(np.diff(first).tolist()) and np.diff(first).max() > maxent.FEW
    expected = np.add.reduceat(values[order], first, axis=0)
    total, sizes = maxent._sums(values, order, first)
    assert (total == expected).all() and (sizes == np.diff(np.append(first, len(key)))).all()

    class Counted:
        rows = 0

        @classmethod
        def reduceat(cls, part, at, axis):
            cls.rows += len(at)
            return np.add.reduceat(part, at, axis=axis)

    class Shadow:
        add = Counted

        def __getattr__(self, name):
            return getattr(np, name)

    monkeypatch.setattr(maxent, "np", Shadow())
    maxent._sums(values, order, first)
    assert Counted.rows == (sizes > maxent.FEW).sum() < len(sizes) / 4
    alone = maxent._sums(values, order[:4], np.arange(4))
    assert (alone[0] == values[order[:4]]).all()
