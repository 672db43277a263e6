"""The prefix trie against a plain one, with long and shared conversations."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from faultline.llm import prefixes
from faultline.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, difference


def plain(rows: list[tuple], group: int = 20, most: int = 4) -> set[tuple]:
    own: dict[int, list] = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    members: dict[tuple, list[int]] = {}
    ended: dict[tuple, list[int]] = {}
    for conv in sorted(own):
        h = zlib.crc32(str(conv).encode()) % most
        base = conv - int(conv - group * int(conv / group))
        path = tuple(own.get(base, [])[:h] + own[conv][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
        ended.setdefault(path, []).append(conv)
    children: dict[tuple, int] = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    out = set()
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, inside in members.items():
        own_saved = (len(inside) - 1) * len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own_saved
            leaves[node[:d]] += node not in children
    for node, inside in members.items():
        ids = ",".join(map(str, ended.get(node, [])))
        out.add((inside[0], len(node), members[node[:-1]][0] if node else None, len(inside), children.get(node, 0), leaves[node], saved[node], hashlib.sha256(ids.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def table(spark, rows):
    wide = [(*r, "k", "node", 1) for r in rows]
    return spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, key string, node string, k int")


def check(spark, rows):
    found = [tuple(r[c] for c in COLUMNS) for r in prefixes.trie(table(spark, rows)).collect()]
    expected = plain(rows)
    assert len(found) == len(expected)
    assert set(found) == expected


def shared(rng: random.Random, convs: int, longest: int) -> list[tuple]:
    rows = []
    for c in range(convs):
        conv = rng.choice([c, 20 * c, c + 1_000])
        say = rng.choice("abc")
        for t in range(rng.randint(1, longest)):
            # long common beginnings that part now and then
            rows.append((conv * 2 - 40, t, rng.choice([None, "user"]), say * 2 + " hello there" if rng.random() < 0.97 else rng.choice("xyz")))
    seen = set()
    return [r for r in rows if (r[0], r[1]) not in seen and not seen.add((r[0], r[1]))]


@pytest.mark.parametrize("longest", [3, 8, 9, 16, 17, 70])
def test_equals_a_plain_trie(spark, longest):
    check(spark, shared(random.Random(longest), 60, longest))


def test_many_ranges_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "RANGE", 25)
    monkeypatch.setattr(prefixes, "CHUNK", 3)
    monkeypatch.setattr(prefixes, "PIECE", 4)
    monkeypatch.setattr(prefixes, "LEVELS", 5)
    check(spark, shared(random.Random(9), 40, 30))
    # one conversation over many ranges, and copies of it
    check(spark, [(c, t, "user", f"turn {t % 7}") for c in (0, 1, 2, 7) for t in range(150)])


def test_nulls_ties_and_lone_conversations(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (2, 1, "user", "a\tb\x0bc"), (2, None, "", "a"), (None, 0, "user", "lost"), (21, 0, "user", "a"), (60, 5, "user", "a\xa0b"), (61, 9, "system", "b")]
    check(spark, rows)
    # repeated rows are turns of their own
    check(spark, [(5, 1, "user", "same")] * 6 + [(25, 1, "user", "same")] * 3)


def test_all_turns_gone(spark):
    """A conversation without a base that is shorter than its exchanged beginning belongs to the root alone."""
    lone = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    check(spark, [(lone, 0, "user", "hello"), (lone, 1, "user", "again")])


def test_empty_table(spark):
    assert prefixes.trie(table(spark, [(1, 1, "a", "b")]).limit(0)).collect() == []


def test_query_equals_sql(spark, sf_dir):
    name = "op11_prefix_trie"
    problem = difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])
    assert problem is None, problem
