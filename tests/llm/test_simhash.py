"""SimHash against a plain computation over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from faultline.llm import simhash
from tests.llm.fixtures import AWKWARD, documents, empty_documents


def plain_fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: list[int], ids: list[int | None], radius: int) -> list[int | None]:
    of = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius:
                    of[i] = of[j] = min(of[i], of[j])
    smallest = {}
    for c, d in zip(of, ids):
        if d is not None:
            smallest[c] = min(d, smallest.get(c, d))
    return [smallest.get(c) for c in of]


def key(row):
    return tuple((v is None, v) for v in row)


def test_awkward_rows(spark):
    found = simhash.near_duplicates(documents(spark)).select("doc_id", simhash.as_hex("fp").alias("f"), "component_id").collect()
    ids, prints = [d for d, _ in AWKWARD], [plain_fingerprint(t) for _, t in AWKWARD]
    expected = zip(ids, (f"{p:016x}" for p in prints), plain_components(prints, ids, 4))
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_empty_table(spark):
    assert simhash.near_duplicates(empty_documents(spark)).collect() == []
    assert simhash.one_of_each(empty_documents(spark)).collect() == []


@pytest.mark.parametrize("tile", [4, 1_000])
def test_links_in_tiles_connect_what_all_pairs_connect(spark, tile):
    rng = random.Random(tile)
    values = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(60):
        v = rng.choice(values)
        for _ in range(rng.randint(1, 6)):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    values = sorted({*values, 0, 1, 2**64 - 1})
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    rooted = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, 4, tile)).collect()}
    expected = plain_components(values, signed, 4)
    assert [rooted.get(v, v) for v in signed] == expected


def test_a_large_group_gives_no_more_links_than_members():
    values = np.array([1 << b for b in range(64)], dtype=np.uint64)
    assert len(simhash.links_within(values, None, 4)) == 63


def test_one_of_each_keeps_the_smallest_id_and_all_columns(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda d: (d is None, d))
    prints = [plain_fingerprint(t) for _, t in AWKWARD]
    groups = plain_components(prints, list(range(len(AWKWARD))), 4)
    best = {}
    for (d, _), g in zip(AWKWARD, groups):
        best[g] = min(best.get(g, (True, 0)), (d is None, d or 0)) if g in best else (d is None, d or 0)
    assert ids == sorted((None if none else d for none, d in best.values()), key=lambda d: (d is None, d))
