"""SimHash near-duplicates by an exact comparison in tiles.

A document's fingerprint has a bit set where over half of its shingles' XXH64 values have it. Equal
fingerprints become one node. Nodes are dealt into tiles of bounded size by their population count;
two tiles are compared only if their counts can differ by no more than the radius, for the counts of
two fingerprints differ by at most the bits they differ in. A task holds one pair of tiles, compares all
their fingerprints by exclusive-or and bit counts, and keeps a spanning forest of the links it finds, so
that a group of copies gives no more links than it has members. Connected components follow by
alternating star contractions on the links.

Defined results: a null text counts as empty; no words give fingerprint zero, which links like any
other. Rows repeat and stay. A null doc_id has a fingerprint and belongs to a component, but is nobody's
smallest id; a component of such rows alone has a null id. Long texts are hashed whole. An empty table
gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import extend, materialise, texts

#: Nodes of a tile; a pair of tiles is compared STRIP rows at a time.
TILE = 32_768
STRIP = 64
#: Shingles that are hashed and counted together.
BLOCK = 65_536
MAX_ROUNDS = 60
#: Names that no column of the input has.
_MARK, _ROW, _KEPT = "__fingerprint", "__row", "__kept"


def fingerprint(text: str | None, words_each: int, seed: int) -> int:
    """The 64 bits of one text, as a signed number."""
    import xxhash

    # bytes.lower and bytes.split know just the letters A-Z and the six ASCII white-space characters
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < words_each:
        shingles: Iterable[bytes] = [b" ".join(words)]
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_each))))
        total = len(words) - words_each + 1
    shingles = iter(shingles)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, BLOCK):
        size = min(BLOCK, total - start)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, islice(shingles, size), repeat(seed)), dtype=np.uint64, count=size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return struct.unpack("<q", bits.tobytes())[0]


def fingerprints(docs: DataFrame, column: str, words_each: int, seed: int = 42) -> DataFrame:
    """docs with their fingerprint (a signed long) in one more column."""

    def make():
        return lambda batch: pa.array([fingerprint(t, words_each, seed) for t in batch], pa.int64())

    return extend(docs, column, T.LongType(), make)


def _roots(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels (smallest member) after joining a[i] with b[i], from labels that are roots already."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def links_within(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Fingerprints of two tiles (or one, right is None) within the radius: a spanning forest of the links.

    All of a tile have one population count, so if two fingerprints differ in d bits in their low
    halves' counts, they differ in at least d + |total difference - d| bits. Both sides are sorted by
    that count, and only the rows it leaves possible are compared.
    """
    nodes = left if right is None else np.concatenate([left, right])
    other = left if right is None else right
    shift = 0 if right is None else len(left)
    more = int(np.bitwise_count(other[0])) - int(np.bitwise_count(left[0]))
    least, most = -((radius - more) // 2), (radius + more) // 2
    low = np.uint64(0xFFFFFFFF)
    counts = np.bitwise_count(other & low).astype(np.int64)
    order = np.argsort(counts, kind="stable")
    other, counts, place = other[order], counts[order], order + shift
    own = np.bitwise_count(left & low).astype(np.int64)
    by_count = np.argsort(own, kind="stable")
    label = np.arange(len(nodes))
    for start in range(0, len(left), STRIP):
        rows = by_count[start : start + STRIP]
        first = np.searchsorted(counts, own[rows[0]] + least, "left")
        last = np.searchsorted(counts, own[rows[-1]] + most, "right")
        if first >= last:
            continue
        near = np.bitwise_count(left[rows][:, None] ^ other[None, first:last]) <= radius
        r, c = np.nonzero(near)
        if len(r):
            label = _roots(rows[r], place[first + c], label)
    joined = np.nonzero(label != np.arange(len(nodes)))[0]
    return [(int(nodes[i]), int(nodes[label[i]])) for i in joined]


def tiles(nodes: DataFrame, tile: int = TILE) -> DataFrame:
    """fp, tile, bits: tiles hold at most about `tile` nodes of one population count."""
    counted = nodes.select("fp", F.bit_count("fp").cast("int").alias("bits"))
    slices = counted.groupBy("bits").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("slices"))
    return counted.join(F.broadcast(slices), "bits").withColumn(  # at most 65 rows
        "slice", F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    )


def links(nodes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """a, b: links that connect whatever is connected within the radius. nodes: distinct fp (long)."""
    dealt = tiles(nodes, tile)
    # at most 65 population counts times nodes / tile slices: a table of tiles, not of nodes
    kinds = dealt.select("bits", "slices").distinct()
    first = kinds.select(F.col("bits").alias("bits_a"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice_a"))
    second = kinds.select(F.col("bits").alias("bits_b"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice_b"))
    reach = first.withColumn("bits_b", F.explode(F.sequence(F.col("bits_a"), F.least(F.lit(64), F.col("bits_a") + F.lit(radius)))))
    pairs = reach.join(second, "bits_b").where((F.col("bits_a") < F.col("bits_b")) | (F.col("slice_a") <= F.col("slice_b")))
    pairs = materialise(pairs.withColumn("pair", F.monotonically_increasing_id()), "tile-pairs")
    single = ((F.col("bits_a") == F.col("bits_b")) & (F.col("slice_a") == F.col("slice_b"))).cast("int").alias("single")
    left = pairs.select(F.col("bits_a").alias("bits"), F.col("slice_a").alias("slice"), "pair", F.lit(0).alias("side"), single)
    right = pairs.select(F.col("bits_b").alias("bits"), F.col("slice_b").alias("slice"), "pair", F.lit(1).alias("side"), single)
    sides = left.unionByName(right.where("single = 0"))
    members = dealt.join(sides, ["bits", "slice"]).select("pair", "side", "single", "fp")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        values, side = pdf["fp"].to_numpy().view(np.uint64), pdf["side"].to_numpy()
        a, b = values[side == 0], values[side == 1]
        if not len(a) or not len(b) and int(pdf["single"].iloc[0]) == 0:
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        found = links_within(a, b if len(b) else None, radius)
        return pd.DataFrame(np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    return members.groupBy("pair").applyInPandas(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of all nodes in edges (a, b).

    Large and small stars in turn: each node points its larger neighbours, then all its neighbours, at
    the smallest it knows, until nothing changes. Every round is written to the shared folder.
    """
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        now = materialise(small, "links")
        if edges.count() == now.count() and now.join(edges, ["a", "b"], "left_anti").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        edges = now
    raise RuntimeError("components did not settle")


def near_duplicates(docs: DataFrame, words_each: int = 4, radius: int = 4, seed: int = 42, tile: int = TILE) -> DataFrame:
    """doc_id, fp (long), component_id of every row."""
    marked = materialise(fingerprints(texts(docs), "fp", words_each, seed).select("doc_id", "fp"), "fingerprints")
    nodes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-nodes")
    parts = components(links(nodes, radius, tile))
    rooted = nodes.join(parts, nodes["fp"] == parts["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def as_hex(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def one_of_each(docs: DataFrame, words_each: int = 4, radius: int = 4, seed: int = 42, tile: int = TILE) -> DataFrame:
    """The rows of docs that stay if each component keeps one: that with the smallest doc_id.

    Rows with the same doc_id and text as the one that stays go too, as does all of a component without any
    doc_id but the row of its smallest fingerprint.
    """
    found = fingerprints(docs, _MARK, words_each, seed).withColumn(_ROW, F.monotonically_increasing_id())
    marked = materialise(found, "fingerprinted")
    # the first row of each fingerprint: rows with an id before those without, then by id, then by place
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("doc_id"), F.col(_ROW).alias("row"))
    nodes = materialise(marked.groupBy(F.col(_MARK).alias("fp")).agg(F.min(first).alias("first")), "fingerprint-nodes")
    parts = components(links(nodes, radius, tile))
    rooted = nodes.join(parts, nodes["fp"] == parts["node"], "left").select("first", F.coalesce("root", "fp").alias("root"))
    stays = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(_KEPT))
    return marked.join(stays, F.col(_ROW) == F.col(_KEPT), "left_semi").select(*docs.columns)
