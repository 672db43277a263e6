"""Approximate nearest neighbours by inner product: probed lists, scanned by adaptive dimensions.

One more component makes all vectors equally long, so that the largest inner product is the smallest
distance; a random rotation then spreads the distance evenly over the dimensions. Vectors are assigned to
lists around centroids fitted on a bounded sample. A query probes the lists nearest to it; how many is
set on the sample, from how far down the true neighbours' lists stand. Within a list the
distance is added up in blocks of columns, and after each block a hypothesis test abandons the
candidates whose partial distance makes it unlikely that they come within the k-th best so far. What is
left is scored exactly on the original vectors.

Lists are dealt to tasks in groups, large groups in slices, so no list lands in one task whole if it is
large. Every row is indexed.

Defined results: vectors that are null or empty or hold a null or non-finite component take no part, nor
do, unless zero is allowed, vectors of zeros; vectors of different length are never compared. Ties
go to the smaller vec_id. A vec_id that repeats is one candidate per row, and a query per row; a query's
own rows are no candidates. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import materialise
from faultline.llm.topk import merge_lists, usable

#: Vectors that centroids and the number of probes are fitted on at most, and queries of these.
SAMPLE, SAMPLE_QUERIES = 20_000, 256
#: Share of the sample's true neighbours that the probed lists must hold.
REACH = 0.975
#: Vectors of the sample for a centroid, at least.
PER_CENTROID = 32
#: Groups of lists and vectors of a group that meet in one task.
GROUPS, SLICE_ROWS = 16, 16_384
#: Queries that a task compares with a slice, about.
QUERY_ROWS = 2_048
#: Columns of a block, and how sure the test is (larger abandons less).
COLUMNS, SURE = 16, 2.1
STEPS = 8


@dataclass
class Index:
    """Rotation, length bound, centroids (of rotated vectors), groups of lists, lists to probe."""

    rotation: np.ndarray
    bound: float
    centroids: np.ndarray
    group: np.ndarray
    probes: int

    def lift(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Rotated vectors with the component that makes them equally long; a query has 0 there."""
        scaled = vectors / self.bound
        more = np.zeros(len(scaled)) if query else np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))
        return np.column_stack([scaled, more]) @ self.rotation

    def order(self, queries: np.ndarray) -> np.ndarray:
        """Lists of each lifted query, nearest first, as many as it probes."""
        return np.argsort(_distances(queries, self.centroids), axis=1, kind="stable")[:, : self.probes]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The list of each vector, some thousand vectors at a time."""
    parts = [_distances(vectors[k : k + 4_096], centroids).argmin(axis=1) for k in range(0, len(vectors), 4_096)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def fit(sample: np.ndarray, bound: float, rows: int, k: int, seed: int = 3) -> Index:
    """An index for `rows` vectors from a sample of them."""
    rng = np.random.default_rng(seed)
    size = sample.shape[1] + 1
    rotation, _ = np.linalg.qr(rng.normal(size=(size, size)))
    index = Index(rotation, bound if bound > 0 else 1.0, np.zeros((1, size)), np.zeros(1, dtype=np.int64), 1)
    lifted = index.lift(sample)
    lists = int(max(1, min(np.sqrt(rows), len(sample) // PER_CENTROID)))
    centroids = lifted[rng.choice(len(lifted), lists, replace=False)].copy()
    for _ in range(STEPS):
        of = nearest(lifted, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, of, lifted)
        n = np.bincount(of, minlength=lists)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    index.centroids = centroids
    # neighbouring lists share a group, so that a query meets few groups
    anchors = centroids[rng.choice(lists, min(GROUPS, lists), replace=False)]
    index.group = nearest(centroids, anchors)
    of = nearest(lifted, centroids)
    asked = rng.choice(len(sample), min(SAMPLE_QUERIES, len(sample)), replace=False)
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, max(1, len(sample) - 1))]
    far = np.argsort(_distances(index.lift(sample[asked], True), centroids), axis=1, kind="stable").argsort(axis=1)
    needed = np.sort(np.take_along_axis(far, of[best], axis=1).ravel())
    index.probes = int(needed[min(len(needed) - 1, int(REACH * len(needed)))]) + 1
    return index


def scan(query: np.ndarray, own: int, original: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]], lifted: np.ndarray, k: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """vec_ids and scores of the best k in lists (vec_ids, vectors, lifted vectors), nearest list first."""
    size = len(lifted)
    best_ids, best_scores = np.zeros(0, dtype=np.int64), np.zeros(0)
    length = float(original @ original) / scale**2 + 1.0
    for ids, vectors, held in lists:
        alive = np.nonzero(ids != own)[0]
        if len(best_scores) == k:
            # the k-th best as a squared distance between lifted vectors
            limit = max(0.0, length - 2.0 * best_scores[-1] / scale**2)
            partial = np.zeros(len(alive))
            for start in range(0, size, COLUMNS):
                stop = min(size, start + COLUMNS)
                apart = held[alive, start:stop] - lifted[start:stop]
                partial += np.einsum("ij,ij->i", apart, apart)
                # the partial distance of a candidate at the limit would rarely be so large
                most = limit * (stop / size) * (1.0 + (SURE / np.sqrt(stop) if stop < size else 1e-9)) ** 2
                kept = partial <= most + 1e-12
                alive, partial = alive[kept], partial[kept]
                if not len(alive):
                    break
        if not len(alive):
            continue
        # row by row in one order of summation, so that equal vectors have equal scores wherever they stand
        scores = np.concatenate([best_scores, (vectors[alive] * original).sum(axis=1)])
        found = np.concatenate([best_ids, ids[alive]])
        if len(scores) > 4 * k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, found = scores[scores >= edge], found[scores >= edge]
        order = np.lexsort((found, -scores))[:k]
        best_ids, best_scores = found[order], scores[order]
    return best_ids, best_scores


def _task(index, k: int):
    def work(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        held: Index = index.value
        out = {c: [] for c in ("query_row", "query_id", "vec_id", "score")}
        if len(queries) and len(rows):
            vectors = np.stack(rows["vector_of"].to_numpy())
            lifted, of, ids = held.lift(vectors), rows["list"].to_numpy(), rows["candidate"].to_numpy()
            order = np.argsort(of, kind="stable")
            vectors, lifted, ids, of = vectors[order], lifted[order], ids[order], of[order]
            names, first = np.unique(of, return_index=True)
            lists = {int(n): (ids[a:b], vectors[a:b], lifted[a:b]) for n, a, b in zip(names, first, [*first[1:], len(of)])}
            asked = np.stack(queries["vector"].to_numpy())
            raised = held.lift(asked, True)
            for query_row, query_id, q, r, probed in zip(queries["query_row"], queries["vec_id"], asked, raised, held.order(raised)):
                found, scores = scan(q, query_id, q, [lists[n] for n in probed.tolist() if n in lists], r, k, held.bound)
                out["query_row"] += [query_row] * len(found)
                out["query_id"] += [query_id] * len(found)
                out["vec_id"] += found.tolist()
                out["score"] += scores.tolist()
        kinds = {"query_row": "int64", "query_id": "int64", "vec_id": "int64", "score": "float64"}
        return pd.DataFrame({c: pd.Series(v, dtype=kinds[c]) for c, v in out.items()}).assign(node=np.int64(key[0]) * 2**20 + np.int64(key[1]))

    return work


def _one_length(rows: DataFrame, is_query, k: int) -> DataFrame:
    context = rows.sparkSession.sparkContext
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    total = rows.agg(F.count("*").alias("n"), F.max(norm).alias("bound")).first()
    # at most SAMPLE vectors, by hash
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    fitted = fit(np.array([r["vector"] for r in chosen]), float(total["bound"]), total["n"], k)
    index = context.broadcast(fitted)

    def place(batches):
        for pdf in batches:
            if len(pdf):
                held = index.value
                of = nearest(held.lift(np.stack(pdf["vector"].to_numpy())), held.centroids)
                yield pdf.assign(list=of, group=held.group[of])

    placed = materialise(
        rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(place, "vec_id long, vector array<double>, row long, list long, group long"),
        "ann-lists",
    )
    # one row per group: large groups are cut into slices, and their queries into blocks
    slices = {r["group"]: -(-r["count"] // SLICE_ROWS) for r in placed.groupBy("group").count().collect()}
    cut = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(slices.items()) for x in pair]), F.col("group"))

    def ask(batches):
        for pdf in batches:
            if len(pdf):
                held = index.value
                probed = held.order(held.lift(np.stack(pdf["vector"].to_numpy()), True))
                yield pdf.assign(group=[sorted(set(held.group[p].tolist())) for p in probed])

    asked = placed.where(is_query).select("vec_id", "vector", F.col("row").alias("query_row"))
    asked = asked.mapInPandas(ask, "vec_id long, vector array<double>, query_row long, group array<long>")
    asked = materialise(asked.withColumn("group", F.explode("group")), "ann-queries")
    counts = {r["group"]: r["count"] for r in asked.groupBy("group").count().collect()}
    blocks = {g: max(1, -(-counts.get(g, 0) // QUERY_ROWS)) for g in slices}
    dealt = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(blocks.items()) for x in pair]), F.col("group"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
    # each slice meets each block of its group's queries
    left = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "query_row"), dealt)).withColumn("slice", every(cut))
    right = placed.withColumn("slice", F.pmod(F.xxhash64("vec_id", "row"), cut)).withColumn("of_block", every(dealt)).select(
        F.col("group").alias("of_group"), "slice", "of_block", "list", F.col("vec_id").alias("candidate"), F.col("vector").alias("vector_of")
    )
    schema = "query_row long, query_id long, vec_id long, score double, node long"
    found = left.groupBy("group", "slice", "block").cogroup(right.groupBy("of_group", "slice", "of_block")).applyInPandas(_task(index, k), schema)
    number = F.element_at(F.create_map(*[F.lit(x) for pair in _numbers(slices).items() for x in pair]), F.col("node"))
    return merge_lists(found.withColumn("node", number), sum(slices.values()), k)


def _numbers(slices: dict[int, int]) -> dict[int, int]:
    """Consecutive numbers of the tasks."""
    return {g * 2**20 + s: i for i, (g, s) in enumerate((g, s) for g, n in sorted(slices.items()) for s in range(n))}


def search(vectors: DataFrame, is_query, k: int, zero: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every row for which is_query (on vec_id) holds."""
    rows = usable(vectors)
    if not zero:
        rows = rows.where(F.exists("vector", lambda x: x != 0))
    lengths = [r["n"] for r in rows.select(F.size("vector").alias("n")).distinct().orderBy("n").collect()]
    if not lengths:
        empty = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], empty)
    found = [_one_length(rows.where(F.size("vector") == n), is_query, k) for n in lengths]
    return reduce(DataFrame.unionByName, found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
