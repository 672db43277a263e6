"""Exact top-k by inner product of whole-number vectors, in tiles.

Queries and candidates are dealt into blocks of bounded size. A task holds one tile (a block of
queries and a block of candidates), multiplies it with one matrix product and keeps the best k of
each query. The lists of a query meet in a tree of bounded fan-in.

Defined results: vectors that are null or empty or hold a null or non-finite component take no part;
vectors of different length are never compared. A component x counts as floor(scale * x) in double
precision; beyond the range of a long, components and scores stay at its bounds. Ties go to the
smaller vec_id. A vec_id that repeats is one candidate per row, and a query per row; a query's own
rows (same vec_id) are no candidates. Rows without vec_id take no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a tile's two sides; a tile's scores are worked out a slice of queries at a time.
QUERY_BLOCK = 2_048
SHARD_ROWS = 8_192
SLICE = 256
#: Lists that meet in one step of the merge.
FAN_IN = 16

_LONG = 2**63 - 1
_EXACT = 2.0**53


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & fine
    )


def _whole(rows: pd.Series, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles, held within a long."""
    return np.clip(np.floor(np.stack(rows.to_numpy()).astype(np.float64) * scale), -(2.0**63), 2.0**63)


def _scores(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Whole-number inner products as long, exact for any size of component."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(shard).max(initial=0)) * queries.shape[1]
    if top < _EXACT:
        return (queries @ shard.T).astype(np.int64)
    bound = lambda a: np.clip(np.array([[int(x) for x in r] for r in a], dtype=object), -_LONG - 1, _LONG)
    return np.clip(bound(queries) @ bound(shard).T, -_LONG - 1, _LONG).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, column) of each row's k largest scores, ties to smaller ids; own rows left out.

    ids ascend. Partial selection finds each row's k-th score; all above it stay, and of those equal
    to it the first ones.
    """
    allowed = ids[None, :] != own[:, None]
    kept = np.where(allowed, scores, -_LONG - 1)
    if scores.shape[1] > k + 1:
        edge = np.partition(kept, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k][:, None]
        above = (kept > edge) & allowed
        level = (kept == edge) & allowed
        room = k - above.sum(axis=1, keepdims=True)
        allowed = above | (level & (np.cumsum(level, axis=1) <= room))
    return np.nonzero(allowed)


def _tile(k: int, scale: int):
    def work(key: tuple, queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(queries) and len(shard):
            shard = shard.rename(columns={"candidate": "vec_id", "vector_of": "vector"}).sort_values("vec_id", kind="stable")
            for (_, left), (_, right) in _same_length(queries, shard):
                ids, matrix = right["vec_id"].to_numpy(), _whole(right["vector"], scale)
                for start in range(0, len(left), SLICE):
                    part = left.iloc[start : start + SLICE]
                    scores = _scores(_whole(part["vector"], scale), matrix)
                    rows, cols = _best(scores, ids, part["vec_id"].to_numpy(), k)
                    found.append(
                        pd.DataFrame(
                            {
                                "query_row": part["query_row"].to_numpy()[rows],
                                "query_id": part["vec_id"].to_numpy()[rows],
                                "vec_id": ids[cols],
                                "score": scores[rows, cols],
                                "node": np.int64(key[1]),
                            }
                        )
                    )
        empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_row", "query_id", "vec_id", "score", "node")})
        return pd.concat(found, ignore_index=True) if found else empty

    return work


def _same_length(left: pd.DataFrame, right: pd.DataFrame) -> Iterator:
    by = {n: g for n, g in right.groupby(right["vector"].map(len))}
    for n, g in left.groupby(left["vector"].map(len)):
        if n in by:
            yield (n, g), (n, by[n])


def blocks(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def merge_lists(lists: DataFrame, nodes: int, k: int) -> DataFrame:
    """The k best of each query from lists with a node number below `nodes`, in steps of FAN_IN."""
    while True:
        nodes = -(-nodes // FAN_IN)
        lists = lists.withColumn("node", (F.col("node") / F.lit(FAN_IN)).cast("long"))
        order = Window.partitionBy("query_row", "query_id", "node").orderBy(F.col("score").desc(), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.lit(k))
        if nodes <= 1:
            return lists
        lists = lists.drop("rank")


def exact_top_k(vectors: DataFrame, is_query, k: int, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every row for which is_query holds.

    is_query is a condition on vec_id. Every row is a candidate.
    """
    rows = usable(vectors)
    queries = rows.where(is_query)
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    shards, groups = blocks(sizes["n"], SHARD_ROWS), blocks(sizes["q"], QUERY_BLOCK)
    numbered = queries.withColumn("query_row", F.monotonically_increasing_id())
    left = numbered.withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "query_row"), F.lit(groups)).cast("int")
    ).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    # one more value than vec_id, so that a vec_id that repeats does not fill one shard
    right = rows.withColumn(
        "shard", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    # names of their own: both sides come from one table
    right = right.select("block", "shard", F.col("vec_id").alias("candidate"), F.col("vector").alias("vector_of"))
    schema = "query_row long, query_id long, vec_id long, score long, node long"
    lists = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInPandas(_tile(k, scale), schema)
    return merge_lists(lists, shards, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
