"""What several operators share: inputs made safe, folds, bounded samples, lineage cuts."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.session import fresh_path

T_ = TypeVar("T_")

#: Most entries of one generation of a per-worker word cache; results do not depend on it.
CACHE_ENTRIES = 200_000
#: Longer pieces are worked out each time instead of being kept.
CACHED_CHARS = 48


class Kept(dict):
    """A cache in two generations: when the young one is full it becomes the old one, which is let go."""

    def __init__(self, make: Callable, entries: int = CACHE_ENTRIES, size: Callable = len):
        super().__init__()
        self.make, self.entries, self.old, self.size = make, entries, {}, size

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if self.size(key) <= CACHED_CHARS:
            if len(self) >= self.entries:
                self[key] = value
            else:
                dict.__setitem__(self, key, value)
        return value

    def add(self, made: dict) -> None:
        """Many at once, all of which may be kept."""
        if len(self) + len(made) > self.entries:
            self.old = dict(self)
            self.clear()
        self.update(made)

    def empty(self) -> None:
        self.clear()
        self.old = {}

    def __setitem__(self, key, value):
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        super().__setitem__(key, value)


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for cycles meanwhile; for work that makes many small objects and no cycles."""
    active = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if active:
            gc.enable()


_held: dict[str, tuple] = {}


def held(owner: str, key, make: Callable[[], T_]) -> T_:
    """What a worker keeps from one task to the next: one owner's thing at a time.

    A worker serves all stages of a job after each other; what an earlier stage kept is let go first, so
    that memory does not add up.
    """
    if owner not in _held or _held[owner][0] != key:
        _held.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _held[owner] = (key, make())
    return _held[owner][1]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id (null stays null) and text (null becomes empty); other columns are left aside."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def fold(modulus: int) -> "F.Column":
    """crc32 of doc_id as text, modulo; null for a null doc_id, which is in no fold."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % F.lit(modulus)


def in_fold(modulus: int, remainder: int):
    """True in the given fold; rows without doc_id are outside."""
    return F.coalesce(fold(modulus) == F.lit(remainder), F.lit(False))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a written table in the shared folder: any executor can reread them."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    return df.mapInArrow(work, schema)


def extend(df: DataFrame, column: str, kind: T.DataType, make: Callable[[], Callable[[list], pa.Array]]) -> DataFrame:
    """All columns of df and one more, made from the texts of each batch.

    make() runs once in each task and returns the function of a list of texts (null as None).
    """
    if column in df.columns:
        raise ValueError(f"column {column} exists already")
    schema = T.StructType([*df.schema.fields, T.StructField(column, kind)])
    at = df.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            values = score(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, column])

    return map_batches(df, work, schema)


def labelled(docs: DataFrame, labels: DataFrame, label: str, training, limit: int) -> DataFrame:
    """doc_id, text, y of at most `limit` labelled rows of the training fold.

    The documents are those with the smallest hashes of doc_id, so that the choice does not depend
    on order. Labels without doc_id or value do not count; of several labels of a document the
    largest counts. Documents that repeat are taken with all their rows; where a document's rows no longer
    fit below the limit it is left out, and the next ones are looked at.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & training)
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    # at most `limit` rows of two numbers, here and in the broadcast
    first = chosen.collect()
    spark = docs.sparkSession
    asked = spark.createDataFrame([(r["doc_id"],) for r in first], "doc_id long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(asked), "doc_id")
    copies = {r["doc_id"]: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    taken, kept = 0, []
    for r in first:
        if taken + copies.get(r["doc_id"], 0) <= limit:
            taken += copies.get(r["doc_id"], 0)
            kept.append((r["doc_id"], r["y"]))
    known = spark.createDataFrame(kept, "doc_id long, y int")
    return texts(docs).join(F.broadcast(known), "doc_id")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights (the last is the bias) by Newton steps; without both classes the bias alone decides."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        w[-1] = np.log(share / (1.0 - share))
        return w
    for _ in range(steps):
        p = sigmoid(z @ w)
        gradient = z.T @ (p - y) / len(y) + l2 * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + l2 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w
