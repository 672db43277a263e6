"""Exact duplicates and repeated keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.schemas import PROVENANCE

RECORD_KEY = ("record_id", "make", "model", "year")
#: Columns that tell when and whence a record was loaded, not what it says.
LOAD_TIMES = ("scraped_at", "etl_timestamp", *PROVENANCE)

# Identifiers of records whose source had none.
EMPTY_IDS = ("complaint_", "recall_", "complaint_None", "recall_None")


def union_all(*frames: DataFrame) -> DataFrame:
    """Append frames by column name; a column one of them lacks is null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def drop_exact_duplicates(df: DataFrame, origin: Iterable[str] = PROVENANCE) -> DataFrame:
    """Keep one of each set of equal rows (nulls equal).

    Copies collapse before the shuffle, so a row repeated very often costs no task more. Columns that
    tell where a record was read do not make it another one; of copies the first origin stays.
    """
    where = [name for name in origin if name in df.columns]
    if not where:
        return df.dropDuplicates()
    rest = [name for name in df.columns if name not in where]
    first = F.min(F.struct(*where)).alias("_origin")
    return df.groupBy(*rest).agg(first).select(*rest, "_origin.*").select(*df.columns)


def slice_number(df: DataFrame, slices: int, origin: Iterable[str] = PROVENANCE) -> Column:
    """A number below `slices` that equal rows share, so each slice drops its copies by itself."""
    said = [name for name in df.columns if name not in set(origin)]
    return F.pmod(F.xxhash64(*said), F.lit(slices)).cast("int")


def row_digest(df: DataFrame) -> Column:
    """SHA-256 over all columns, each written with its length so rows cannot be confused."""
    for column in df.schema:
        if not isinstance(column.dataType, T.AtomicType) or isinstance(
            column.dataType, T.BinaryType
        ):
            raise ValueError(f"no digest for {column.name}: {column.dataType.simpleString()}")
    parts = []
    for column in df.schema:
        value = F.col(column.name)
        if isinstance(column.dataType, T.FractionalType):
            value = value + F.lit(0).cast(column.dataType)  # -0.0 equals 0.0
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-")))
    # Never null, so joins on it add no filter that would compute it again.
    return F.coalesce(F.unhex(F.sha2(F.concat(*parts), 256)), F.lit(b""))


def duplicate_rows(df: DataFrame, digest: str | None = None) -> DataFrame:
    """One row: total rows and rows beyond the first of each set of equal rows.

    Only digests are shuffled, never the rows. `digest` names a column that holds them already.
    """
    own = row_digest(df) if digest is None else F.col(digest)
    groups = df.select(own.alias("digest")).groupBy("digest").count()
    return groups.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def duplicate_samples(df: DataFrame, limit: int = 10, digest: str | None = None) -> DataFrame:
    """The first rows, in digest order, of those that occur more than once.

    At most `limit` digests are sent back to the rows, and each task keeps at most
    `limit` rows, whatever the number of copies.
    """
    own = (row_digest(df) if digest is None else F.col(digest)).alias("digest")
    repeated = (
        df.select(own)
        .groupBy("digest")
        .count()
        .where("count > 1")
        .select("digest")
        .orderBy("digest")
        .limit(limit)
    )
    members = df.select("*", own).join(F.broadcast(repeated), "digest", "left_semi")
    return members.orderBy("digest").limit(limit).select(*[n for n in df.columns if n != digest])


def dedupe_by_key(
    df: DataFrame,
    keys: Iterable[str] = RECORD_KEY,
    latest: str = "scraped_at",
    identifier: str = "record_id",
) -> DataFrame:
    """Keep the latest row per key; the other columns break ties.

    Rows without an identifier do not share a key: they are repeats only if everything
    but the load times agrees. The row_number limit is applied in each task before the
    shuffle as well, so a key that holds a large share of the rows sends one row per task.
    """
    keys = list(keys)
    rest = sorted(set(df.columns) - set(keys) - {latest})
    content = [name for name in df.columns if name not in {latest, *LOAD_TIMES}]
    unnamed = F.col(identifier).isNull() | F.col(identifier).isin(*EMPTY_IDS)
    df = df.withColumn("_content", F.when(unnamed, row_digest(df.select(content))))
    order = [F.col(latest).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in rest]]
    window = Window.partitionBy(*keys, "_content").orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where("_rank = 1").drop("_rank", "_content")
