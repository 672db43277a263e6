"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, "the QUICK brown fox jumps over the lazy dog"),
    (2, "the QUICK brown fox jumps over the lazy dog"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (None, "a row without an id"),
    (None, None),
    (6, LONG),
    (7, "one"),
    (8, "ÉTÉ İstanbul ΣΑΣ 漢字 😀 l'été"),
    (9, "x" * 20_000),
    (10, "The quick brown fox jumps over the lazy dog again"),
]


def documents(spark: SparkSession, rows=None) -> DataFrame:
    """doc_id, text, and columns whose names operators use themselves."""
    rows = AWKWARD if rows is None else rows
    wide = [(d, t, "s", None, "x", 1.5, "q") for d, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, source string, lang string, fp string, score double, block string")


def empty_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, []).limit(0)


def labels(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
