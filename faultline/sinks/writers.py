"""Writers. Each replaces what an earlier run of the same job wrote, never adds to it."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.dims import dim_make, dim_sentiment
from faultline.session import shuffles_removed
from faultline.sources import listing
from faultline.sources.facts import FACTS_PREFIX

PARTITIONS = ("make", "year")
_SALTS = 64
#: Rows of few different values take few bytes: bytes alone would put very many into one file, which one task reads.
ROWS_PER_FILE = 200_000


def timestamp_name() -> str:
    return datetime.now(tz=timezone.utc).strftime("%Y%m%d_%H%M%S")


def write_snapshot(
    records: DataFrame, folder: str, stem: str | None = None, packed: bool = False, begun: bool = False, unfinished: bool = False
) -> str:
    """Raw records as JSON lines, which split over tasks when read; returns the path.

    `packed` lines take a tenth of the disk. Their files do not split, so each holds a bounded number of
    rows. `begun` and `unfinished` as in `write_facts`, for a snapshot named by its stem.
    """
    stem = stem or f"nhtsa_{timestamp_name()}"
    path = f"{folder.rstrip('/')}/{stem}.json"
    writer = records.write.mode("append" if begun else "overwrite").option("ignoreNullFields", True)
    if packed:
        writer = writer.options(**_PACKED)
    if unfinished:
        writer = writer.option(listing.MARKS, "false")
    with shuffles_removed(records.sparkSession):
        writer.json(path)
    return path


#: The fastest gzip: lines repeat their keys, so a better one gains little more.
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 25_000}


def spread(facts: DataFrame) -> DataFrame:
    """Bring each partition's rows together in few files, without one task per partition.

    Rebalancing splits a make and year that hold a large share of the rows and joins the
    small ones. It needs adaptive execution; without it a salt does the splitting.
    """
    if facts.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return facts.hint("rebalance", *PARTITIONS)
    rest = [name for name in facts.columns if name not in PARTITIONS]
    salt = F.pmod(F.xxhash64(*rest), F.lit(_SALTS))
    return facts.repartition(*PARTITIONS, salt)


def write_facts(
    facts: DataFrame, base: str, stem: str, only_touched: bool = False, begun: bool = False, unfinished: bool = False
) -> str:
    """Hive-partitioned Parquet by make and year; returns the path.

    A full refresh replaces the snapshot's folder. `only_touched` replaces just the
    partitions that occur in the rows. A refresh may come in several writes: all but the first go on with one
    that has `begun`, and an `unfinished` one leaves the folder without the mark of a complete one.
    """
    path = f"{base.rstrip('/')}/{FACTS_PREFIX}{stem}"
    mode = "dynamic" if only_touched else "static"
    writer = spread(facts).write.mode("append" if begun else "overwrite")
    if unfinished:
        writer = writer.option(listing.MARKS, "false")
    writer.option("partitionOverwriteMode", mode).partitionBy(*PARTITIONS).parquet(path)
    return path


def save_facts_table(facts: DataFrame, table: str) -> None:
    """The facts as a catalog table."""
    spread(facts).write.mode("overwrite").format("parquet").partitionBy(*PARTITIONS).saveAsTable(
        table
    )


def save_snapshot_table(records: DataFrame, database: str, snapshot: str) -> None:
    """A snapshot as a catalog table of its own, with statistics of its columns for the optimizer."""
    spark = records.sparkSession
    records.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.`{snapshot}`")
    spark.sql(f"analyze table {database}.`{snapshot}` compute statistics for all columns")


def latest_snapshot_view(spark: SparkSession, database: str, view: str = "latest") -> str:
    """Make the view show the snapshot table with the greatest name; returns that name."""
    found = [table.name for table in spark.catalog.listTables(database) if table.tableType != "VIEW"]
    if not found:
        raise FileNotFoundError(f"no snapshot table in {database}")
    spark.sql(f"create or replace view {database}.`{view}` as select * from {database}.`{max(found)}`")
    return max(found)


def write_dims(spark: SparkSession, base: str, with_sentiment: bool = True) -> None:
    """The dimensions; a handful of rows, hence one file each."""
    dims = {"dim_make": dim_make(spark)}
    if with_sentiment:
        dims["dim_sentiment"] = dim_sentiment(spark)
    for name, dim in dims.items():
        dim.coalesce(1).write.mode("overwrite").parquet(f"{base.rstrip('/')}/{name}.parquet")


def write_results(results: dict[str, DataFrame | None], folder: str) -> list[str]:
    """Each result as a CSV folder with header, in the result's order; others are skipped.

    The files follow RFC 4180, so any reader of that takes them: fields with separators, quotes or line
    ends are quoted, quotes inside are doubled, blanks around a text stay. A null is an empty field
    and an empty text a quoted one. `read_results` reads them back with the types of the result.
    """
    written = []
    for name, result in results.items():
        if isinstance(result, DataFrame):
            path = f"{folder.rstrip('/')}/{name}.csv"
            result.write.mode("overwrite").options(**_CSV).csv(path)
            written.append(path)
    return written


#: Quotes are doubled, as RFC 4180 has it, not escaped by a backslash.
_CSV = {
    "header": True, "quote": '"', "escape": '"', "charToEscapeQuoteEscaping": "\0",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": '""', "nullValue": "",
}


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A result written by `write_results`; texts may hold line ends, an empty text is no null."""
    # no value is a NUL sign, so only a field without quotes is read as null
    reading = {**_CSV, "emptyValue": "", "nullValue": "\0", "multiLine": True}
    return spark.read.schema(schema).options(**reading).csv(path)


def report_name(snapshots: list[str]) -> str:
    """Named after the one snapshot, or combined with the time."""
    if len(snapshots) == 1:
        return f"val_{snapshots[0].removesuffix('.json')}"
    return f"val_combined_{timestamp_name()}"


def write_profile(profile: DataFrame, report: str, name: str) -> DataFrame:
    """One table of a report, read back so that what builds on it does not redo it."""
    path = f"{report}/{name}"
    profile.write.mode("overwrite").parquet(path)
    return profile.sparkSession.read.schema(profile.schema).parquet(path)


def write_batch(rows: DataFrame, path: str, part: str) -> None:
    """Replace the partitions of `part` that the rows have, and no others."""
    replaced = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    replaced.partitionBy(part).parquet(path)


def write_snapshot_profiles(profiles: DataFrame, folder: str, name: str = "field_profiles") -> str:
    """Profiles with a column `snapshot`, into one table of all snapshots; returns its path.

    Only the partitions of the snapshots given are replaced, so a repeated run adds nothing.
    """
    path = f"{folder.rstrip('/')}/{name}"
    write_batch(profiles, path, "snapshot")
    return path


def write_quarantine(records: DataFrame, folder: str) -> str:
    """Unreadable records for inspection, added to those of other runs by file; returns the path.

    A repeated run replaces the records of the files it read.
    """
    path = f"{folder.rstrip('/')}/quarantine"
    write_batch(records, path, "source_file")
    return path


def write_lines(lines: DataFrame, report: str, name: str) -> None:
    """The rendered text of a report."""
    lines.write.mode("overwrite").text(f"{report}/{name}")
