"""Incremental loads: each landed snapshot updates the facts instead of a full refresh."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from faultline import schemas
from faultline.config import UNKNOWN_MAKE, Profile
from faultline.functions.lexicon import Lexicon, LexiconTable
from faultline.operators.dedupe import RECORD_KEY, dedupe_by_key
from faultline.plans.jobs import standardise
from faultline.session import fresh_path
from faultline.sinks import versions, writers
from faultline.sinks.writers import PARTITIONS
from faultline.sources import facts, snapshots

SUMMARY = "batch long, figure string, value long"


def merge_facts(new: DataFrame, base: str, stem: str, profile: Profile) -> str:
    """Merge facts into the written ones: the latest row per key stays.

    The partitions that the new rows touch are read, merged and written below a new version
    folder; then a manifest names for every partition the version that holds it. Nothing written
    before is changed or removed, so a merge lost at any point leaves the facts as they were, and
    repeating it gives the same rows. Merges may run at the same time: the one that commits later starts from
    the other's manifest. Facts of a full refresh become the first version as a whole.
    The new rows are worked out once.
    """
    spark = new.sparkSession
    path = versions.folder(base, stem)
    landed = fresh_path(spark, "landed")
    new.write.option("maxRecordsPerFile", writers.ROWS_PER_FILE).parquet(landed)
    landed_rows = spark.read.schema(new.schema).parquet(landed)
    own = landed_rows.select(*PARTITIONS).distinct()

    def touched(_held: DataFrame | None) -> DataFrame:
        return own

    def merged(held: DataFrame | None, changed: DataFrame | None) -> DataFrame:
        part, rows = (own, landed_rows) if changed is None else (changed, landed_rows.join(changed, list(PARTITIONS), "left_semi"))
        if held is not None:
            # by partition columns alone, so that only those partitions are read
            old = facts.scan_versions(spark, path, profile, held.join(part, list(PARTITIONS), "left_semi"))
        elif facts.plain_partitions(spark, path):
            old = facts.scan_entry(spark, path, profile, provenance=True)
        else:
            return dedupe_by_key(rows)
        return dedupe_by_key(old.unionByName(rows, allowMissingColumns=True))

    versions.replace_partitions(spark, path, touched, merged)
    return path


def stream_snapshots(
    spark: SparkSession,
    folder: str,
    layout: str = "lines",
    files_per_batch: int = 10_000,
    provenance: bool = False,
    keep_corrupt: bool = False,
    schema: T.StructType = schemas.RAW,
) -> DataFrame:
    """Raw records of snapshots as they land; a long backlog is taken in several batches.

    Unreadable records end the stream, or are kept in `_corrupt_record`. `provenance` adds where each record
    was read from.
    """
    if layout not in ("lines", "array"):
        raise ValueError(f"a stream reads 'lines' or 'array', not {layout!r}")
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE" if keep_corrupt else "FAILFAST")
    reader = reader.option("multiLine", layout == "array")
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    records = reader.json(f"{folder.rstrip('/')}/*.json")
    return records.select("*", *snapshots.read_from()) if provenance else records


def first_of_each(
    records: DataFrame,
    keys: Iterable[str] = RECORD_KEY,
    at: str = "scraped_at",
    within: str = "1 day",
) -> DataFrame:
    """A stream without repeated records; its state is bounded by time, not by the number of records.

    Of the records that agree in the keys and lie within `within` of each other the one that lands
    first stays. A key is kept in the state store until the watermark (the latest time seen in earlier batches
    less `within`) has passed its time by `within`. Records older than the watermark are late and dropped:
    whether they are repeats can no longer be told. Records without a time are never late, and only
    repeats in one batch are told; the merge by key settles the others.
    """
    timed = records.withColumn("_at", F.col(at).try_cast("timestamp"))
    return timed.withWatermark("_at", within).dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def start_landing(
    records: DataFrame,
    base: str,
    stem: str,
    profile: Profile,
    checkpoint: str,
    lexicon: Lexicon | LexiconTable | None = None,
    modifiers: bool = False,
    summary: str | None = None,
) -> StreamingQuery:
    """Process all snapshots not yet seen, then stop; run it on the ingestion schedule.

    Cleaning is row-wise and the merge deduplicates by key, so the stream keeps no state
    beyond the list of files seen, unless the records went through `first_of_each`. Records kept as
    unreadable are counted and left out. `summary` names a folder for the run summary: per batch and
    figure one row, observed while the batch is written; a batch that is repeated replaces its rows.
    """
    if profile.with_sentiment and lexicon is None:
        raise ValueError("this profile scores texts: pass a lexicon")
    codes = dict.fromkeys([code for _, code, _ in profile.make_keywords] + [UNKNOWN_MAKE])

    def merge(batch: DataFrame, batch_id: int) -> None:
        unread = F.col(schemas.CORRUPT).isNotNull() if schemas.CORRUPT in batch.columns else F.lit(False)
        read, made = Observation(), Observation()
        batch = batch.observe(read, F.count(F.lit(1)).alias("rows_read"), F.count_if(unread).alias("unreadable"))
        rows = standardise(batch.where(~unread).drop(schemas.CORRUPT), profile, lexicon, modifiers)
        makes = [F.count_if(F.col("make") == code).alias(f"make:{code}") for code in codes]
        merge_facts(rows.observe(made, F.count(F.lit(1)).alias("rows"), *makes), base, stem, profile)
        if summary is not None:
            figures = [(batch_id, name, n) for name, n in {**read.get, **made.get}.items()]
            table = batch.sparkSession.createDataFrame(figures, SUMMARY)
            writers.write_batch(table, summary, "batch")

    return (
        records.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
