"""Versions of merged facts: what commits them, and what keeps them few.

A folder of merged facts holds version folders, each with some partitions, and manifests, each naming for
every partition the version that holds it. A manifest counts once its file, named by its number, is
there; the file can be created once only. A writer starts from the newest manifest and commits the number
after it. If another writer took that number, nothing of the two is lost: the later one looks at the
new manifest and tries again. Version numbers are claimed in the same way, so writers never share a folder.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.config import Profile
from faultline.sinks.writers import PARTITIONS, ROWS_PER_FILE, spread
from faultline.sources import facts, listing
from faultline.sources.facts import FACTS_PREFIX, MANIFESTS

#: A writer gives up after so many lost races.
ATTEMPTS = 100
#: Versions that compaction leaves.
MOST_VERSIONS = 8
#: Manifests that vacuum leaves for readers under way, and the age in seconds at which what no manifest names goes.
KEPT_MANIFESTS, GRACE = 2, 7 * 24 * 3600

_CLAIMS = "claims"


def folder(base: str, stem: str) -> str:
    return f"{base.rstrip('/')}/{FACTS_PREFIX}{stem}"


def new_version(spark: SparkSession, path: str) -> int:
    """The next number that no other writer has."""
    taken = [int(entry.name) for entry in listing.entries(spark, f"{path}/{MANIFESTS}/{_CLAIMS}/[0-9]*")]
    # folders written before numbers were claimed
    taken += [int(entry.name.partition("=")[2]) for entry in listing.folders(spark, f"{path}/version=*")]
    number = max(taken, default=0) + 1
    while not listing.create_once(spark, f"{path}/{MANIFESTS}/{_CLAIMS}/{number}", ""):
        number += 1
    return number


def write_version(rows: DataFrame, path: str) -> DataFrame:
    """The rows below a new version folder; returns their entries for a manifest."""
    spark = rows.sparkSession
    version = new_version(spark, path)
    target = f"{path}/version={version}"
    written = spread(rows).write.mode("overwrite").option("partitionOverwriteMode", "static")
    written = written.option("maxRecordsPerFile", ROWS_PER_FILE)
    written.partitionBy(*PARTITIONS).parquet(target)
    fresh = spark.read.schema(rows.schema).parquet(target).select(*PARTITIONS).distinct()
    return fresh.withColumn("version", F.lit(version).cast("long"))


def commit(entries: DataFrame, path: str, after: listing.Entry | None) -> bool:
    """Make the entries the manifest that follows `after`; false if another writer was first."""
    staged = f"entries-{uuid4().hex}"
    # one row per partition
    entries.coalesce(1).write.parquet(f"{path}/{MANIFESTS}/{staged}")
    number = 1 if after is None else int(after.name) + 1
    return listing.create_once(entries.sparkSession, f"{path}/{MANIFESTS}/{number:010d}", staged)


def replace_partitions(
    spark: SparkSession,
    path: str,
    chosen: Callable[[DataFrame | None], DataFrame],
    made: Callable[[DataFrame | None, DataFrame | None], DataFrame],
) -> None:
    """Replace partitions and commit; tried again as long as other writers come first.

    `chosen` tells from the newest manifest (None without one) the partitions to replace, `made` their new
    rows, of all of them or of those given. After a lost race only the partitions that have changed in the
    meantime are made again.
    """
    keys = list(PARTITIONS)
    fresh = used = None
    for _ in range(ATTEMPTS):
        known = facts.manifests(spark, path)
        newest = known[-1] if known else None
        held = facts.read_manifest(spark, path, newest) if newest else None
        touched = chosen(held)
        before = None if held is None else held.join(touched, keys, "left_semi")
        if fresh is None:
            fresh = write_version(made(held, None), path)
        elif before is not None:
            changed = _changed(used, before)
            # a first version made of a full refresh holds partitions that were not chosen
            fresh = fresh.join(touched, keys, "left_semi")
            if not changed.isEmpty():
                again = write_version(made(held, changed), path)
                fresh = fresh.join(changed, keys, "left_anti").unionByName(again)
        used = before
        entries = fresh if held is None else held.join(touched, keys, "left_anti").unionByName(fresh)
        if commit(entries, path, newest):
            return
    raise RuntimeError(f"{ATTEMPTS} other writers came first: {path}")


def _changed(used: DataFrame | None, now: DataFrame) -> DataFrame:
    """Partitions that have another version now, or only now one, or none any more."""
    if used is None:
        return now.select(*PARTITIONS)
    return used.exceptAll(now).unionByName(now.exceptAll(used)).select(*PARTITIONS).distinct()


def compact_facts(spark: SparkSession, base: str, stem: str, profile: Profile, most: int = MOST_VERSIONS) -> bool:
    """Write the partitions of small versions anew, together, until at most `most` versions hold all."""
    path = folder(base, stem)

    def scattered(held: DataFrame | None) -> DataFrame:
        if held is None:
            return spark.createDataFrame([], facts.MANIFEST).select(*PARTITIONS)
        sizes = held.groupBy("version").count().orderBy(F.desc("count"), F.desc("version")).collect()
        large = [row["version"] for row in sizes[: most - 1]]
        return held.where(~F.col("version").isin(large)).select(*PARTITIONS)

    known = facts.manifests(spark, path)
    if not known or facts.read_manifest(spark, path, known[-1]).select("version").distinct().count() <= most:
        return False

    def together(held: DataFrame, changed: DataFrame | None) -> DataFrame:
        rows = held.join(scattered(held), list(PARTITIONS), "left_semi")
        rows = rows if changed is None else rows.join(changed, list(PARTITIONS), "left_semi")
        return facts.scan_versions(spark, path, profile, rows)

    replace_partitions(spark, path, scattered, together)
    return True


def vacuum_facts(spark: SparkSession, base: str, stem: str, keep: int = KEPT_MANIFESTS, grace: float = GRACE) -> list[str]:
    """Remove what none of the last `keep` manifests names, once it is `grace` seconds old; returns the folders.

    A merge under way has no manifest yet; the grace is to be longer than any merge. Readers of the kept
    manifests find all their versions. The partitions of a full refresh go with the first manifest that is kept.
    """
    path = folder(base, stem)
    known = facts.manifests(spark, path)
    if not known:
        return []
    kept = known[-keep:]
    named = {row["version"] for one in kept for row in facts.read_manifest(spark, path, one).select("version").distinct().collect()}
    entries = {facts.manifest_entries(spark, one).rpartition("/")[2] for one in kept}
    limit = 1000 * (time.time() - grace)
    found = [e for e in listing.folders(spark, f"{path}/version=*") if int(e.name.partition("=")[2]) not in named]
    found += [e for e in listing.folders(spark, f"{path}/{MANIFESTS}/entries-*") if e.name not in entries]
    found += [*facts.plain_partitions(spark, path), *known[:-keep]]
    claims = sorted(listing.entries(spark, f"{path}/{MANIFESTS}/{_CLAIMS}/[0-9]*"), key=lambda e: int(e.name))
    found += [e for e in claims[:-1] if int(e.name) not in named]  # the greatest one bounds the next number
    gone = [entry.path for entry in found if entry.modified <= limit]
    for one in gone:
        listing.remove(spark, one)
    return gone
