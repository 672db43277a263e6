"""Command line: validate, transform, analyse, look up, compare profiles and maintain merged facts.

    python -m faultline validate  --raw data/raw --out data/reports
    python -m faultline transform --raw data/raw --out data/processed --lexicon words.tsv
    python -m faultline analyse   --facts data/processed --out data/analysis
    python -m faultline lookup    --facts data/processed --make FORD --year 2015 --label positive
    python -m faultline drift     --reports data/reports --before nhtsa_1 --after nhtsa_2
    python -m faultline maintain  --facts data/processed --stem all
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from faultline import schemas
from faultline.config import CLOUD, FIRST_YEAR, LAST_YEAR, LOCAL
from faultline.functions.lexicon import Lexicon
from faultline.operators import clean, quality
from faultline.plans import analytics, jobs
from faultline.session import prepare
from faultline.sinks import versions, writers
from faultline.sources import facts, snapshots

PROFILES = {profile.name: profile for profile in (LOCAL, CLOUD)}


def validate(spark: SparkSession, args: argparse.Namespace) -> None:
    raw, names = snapshots.read_all_snapshots(spark, args.raw, args.layout, provenance=True)
    print(jobs.run_validate(raw, args.out, names, args.compat))


def transform(spark: SparkSession, args: argparse.Namespace) -> None:
    profile = PROFILES[args.profile]
    latest = snapshots.latest_snapshot(spark, args.raw, args.latest)
    raw = snapshots.read_entries(
        spark, [latest], args.layout, keep_corrupt=bool(args.quarantine), provenance=args.provenance or bool(args.quarantine)
    )
    if args.quarantine:
        raw, bad = snapshots.split_corrupt(spark, raw)
        print(writers.write_quarantine(bad, args.quarantine))
    if not args.provenance:
        raw = raw.drop(*schemas.PROVENANCE)
    if args.infer_dates:
        profile = replace(profile, date_formats=clean.choose_date_formats(raw))
    lexicon = Lexicon.from_file(spark, args.lexicon) if args.lexicon else None
    empty = None
    if args.report:
        empty = quality.null_fields(spark.read.parquet(f"{args.report}/field_profile"))
    stem = latest.name.removesuffix(".json")
    print(jobs.run_transform(raw, args.out, stem, profile, lexicon, empty, args.modifiers))


def analyse(spark: SparkSession, args: argparse.Namespace) -> None:
    profile = PROFILES[args.profile]
    rows = facts.scan_facts(spark, args.facts, profile, args.snapshot)
    for path in jobs.run_analysis(rows, args.out, args.first_year, args.last_year, profile):
        print(path)


def lookup(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = facts.scan_facts(spark, args.facts, LOCAL, args.snapshot)
    found = analytics.partition_point_lookup(rows, args.make, args.year, args.label)
    for row in found.select(F.to_json(F.struct("*"))).toLocalIterator():
        print(row[0])  # whole rows, one partition in memory at a time


def drift(spark: SparkSession, args: argparse.Namespace) -> None:
    table = spark.read.parquet(f"{args.reports}/field_profiles")
    before, after = (table.where(F.col("snapshot") == name) for name in (args.before, args.after))
    for row in quality.profile_drift(before, after).orderBy("field").select(F.to_json(F.struct("*"))).collect():
        print(row[0])  # one row per field


def maintain(spark: SparkSession, args: argparse.Namespace) -> None:
    versions.compact_facts(spark, args.facts, args.stem, PROFILES[args.profile], args.versions)
    for path in versions.vacuum_facts(spark, args.facts, args.stem, args.keep, args.grace):
        print(path)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="faultline")
    commands = top.add_subparsers(required=True)

    def command(run, *folders: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__)
        sub.set_defaults(run=run, sized_by=folders[0])
        for folder in folders:
            sub.add_argument(f"--{folder}", required=True)
        return sub

    for run in (validate, transform):
        sub = command(run, "raw", "out")
        sub.add_argument("--layout", choices=snapshots.LAYOUTS)
        if run is validate:
            sub.add_argument("--compat", action="store_true")
        else:
            sub.add_argument("--profile", choices=PROFILES, default=LOCAL.name)
            sub.add_argument("--latest", choices=("name", "mtime"), default="name")
            sub.add_argument("--infer-dates", action="store_true")
            sub.add_argument("--lexicon")
            sub.add_argument("--modifiers", action="store_true")
            sub.add_argument("--quarantine")
            sub.add_argument("--provenance", action="store_true")
            sub.add_argument("--report")

    sub = command(analyse, "facts", "out")
    sub.add_argument("--profile", choices=PROFILES, default=LOCAL.name)
    sub.add_argument("--snapshot", default="latest")
    sub.add_argument("--first-year", type=int, default=FIRST_YEAR)
    sub.add_argument("--last-year", type=int, default=LAST_YEAR)

    sub = command(lookup, "facts")
    sub.add_argument("--snapshot", default="latest")
    sub.add_argument("--make", required=True)
    sub.add_argument("--year", type=int, required=True)
    sub.add_argument("--label", required=True)

    sub = command(drift, "reports")
    sub.add_argument("--before", required=True)
    sub.add_argument("--after", required=True)

    sub = command(maintain, "facts")
    sub.add_argument("--stem", required=True)
    sub.add_argument("--profile", choices=PROFILES, default=LOCAL.name)
    sub.add_argument("--versions", type=int, default=versions.MOST_VERSIONS)
    sub.add_argument("--keep", type=int, default=versions.KEPT_MANIFESTS)
    sub.add_argument("--grace", type=float, default=versions.GRACE)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("faultline").getOrCreate()
    prepare(spark, getattr(args, args.sized_by))
    args.run(spark, args)


if __name__ == "__main__":
    main()
