"""The three jobs: validate the raw records, transform them to facts, answer the questions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faultline import schemas
from faultline.config import (
    DIM_SENTIMENT,
    FIRST_YEAR,
    LAST_YEAR,
    LOCAL,
    PROSE_FIELDS,
    UNKNOWN_MAKE,
    Profile,
)
from faultline.functions.lexicon import Lexicon, LexiconTable
from faultline.operators import clean, dedupe, makes, quality, sentiment
from faultline.plans import analytics
from faultline.session import fresh_path, shuffles_removed
from faultline.sinks import writers
from faultline.sources import listing
from faultline.sources.snapshots import snapshot_of


#: Rows that settle most columns as not empty.
_HEAD = 1000
#: Parts of the landed records that share no copies. They are taken on in rounds of about so many records, and
#: what a round shuffles is off the disk before the next one.
_SLICES = 16
_ROUND = 5_000_000
#: Bytes that a task buffers of each slice it writes.
_SLICE_BUFFER = 8 * 1024 * 1024


def transform(
    raw: DataFrame,
    profile: Profile,
    lexicon: Lexicon | LexiconTable | None = None,
    empty_columns: Iterable[str] | None = None,
    modifiers: bool = False,
) -> DataFrame:
    """Raw records to curated facts as one lazy plan; its only shuffle is the dedupe.

    `empty_columns` names the columns to drop, as `quality.null_fields` reads them from
    a stored profile; without it they are found in the data.
    """
    _ask_for_lexicon(profile, lexicon)
    _refuse_corrupt(raw)
    # Copies do not change which columns are empty, so the check reads the raw records.
    doomed = clean.null_columns(raw) if empty_columns is None else list(empty_columns)
    df = dedupe.drop_exact_duplicates(raw)
    return standardise(clean.drop_null_columns(df, doomed), profile, lexicon, modifiers)


def _ask_for_lexicon(profile: Profile, lexicon) -> None:
    if profile.with_sentiment and lexicon is None:
        raise ValueError("this profile scores texts: pass a lexicon")


def _refuse_corrupt(raw: DataFrame) -> None:
    """Records kept as corrupt text are no facts."""
    if schemas.CORRUPT in raw.columns:
        raise ValueError("split the unreadable records off first: snapshots.split_corrupt")


def standardise(
    df: DataFrame,
    profile: Profile,
    lexicon: Lexicon | LexiconTable | None = None,
    modifiers: bool = False,
    loaded: datetime | None = None,
) -> DataFrame:
    """The row-wise part of the transform: clean, map makes, score or date, type.

    `loaded` is the load time of profiles that have one, by default the time at which the plan runs.
    """
    _ask_for_lexicon(profile, lexicon)
    _refuse_corrupt(df)
    df = clean.clean_numeric(df)
    df = clean.clean_text(df, clean.text_placeholders(profile))
    df = clean.clean_dates(df, profile.date_formats)
    df = clean.clean_scraped_at(df)
    if profile.with_event_date:
        df = clean.add_event_date(df)
    df = clean.clean_booleans(df)
    df = makes.normalise_make(df, profile.make_keywords)
    if profile.with_sentiment:
        df = sentiment.score_columns(df, lexicon, PROSE_FIELDS, modifiers)
    if profile.with_etl_timestamp:
        df = clean.add_etl_timestamp(df, loaded)
    labels = [name for name in df.columns if name.endswith("_sentiment_label")]
    stripped = [*clean.text_placeholders(profile), "make", "make_raw", *labels]
    return clean.enforce_schema(df, profile, stripped)


@dataclass(frozen=True)
class RunSummary:
    path: str
    rows_read: int
    rows_written: int
    columns: int
    makes: dict[str, int]
    body_sentiment: dict[str, int]

    def figures(self) -> dict[str, int]:
        """All figures by name, for a table or a log."""
        return {
            "rows_read": self.rows_read,
            "rows_written": self.rows_written,
            "columns": self.columns,
            **{f"make:{make}": n for make, n in self.makes.items()},
            **{f"body_sentiment:{label}": n for label, n in self.body_sentiment.items()},
        }


def run_transform(
    raw: DataFrame,
    base: str,
    stem: str,
    profile: Profile,
    lexicon: Lexicon | LexiconTable | None = None,
    empty_columns: Iterable[str] | None = None,
    modifiers: bool = False,
) -> RunSummary:
    """Transform and write facts and dimensions; figures come from the write itself.

    The raw records are read once. Where the empty columns are to be found, all of them land as columns in the
    shared folder, in slices by a hash of the whole record. Copies share a slice, so rounds of slices
    are freed of them, transformed and written one after the other, and the disk holds what one
    round shuffles.
    """
    _ask_for_lexicon(profile, lexicon)
    _refuse_corrupt(raw)
    spark, started = raw.sparkSession, datetime.now(tz=timezone.utc)
    read, rows = Observation(), F.count(F.lit(1)).alias("rows")
    codes = [code for _, code, _ in profile.make_keywords] + [UNKNOWN_MAKE]
    figures = {f"make:{code}": F.col("make") == code for code in dict.fromkeys(codes)}

    def observed(facts: DataFrame) -> tuple[DataFrame, Observation]:
        asked = dict(figures)
        if "body_sentiment_label" in facts.columns:
            for _, label, _ in DIM_SENTIMENT:
                asked[f"label:{label}"] = F.col("body_sentiment_label") == label
        tests = [F.count_if(test).alias(name) for name, test in asked.items()]
        return facts.observe(written := Observation(), rows, *tests), written

    if empty_columns is None:
        landed = _landed_slices(raw.observe(read, rows))
        try:
            doomed = clean.null_columns(_slices(raw, landed), _HEAD)
            rounds = _rounds(spark, landed, read.get["rows"])
            total: Counter[str] = Counter()
            with shuffles_removed(spark):
                for k, paths in enumerate(rounds, 1):
                    single = dedupe.drop_exact_duplicates(_slices(raw, *paths))
                    kept = clean.drop_null_columns(single, doomed)
                    facts, written = observed(standardise(kept, profile, lexicon, modifiers, started))
                    path = writers.write_facts(facts, base, stem, begun=k > 1, unfinished=k < len(rounds))
                    total.update(written.get)
                    for done in paths:
                        listing.remove(spark, done)
        finally:
            listing.remove(spark, landed)
    else:
        facts, written = observed(transform(raw.observe(read, rows), profile, lexicon, empty_columns, modifiers))
        path = writers.write_facts(facts, base, stem)
        total = Counter(written.get)
    writers.write_dims(spark, base, profile.with_sentiment)

    def counts(kind: str) -> dict[str, int]:
        return {
            name.partition(":")[2]: value
            for name, value in total.items()
            if name.startswith(f"{kind}:")
        }

    return RunSummary(
        path=path,
        rows_read=read.get["rows"],
        rows_written=total["rows"],
        columns=len(facts.columns),
        makes=counts("make"),
        body_sentiment=counts("label"),
    )


def _landed_slices(raw: DataFrame) -> str:
    """The raw records as columns, a folder a slice; returns the path."""
    path = fresh_path(raw.sparkSession, "sliced")
    # in order, so that a task fills its files one after the other
    sliced = raw.withColumn("slice", dedupe.slice_number(raw, _SLICES)).sortWithinPartitions("slice")
    options = {"parquet.block.size": _SLICE_BUFFER, "compression": "zstd"}
    with shuffles_removed(raw.sparkSession):
        sliced.write.options(**options).partitionBy("slice").parquet(path)
    return path


def _slices(raw: DataFrame, *paths: str) -> DataFrame:
    """Landed records as they were read; a path is a slice, or holds all of them."""
    return raw.sparkSession.read.schema(raw.schema).parquet(*paths).select(*raw.columns)


def _rounds(spark: SparkSession, landed: str, rows: int) -> list[list[str]]:
    """The paths of the slices that are taken on together, at least one round of them.

    A folder written in several rounds is known as complete by its mark only, so sessions that write none
    take all slices on at once.
    """
    paths = [entry.path for entry in listing.folders(spark, f"{landed}/slice=*")]
    if listing.writes_no_marks(spark) or not paths:
        return [paths or [landed]]
    together = max(1, len(paths) * _ROUND // rows)
    n = -(-len(paths) // together)
    return [paths[k::n] for k in range(n)]


def run_validate(
    raw: DataFrame, folder: str, snapshots: list[str], compat: bool = False
) -> str:
    """Write the quality tables of the snapshots below one folder; returns its path.

    The raw records are read once: they land as columns in the shared folder, with a digest of each row.
    From there all plain counts share a pass, the frequency tables come from one table of counts, and
    samples are looked for only where a count says there are any. With a column `source_file` (provenance)
    the table field_profiles beside the reports gets a partition per snapshot.
    """
    path = f"{folder.rstrip('/')}/{writers.report_name(snapshots)}"
    raw, by_snapshot = _landed(raw), None
    if "source_file" in raw.columns:
        by_snapshot = raw.withColumn("snapshot", snapshot_of()).drop(*schemas.PROVENANCE, "_digest")
    raw, whole = raw.drop(*schemas.PROVENANCE, "_digest"), raw.drop(*schemas.PROVENANCE)

    def keep(name: str, table: DataFrame) -> DataFrame:
        return writers.write_profile(table, path, name)

    profile = keep("field_profile", quality.field_profile(raw, compat))
    writers.write_lines(quality.render_profile(profile), path, "field_profile_text")

    figures = keep("figures", quality.figures(raw, compat))
    for name, table in quality.from_figures(figures).items():
        keep(name, table)

    counts = keep("counts", quality.group_counts(raw, "source", "make"))
    keep("value_counts", quality.value_counts(counts, "source", "make", counted=True))
    keep("make_variants", quality.make_variants(counts, counted=True))
    keep("make_variant_total", quality.make_variant_total(counts))
    keep("record_count_summary", quality.record_count_summary(counts, counted=True))

    duplicates = keep("duplicate_rows", dedupe.duplicate_rows(whole, "_digest"))
    if duplicates.first()["duplicate_rows"]:
        keep("duplicate_samples", dedupe.duplicate_samples(whole, digest="_digest"))
    if by_snapshot is not None:
        writers.write_snapshot_profiles(quality.field_profile(by_snapshot, compat, by="snapshot"), folder)
    anomalies = quality.from_figures(figures).get("numeric_anomalies")
    if anomalies is not None and not anomalies.where("type_errors > 0").isEmpty():
        keep("bad_numeric_values", quality.bad_numeric_values(raw))
    return path


def _landed(raw: DataFrame) -> DataFrame:
    """The raw records as columns, with a digest of each row; where it was read does not count."""
    said = raw.drop(*schemas.PROVENANCE)
    path = fresh_path(raw.sparkSession, "raw")
    raw.withColumn("_digest", dedupe.row_digest(said)).write.parquet(path)
    return raw.sparkSession.read.schema(raw.schema.add("_digest", "binary")).parquet(path)


def run_analysis(
    facts: DataFrame,
    folder: str,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    profile: Profile = LOCAL,
) -> list[str]:
    """Answer all questions of the profile and save them as CSV.

    The facts are scanned once: their tally is written to the shared folder and every
    question reads it from there, also after a lost executor.
    """
    spark = facts.sparkSession
    tally_path = fresh_path(spark, "tally")
    analytics.roll_up(facts).write.parquet(tally_path)
    tally = spark.read.parquet(tally_path)
    results = {}
    for name, question in analytics.report_questions(profile).items():
        years = {"first_year": first_year, "last_year": last_year}
        results[name] = question(tally, **(years if question is analytics.year_trend else {}))
    return writers.write_results(results, folder)
