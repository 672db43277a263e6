"""Raw snapshots: one file or folder of JSON records per ingestion run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline import schemas
from faultline.config import FIRST_YEAR, LAST_YEAR, REQUEST_MODELS
from faultline.functions import columns as C
from faultline.operators.dedupe import union_all
from faultline.session import fresh_path
from faultline.sources import listing

LAYOUTS = ("auto", "lines", "array", "indented")


def read_snapshot(
    spark: SparkSession,
    path: str | list[str],
    layout: str = "auto",
    schema: T.StructType = schemas.RAW,
    keep_corrupt: bool = False,
    line_end: str = "\n",
    provenance: bool = False,
) -> DataFrame:
    """Records of one or more snapshots, every field as text, missing keys null.

    `lines` has one record per line and `indented` is an array dumped with an indent of
    two and the given line end; both split over tasks however long the file. `array`
    takes any formatting, one task per file. `auto` looks at the first lines of each path. Unreadable
    records end the job, or are kept in `_corrupt_record`. `provenance` adds the file of each record, the
    start of the block it was read from, and the file's time.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    if layout == "auto":
        groups: dict[tuple[str, str], list[str]] = {}
        for one in [path] if isinstance(path, str) else path:
            groups.setdefault(detect_layout(spark, one), []).append(one)
        return union_all(
            *[
                read_snapshot(spark, paths, kind, schema, keep_corrupt, end, provenance)
                for (kind, end), paths in groups.items()
            ]
        )
    mode = "PERMISSIVE" if keep_corrupt else "FAILFAST"
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    if layout == "indented":
        return _read_indented(spark, path, schema, mode, line_end, provenance)
    reader = spark.read.schema(schema).option("mode", mode)
    records = reader.option("multiLine", layout == "array").json(path)
    return records.select("*", *read_from()) if provenance else records


def read_from() -> list:
    """Columns that tell where a record was read."""
    return [F.col(f"_metadata.{name}").cast(kind).alias(column) for column, (name, kind) in schemas.PROVENANCE.items()]


def snapshot_of(file: str = "source_file"):
    """The snapshot that a file belongs to: its own name, or its folder's if that ends in .json."""
    text = F.url_decode(F.col(file))
    return F.regexp_extract(text, r"([^/]+)\.json(?:/[^/]*)?$", 1)


def split_corrupt(spark: SparkSession, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records and the quarantine table (raw text, reason, provenance), from one read.

    `records` were read with keep_corrupt and provenance. They are written once, in two partitions of one
    table, so the source is parsed once however often the parts are used. Nothing is lost: each record is
    in one part.
    """
    path = fresh_path(spark, "quarantine")
    bad = F.col(schemas.CORRUPT).isNotNull()
    # Spark refuses to look at the raw text alone, so the whole record is written with it
    records.withColumn("unreadable", bad).write.partitionBy("unreadable").parquet(path)
    kept = spark.read.schema(records.schema.add("unreadable", "boolean")).parquet(path)
    good = kept.where(~F.col("unreadable")).drop("unreadable", schemas.CORRUPT)
    raw = F.col(schemas.CORRUPT)
    kind = F.schema_of_variant(F.try_parse_json(raw))
    reason = F.when(C.is_blank(raw), "blank").when(kind.isNull(), "not JSON").when(~kind.startswith("OBJECT"), "no object").otherwise("wrong type")
    left = kept.where("unreadable").select(raw.alias("raw"), reason.alias("reason"), *schemas.PROVENANCE)
    return good, left


def detect_layout(spark: SparkSession, path: str) -> tuple[str, str]:
    """Layout and line end of a snapshot, from its first two lines; they alone are read."""
    first = [row["value"] for row in spark.read.option("lineSep", "\n").text(path).take(2)]
    head = [line.removesuffix("\r") for line in first]
    if head and head[0].startswith("{") and head[0].rstrip().endswith("}"):
        return "lines", "\n"
    if head == ["[", "  {"]:
        return "indented", "\r\n" if first[0].endswith("\r") else "\n"
    return "array", "\n"


def _read_indented(
    spark, path, schema: T.StructType, mode: str, line_end: str, provenance: bool
) -> DataFrame:
    # Text values cannot hold a raw line end, so the separator only occurs between records.
    pieces = spark.read.option("lineSep", f"{line_end}  }},{line_end}").text(path)
    body = F.regexp_replace("value", r"\A\s*(\[\s*)?|\s*(\]\s*)?\z", "")
    single = F.col("body").rlike(r"\A\{\s*\n") & ~F.col("body").rlike(r"\n\s*\},")
    closed = F.when(F.col("body").endswith("}"), F.col("body")).otherwise(
        F.concat("body", F.lit("}"))
    )
    # Other formatting would put several records into one piece: stop, do not lose any.
    wrong = F.raise_error(F.lit("not an array with an indent of two and this line end"))
    options = {"mode": mode, "columnNameOfCorruptRecord": schemas.CORRUPT}
    origin = list(schemas.PROVENANCE) if provenance else []
    return (
        pieces.select(body.alias("body"), *(read_from() if provenance else []))
        .where(F.col("body") != "")
        .select(F.when(single, closed).otherwise(wrong).alias("record"), *origin)
        .select(F.from_json("record", schema, options).alias("record"), *origin)
        .select("record.*", *origin)
    )


def list_snapshots(spark: SparkSession, folder: str) -> list[listing.Entry]:
    return listing.entries(spark, f"{folder.rstrip('/')}/*.json")


def latest_snapshot(spark: SparkSession, folder: str, by: str = "name") -> listing.Entry:
    """The snapshot with the greatest name, or the one written last."""
    if by not in ("name", "mtime"):
        raise ValueError(f"by must be 'name' or 'mtime', not {by!r}")
    found = list_snapshots(spark, folder)
    if not found:
        raise FileNotFoundError(f"no JSON snapshot in {folder}")
    return max(found, key=lambda e: e.name if by == "name" else (e.modified, e.name))


def read_entries(
    spark: SparkSession,
    found: list[listing.Entry],
    layout: str | None = None,
    keep_corrupt: bool = False,
    provenance: bool = False,
) -> DataFrame:
    """Listed snapshots appended. Without a layout, folders hold lines and files tell theirs."""
    paths: dict[str, list[str]] = {}
    for entry in found:
        kind = layout or ("lines" if entry.is_folder else "auto")
        paths.setdefault(kind, []).append(entry.path)
    return union_all(
        *[
            read_snapshot(spark, group, kind, keep_corrupt=keep_corrupt, provenance=provenance)
            for kind, group in paths.items()
        ]
    )


def read_all_snapshots(
    spark: SparkSession, folder: str, layout: str | None = None, provenance: bool = False
) -> tuple[DataFrame, list[str]]:
    """All snapshots of a folder appended, and their names."""
    found = list_snapshots(spark, folder)
    if not found:
        raise FileNotFoundError(f"no JSON snapshot in {folder}")
    records = read_entries(spark, found, layout, provenance=provenance)
    return records, [entry.name for entry in found]


def request_grid(
    spark: SparkSession,
    models: dict = REQUEST_MODELS,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
) -> DataFrame:
    """Every make, model and year that ingestion asks for."""
    pairs = [(make, model) for make, names in models.items() for model in names]
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    return spark.createDataFrame(pairs, "make string, model string").select(
        "make", "model", F.explode(years).alias("year")
    )
