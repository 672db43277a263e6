"""Cleaning: each step is one projection, so Catalyst folds the steps into one stage.

Every step skips fields the frame does not have.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.config import (
    BOOLEAN_FIELDS,
    COMPLAINTS,
    DATE_CANDIDATES,
    DATE_FIELDS,
    LABEL_FIELDS,
    MISSING_DATE,
    MISSING_FLOAT,
    MISSING_INT,
    NUMERIC_FIELDS,
    PROSE_FIELDS,
    Profile,
)
from faultline.functions import columns as C
from faultline.schemas import curated_types


def _present(df: DataFrame, fields: Iterable[str]) -> list[str]:
    return [name for name in fields if name in df.columns]


def clean_numeric(df: DataFrame, fields: Iterable[str] = NUMERIC_FIELDS) -> DataFrame:
    """Whole numbers; missing and non-numeric become -1."""
    return df.withColumns(
        {
            name: F.coalesce(C.to_whole(F.col(name)), F.lit(MISSING_INT).cast("bigint"))
            for name in _present(df, fields)
        }
    )


def clean_text(df: DataFrame, placeholders: dict[str, str]) -> DataFrame:
    """Strip, and replace null-like texts by the field's placeholder."""
    return df.withColumns(
        {
            name: C.fill_text(F.col(name), placeholders[name])
            for name in _present(df, placeholders)
        }
    )


def text_placeholders(profile: Profile) -> dict[str, str]:
    return {
        **{name: profile.label_placeholder for name in LABEL_FIELDS},
        **{name: profile.prose_placeholder for name in PROSE_FIELDS},
    }


def clean_dates(df: DataFrame, formats: dict[str, Iterable[str]]) -> DataFrame:
    """Dates with a `<field>_missing` flag; missing or unreadable become 9999-12-31."""
    fields = _present(df, formats)
    parsed = df.withColumns({name: C.to_date_any(F.col(name), formats[name]) for name in fields})
    flagged = parsed.withColumns({f"{name}_missing": F.col(name).isNull() for name in fields})
    return flagged.withColumns(
        {name: F.coalesce(F.col(name), F.lit(MISSING_DATE).cast("date")) for name in fields}
    )


def choose_date_formats(
    df: DataFrame,
    fields: Iterable[str] = DATE_FIELDS,
    candidates: Iterable[str] = DATE_CANDIDATES,
) -> dict[str, tuple[str, ...]]:
    """Per field the one format that reads most of its values, in one pass.

    For sources that do not state their format; the first candidate wins a tie, so the
    answer does not depend on the order of the rows.
    """
    fields, candidates = _present(df, fields), list(candidates)
    if not fields:
        return {}
    read = df.agg(
        *[
            F.count(C.to_date_any(F.col(name), (fmt,))).alias(f"{name}:{fmt}")
            for name in fields
            for fmt in candidates
        ]
    ).first()
    return {
        name: (max(candidates, key=lambda fmt: read[f"{name}:{fmt}"]),) for name in fields
    }


def clean_scraped_at(df: DataFrame, field: str = "scraped_at") -> DataFrame:
    """Text to instant; nulls are kept, because a missing load time is an ingestion fault."""
    return df.withColumns({name: C.to_instant(F.col(name)) for name in _present(df, [field])})


def wall_clock(df: DataFrame, zone: str, field: str = "scraped_at") -> DataFrame:
    """Add `<field>_local`: the instant as the clock of that zone shows it."""
    here = F.col(field).cast("timestamp_ntz")
    shown = F.convert_timezone(F.current_timezone(), F.lit(zone), here)
    return df.withColumn(f"{field}_local", shown)


def clean_booleans(df: DataFrame, fields: Iterable[str] = BOOLEAN_FIELDS) -> DataFrame:
    """True for the known words only."""
    return df.withColumns({name: C.to_flag(F.col(name)) for name in _present(df, fields)})


def add_event_date(df: DataFrame) -> DataFrame:
    """One date for both kinds of record: incident date of complaints, else recall date."""
    missing = F.lit(MISSING_DATE).cast("date")

    def either(name: str):
        return F.col(name) if name in df.columns else missing

    chosen = F.when(F.col("source") == COMPLAINTS, either("incident_date")).otherwise(
        either("recall_date")
    )
    return df.withColumn("event_date", chosen).withColumn(
        "event_date_missing", F.col("event_date") >= missing
    )


def add_etl_timestamp(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """The time of the load: `at`, or else when the plan runs."""
    return df.withColumn("etl_timestamp", F.current_timestamp() if at is None else F.lit(at))


def null_columns(df: DataFrame, head: int = 0) -> list[str]:
    """Columns that hold only nulls and blanks, from one pass over all rows.

    Columns with a value in the first `head` rows are settled by these, so the pass reads the others
    only: for written columns, that are cheap to read one by one.
    """
    open_ = df.columns
    for rows in (df.limit(head), df) if head else (df,):
        filled = [F.count_if(C.is_present(F.col(name).cast("string"))).alias(name) for name in open_]
        if not filled:
            return []
        found = rows.agg(*filled).first()
        open_ = [name for name in open_ if found[name] == 0]
    return open_


def drop_null_columns(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Drop the named columns, or the ones found empty in the data."""
    doomed = null_columns(df) if names is None else _present(df, names)
    return df.drop(*doomed)


def enforce_schema(
    df: DataFrame, profile: Profile, stripped: Iterable[str] = ()
) -> DataFrame:
    """One projection to the curated types.

    Unreadable whole numbers become -1, unreadable or undefined doubles 0.0, unknown booleans
    false, unreadable dates and times null; text is stripped and stays null if missing. Optional columns only if present;
    columns the schema does not name pass through. Texts named in `stripped` have been
    stripped already.
    """
    return df.select(*_typed(df, curated_types(profile), set(stripped)))


def _typed(df: DataFrame, kinds: dict[str, str], stripped: set[str]) -> list:
    out = []
    for column in df.schema:
        kind, value = kinds.get(column.name), F.col(column.name)
        if kind == "bigint":
            if not isinstance(column.dataType, T.IntegralType):
                value = C.to_whole(value)
            value = F.coalesce(value.cast("bigint"), F.lit(MISSING_INT).cast("bigint"))
        elif kind == "double":
            if not isinstance(column.dataType, T.NumericType):
                value = C.to_number(value)
            value = value.cast("double")
            value = F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.lit(MISSING_FLOAT))
        elif kind == "string" and column.name not in stripped:
            value = C.strip(value.cast("string"))
        elif kind == "boolean":
            value = F.coalesce(value.try_cast("boolean"), F.lit(False))
        elif kind in ("date", "timestamp") and column.dataType.simpleString() != kind:
            value = value.try_cast(kind)
        out.append(value.alias(column.name))
    return out
