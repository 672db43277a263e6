"""Explicit schemas: raw fields are all text, curated fields are typed per profile."""

from __future__ import annotations

from pyspark.sql import types as T

from faultline.config import PROSE_FIELDS, Profile

RAW_FIELDS = (
    "record_id", "source", "source_weight", "make", "model", "year", "component",
    "body", "consequence", "remedy", "incident_date", "recall_date",
    "crash_involved", "fire_involved", "injuries", "deaths", "units_affected",
    "scraped_at", "week_added",
)

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

CORRUPT = "_corrupt_record"

#: Where a record was read: column -> (field of Spark's file metadata, type).
PROVENANCE = {
    "source_file": ("file_path", "string"),
    "source_block": ("file_block_start", "bigint"),
    "source_modified": ("file_modification_time", "timestamp"),
}
QUARANTINE = "raw string, reason string, " + ", ".join(f"{name} {kind}" for name, (_, kind) in PROVENANCE.items())

DIM_MAKE = "make_id bigint, make string, make_label string"
DIM_SENTIMENT = "sentiment_id bigint, sentiment_label string, threshold string"

_BASE = {
    "record_id": "string", "source": "string", "source_weight": "double",
    "make_raw": "string", "make_id": "bigint", "model": "string",
    "component": "string", "body": "string", "consequence": "string",
    "remedy": "string", "incident_date": "date", "incident_date_missing": "boolean",
    "recall_date": "date", "recall_date_missing": "boolean",
    "crash_involved": "boolean", "fire_involved": "boolean", "injuries": "bigint",
    "deaths": "bigint", "units_affected": "bigint", "scraped_at": "timestamp",
    "week_added": "bigint",
}


def curated_types(profile: Profile) -> dict[str, str]:
    """Column name -> type of the facts, the partition columns last."""
    types = dict(_BASE)
    if profile.with_sentiment:
        for name in PROSE_FIELDS:
            types[f"{name}_sentiment_score"] = "double"
            types[f"{name}_sentiment_label"] = "string"
            types[f"{name}_sentiment_id"] = "bigint"
    if profile.with_event_date:
        types["event_date"] = "date"
        types["event_date_missing"] = "boolean"
    if profile.with_etl_timestamp:
        types["etl_timestamp"] = "timestamp"
    types["make"] = "string"
    types["year"] = "bigint"
    return types


def curated(profile: Profile, provenance: bool = False) -> T.StructType:
    types = curated_types(profile)
    if provenance:
        # before the partition columns, which stay last
        read_from = {name: kind for name, (_, kind) in PROVENANCE.items()}
        parts = {name: types.pop(name) for name in ("make", "year")}
        types = {**types, **read_from, **parts}
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in types.items()))
