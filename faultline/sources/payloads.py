"""Landed API payloads to raw records.

A payload row has the request parameters make, model, year, the arrival time fetched_at
and the response text. A response that cannot be read gives no records, as a failed
request does; `unreadable_payloads` counts them and `coverage_grid` shows the holes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.config import COMPLAINTS, RECALLS
from faultline.operators.dedupe import union_all

# Output field -> (source key, value if the key is absent).
COMPLAINT_KEYS = {
    "component": ("components", ""),
    "body": ("cdescription", ""),
    "incident_date": ("dateOfIncident", ""),
    "crash_involved": ("crash", "false"),
    "fire_involved": ("fire", "false"),
    "injuries": ("numberOfInjuries", "0"),
    "deaths": ("numberOfDeaths", "0"),
}
RECALL_KEYS = {
    "component": ("Component", ""),
    "body": ("Summary", ""),
    "consequence": ("Consequence", ""),
    "remedy": ("Remedy", ""),
    "recall_date": ("ReportReceivedDate", ""),
    "units_affected": ("PotentialNumberOfUnitsAffected", "0"),
}


# A map, unlike a struct, tells an absent key from one that is null.
_RESULTS = "results array<map<string,string>>"


def unreadable_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads per make, and those of them without a readable list of results."""
    readable = F.from_json("payload", _RESULTS)["results"].isNotNull()
    return payloads.groupBy("make").agg(
        F.count(F.lit(1)).alias("payloads"),
        F.count_if(~readable).alias("unreadable"),
    )


def _pick(item: Column, key: str, default: str) -> Column:
    """The value of a key; the default only if the key is absent, so null stays null."""
    # whether the key is there is looked up only where it has no value
    absent = F.when(~F.map_contains_key(item, key), F.lit(default))
    return F.coalesce(F.try_element_at(item, F.lit(key)), absent)


def _flatten(
    payloads: DataFrame, prefix: str, id_key: str, source: str, weight: float, keys: dict
) -> DataFrame:
    parsed = F.from_json("payload", _RESULTS)["results"]
    items = payloads.select("make", "model", "year", "fetched_at", F.explode(parsed).alias("item"))
    item = F.col("item")
    items = items.where(item.isNotNull())  # a null among the results is no record
    # A null id prints as None behind the prefix.
    identifier = F.coalesce(_pick(item, id_key, ""), F.lit("None"))
    return items.select(
        F.concat(F.lit(prefix), identifier).alias("record_id"),
        F.lit(source).alias("source"),
        F.lit(str(weight)).alias("source_weight"),
        "make",
        "model",
        F.col("year").cast("string").alias("year"),
        *[_pick(item, key, default).alias(name) for name, (key, default) in keys.items()],
        F.col("fetched_at").cast("string").alias("scraped_at"),
        F.lit("1").alias("week_added"),
    )


def flatten_complaints(payloads: DataFrame) -> DataFrame:
    return _flatten(payloads, "complaint_", "odiNumber", COMPLAINTS, 1.0, COMPLAINT_KEYS)


def flatten_recalls(payloads: DataFrame, weight: float) -> DataFrame:
    return _flatten(payloads, "recall_", "NHTSACampaignNumber", RECALLS, weight, RECALL_KEYS)


def raw_records(complaints: DataFrame, recalls: DataFrame, recall_weight: float) -> DataFrame:
    """Both kinds of payload as one set of raw records."""
    return union_all(flatten_complaints(complaints), flatten_recalls(recalls, recall_weight))
