"""The analytic questions over the facts.

Each question reads the facts once. Figures of complaints and recalls that belong to the
same group come from one conditional aggregation instead of two aggregations and a join,
so a table of any size is scanned once and only group totals are shuffled.

Every question accepts the facts themselves, or the tally made from them by `roll_up`:
the tally has one row per make, model, component, year and source, so a set of questions
costs one scan of the facts.
"""

from __future__ import annotations

from functools import partial
from inspect import signature

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import (
    COMPLAINTS,
    FIRST_YEAR,
    LAST_YEAR,
    MISSING_INT,
    MISSING_TEXT,
    RECALLS,
    UNKNOWN_MAKE,
    Profile,
)
from faultline.functions import columns as C

TALLY_KEYS = ("make", "model", "component", "year", "source")
_MEASURES = (
    "records",
    "crashes",
    "injured",
    "units",
    "units_reported",
    "known_units",
    "known_units_reported",
)

# The statuses as reports show them.
STATUS_HIGH = "high concern — no recall"
STATUS_NONE = "no recall issued"
STATUS_EXISTS = "recall exists"


def _is_complaint() -> Column:
    return F.col("source") == COMPLAINTS


def _is_recall() -> Column:
    return F.col("source") == RECALLS


def is_tally(rows: DataFrame) -> bool:
    """Whether the columns are those of a tally, all of them and no others."""
    return set(rows.columns) == {*TALLY_KEYS, *_MEASURES}


def tally(facts: DataFrame) -> DataFrame:
    """Facts as additive measures, one row per record; a tally passes through.

    A projection only, so column pruning and filters still reach the scan. Units are kept twice,
    with and without the -1 that stands for missing ones.
    """
    if is_tally(facts):
        return facts
    units = F.col("units_affected")
    known = F.nullif(units, F.lit(MISSING_INT))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return facts.select(
        *TALLY_KEYS,
        one.alias("records"),
        F.when(F.col("crash_involved"), one).otherwise(none).alias("crashes"),
        F.when(F.col("injuries") > 0, F.col("injuries")).otherwise(none).alias("injured"),
        units.alias("units"),
        F.when(units.isNotNull(), one).otherwise(none).alias("units_reported"),
        known.alias("known_units"),
        F.when(known.isNotNull(), one).otherwise(none).alias("known_units_reported"),
    )


def roll_up(facts: DataFrame) -> DataFrame:
    """The tally summed per key: all questions below can be answered from it."""
    return tally(facts).groupBy(*TALLY_KEYS).agg(*[F.sum(name).alias(name) for name in _MEASURES])


def _sum_where(condition: Column, measure: str) -> Column:
    return F.sum(F.when(condition, F.col(measure)).otherwise(0))


def _complaints(measure: str = "records") -> Column:
    return _sum_where(_is_complaint(), measure)


def _recalls(measure: str = "records") -> Column:
    return _sum_where(_is_recall(), measure)


def _known_makes(facts: DataFrame) -> DataFrame:
    return tally(facts).where(F.col("make") != UNKNOWN_MAKE)


def _desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def recall_complaint_ratio(facts: DataFrame) -> DataFrame:
    """Recalls per hundred complaints of each make, and units recalled."""
    return (
        _known_makes(facts)
        .groupBy("make")
        .agg(
            _complaints().alias("complaint_count"),
            _recalls().alias("recall_count"),
            _recalls("units").alias("total_units_affected"),
        )
        .select(
            "make",
            "complaint_count",
            "recall_count",
            C.percent(F.col("recall_count"), F.col("complaint_count")).alias(
                "recall_to_complaint_pct"
            ),
            "total_units_affected",
        )
        .orderBy(_desc("recall_to_complaint_pct"), "make")
    )


def _crash_rates(facts: DataFrame, keys: list[str], label: str, placeholder: str) -> DataFrame:
    return (
        _known_makes(facts)
        .where(_is_complaint() & (F.col(label) != placeholder))
        .groupBy(*keys)
        .agg(F.sum("records").alias("complaint_count"), F.sum("crashes").alias("crash_count"))
        .withColumn("crash_rate_pct", C.percent(F.col("crash_count"), F.col("complaint_count")))
    )


def component_crash_rate(
    facts: DataFrame, placeholder: str = MISSING_TEXT, at_least: int = 10, top: int = 20
) -> DataFrame:
    """Components with the highest crash rate; ties by complaints, then name."""
    return (
        _crash_rates(facts, ["component"], "component", placeholder)
        .where(F.col("complaint_count") >= at_least)
        .orderBy(_desc("crash_rate_pct"), _desc("complaint_count"), "component")
        .limit(top)
    )


def component_brand_crash_rate(
    facts: DataFrame, placeholder: str = MISSING_TEXT, at_least: int = 5
) -> DataFrame:
    """Crash rate per make and component."""
    return (
        _crash_rates(facts, ["make", "component"], "component", placeholder)
        .where(F.col("complaint_count") >= at_least)
        .orderBy("make", _desc("crash_rate_pct"))
    )


def weighted_brand_risk(
    facts: DataFrame, placeholder: str = MISSING_TEXT, at_least: int = 10
) -> DataFrame:
    """Crash rate of each make's components, weighted by the make's complaints.

    A component's rate covers all makes, unknown ones included; the window runs over the
    totals per make and component, so a component's group is as long as the make list.
    """
    across_makes = Window.partitionBy("component")
    n, crashes = F.col("records"), F.col("crashes")
    by_pair = (
        tally(facts)
        .where(_is_complaint() & (F.col("component") != placeholder))
        .groupBy("make", "component")
        .agg(F.sum(n).alias("records"), F.sum(crashes).alias("crashes"))
        .select(
            "make",
            "records",
            F.sum(n).over(across_makes).alias("component_records"),
            F.sum(crashes).over(across_makes).alias("component_crashes"),
        )
        .where((F.col("component_records") >= at_least) & (F.col("make") != UNKNOWN_MAKE))
        .withColumn("rate", C.ratio(F.col("component_crashes"), F.col("component_records")))
    )
    weighted = F.sum(n * F.col("rate")) / F.nullif(F.sum(n), F.lit(0)) * F.lit(100.0)
    return (
        by_pair.groupBy("make")
        .agg(F.round(weighted, 2).alias("weighted_crash_risk_pct"))
        .orderBy(_desc("weighted_crash_risk_pct"), "make")
    )


def model_complaints(facts: DataFrame, placeholder: str = MISSING_TEXT) -> DataFrame:
    """Complaints and crash rate per model."""
    return _crash_rates(facts, ["make", "model"], "model", placeholder).orderBy(
        "make", _desc("complaint_count")
    )


def model_recalls(
    facts: DataFrame, placeholder: str = MISSING_TEXT, exclude_sentinels: bool = False
) -> DataFrame:
    """Recalls and units recalled per model; a campaign counts once per row.

    `exclude_sentinels` leaves out the -1 that stands for missing units.
    """
    units = "known_units" if exclude_sentinels else "units"
    return (
        tally(facts)
        .where(_is_recall() & (F.col("make") != UNKNOWN_MAKE) & (F.col("model") != placeholder))
        .groupBy("make", "model")
        .agg(
            F.sum("records").alias("recall_count"),
            F.sum(units).alias("total_units_affected"),
            C.ratio(F.sum(units), F.sum(f"{units}_reported")).alias("avg_units_per_recall"),
        )
        .orderBy("make", _desc("recall_count"))
    )


def recall_campaigns(facts: DataFrame, placeholder: str = MISSING_TEXT) -> DataFrame:
    """Distinct recall campaigns per model, where `model_recalls` counts rows. Facts only."""
    return (
        facts.where(
            _is_recall() & (F.col("make") != UNKNOWN_MAKE) & (F.col("model") != placeholder)
        )
        .groupBy("make", "model")
        .agg(F.count_distinct("record_id").alias("campaign_count"))
        .orderBy("make", _desc("campaign_count"))
    )


def model_scorecard(
    facts: DataFrame, placeholder: str = MISSING_TEXT, how: str = "left"
) -> DataFrame:
    """Complaints beside recalls per model.

    `left` lists the models with complaints; `full` also those with recalls only.
    """
    if how not in ("left", "full"):
        raise ValueError(f"how must be 'left' or 'full', not {how!r}")
    cards = (
        _known_makes(facts)
        .where((F.col("model") != placeholder) & (_is_complaint() | _is_recall()))
        .groupBy("make", "model")
        .agg(
            _complaints().alias("complaint_count"),
            _recalls().alias("recall_count"),
            F.coalesce(_recalls("units"), F.lit(0).cast("bigint")).alias("units_affected"),
        )
        .withColumn(
            "recall_to_complaint_pct", C.percent(F.col("recall_count"), F.col("complaint_count"))
        )
    )
    if how == "left":
        cards = cards.where(F.col("complaint_count") > 0)
    return cards.orderBy("make", _desc("complaint_count"))


def year_trend(
    facts: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR
) -> DataFrame:
    """Complaints and recalls per make and year within the years given."""
    return (
        _known_makes(facts)
        .where(F.col("year").between(first_year, last_year))
        .groupBy("make", "year")
        .agg(_complaints().alias("complaints"), _recalls().alias("recalls"))
        .orderBy("make", "year")
    )


def _totals(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        _complaints().alias("complaints"),
        _recalls().alias("recalls"),
        F.sum("records").alias("total"),
    )


def brand_totals(facts: DataFrame) -> DataFrame:
    """Complaints, recalls and all records per make."""
    return _totals(_known_makes(facts), "make").orderBy(_desc("total"), "make")


def model_totals(facts: DataFrame, placeholder: str = MISSING_TEXT) -> DataFrame:
    """Complaints, recalls and all records per model."""
    named = _known_makes(facts).where(F.col("model") != placeholder)
    return _totals(named, "make", "model").orderBy("make", _desc("total"))


def _with_brand_total(groups: DataFrame, measure: str, name: str) -> DataFrame:
    """Each group with the sum of its make's groups, as one more column.

    A make may have any number of groups, so they are summed in each task first and the few
    totals go back to them; no task holds a make.
    """
    totals = groups.groupBy("make").agg(F.sum(measure).alias(name))
    return groups.join(totals, "make")


def model_share_of_brand(facts: DataFrame, placeholder: str = MISSING_TEXT) -> DataFrame:
    """Each model's share of all complaints of its make.

    The make's total includes records without a model name, so it is taken before that filter.
    """
    groups = (
        _known_makes(facts)
        .where(_is_complaint())
        .groupBy("make", "model")
        .agg(F.sum("records").alias("complaints"))
    )
    return (
        _with_brand_total(groups, "complaints", "brand_total")
        .where(F.col("model") != placeholder)
        .withColumn(
            "pct_of_brand_complaints", C.percent(F.col("complaints"), F.col("brand_total"))
        )
        .select("make", "model", "complaints", "brand_total", "pct_of_brand_complaints")
        .orderBy("make", _desc("pct_of_brand_complaints"))
    )


def component_recall_gap(
    facts: DataFrame, placeholder: str = MISSING_TEXT, concern_from: int = 50
) -> DataFrame:
    """Components with complaints, whether a recall answers them, and their share.

    The share is of the make's complaints with a named component.
    """
    no_recall = F.col("recall_count") == 0
    worrying = (F.col("complaint_count") >= concern_from) & (F.col("crash_count") > 0)
    groups = (
        _known_makes(facts)
        .where((F.col("component") != placeholder) & (_is_complaint() | _is_recall()))
        .groupBy("make", "component")
        .agg(
            _complaints().alias("complaint_count"),
            _complaints("crashes").alias("crash_count"),
            _complaints("injured").alias("total_injuries"),
            _recalls().alias("recall_count"),
            F.coalesce(_recalls("units"), F.lit(0).cast("bigint")).alias("units_affected"),
        )
        .where(F.col("complaint_count") > 0)
    )
    share = C.percent(F.col("complaint_count"), F.col("brand_total"))
    return (
        _with_brand_total(groups, "complaint_count", "brand_total")
        .withColumn(
            "recall_status",
            F.when(no_recall & worrying, STATUS_HIGH)
            .when(no_recall, STATUS_NONE)
            .otherwise(STATUS_EXISTS),
        )
        .withColumn("pct_of_brand_complaints", share)
        .drop("brand_total")
        .orderBy("make", _desc("crash_count"), _desc("complaint_count"))
    )


def partition_point_lookup(facts: DataFrame, make: str, year: int, label: str) -> DataFrame:
    """Texts of one make and year with one sentiment label; reads one partition."""
    return (
        facts.where(
            (F.col("make") == make)
            & (F.col("year") == year)
            & (F.col("body_sentiment_label") == label)
        )
        .select("make", "year", "body", "body_sentiment_label")
        .orderBy("make", "year", "body_sentiment_label")
    )


def coverage_grid(facts: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    """Every requested combination with its counts; an empty request shows as zero."""
    counts = (
        tally(facts)
        .groupBy(*keys)
        .agg(_complaints().alias("complaints"), _recalls().alias("recalls"))
    )
    none = F.lit(0).cast("bigint")
    return grid.join(counts, keys, "left").select(
        *keys,
        F.coalesce("complaints", none).alias("complaints"),
        F.coalesce("recalls", none).alias("recalls"),
    )


# Name of the saved result -> question, in reporting order.
REPORTS = {
    "q1_recall_complaint_ratio": recall_complaint_ratio,
    "q2_component_crash_rate": component_crash_rate,
    "q2_component_brand": component_brand_crash_rate,
    "q2_weighted_brand_risk": weighted_brand_risk,
    "q3_model_complaints": model_complaints,
    "q3_model_recalls": model_recalls,
    "q3_model_scorecard": model_scorecard,
    "q4_year_trend": year_trend,
}
# The cloud report adds these; all its questions leave out the cloud profile's placeholder.
CLOUD_REPORTS = {
    "q5_brand_totals": brand_totals,
    "q6_model_totals": model_totals,
    "q7_model_share_of_brand": model_share_of_brand,
    "q8_component_recall_gap": component_recall_gap,
}


def report_questions(profile: Profile) -> dict:
    """Name of each saved result of a profile -> the question of the facts or the tally."""
    questions = REPORTS | (CLOUD_REPORTS if profile.label_placeholder != MISSING_TEXT else {})
    takes = {name: signature(question).parameters for name, question in questions.items()}
    return {
        name: partial(question, placeholder=profile.label_placeholder)
        if "placeholder" in takes[name]
        else question
        for name, question in questions.items()
    }
