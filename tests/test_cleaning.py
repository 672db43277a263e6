from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline import schemas
from faultline.config import CLOUD, LOCAL
from faultline.operators import clean, dedupe, dims, makes
from tests.helpers import plan, texts


def test_absent_fields_are_skipped(spark):
    df = texts(spark, "x")
    for step in (clean.clean_numeric, clean.clean_booleans, clean.clean_scraped_at):
        assert step(df).columns == df.columns
    assert clean.clean_text(df, clean.text_placeholders(LOCAL)).columns == df.columns
    assert clean.clean_dates(df, LOCAL.date_formats).columns == df.columns


def test_profiles_differ_in_label_placeholder_only():
    local, cloud = clean.text_placeholders(LOCAL), clean.text_placeholders(CLOUD)
    assert {name for name in local if local[name] != cloud[name]} == {"component", "model"}
    assert cloud["component"] == "Unknown" and cloud["body"] == "N/A"


def test_dates_flag_before_filling(spark):
    df = spark.createDataFrame([("02/29/2021",), ("02/29/2020",)], "incident_date string")
    rows = clean.clean_dates(df, LOCAL.date_formats).collect()
    assert [tuple(r) for r in rows] == [
        (dt.date(9999, 12, 31), True),
        (dt.date(2020, 2, 29), False),
    ]


def test_date_format_is_chosen_by_the_column(spark):
    df = spark.createDataFrame(
        [("03/04/2020", "03/04/2020", "2020-01-15"), ("25/12/2020", "12/25/2020", ""),
         ("x", None, None)],
        "recall_date string, incident_date string, other string",
    )
    assert clean.choose_date_formats(df, ["recall_date", "incident_date", "other", "absent"]) == {
        "recall_date": ("d/M/yyyy",), "incident_date": ("M/d/yyyy",), "other": ("iso",),
    }
    empty = df.where("false")
    assert clean.choose_date_formats(empty)["recall_date"] == ("M/d/yyyy",)
    chosen = clean.clean_dates(df, clean.choose_date_formats(df, ["recall_date"]))
    assert [str(r["recall_date"]) for r in chosen.collect()] == [
        "2020-04-03", "2020-12-25", "9999-12-31",
    ]


def test_event_date_without_recall_dates(spark):
    df = spark.createDataFrame(
        [("nhtsa_complaints", dt.date(2020, 1, 1)), ("nhtsa_recalls", dt.date(2020, 1, 1))],
        "source string, incident_date date",
    )
    rows = clean.add_event_date(df).collect()
    assert [r["event_date_missing"] for r in rows] == [False, True]


def test_wall_clock_follows_daylight_saving(spark):
    df = texts(spark, "2026-06-06T20:03:41Z", "2026-01-06T20:03:41Z").select(
        F.col("value").alias("scraped_at")
    )
    shown = clean.wall_clock(clean.clean_scraped_at(df), "America/Chicago").collect()
    assert [r["scraped_at_local"].hour for r in shown] == [15, 14]


@pytest.mark.parametrize(
    ("raw", "code", "make_id"),
    [
        ("FORD MOTOR COMPANY.", "FORD", 1),
        ("Stanford", "FORD", 1),
        (" toyota..", "TOYOTA", 0),
        ("Ford Toyota", "TOYOTA", 0),
        ("Honda", "UNKNOWN", -1),
        (None, "UNKNOWN", -1),
    ],
)
def test_make_mapping(spark, raw, code, make_id):
    df = spark.createDataFrame([(raw,)], "make string")
    row = makes.normalise_make(df).first()
    assert (row["make"], row["make_id"]) == (code, make_id)
    assert row["make_raw"] == (raw.strip() if raw else None)


def test_keyword_table_equals_keyword_chain(spark):
    raws = ["FORD MOTOR COMPANY.", "Stanford", "Ford Toyota", "Honda", None, "", "t", "tesla ford"]
    df = spark.createDataFrame([(i, raw) for i, raw in enumerate(raws)], "id int, make string")
    table = spark.createDataFrame(
        [("toyota", "TOYOTA", 0, 0), ("ford", "FORD", 1, 1), ("tesla", "TESLA", 2, 2),
         ("ford", "LATER", 9, 8)],
        "keyword string, make string, make_id bigint, priority int",
    )
    wanted = makes.normalise_make(df).select("id", "make_raw", "make", "make_id")
    found = makes.normalise_make_join(df, table).select(wanted.columns)
    assert sorted(found.collect()) == sorted(wanted.collect())
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)


def test_null_columns_are_exact(spark):
    rows = [(None, " ", "x" if i == 1999 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "a string, b string, c string").repartition(4)
    assert clean.null_columns(df) == ["a", "b"]
    assert clean.drop_null_columns(df).columns == ["c"]
    assert clean.drop_null_columns(df, ["c", "absent"]).columns == ["a", "b"]


def test_enforce_schema_types_and_defaults(spark):
    df = spark.createDataFrame(
        [("7.9", None, "x", None, None, 5)],
        "year string, source_weight string, week_added string, record_id string, "
        "crash_involved boolean, other int",
    )
    typed = clean.enforce_schema(df, LOCAL)
    assert tuple(typed.first()) == (7, 0.0, -1, None, False, 5)
    kinds = dict(typed.dtypes)
    assert kinds["year"] == "bigint" and kinds["source_weight"] == "double"
    assert kinds["other"] == "int"


def test_schemas_name_each_profile(spark):
    local, cloud = schemas.curated_types(LOCAL), schemas.curated_types(CLOUD)
    assert "body_sentiment_id" in local and "event_date" not in local
    assert "event_date" in cloud and "etl_timestamp" in cloud and "body_sentiment_id" not in cloud
    assert list(local)[-2:] == ["make", "year"]
    assert isinstance(schemas.curated(LOCAL), T.StructType)


def test_exact_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "")], "x string, y string")
    assert dedupe.drop_exact_duplicates(df).count() == 2
    assert tuple(dedupe.duplicate_rows(df).first()) == (3, 1)


def test_duplicate_counts_of_empty_frame(spark):
    df = spark.createDataFrame([], "x string")
    assert tuple(dedupe.duplicate_rows(df).first()) == (0, 0)


def test_digest_separates_neighbouring_columns(spark):
    df = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), (None, "-"), ("-", None), ("", None)], "x string, y string"
    )
    assert tuple(dedupe.duplicate_rows(df).first()) == (5, 0)


def test_digest_follows_equality_of_doubles(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "x double")
    assert tuple(dedupe.duplicate_rows(df).first()) == (3, 1)


def test_digest_rejects_nested_columns(spark):
    with pytest.raises(ValueError, match="no digest"):
        dedupe.duplicate_rows(spark.createDataFrame([([1],)], "x array<int>"))


def test_duplicate_samples_hold_all_members(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), ("c",)], "x string")
    rows = sorted(r["x"] for r in dedupe.duplicate_samples(df).collect())
    assert rows == ["a", "a", "c", "c", "c"]
    assert dedupe.duplicate_samples(df, 2).count() == 2


def test_dedupe_by_key_keeps_latest(spark):
    df = spark.createDataFrame(
        [("r1", "FORD", "A", 2015, 1, "old"), ("r1", "FORD", "A", 2015, 2, "new"),
         ("r1", "FORD", "A", 2016, 1, "other year"), ("r1", "FORD", "A", 2015, None, "none"),
         (None, "FORD", "A", 2015, 1, "no id"), (None, "FORD", "A", 2015, 3, "no id"),
         ("complaint_", "FORD", "A", 2015, 1, "x"), ("complaint_", "FORD", "A", 2015, 1, "y")],
        "record_id string, make string, model string, year int, scraped_at int, body string",
    )
    kept = sorted(r["body"] for r in dedupe.dedupe_by_key(df).collect())
    assert kept == ["new", "no id", "other year", "x", "y"]


def test_dedupe_by_key_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as record_id", "id as scraped_at")
    text = plan(dedupe.dedupe_by_key(df, ["record_id"]))
    assert "WindowGroupLimit" in text[text.index("Exchange"):]


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    rows = dedupe.union_all(a, b).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, None, "y")]


def test_dimensions(spark):
    assert [tuple(r) for r in dims.dim_make(spark).collect()] == [
        (0, "TOYOTA", "Toyota"), (1, "FORD", "Ford"), (2, "TESLA", "Tesla"),
        (-1, "UNKNOWN", "Unknown"),
    ]
    labels = {r["sentiment_id"]: r["sentiment_label"] for r in dims.dim_sentiment(spark).collect()}
    assert labels == {3: "positive", 2: "neutral", 1: "negative", 0: "critical", -1: "N/A"}
    facts = spark.createDataFrame([(1,), (1,), (7,)], "make_id bigint")
    used = {r["make"]: r["record_count"] for r in
            dims.dim_usage(facts, dims.dim_make(spark), "make_id").collect()}
    assert used == {"TOYOTA": 0, "FORD": 2, "TESLA": 0, "UNKNOWN": 0}
    assert dims.with_dim(facts, dims.dim_make(spark), "make_id").count() == 3


def test_enforce_schema_reads_raw_texts(spark):
    df = spark.createDataFrame(
        [("maybe", "nan", "2020-01-15"), ("true", "1.5", "soon"), (None, None, None)],
        "crash_involved string, source_weight string, recall_date string",
    )
    typed = clean.enforce_schema(df, LOCAL)
    assert dict(typed.dtypes) == {"crash_involved": "boolean", "source_weight": "double", "recall_date": "date"}
    rows = [tuple(map(str, r)) for r in typed.collect()]
    assert rows == [("False", "0.0", "2020-01-15"), ("True", "1.5", "None"), ("False", "0.0", "None")]
    undefined = spark.createDataFrame([(float("nan"),)], "source_weight double")
    assert clean.enforce_schema(undefined, LOCAL).first()[0] == 0.0
