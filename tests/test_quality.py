from __future__ import annotations

import pytest

from faultline.operators import quality


@pytest.fixture(scope="module")
def sample(spark):
    long = "x" * 100
    rows = [
        (None, "", long, "a"), (None, "  ", long, "a"), ("1", None, long + "y", "b"),
        ("1", "v", " " * 90, "b"),
    ]
    return spark.createDataFrame(rows, "a string, b string, c string, make string")


def _by_field(df):
    return {row["field"]: row.asDict() for row in df.collect()}


def test_field_profile_counts(sample):
    got = _by_field(quality.field_profile(sample))
    assert (got["a"]["nulls"], got["a"]["blanks"], got["a"]["duplicates"]) == (2, 0, 2)
    assert (got["b"]["nulls"], got["b"]["blanks"], got["b"]["duplicates"]) == (1, 2, 0)
    assert (got["c"]["blanks"], got["c"]["duplicates"]) == (1, 1)
    assert got["a"]["missing_pct"] == 50.0 and got["a"]["severity"] == "WARN"
    assert got["b"]["severity"] == "HIGH" and got["make"]["severity"] == ""


def test_field_profile_keeps_column_order(sample):
    rows = quality.field_profile(sample).collect()
    assert [r["field"] for r in rows] == sample.columns


def test_compat_subtracts_nulls_twice(spark):
    df = spark.createDataFrame([(None,), (None,), ("",), (" ",), ("x",)], "a string")
    assert _by_field(quality.field_profile(df))["a"]["blanks"] == 2
    compat = _by_field(quality.field_profile(df, compat=True))["a"]
    assert (compat["blanks"], compat["missing"]) == (0, 2)


def test_approximate_profile_agrees_on_small_data(sample):
    exact = _by_field(quality.field_profile(sample))
    assert _by_field(quality.field_profile(sample, approximate=True)) == exact


def test_null_fields_need_every_row_missing(spark):
    rows = [(None, "x" if i == 0 else None) for i in range(3000)]
    profile = quality.field_profile(spark.createDataFrame(rows, "a string, b string"))
    assert _by_field(profile)["b"]["missing_pct"] == 100.0
    assert quality.null_fields(profile) == ["a"]


def test_identity_check(spark):
    df = spark.createDataFrame(
        [(None,), ("complaint_",), ("recall_",), ("complaint_None",), ("recall_1",)],
        "record_id string",
    )
    assert tuple(quality.identity_check(df).first()) == (1, 2)


def test_completeness_counts_within_source(spark):
    df = spark.createDataFrame(
        [("nhtsa_complaints", "01/01/2020", None), ("nhtsa_complaints", " ", None),
         ("nhtsa_recalls", None, "2020-01-01")],
        "source string, incident_date string, recall_date string",
    )
    got = _by_field(quality.date_completeness(df))
    assert set(got) == {"incident_date", "recall_date"}
    assert (got["incident_date"]["total"], got["incident_date"]["missing"]) == (2, 1)
    assert got["incident_date"]["warn"] and not got["recall_date"]["warn"]
    assert got["incident_date"]["sample"] == "01/01/2020"


def test_description_profile_of_empty_source(spark):
    df = spark.createDataFrame(
        [("nhtsa_complaints", "ab", None)], "source string, body string, consequence string"
    )
    got = _by_field(quality.description_profile(df))
    assert got["body"]["avg_length"] == 2
    assert got["consequence"]["total"] == 0 and got["consequence"]["missing_pct"] == 0.0


def test_numeric_anomalies(spark):
    df = spark.createDataFrame(
        [("1",), ("-1",), ("1001",), ("x",), (None,), ("",), ("1e3",)], "injuries string"
    )
    row = quality.numeric_anomalies(df).first()
    assert tuple(row) == ("injuries", 1, 2, 1, 1)
    bad = quality.bad_numeric_values(df).collect()
    assert [(r["place"], r["value"]) for r in bad] == [(1, ""), (2, "x")]


def test_checks_without_their_fields(spark):
    df = spark.createDataFrame([("complaint_",)], "record_id string")
    assert list(quality.from_figures(quality.figures(df))) == ["identity_check"]
    with pytest.raises(ValueError, match="none of the checked fields"):
        quality.numeric_anomalies(df)


def test_bad_values_stop_at_the_limit_per_field(spark):
    df = spark.range(50).selectExpr("concat('v', id) as injuries", "concat('w', id) as deaths")
    rows = quality.bad_numeric_values(df).collect()
    assert len(rows) == 10 and {r["place"] for r in rows} == {1, 2, 3, 4, 5}


def test_variants_and_summary(spark):
    df = spark.createDataFrame(
        [("s", "B"), ("s", "A"), ("s", "A"), (None, "A"), ("s", None)],
        "source string, make string",
    )
    assert [tuple(r) for r in quality.make_variants(df).collect()] == [
        ("A", 3), ("B", 1), (None, 1),
    ]
    assert quality.make_variant_total(df).first()[0] == 3
    assert [tuple(r) for r in quality.record_count_summary(df).collect()] == [
        ("s", "A", 2), ("s", "B", 1),
    ]


def test_rendered_profile_has_one_line_per_field(sample):
    lines = [r["value"] for r in quality.render_profile(quality.field_profile(sample)).collect()]
    assert len(lines) == 4 and lines[1].startswith("b ") and lines[1].endswith("HIGH")
