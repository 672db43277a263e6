from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.functions import columns as C
from tests.helpers import evaluate

V = "value"


def test_whitespace_is_what_unicode_says():
    every = {chr(code) for code in range(0x110000) if chr(code).isspace()}
    assert set(C.WHITESPACE) == every


def test_number_edges(spark):
    values = ["1_000", "1.5d", "Infinity", "1e3", "2.9", " 5 ", "-5", "", "abc", None, ".5", "+7",
              "-2.9", "1e400", "9007199254740993", "0x10", "NaN"]
    expected = [None, None, None, 1000, 2, 5, -5, None, None, None, 0, 7, -2, None,
                9007199254740993, None, None]
    assert evaluate(spark, C.to_whole(F.col(V)), *values) == expected


def test_text_placeholders(spark):
    values = ["N/A", "Unknown", None, "Null", "null", "nan", "None", "", " \t ", " x\n"]
    expected = ["N/A", "Unknown", "PH", "Null", "PH", "PH", "PH", "PH", "PH", "x"]
    assert evaluate(spark, C.fill_text(F.col(V), "PH"), *values) == expected


def test_date_edges(spark):
    values = ["02/29/2020", "02/29/2021", "13/45/2020", "", None, " 1/5/2020 ", "2020-01-15",
              "2020-01-15T10:00:00", "12/31/9999"]
    expected = [dt.date(2020, 2, 29), None, None, None, None, dt.date(2020, 1, 5),
                dt.date(2020, 1, 15), dt.date(2020, 1, 15), None]
    assert evaluate(spark, C.to_date_any(F.col(V), ("M/d/yyyy", "iso")), *values) == expected


def test_first_date_format_wins(spark):
    both = C.to_date_any(F.col(V), ("M/d/yyyy", "d/M/yyyy"))
    assert evaluate(spark, both, "03/04/2020", "25/12/2020") == [
        dt.date(2020, 3, 4),
        dt.date(2020, 12, 25),
    ]


def test_flag_edges(spark):
    values = ["Y", "1.0", None, " TRUE ", "yes", "1", "false", ""]
    expected = [False, False, False, True, True, True, False, False]
    assert evaluate(spark, C.to_flag(F.col(V)), *values) == expected


def test_instant_offsets(spark):
    values = ["2026-06-06T20:03:41+00:00", "2026-06-06T15:03:41-05:00", "2026-06-06 20:03:41", "x"]
    shown = F.date_format(C.to_instant(F.col(V)), "yyyy-MM-dd HH:mm:ss")
    assert evaluate(spark, shown, *values) == ["2026-06-06 20:03:41"] * 3 + [None]


def test_percent_rounds_half_away_and_handles_empty_whole(spark):
    df = spark.createDataFrame([(1, 800), (5, 0), (1, 3)], "a bigint, b bigint")
    got = [r[0] for r in df.select(C.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [0.13, None, 33.33]


def test_report_percent_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 80), (3, 80), (0, 0)], "a bigint, b bigint")
    got = [r[0] for r in df.select(C.report_percent(F.col("a"), F.col("b"))).collect()]
    assert got == [1.2, 3.8, 0.0]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(
        st.text(alphabet=st.sampled_from(list(C.WHITESPACE + "ab.é字")), max_size=8),
        min_size=1,
        max_size=30,
    )
)
def test_strip_and_blank_match_unicode_rules(spark, values):
    assert evaluate(spark, C.strip(F.col(V)), *values) == [v.strip() for v in values]
    assert evaluate(spark, C.is_blank(F.col(V)), *values) == [v.strip() == "" for v in values]


@pytest.mark.parametrize("value", [None, "", "7"])
def test_record_key(spark, value):
    key = C.record_key("complaint_", F.col(V))
    assert evaluate(spark, key, value) == ["complaint_" + (value or "")]
