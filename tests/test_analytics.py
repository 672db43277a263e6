from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faultline.operators import quality
from faultline.plans import analytics as A
from faultline.plans import bindings as B
from tests.helpers import plan

SCHEMA = (
    "record_id string, make string, model string, component string, year int, source string, "
    "crash_involved boolean, injuries bigint, units_affected bigint"
)
C, R = "nhtsa_complaints", "nhtsa_recalls"


@pytest.fixture(scope="module")
def small(spark):
    rows = [
        ("c1", "FORD", "Escape", "BRAKES", 2015, C, True, 2, -1),
        ("c2", "FORD", "Escape", "BRAKES", 2015, C, False, -1, -1),
        ("c3", "FORD", "N/A", "N/A", 2016, C, None, 0, -1),
        ("r1", "FORD", "Escape", "BRAKES", 2015, R, False, -1, 100),
        ("r1", "FORD", "Escape", "BRAKES", 2016, R, False, -1, -1),
        ("r2", "FORD", "F-150", "AIR BAGS", 2030, R, False, -1, 7),
        ("c4", "UNKNOWN", "X", "BRAKES", 2015, C, True, 1, -1),
        ("r3", "TESLA", "Model 3", "SOFTWARE", 2020, R, False, -1, 50),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def facts(spark, sf_dir):
    return B.facts(spark, sf_dir).cache()


def _rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_ratio_of_make_without_complaints_is_null_and_last(small):
    assert _rows(A.recall_complaint_ratio(small)) == [
        ("FORD", 3, 3, 100.0, 106),
        ("TESLA", 0, 1, None, 50),
    ]


def test_scorecard_left_and_full(small):
    left = _rows(A.model_scorecard(small))
    assert left == [("FORD", "Escape", 2, 2, 99, 100.0)]
    full = {r[1] for r in _rows(A.model_scorecard(small, how="full"))}
    assert full == {"Escape", "F-150", "Model 3"}
    with pytest.raises(ValueError):
        A.model_scorecard(small, how="inner")


def test_sentinels_can_be_left_out(small):
    with_mark = {r[1]: r[2:] for r in _rows(A.model_recalls(small))}
    without = {r[1]: r[2:] for r in _rows(A.model_recalls(small, exclude_sentinels=True))}
    assert with_mark["Escape"] == (2, 99, 49.5)
    assert without["Escape"] == (2, 100, 100.0)


def test_campaigns_count_once(small):
    counts = {r[1]: r[2] for r in _rows(A.recall_campaigns(small))}
    assert counts == {"Escape": 1, "F-150": 1, "Model 3": 1}


def test_share_counts_unnamed_models_in_the_total(small):
    assert _rows(A.model_share_of_brand(small)) == [("FORD", "Escape", 2, 3, 66.67)]


def test_gap_statuses(small):
    (row,) = A.component_recall_gap(small).collect()
    assert (row["total_injuries"], row["recall_status"]) == (2, A.STATUS_EXISTS)
    complaints = small.where(F.col("source") == C)
    (row,) = A.component_recall_gap(complaints, concern_from=2).collect()
    assert row["recall_status"] == "high concern — no recall"
    (row,) = A.component_recall_gap(complaints).collect()
    assert row["recall_status"] == "no recall issued"


def test_weighted_risk_includes_unknown_makes_in_rates(small):
    assert _rows(A.weighted_brand_risk(small, at_least=2)) == [("FORD", 66.67)]


def test_year_range(small):
    years = {(r[0], r[1]) for r in _rows(A.year_trend(small))}
    assert years == {("FORD", 2015), ("FORD", 2016), ("TESLA", 2020)}


QUESTIONS = [
    A.recall_complaint_ratio, A.component_crash_rate, A.component_brand_crash_rate,
    A.weighted_brand_risk, A.model_complaints, A.model_recalls, A.model_scorecard, A.brand_totals,
    A.model_totals, A.model_share_of_brand, A.component_recall_gap,
]


@pytest.fixture(scope="module")
def tally(facts):
    return A.roll_up(facts).cache()


@pytest.mark.parametrize("question", QUESTIONS, ids=lambda q: q.__name__)
def test_tally_answers_as_the_facts_do(facts, tally, question):
    assert sorted(map(str, question(tally).collect())) == sorted(
        map(str, question(facts).collect())
    )


def test_totals_agree_between_questions(facts):
    q1 = {r["make"]: r for r in A.recall_complaint_ratio(facts).collect()}

    def total(df, column):
        rows = df.groupBy("make").agg(F.sum(column).alias("n")).collect()
        return {r["make"]: r["n"] for r in rows}

    complaints = {make: r["complaint_count"] for make, r in q1.items()}
    recalls = {make: r["recall_count"] for make, r in q1.items()}
    trend = A.year_trend(facts, 1900, 2100)
    assert total(A.model_complaints(facts), "complaint_count") == complaints
    assert total(A.model_scorecard(facts), "complaint_count") == complaints
    assert total(trend, "complaints") == complaints
    assert total(A.model_recalls(facts), "recall_count") == recalls
    assert total(trend, "recalls") == recalls
    card = total(A.model_scorecard(facts), "recall_count")
    assert all(card[make] <= recalls[make] for make in card)
    assert total(A.model_scorecard(facts, how="full"), "recall_count") == recalls


@pytest.mark.parametrize("question", QUESTIONS, ids=lambda q: q.__name__)
def test_each_question_scans_the_facts_once(spark, small, tmp_path, question):
    small.write.partitionBy("make", "year").parquet(str(tmp_path / "facts"))
    text = plan(question(spark.read.parquet(str(tmp_path / "facts"))))
    # shares of a make read the totals again, so that no task holds all groups of a make
    shares = question in (A.model_share_of_brand, A.component_recall_gap)
    assert text.count("FileScan") == 1 + shares
    assert ("Join" in text) == shares and "Window" not in text or question is A.weighted_brand_risk
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text
    assert "partial_" in text


def test_top_list_needs_no_full_sort(small):
    assert "TakeOrderedAndProject" in plan(A.component_crash_rate(small))


def test_questions_read_only_their_columns(spark, small, tmp_path):
    small.write.parquet(str(tmp_path / "facts"))
    text = plan(A.year_trend(spark.read.parquet(str(tmp_path / "facts"))))
    schema = text[text.index("ReadSchema"):].splitlines()[0]
    assert "component" not in schema and "injuries" not in schema and "year" in schema
    assert "PushedFilters: [" in text and "Not(EqualTo(make,UNKNOWN))" in text


def test_a_table_with_a_column_of_a_tally_is_no_tally(small):
    rows = small.withColumn("records", F.lit(7)).withColumn("record_count", F.lit(7))
    assert sorted(A.brand_totals(rows).collect()) == sorted(A.brand_totals(small).collect())
    assert quality.group_counts(rows, "make").agg(F.sum("record_count")).first()[0] == small.count()


def test_a_tally_knows_both_sums_of_units(small):
    for flag in (True, False):
        found = A.model_recalls(A.roll_up(small), exclude_sentinels=flag)
        assert sorted(found.collect()) == sorted(A.model_recalls(small, exclude_sentinels=flag).collect())
