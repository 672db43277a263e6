from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from faultline.functions import lexicon as L
from faultline.functions.lexicon import Lexicon
from faultline.operators import sentiment
from tests.helpers import evaluate, plan, texts

WORDS = Lexicon(
    {"good": 2.0, "bad": -2.0, "don't": -0.5},
    {"very": 0.293, "slightly": -0.293},
    frozenset({"not", "never"}),
)


def _micro(spark, total, *values):
    return evaluate(spark, total(F.col("value"), WORDS), *values)


def test_plain_sum_reads_whole_text(spark):
    long = "filler " * 20_000 + "good"
    got = _micro(spark, L.plain_sum, "Good, GOOD! bad", "nothing here", long, "don't")
    assert got == [2_000_000, 0, 2_000_000, -500_000]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("good", 2.0),
        ("very good", 2.293),
        ("very bad", -2.293),
        ("slightly good", 1.707),
        ("very much good", 2.0 + 0.293 * 0.95),
        ("very much so good", 2.0 + 0.293 * 0.9),
        ("very very good", 2.0 + 0.293 + 0.293 * 0.95),
        ("very a b c good", 2.0),
        ("not good", 2.0 * -0.74),
        ("not a b good", 2.0 * -0.74),
        ("not a b c good", 2.0),
        ("not very good", (2.0 + 0.293) * -0.74),
        ("good not bad", 2.0 + 2.0 * 0.74),
    ],
)
def test_modifiers(spark, text, expected):
    (got,) = _micro(spark, L.modified_sum, text)
    assert got == pytest.approx(expected * 1e6, abs=1)


def test_compound_squeezes(spark):
    df = spark.createDataFrame([(0,), (2_000_000,), (-10**12,)], "s bigint")
    got = [r[0] for r in df.select(L.compound(F.col("s"))).collect()]
    assert got == [0.0, 2 / math.sqrt(19), pytest.approx(-1.0)]


def test_label_bounds_are_exclusive(spark):
    df = spark.createDataFrame(
        [(-0.51,), (-0.5,), (-0.21,), (-0.2,), (0.049,), (0.05,)], "score double"
    )
    got = [r[0] for r in df.select(sentiment.label_of(F.col("score"))).collect()]
    assert got == ["critical", "negative", "negative", "neutral", "neutral", "positive"]


def test_label_and_id_belong_together(spark):
    df = spark.range(-400, 400).select((F.col("id") * 10_000).alias("s"))
    pairs = df.select(sentiment.verdict(F.col("s")).alias("v")).select("v.label", "v.id")
    assert {tuple(r) for r in pairs.distinct().collect()} == {
        ("critical", 0), ("negative", 1), ("neutral", 2), ("positive", 3),
    }


def test_unscored_texts(spark):
    df = texts(spark, None, "", " \t", "N/A", "word").withColumnRenamed("value", "body")
    rows = sentiment.score_columns(df, WORDS).orderBy("id").collect()
    got = [(r["body_sentiment_score"], r["body_sentiment_label"], r["body_sentiment_id"])
           for r in rows]
    assert got == [(0.0, "N/A", -1)] * 4 + [(0.0, "neutral", 2)]


def test_only_present_fields_get_columns(spark):
    df = texts(spark, "good").withColumnRenamed("value", "remedy")
    assert sentiment.score_columns(df, WORDS).columns == [
        "id", "remedy", "remedy_sentiment_score", "remedy_sentiment_label", "remedy_sentiment_id",
    ]


@pytest.mark.parametrize("modifiers", [False, True])
def test_a_lexicon_table_gives_the_same_answers(spark, modifiers):
    bodies = ("good good bad", "", "word", None, "bad. bad; bad", "not very good", "very x not y bad good", "N/A")
    df = texts(spark, *bodies, "good good bad").withColumnRenamed("value", "body")
    rows = [("Good", 1.9, 0.0, False), ("bad", -2.0, 0.0, False), ("BAD", -0.5, 0.0, False), ("very", 0.0, 0.293, False), ("not", 0.0, 0.0, True)]
    table = spark.createDataFrame(rows, "token string, valence double, boost double, negator boolean")
    lexicon = Lexicon.from_table(table)
    assert lexicon == Lexicon({"good": 1.9, "bad": -2.5}, {"very": 0.293}, frozenset({"not"}))
    expected = sentiment.score_columns(df, lexicon, ["body"], modifiers)
    found = sentiment.score_columns(df, L.LexiconTable.of(table), ["body"], modifiers)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_entries_are_lower_cased_and_added_up():
    with pytest.warns(UserWarning, match="1 lexicon entries"):
        assert Lexicon({"Good": 1.0, "good": 0.5, ":)": 2.0}).valences == {"good": 1.5, ":)": 2.0}


def test_a_lexicon_file_may_hold_modifiers(spark, tmp_path):
    path = tmp_path / "words.tsv"
    path.write_text("good\t1.9\nvery\t0\t0.293\tfalse\nnot\t0\t0\ttrue\nbad\t-2.5\t0.8\t[-3, -2]\n", encoding="utf-8")
    lexicon = Lexicon.from_file(spark, str(path))
    assert lexicon == Lexicon({"good": 1.9, "bad": -2.5}, {"very": 0.293}, frozenset({"not"}))


def test_scoring_neither_shuffles_nor_calls_python(spark):
    df = texts(spark, "good").withColumnRenamed("value", "body")
    text = plan(sentiment.score_columns(df, WORDS, modifiers=True))
    assert "Exchange" not in text and "Python" not in text and "Join" not in text


def test_a_large_lexicon_stays_a_table(spark):
    n = L.MAX_CONSTANT_ENTRIES + 1
    table = spark.range(n).selectExpr("concat('w', id) as token", "1.0D as valence")
    assert isinstance(Lexicon.from_table(table), L.LexiconTable)
    assert isinstance(Lexicon.from_table(table.limit(n - 1)), Lexicon)
