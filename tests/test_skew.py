"""Hot keys and copies: results against plain Python on data where one value dominates."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from faultline.functions import lexicon as L
from faultline.operators import dedupe, quality, sentiment
from faultline.plans import analytics as A
from tests.helpers import texts

COMPLAINT, RECALL = "nhtsa_complaints", "nhtsa_recalls"
COLUMNS = ("record_id", "make", "model", "component", "year", "source", "crash_involved",
           "injuries", "units_affected", "scraped_at")
SCHEMA = (
    "record_id string, make string, model string, component string, year int, source string, "
    "crash_involved boolean, injuries bigint, units_affected bigint, scraped_at int"
)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    copy = ("c0", "FORD", "Escape", "BRAKES", 2015, COMPLAINT, True, 1, -1, 1)
    made = [copy] * 4000
    for i in range(6000):
        hot = rng.random() < 0.5
        made.append(
            (
                "hot" if hot else f"r{rng.randrange(3000)}",
                "FORD" if hot else rng.choice(["FORD", "TESLA", "TOYOTA", "UNKNOWN"]),
                "Escape" if hot else rng.choice(["Escape", "F-150", "N/A"]),
                rng.choice(["BRAKES", "AIR BAGS", "N/A", f"C{rng.randrange(40)}"]),
                2015 if hot else rng.randrange(2010, 2030),
                rng.choice([COMPLAINT, COMPLAINT, COMPLAINT, RECALL]),
                rng.random() < 0.2,
                rng.randrange(-1, 4),
                rng.choice([-1, 10, 500]),
                i,
            )
        )
    return made


@pytest.fixture(scope="module")
def facts(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(8).cache()


def _records(rows):
    return [dict(zip(COLUMNS, row)) for row in rows]


def test_duplicates(facts, rows):
    counts = Counter(rows)
    assert tuple(dedupe.duplicate_rows(facts).first()) == (len(rows), len(rows) - len(counts))
    assert dedupe.drop_exact_duplicates(facts).count() == len(counts)
    samples = [tuple(r) for r in dedupe.duplicate_samples(facts).collect()]
    assert len(samples) == 10 and all(counts[row] > 1 for row in samples)


def test_field_profile(facts, rows):
    got = {r["field"]: r["duplicates"] for r in quality.field_profile(facts).collect()}
    for place, name in enumerate(COLUMNS):
        assert got[name] == len(rows) - len({row[place] for row in rows})


def test_latest_row_per_key(facts, rows):
    latest: dict = {}
    for row in _records(rows):
        key = tuple(row[name] for name in dedupe.RECORD_KEY)
        if key not in latest or row["scraped_at"] > latest[key]:
            latest[key] = row["scraped_at"]
    kept = dedupe.dedupe_by_key(facts).collect()
    assert {tuple(r[name] for name in dedupe.RECORD_KEY): r["scraped_at"] for r in kept} == latest
    assert len(kept) == len(latest)


def test_weighted_risk(facts, rows):
    named = [r for r in _records(rows) if r["source"] == COMPLAINT and r["component"] != "N/A"]
    total, crashes, pairs = Counter(), Counter(), Counter()
    for r in named:
        total[r["component"]] += 1
        crashes[r["component"]] += r["crash_involved"]
        pairs[r["make"], r["component"]] += 1
    weight, weighted = Counter(), defaultdict(float)
    for (make, component), n in pairs.items():
        if total[component] >= 10 and make != "UNKNOWN":
            weight[make] += n
            weighted[make] += n * crashes[component] / total[component]
    got = {r["make"]: r["weighted_crash_risk_pct"] for r in A.weighted_brand_risk(facts).collect()}
    assert got == {make: pytest.approx(weighted[make] / weight[make] * 100, abs=0.0051)
                   for make in weight}


def test_recall_gap(facts, rows):
    groups: dict = defaultdict(lambda: [0, 0, 0, 0, 0])
    for r in _records(rows):
        if r["make"] == "UNKNOWN" or r["component"] == "N/A":
            continue
        group = groups[r["make"], r["component"]]
        if r["source"] == COMPLAINT:
            group[0] += 1
            group[1] += r["crash_involved"]
            group[2] += max(r["injuries"], 0)
        else:
            group[3] += 1
            group[4] += r["units_affected"]
    expected = {key: tuple(group) for key, group in groups.items() if group[0]}
    got = {
        (r["make"], r["component"]): (r["complaint_count"], r["crash_count"], r["total_injuries"],
                                      r["recall_count"], r["units_affected"])
        for r in A.component_recall_gap(facts).collect()
    }
    assert got == expected


WORDS = L.Lexicon(
    {"good": 1.9, "bad": -2.5, "fine": 0.8},
    {"very": 0.293, "hardly": -0.293},
    frozenset({"not", "never"}),
)


def _expected_sum(text: str) -> int:
    words = text.lower().split()
    total = 0
    for i, word in enumerate(words):
        valence = L.to_micro(WORDS.valences.get(word, 0.0))
        if not valence:
            continue
        before = [words[i - d] if i >= d else "" for d in (1, 2, 3)]
        boost = sum(
            L.to_micro(WORDS.boosters.get(w, 0.0)) * weight
            for w, weight in zip(before, L.BOOSTER_REACH)
        )
        value = valence + (boost if valence > 0 else -boost)
        if any(w in WORDS.negators for w in before):
            value *= L.NEGATION
        total += round(value)
    return total


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.lists(
            st.sampled_from(["good", "bad", "fine", "very", "hardly", "not", "never", "car"]),
            max_size=12,
        ).map(" ".join),
        min_size=1,
        max_size=20,
    )
)
def test_modifiers_follow_the_rules_on_any_text(spark, bodies):
    df = texts(spark, *bodies).withColumnRenamed("value", "body")
    scored = sentiment.score_columns(df, WORDS, ["body"], modifiers=True).orderBy("id")
    got = [r["body_sentiment_score"] for r in scored.collect()]
    expected = []
    for text in bodies:
        x = _expected_sum(text) / L.MICRO
        expected.append(x / (x * x + L.NORMALISER) ** 0.5)
    assert got == pytest.approx(expected, abs=0.000051)
