"""Profiles and fixed values that decide what the operators compute."""

from __future__ import annotations

from dataclasses import dataclass, field

COMPLAINTS = "nhtsa_complaints"
RECALLS = "nhtsa_recalls"
ALL_SOURCES = "all"

MISSING_INT = -1
MISSING_FLOAT = 0.0
MISSING_TEXT = "N/A"
MISSING_DATE = "9999-12-31"
MISSING_SCORE = 0.0
UNKNOWN_MAKE = "UNKNOWN"
UNKNOWN_MAKE_ID = -1

# Texts that stand for a missing value (exact match after stripping).
NULL_TEXTS = ("", "None", "nan", "NaN", "NULL", "null")

# Texts read as true (after stripping and lower-casing).
TRUE_TEXTS = ("true", "yes", "1")

# Keyword, make code, make id. The first keyword contained wins.
MAKE_KEYWORDS = (
    ("toyota", "TOYOTA", 0),
    ("ford", "FORD", 1),
    ("tesla", "TESLA", 2),
)

# Rows of the make dimension (make_id, make, make_label).
DIM_MAKE = (
    (0, "TOYOTA", "Toyota"),
    (1, "FORD", "Ford"),
    (2, "TESLA", "Tesla"),
    (-1, "UNKNOWN", "Unknown"),
)

# Rows of the sentiment dimension (sentiment_id, sentiment_label, threshold).
DIM_SENTIMENT = (
    (3, "positive", ">= 0.05"),
    (2, "neutral", ">= -0.2 and < 0.05"),
    (1, "negative", ">= -0.5 and < -0.2"),
    (0, "critical", "< -0.5"),
    (-1, "N/A", "unscored"),
)

# A score below the bound gets the label; anything else is positive.
SENTIMENT_BOUNDS = (("critical", -0.5), ("negative", -0.2), ("neutral", 0.05))
SENTIMENT_TOP_LABEL = "positive"
SENTIMENT_IDS = {label: key for key, label, _ in DIM_SENTIMENT}

# The request grid of the landing API.
REQUEST_MODELS = {
    "Toyota": ("Camry", "Corolla", "RAV4", "Prius", "C-HR"),
    "Ford": ("F-150", "Mustang", "Explorer", "Escape", "Fiesta"),
    "Tesla": ("Model 3", "Model S", "Model X", "Model Y"),
}
FIRST_YEAR, LAST_YEAR = 2015, 2025

NUMERIC_FIELDS = ("injuries", "deaths", "units_affected")
BOOLEAN_FIELDS = ("crash_involved", "fire_involved")
LABEL_FIELDS = ("component", "model")
PROSE_FIELDS = ("body", "consequence", "remedy")
DATE_FIELDS = ("incident_date", "recall_date")

# Valid range per numeric field (inclusive).
NUMERIC_BOUNDS = {
    "injuries": (0, 1000),
    "deaths": (0, 100),
    "units_affected": (0, 10_000_000),
}

# Field -> the source in which it is expected.
DATE_EXPECTED_IN = {"scraped_at": ALL_SOURCES, "incident_date": COMPLAINTS, "recall_date": RECALLS}
PROSE_EXPECTED_IN = {"body": ALL_SOURCES, "consequence": RECALLS, "remedy": RECALLS}

# Ordered date formats, first successful parse wins; "iso" is Spark's own date cast.
DATE_FORMATS = ("M/d/yyyy", "iso")

# Formats to choose one from per column, where the data decides.
DATE_CANDIDATES = ("M/d/yyyy", "d/M/yyyy", "iso")


@dataclass(frozen=True)
class Profile:
    """One dialect of the transform; pass a changed copy to adapt it."""

    name: str
    label_placeholder: str
    recall_weight: float
    with_sentiment: bool
    with_event_date: bool
    with_etl_timestamp: bool
    display_zone: str
    prose_placeholder: str = MISSING_TEXT
    make_keywords: tuple = MAKE_KEYWORDS
    date_formats: dict = field(
        default_factory=lambda: {name: DATE_FORMATS for name in DATE_FIELDS}
    )


LOCAL = Profile(
    name="local",
    label_placeholder=MISSING_TEXT,
    recall_weight=1.5,
    with_sentiment=True,
    with_event_date=False,
    with_etl_timestamp=False,
    display_zone="UTC",
)

CLOUD = Profile(
    name="cloud",
    label_placeholder="Unknown",
    recall_weight=2.0,
    with_sentiment=False,
    with_event_date=True,
    with_etl_timestamp=True,
    display_zone="America/Chicago",
)
