"""Data-quality profiles as typed tables.

`compat=True` subtracts nulls from blanks a second time, as older text reports of the
same figures did; the default reports nulls and blanks as they are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import (
    ALL_SOURCES,
    DATE_EXPECTED_IN,
    NUMERIC_BOUNDS,
    PROSE_EXPECTED_IN,
)
from faultline.functions import columns as C

# Longer values are grouped by digest (32 bytes), so a long text is never shuffled.
_LONGEST_KEY = 32
_SAMPLE_CHARS = 120
#: Logarithm of a sketch's registers.
SKETCH_PRECISION = 14


def _severity(missing_pct: Column) -> Column:
    return F.when(missing_pct > 50, "HIGH").when(missing_pct > 10, "WARN").otherwise("")


def _blanks(nulls: Column, blanks: Column, compat: bool) -> Column:
    return F.greatest(blanks - nulls, F.lit(0).cast("bigint")) if compat else blanks


def _long(df: DataFrame, fields: list[str], by: Iterable[str] = ()) -> DataFrame:
    """(field, value) rows, values as text, behind the columns `by`."""
    texts = df.select(*by, *[F.col(name).cast("string").alias(name) for name in fields])
    return texts.unpivot(list(by), fields, "field", "value")


def field_profile(
    df: DataFrame, compat: bool = False, approximate: bool = False, by: str | None = None
) -> DataFrame:
    """Per column: total, nulls, blanks, missing %, repeated values, type and severity.

    Exact: equal values are counted in each task, then across tasks, then per field; two
    shuffles whatever the number of columns. `approximate` estimates the distinct values
    instead, in one pass without shuffling values. `by` names a column (a snapshot, say) for each value
    of which there is a profile of the other columns, from the same pass.
    """
    keys = [] if by is None else [by]
    if approximate and by is not None:
        raise ValueError("profiles by a column are exact; sketches give mergeable estimates")
    counted = _approximate_counts(df) if approximate else _exact_counts(df, keys)
    order = {name: place for place, name in enumerate(df.columns)}
    types = {column.name: column.dataType.simpleString() for column in df.schema}
    details = F.create_map(*[F.lit(part) for pair in types.items() for part in pair])
    places = F.create_map(*[F.lit(part) for pair in order.items() for part in pair])
    return (
        counted.withColumn("blanks", _blanks(F.col("nulls"), F.col("blanks"), compat))
        .withColumn("missing", F.col("nulls") + F.col("blanks"))
        .withColumn("missing_pct", C.report_percent(F.col("missing"), F.col("total")))
        .select(
            *keys, "field", "total", "nulls", "blanks", "missing", "missing_pct", "duplicates",
            details[F.col("field")].alias("dtype"),
            _severity(F.col("missing_pct")).alias("severity"),
        )
        .orderBy(*keys, places[F.col("field")])
    )


def profile_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """What changed between two field profiles: one row per field of either.

    Percentages change in points. A field that only one of them has is `added` or `removed`.
    """
    kept = ["total", "missing", "missing_pct", "duplicates", "dtype"]
    old = before.select(F.col("field").alias("a"), *[F.col(n).alias(f"{n}_before") for n in kept])
    new = after.select(F.col("field").alias("b"), *[F.col(n).alias(f"{n}_after") for n in kept])
    both = old.join(new, F.col("a").eqNullSafe(F.col("b")), "full_outer")
    repeated = [C.report_percent(F.col(f"duplicates_{w}"), F.col(f"total_{w}")) for w in ("before", "after")]
    same = F.lit(True)
    for name in kept:
        same = same & F.col(f"{name}_before").eqNullSafe(F.col(f"{name}_after"))
    change = (
        F.when(F.col("total_before").isNull(), "added")
        .when(F.col("total_after").isNull(), "removed")
        .when(same, "same")
        .otherwise("changed")
    )
    return both.select(
        F.coalesce("a", "b").alias("field"),
        change.alias("change"),
        *[F.col(f"{name}_{when}") for name in ("total", "missing", "duplicates") for when in ("before", "after")],
        F.bround(F.col("missing_pct_after") - F.col("missing_pct_before"), 1).alias("missing_points"),
        F.bround(repeated[1] - repeated[0], 1).alias("repeated_points"),
    )


def distinct_sketches(df: DataFrame, by: str, precision: int = SKETCH_PRECISION) -> DataFrame:
    """by, field, sketch: a HyperLogLog sketch of each column's values for each value of `by`.

    Sketches of several snapshots unite without the snapshots being read again.
    """
    fields = [name for name in df.columns if name != by]
    rows = df.groupBy(by).agg(*[F.hll_sketch_agg(F.col(n).cast("string"), F.lit(precision)).alias(n) for n in fields])
    return rows.unpivot(by, fields, "field", "sketch")


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """field, distinct_values: an estimate over all the sketches given.

    Its standard error is about 1.04 / sqrt(2 ** precision), 0.8 % by default; nulls do not count.
    """
    united = F.hll_union_agg("sketch", F.lit(False))
    return sketches.groupBy("field").agg(F.hll_sketch_estimate(united).alias("distinct_values"))


def _exact_counts(df: DataFrame, by: list[str]) -> DataFrame:
    value = F.col("value")
    kind = F.when(value.isNull(), "null").when(C.is_blank(value), "blank").otherwise("value")
    # The kind keeps a digest apart from a short value that looks like one.
    short = F.octet_length(value) <= _LONGEST_KEY
    fields = [name for name in df.columns if name not in by]
    keyed = _long(df, fields, by).select(
        *by,
        "field",
        F.concat(kind, F.when(short, "").otherwise("+digest")).alias("kind"),
        F.when(short, value.cast("binary"))
        .otherwise(F.unhex(F.sha2(value, 256)))
        .alias("key"),
    )
    kind = F.col("kind")
    n = F.col("n")
    return (
        keyed.groupBy(*by, "field", "kind", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*by, "field")
        .agg(
            F.sum(n).alias("total"),
            F.sum(F.when(kind.startswith("null"), n).otherwise(0)).alias("nulls"),
            F.sum(F.when(kind.startswith("blank"), n).otherwise(0)).alias("blanks"),
            F.sum(n - 1).alias("duplicates"),
        )
    )


def _approximate_counts(df: DataFrame) -> DataFrame:
    aggregates = []
    for name in df.columns:
        text = F.col(name).cast("string")
        nulls = F.count_if(text.isNull())
        distinct = F.approx_count_distinct(text) + F.when(nulls > 0, 1).otherwise(0)
        aggregates.append(
            F.struct(
                F.lit(name).alias("field"),
                F.count(F.lit(1)).alias("total"),
                nulls.alias("nulls"),
                F.count_if(C.is_blank(text)).alias("blanks"),
                F.greatest(F.count(F.lit(1)) - distinct, F.lit(0).cast("bigint")).alias(
                    "duplicates"
                ),
            )
        )
    return df.agg(F.array(*aggregates).alias("rows")).select(F.inline("rows"))


def empty_fields(profile: DataFrame) -> DataFrame:
    """Profile rows of fields without a value: exactly all missing, not 100 % by rounding."""
    return profile.where((F.col("missing") == F.col("total")) & (F.col("total") > 0))


def null_fields(profile: DataFrame) -> list[str]:
    """Names of the empty fields; the profile has one row per column, so the list is short."""
    return [row["field"] for row in empty_fields(profile).select("field").collect()]


def group_counts(df: DataFrame, *fields: str, counted: bool = False) -> DataFrame:
    """Rows per combination of the fields; of counts made by this function if `counted`."""
    one = F.col("record_count") if counted else F.lit(1).cast("bigint")
    return df.groupBy(*fields).agg(F.sum(one).alias("record_count"))


def value_counts(df: DataFrame, *fields: str, counted: bool = False) -> DataFrame:
    """Rows per value of each field, most frequent first; nulls are not counted."""
    groups = group_counts(df, *fields, counted=counted)
    texts = groups.select(
        "record_count", *[F.col(name).cast("string").alias(name) for name in fields]
    )
    values = texts.unpivot("record_count", list(fields), "field", "value")
    return (
        group_counts(values.where(F.col("value").isNotNull()), "field", "value", counted=True)
        .orderBy("field", F.col("record_count").desc(), "value")
    )


# The checks below are arrays of aggregates, one struct per output row, so that any number
# of them shares one pass over the data.


def _expected(source: str) -> Column:
    return F.lit(True) if source == ALL_SOURCES else F.col("source") == source


def _identity_rows() -> Column:
    key = F.col("record_id")
    return F.array(
        F.struct(
            F.count_if(key.isNull()).alias("null_ids"),
            F.count_if(key.isin("complaint_", "recall_")).alias("empty_ids"),
        )
    )


def _judged_once(df: DataFrame, texts: Iterable[str], numbers: Iterable[str]) -> DataFrame:
    """Add per text field whether it is blank, and per number field its value.

    A projection of its own, so that the many aggregates share one evaluation per row.
    """
    blank = {f"_blank_{n}": C.is_blank(F.col(n).cast("string")) for n in texts if n in df.columns}
    number = {f"_number_{n}": C.to_number(F.col(n)) for n in numbers if n in df.columns}
    return df.withColumns({**blank, **number})


def _completeness_rows(
    df: DataFrame, fields: dict[str, str], extra, compat: bool
) -> Column | None:
    structs = []
    for name, source in fields.items():
        if name not in df.columns:
            continue
        text, blank = F.col(name).cast("string"), F.col(f"_blank_{name}")
        inside = _expected(source)
        nulls = F.count_if(inside & text.isNull())
        blanks = F.count_if(inside & blank)
        structs.append(
            F.struct(
                F.lit(name).alias("field"),
                F.lit(source).alias("expected_in"),
                F.count_if(inside).alias("total"),
                nulls.alias("nulls"),
                _blanks(nulls, blanks, compat).alias("blanks"),
                *extra(text, inside & text.isNotNull() & ~blank),
            )
        )
    return F.array(*structs) if structs else None


def _date_figures(text: Column, present: Column) -> list[Column]:
    return [F.min(F.when(present, text)).alias("sample")]


def _prose_figures(text: Column, present: Column) -> list[Column]:
    length = F.when(present, F.length(text).cast("bigint"))
    mean = F.sum(length) / F.nullif(F.count(length), F.lit(0))
    return [
        F.bround(mean, 0).cast("bigint").alias("avg_length"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
        F.min(F.when(present, F.substring(text, 1, _SAMPLE_CHARS))).alias("sample"),
    ]


def _judged(rows: DataFrame) -> DataFrame:
    extras = rows.columns[5:]
    return (
        rows.withColumn("missing", F.col("nulls") + F.col("blanks"))
        .withColumn("missing_pct", C.report_percent(F.col("missing"), F.col("total")))
        .withColumn("warn", F.col("missing_pct") > 10)
        .select(*rows.columns[:5], "missing", "missing_pct", *extras, "warn")
    )


def _numeric_rows(df: DataFrame, bounds: dict[str, tuple[int, int]]) -> Column | None:
    structs = []
    for name, (low, high) in bounds.items():
        if name not in df.columns:
            continue
        text, number = F.col(name).cast("string"), F.col(f"_number_{name}")
        structs.append(
            F.struct(
                F.lit(name).alias("field"),
                F.count_if(text.isNull()).alias("nulls"),
                F.count_if(text.isNotNull() & number.isNull()).alias("type_errors"),
                F.count_if(number < low).alias("negatives"),
                F.count_if(number > high).alias("outliers"),
            )
        )
    return F.array(*structs) if structs else None


def figures(df: DataFrame, compat: bool = False) -> DataFrame:
    """All checks of this section in one pass: one row, to be read with `from_figures`."""
    prepared = _judged_once(df, [*DATE_EXPECTED_IN, *PROSE_EXPECTED_IN], NUMERIC_BOUNDS)
    checks = {
        "identity_check": _identity_rows(),
        "date_completeness": _completeness_rows(df, DATE_EXPECTED_IN, _date_figures, compat),
        "description_profile": _completeness_rows(df, PROSE_EXPECTED_IN, _prose_figures, compat),
        "numeric_anomalies": _numeric_rows(df, NUMERIC_BOUNDS),
    }
    return prepared.agg(
        *[rows.alias(name) for name, rows in checks.items() if rows is not None]
    )


def from_figures(row: DataFrame) -> dict[str, DataFrame]:
    """The tables of the checks, by name."""
    tables = {name: row.select(F.inline(name)) for name in row.columns}
    for name in ("date_completeness", "description_profile"):
        if name in tables:
            tables[name] = _judged(tables[name])
    return tables


def _unfold(df: DataFrame, rows: Column | None) -> DataFrame:
    if rows is None:
        raise ValueError(f"none of the checked fields among {df.columns}")
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def identity_check(df: DataFrame) -> DataFrame:
    """Null record ids, and ids that are a bare prefix without a value."""
    return _unfold(df, _identity_rows())


def date_completeness(
    df: DataFrame, fields: dict[str, str] = DATE_EXPECTED_IN, compat: bool = False
) -> DataFrame:
    """Missing dates per field within the source that should have it; smallest as sample."""
    rows = _completeness_rows(df, fields, _date_figures, compat)
    return _judged(_unfold(_judged_once(df, fields, ()), rows))


def description_profile(
    df: DataFrame, fields: dict[str, str] = PROSE_EXPECTED_IN, compat: bool = False
) -> DataFrame:
    """The same for prose, with lengths of the non-blank texts and the head of one text."""
    rows = _completeness_rows(df, fields, _prose_figures, compat)
    return _judged(_unfold(_judged_once(df, fields, ()), rows))


def numeric_anomalies(
    df: DataFrame, bounds: dict[str, tuple[int, int]] = NUMERIC_BOUNDS
) -> DataFrame:
    """Nulls, non-numeric texts and values out of range per field."""
    return _unfold(_judged_once(df, (), bounds), _numeric_rows(df, bounds))


def bad_numeric_values(
    df: DataFrame, bounds: dict[str, tuple[int, int]] = NUMERIC_BOUNDS, samples: int = 5
) -> DataFrame:
    """The smallest distinct texts per field that are not numbers.

    Equal values collapse before the shuffle, and the ranking limit is applied in each
    task first, so no task sees all bad values of a field.
    """
    fields = [name for name in bounds if name in df.columns]
    value = F.col("value")
    bad = (
        _long(df, fields)
        .where(value.isNotNull() & C.to_number(value).isNull())
        .distinct()
    )
    window = Window.partitionBy("field").orderBy("value")
    return (
        bad.withColumn("place", F.row_number().over(window).cast("bigint"))
        .where(F.col("place") <= samples)
        .select("field", "place", "value")
    )


def make_variants(df: DataFrame, counted: bool = False) -> DataFrame:
    """Each raw make as it appears, with its rows, sorted."""
    return group_counts(df, "make", counted=counted).orderBy(F.col("make").asc_nulls_last())


def make_variant_total(df: DataFrame) -> DataFrame:
    """The number of distinct raw makes, a missing make counting as one."""
    return df.select("make").distinct().agg(F.count(F.lit(1)).alias("variants"))


def record_count_summary(df: DataFrame, counted: bool = False) -> DataFrame:
    """Rows by source and make; rows without either are left out."""
    named = df.where(F.col("source").isNotNull() & F.col("make").isNotNull())
    return group_counts(named, "source", "make", counted=counted).orderBy("source", "make")


def render_profile(profile: DataFrame) -> DataFrame:
    """The field profile as lines of text."""
    line = F.format_string(
        "%-28s %12d %12d %12d %8.1f%% %12d  %-10s %s",
        "field", "total", "nulls", "blanks", "missing_pct", "duplicates", "dtype", "severity",
    )
    return profile.select(line.alias("value"))
