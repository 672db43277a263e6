"""Sentiment scores, labels and ids of text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.config import (
    MISSING_SCORE,
    MISSING_TEXT,
    PROSE_FIELDS,
    SENTIMENT_BOUNDS,
    SENTIMENT_IDS,
    SENTIMENT_TOP_LABEL,
)
from faultline.functions import columns as C
from faultline.functions.lexicon import (
    Lexicon,
    LexiconTable,
    compound,
    modified_sum,
    plain_sum,
    sums_by_join,
)
from faultline.operators.quality import value_counts


def is_scored(text: Column) -> Column:
    return F.coalesce(C.is_present(text) & (text != MISSING_TEXT), F.lit(False))


def label_of(score: Column) -> Column:
    """Label of an unrounded score; the bounds are exclusive from below."""
    (first, bound), *rest = SENTIMENT_BOUNDS
    chain = F.when(score < bound, F.lit(first))
    for label, bound in rest:
        chain = chain.when(score < bound, F.lit(label))
    return chain.otherwise(F.lit(SENTIMENT_TOP_LABEL))


def _id_of(score: Column) -> Column:
    (first, bound), *rest = SENTIMENT_BOUNDS
    chain = F.when(score < bound, F.lit(SENTIMENT_IDS[first]))
    for label, bound in rest:
        chain = chain.when(score < bound, F.lit(SENTIMENT_IDS[label]))
    return chain.otherwise(F.lit(SENTIMENT_IDS[SENTIMENT_TOP_LABEL])).cast("bigint")


def verdict(micro_sum: Column) -> Column:
    """(score, label, id) of a valence sum; the label is that of the unrounded score."""
    raw = compound(micro_sum)
    return F.struct(
        F.bround(raw, 4).alias("score"), label_of(raw).alias("label"), _id_of(raw).alias("id")
    )


def _unscored() -> Column:
    return F.struct(
        F.lit(MISSING_SCORE).alias("score"),
        F.lit(MISSING_TEXT).alias("label"),
        F.lit(SENTIMENT_IDS[MISSING_TEXT]).cast("bigint").alias("id"),
    )


def _spell_out(df: DataFrame, verdicts: dict[str, Column]) -> DataFrame:
    """Add the three columns per field.

    A verdict is one expression, so a filter that Spark moves below the scoring repeats
    it at most once; it is never null, so joins add no such filter.
    """
    judged = df.withColumns(
        {f"_{name}": F.coalesce(value, _unscored()) for name, value in verdicts.items()}
    )
    return judged.select(
        *df.columns,
        *[
            F.col(f"_{name}")[part].alias(f"{name}_sentiment_{part}")
            for name in verdicts
            for part in ("score", "label", "id")
        ],
    )


def score_columns(
    df: DataFrame,
    lexicon: Lexicon | LexiconTable,
    fields: Iterable[str] = PROSE_FIELDS,
    modifiers: bool = False,
) -> DataFrame:
    """Add score, label and id for each text field the frame has, over its whole texts.

    A lexicon constant scores every row where it lies, without a shuffle. A lexicon table gives the
    same answers by joins.
    """
    present = [name for name in fields if name in df.columns]
    if isinstance(lexicon, LexiconTable):
        return _score_by_table(df, lexicon, present, modifiers)
    total = modified_sum if modifiers else plain_sum
    return _spell_out(
        df,
        {
            name: F.when(is_scored(F.col(name)), total(F.col(name), lexicon, verdict))
            for name in present
        },
    )


def _score_by_table(
    df: DataFrame, lexicon: LexiconTable, fields: list[str], modifiers: bool
) -> DataFrame:
    """Each distinct text is scored once; rows meet its sum by the text's digest."""
    columns, verdicts = df.columns, {}
    for name in fields:
        digest = F.when(is_scored(F.col(name)), F.unhex(F.sha2(F.col(name), 256)))
        df = df.withColumn(f"_key_{name}", digest)
        texts = df.where(F.col(f"_key_{name}").isNotNull()).select(
            F.col(f"_key_{name}").alias("key"), F.col(name).alias("text")
        )
        sums = sums_by_join(texts.dropDuplicates(["key"]), lexicon, modifiers).select(
            F.col("key").alias(f"_of_{name}"), F.col("micro").alias(f"_micro_{name}")
        )
        df = df.join(sums, F.col(f"_key_{name}") == F.col(f"_of_{name}"), "left")
        total = F.coalesce(f"_micro_{name}", F.lit(0).cast("bigint"))
        verdicts[name] = F.when(F.col(f"_key_{name}").isNotNull(), verdict(total))
    scored = _spell_out(df, verdicts)
    return scored.select(*columns, *[c for c in scored.columns if "_sentiment_" in c and c not in columns])


def label_distribution(df: DataFrame, fields: Iterable[str] = PROSE_FIELDS) -> DataFrame:
    """Rows per sentiment label of each scored field."""
    labels = [f"{name}_sentiment_label" for name in fields]
    return value_counts(df, *[name for name in labels if name in df.columns])
