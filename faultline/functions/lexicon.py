"""Lexicon scoring of whole texts as one narrow expression.

The lexicon becomes a constant array of small hash buckets inside the plan, so a token
is looked up in constant time, with no shuffle, no join back to the wide row and no
Python worker. Valences are whole millionths, so sums do not depend on their order.
"""

from __future__ import annotations

import json
import warnings
import zlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.session import fresh_path

MICRO = 1_000_000
TOKEN_GAP = r"[^\p{L}\p{N}']+"

# Largest lexicon kept as a constant; a larger one stays a table and meets the words by a join.
MAX_CONSTANT_ENTRIES = 20_000

# Fixed values (Hutto & Gilbert, ICWSM 2014): normalising constant, negation factor,
# weight of a booster one, two and three tokens before the scored word.
NORMALISER = 15
NEGATION = -0.74
BOOSTER_REACH = (1.0, 0.95, 0.9)

_ENTRY = "struct<v:bigint,b:bigint,n:boolean>"

Finish = Callable[[Column], Column]


def to_micro(value: float) -> int:
    return round(value * MICRO)


@dataclass(frozen=True)
class Lexicon:
    """Token -> valence, and for the modifier step token -> boost and the negators."""

    valences: Mapping[str, float]
    boosters: Mapping[str, float] = field(default_factory=dict)
    negators: frozenset = frozenset()

    def __post_init__(self) -> None:
        # texts are lower-cased before the lookup; entries that then agree are added up
        for name in ("valences", "boosters"):
            merged: dict[str, float] = {}
            for word, value in getattr(self, name).items():
                merged[word.lower()] = merged.get(word.lower(), 0.0) + value
            object.__setattr__(self, name, merged)
        object.__setattr__(self, "negators", frozenset(w.lower() for w in self.negators))
        _warn_of_unmatched(sum(not _is_token(w) for w in self.tokens()))

    @classmethod
    def from_table(cls, table: DataFrame) -> Lexicon | LexiconTable:
        """Read (token, valence) and, if there, (boost, negator); one entry per lower-case token.

        A lexicon of more entries than a constant may have stays a table; it is worked out once and kept in
        the shared folder.
        """
        merged = LexiconTable.of(table).table
        path = fresh_path(table.sparkSession, "lexicon")
        merged.write.parquet(path)
        held = LexiconTable(table.sparkSession.read.schema(merged.schema).parquet(path))
        rows = held.table.limit(MAX_CONSTANT_ENTRIES + 1).collect()
        if len(rows) > MAX_CONSTANT_ENTRIES:
            return held
        return cls(
            {r["token"]: r["v"] / MICRO for r in rows if r["v"]},
            {r["token"]: r["b"] / MICRO for r in rows if r["b"]},
            frozenset(r["token"] for r in rows if r["n"]),
        )

    @classmethod
    def from_file(cls, spark: SparkSession, path: str) -> Lexicon | LexiconTable:
        """Read tab-separated lines: token, valence, and optionally boost and negator (true)."""
        lines = spark.read.schema("token string, valence double, boost string, negator string")
        lines = lines.option("sep", "\t").option("mode", "PERMISSIVE").option("quote", "").csv(path)
        # other lexica have other things in these columns
        boost = F.coalesce(F.col("boost").try_cast("double"), F.lit(0.0))
        negator = F.when(F.lower(F.trim("negator")).isin("true", "false"), F.lower(F.trim("negator")) == "true")
        named = lines.where("token is not null and valence is not null")
        held = F.when(negator.isNotNull(), boost).otherwise(F.lit(0.0))
        return cls.from_table(named.select("token", "valence", held.alias("boost"), F.coalesce(negator, F.lit(False)).alias("negator")))

    def tokens(self) -> set[str]:
        return {*self.valences, *self.boosters, *self.negators}

    def lookup(self, token: Column) -> Column:
        """The entry (v, b, n) of one token, or null."""
        size = 1 << max(1, len(self.tokens()).bit_length())
        buckets: list[dict] = [{} for _ in range(size)]
        for word in sorted(self.tokens()):
            buckets[zlib.crc32(word.encode("utf-8")) % size][word] = {
                "v": to_micro(self.valences.get(word, 0.0)),
                "b": to_micro(self.boosters.get(word, 0.0)),
                "n": word in self.negators,
            }
        table = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{_ENTRY}>>")
        slot = F.pmod(F.crc32(token.cast("binary")), F.lit(size)).cast("int")
        return F.try_element_at(F.get(table, slot), token)


@dataclass(frozen=True)
class LexiconTable:
    """A lexicon of any size: token, v and b in millionths, n; one row per lower-case token."""

    table: DataFrame

    @classmethod
    def of(cls, table: DataFrame) -> LexiconTable:
        """From (token, valence) and, if there, (boost, negator)."""
        boost = F.col("boost") if "boost" in table.columns else F.lit(0.0)
        negator = F.col("negator") if "negator" in table.columns else F.lit(False)
        micro = lambda value: F.round(F.coalesce(value, F.lit(0.0)) * MICRO).cast("bigint")
        merged = (
            table.where(F.col("token").isNotNull())
            .groupBy(F.lower("token").alias("token"))
            .agg(
                F.sum(micro(F.col("valence"))).alias("v"),
                F.sum(micro(boost)).alias("b"),
                F.max(F.coalesce(negator, F.lit(False))).alias("n"),
            )
        )
        return cls(merged)


def _is_token(word: str) -> bool:
    return bool(word) and all(c.isalpha() or c.isnumeric() or c == "'" for c in word)


def _warn_of_unmatched(count: int) -> None:
    if count:
        warnings.warn(f"{count} lexicon entries hold other signs than words do and match no word", stacklevel=4)


def tokens(text: Column) -> Column:
    return F.split(F.lower(text), TOKEN_GAP)


def _keep(value: Column) -> Column:
    return value


def plain_sum(text: Column, lexicon: Lexicon, finish: Finish = _keep) -> Column:
    """Sum of the valences of all tokens, in millionths, passed through `finish`."""
    zero = F.lit(0).cast("bigint")
    return F.aggregate(
        tokens(text),
        zero,
        lambda total, token: total + F.coalesce(lexicon.lookup(token)["v"], zero),
        finish,
    )


def _moved(value: Column, boost: Column, negated: Column) -> Column:
    """A valence strengthened away from zero by the boost, or turned, in whole millionths."""
    moved = value + F.signum(value.cast("double")) * boost
    turned = F.when(negated, F.lit(NEGATION)).otherwise(F.lit(1.0))
    return F.round(moved * turned).cast("bigint")


def modified_sum(text: Column, lexicon: Lexicon, finish: Finish = _keep) -> Column:
    """Valence sum where the three tokens before a word strengthen, weaken or negate it."""
    entries = F.transform(tokens(text), lambda token: lexicon.lookup(token))
    zero = F.lit(0).cast("bigint")

    def adjusted(array: Column, entry: Column, index: Column) -> Column:
        boost, negated = F.lit(0.0), F.lit(False)
        for distance, weight in enumerate(BOOSTER_REACH, start=1):
            before = F.get(array, index - F.lit(distance))
            boost = boost + F.coalesce(before["b"], zero) * F.lit(weight)
            negated = negated | F.coalesce(before["n"], F.lit(False))
        scored = F.coalesce(entry["v"], zero) != 0
        return F.when(scored, _moved(entry["v"], boost, negated)).otherwise(zero)

    # The aggregate over one array lets the inner steps name the array of entries once.
    return F.aggregate(
        F.array(entries),
        zero,
        lambda total, array: F.aggregate(
            F.transform(array, lambda entry, index: adjusted(array, entry, index)),
            total,
            lambda part, value: part + value,
        ),
        finish,
    )


def sums_by_join(texts: DataFrame, lexicon: LexiconTable, modifiers: bool = False) -> DataFrame:
    """key, micro: the plain or modified valence sum of each text (key, text; keys are distinct).

    The same answers as the constant gives. Of a text's words only those in the table are ordered.
    """
    words = texts.select("key", F.posexplode(tokens(F.col("text"))).alias("place", "token"))
    met = words.join(lexicon.table, "token")
    if not modifiers:
        return met.groupBy("key").agg(F.sum("v").alias("micro"))
    order = Window.partitionBy("key").orderBy("place")
    boost, negated = F.lit(0.0), F.lit(False)
    # the three entries before a word are among its three predecessors here
    near = [[F.lag(name, step).over(order).alias(f"{name}{step}") for name in ("place", "b", "n")] for step in (1, 2, 3)]
    known = met.select("key", "place", "v", *[column for columns in near for column in columns])
    for distance, weight in enumerate(BOOSTER_REACH, start=1):
        at, total, turned = F.col("place") - F.lit(distance), F.lit(0).cast("bigint"), F.lit(False)
        for step in (1, 2, 3):
            here = F.coalesce(F.col(f"place{step}") == at, F.lit(False))
            total = total + F.when(here, F.col(f"b{step}")).otherwise(F.lit(0))
            turned = turned | (here & F.coalesce(f"n{step}", F.lit(False)))
        boost, negated = boost + total * F.lit(weight), negated | turned
    scored = known.where("v != 0").select("key", _moved(F.col("v"), boost, negated).alias("micro"))
    return scored.groupBy("key").agg(F.sum("micro").alias("micro"))


def compound(micro_sum: Column) -> Column:
    """x / sqrt(x^2 + 15): the sum squeezed into [-1, 1]."""
    x = micro_sum / F.lit(float(MICRO))
    return x / F.sqrt(x * x + F.lit(float(NORMALISER)))
