"""Quality rules whose cutoffs are proven, on labelled documents, to reject few good ones in every stratum.

Each text is measured once. A fixed base rule rejects short and repetitive texts. Further rules compare whole
numbers made from the measures with a cutoff. The cutoffs come from labelled documents that pass the
base rule: a rule's grid is walked from its mildest cutoff, and a cutoff holds while the exact binomial
probability of so few rejected good documents, if the true share were `risk` / rules, is at most
`doubt` / (strata * rules). The walk ends at the first cutoff that fails (fixed-sequence testing), so no
correction within a grid is needed; Bonferroni corrects for rules and strata. With probability 1 - `doubt` all
strata at once lose at most a share `risk` of good documents to the rules together. Whichever proven
cutoff is taken, that holds; it is the one where the share of bad documents rejected exceeds that of
good ones by most (of equal ones the mildest), and none where there is no excess. Counts cover all labelled
documents; only a histogram of bounded size reaches the driver.

Strata are the values of a column. The `most` values with the most labelled documents are strata of their own
(ties by value), all others, nulls too, are one more; this bounds what is broadcast, and every document
has a stratum.

Defined results: a null text counts as none and measures 0, an empty one too; both fail the base rule.
Rows repeat and are measured and counted each; a null doc_id has no label. Labels without doc_id or value do
not count, of several labels of a document the largest counts. Without enough labelled documents no
cutoff can be proven and the base rule alone decides. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import map_batches, materialise

LEAST_WORDS, MOST_REPEATED = 50, 50  # words, per cent of the words
SYMBOLS = b"#*$%&|<>"
#: Texts of more words look for repeated windows by sorting numbers.
MANY_WORDS = 100_000
#: Strata of their own.
MOST_STRATA = 32
RISK, DOUBT = 0.05, 0.10

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


@dataclass(frozen=True)
class Rule:
    """Documents are rejected where the value (a whole number, SQL over the measures) reaches the cutoff."""

    name: str
    value: str
    grid: tuple[int, ...]  # from the mildest cutoff on


#: Shares count in thousandths, mean word lengths in hundredths of a code point.
RULES = (
    Rule("symbols", "1000 * n_symbols div n_words", tuple(range(1000, 0, -10))),
    Rule("equal_lines", "1000 * n_dup_lines div greatest(n_lines, 1L)", tuple(range(1000, 0, -10))),
    Rule("repeated_words", "1000 * n_repeat_words div n_words", tuple(range(500, 0, -5))),
    Rule("long_words", "100 * word_chars div n_words", tuple(range(3000, 400, -20))),
    Rule("short_words", "-(100 * word_chars div n_words)", tuple(range(-100, -800, -10))),
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three found more than once."""
    n = len(words) - 2
    if n < 2:
        return 0
    if n <= MANY_WORDS:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == n:
            return 0
        found = Counter(windows)
        often = np.fromiter((found[w] > 1 for w in windows), dtype=bool, count=n)
    else:
        numbers: dict[bytes, int] = {}
        codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n + 2)
        # a number for each distinct pair, then for each pair and third word
        pairs = np.unique(codes[:-2] * len(numbers) + codes[1:-1], return_inverse=True)[1]
        _, place, counts = np.unique(pairs * len(numbers) + codes[2:], return_inverse=True, return_counts=True)
        often = counts[place] > 1
    covered = np.zeros(n + 2, dtype=bool)
    for k in range(3):
        covered[k : n + k] |= often
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """MEASURES of one text. Words are parted at the six ASCII white-space characters."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    joined = b"".join(words)
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(joined.decode("utf-8", "surrogatepass")),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def measured(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns, the measures and base_failed of every document."""
    rows = docs.select(*carried, F.col("text").cast("string").alias("text"))
    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "text"), *(T.StructField(m, T.LongType()) for m in MEASURES)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure(t) for t in batch.column(batch.num_columns - 1).to_pylist()], dtype=np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, found.T)], names=[*carried, *MEASURES])

    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return map_batches(rows, work, schema).withColumn("base_failed", failed)


def rejected_at_most(k: int, n: int, share: float) -> float:
    """Probability of at most k rejections among n if each is rejected with this probability."""
    if k >= n:
        return 1.0
    ways = (math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(share) + (n - j) * math.log1p(-share) for j in range(k + 1))
    return min(1.0, math.fsum(map(math.exp, ways)))


def proven(values: dict[int, list[int]], grid: tuple[int, ...], share: float, level: float) -> int | None:
    """Of the proven cutoffs the one that gains most, from counts (good, bad) by value; None if none gains."""
    good, bad = (sum(c[y] for c in values.values()) for y in (0, 1))
    at = sorted(values, reverse=True)
    best, most, lost, caught, reached = None, 0, 0, 0, 0
    # more rejections than this can never be proven, and need no sum
    hopeless = share * good
    for cutoff in grid:
        while reached < len(at) and at[reached] >= cutoff:
            lost, caught = lost + values[at[reached]][0], caught + values[at[reached]][1]
            reached += 1
        if lost > hopeless or rejected_at_most(lost, good, share) > level:
            break
        gain = caught * good - lost * bad  # the share of the bad less that of the good, in whole numbers
        if gain > most:
            best, most = cutoff, gain
    return best


def cutoffs(rows: DataFrame, labels: DataFrame, label: str, rules=RULES, risk: float = RISK, doubt: float = DOUBT) -> dict[str | None, list[int | None]]:
    """By stratum the cutoff of each rule; rows hold doc_id, __stratum, the measures and base_failed."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("of"), F.col(label).cast("int").alias("y"))
        .where(F.col("of").isNotNull() & F.col("y").isNotNull())
        .groupBy("of")
        .agg(F.max("y").alias("y"))
    )
    held = rows.where(~F.col("base_failed")).join(known, F.col("doc_id") == F.col("of"))
    tried = F.explode(
        F.array(*(F.struct(F.lit(k).alias("rule"), _step(F.expr(r.value), r.grid).alias("value")) for k, r in enumerate(rules)))
    )
    counted = held.select("__stratum", "y", tried.alias("t")).groupBy("__stratum", "t.rule", "t.value")
    good = F.col("y") > 0
    # strata, rules and steps of the grids bound these rows
    counts = counted.agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad")).collect()
    found: dict[str | None, list[dict[int, list[int]]]] = {}
    for r in counts:
        found.setdefault(r["__stratum"], [{} for _ in rules])[r["rule"]][r["value"]] = [r["good"], r["bad"]]
    share, level = risk / len(rules), doubt / max(1, len(found) * len(rules))
    return {
        stratum: [proven(values, rule.grid, share, level) for rule, values in zip(rules, tables)] for stratum, tables in found.items()
    }


def _step(value, grid: tuple[int, ...]):
    """The mildest cutoff of an evenly spaced falling grid that the value reaches; one step below the grid if none."""
    width = grid[0] - grid[1]
    below = F.lit(grid[-1] - width)
    reached = F.floor((F.least(value, F.lit(grid[0])) - below) / F.lit(width)) * width + below
    return F.greatest(reached, below).cast("long")


def strata(rows: DataFrame, column: str, labels: DataFrame, most: int) -> list:
    """The values of the column with the most labelled documents."""
    ids = labels.select(F.col("doc_id").cast("long").alias("of")).where(F.col("of").isNotNull()).distinct()
    counted = rows.where(F.col(column).isNotNull()).join(ids, F.col("doc_id") == F.col("of"), "left_semi").groupBy(column).count()
    return [r[0] for r in counted.orderBy(F.desc("count"), column).limit(most).collect()]


def judge(
    docs: DataFrame, labels: DataFrame, label: str, stratum: str, rules=RULES, risk: float = RISK, doubt: float = DOUBT, most: int = MOST_STRATA
) -> DataFrame:
    """doc_id, the measures, base_failed, stratum, broken (names of the rules a document breaks) and kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).cast("string").alias("__stratum"), "text")
    seen = materialise(measured(rows, ["doc_id", "__stratum"]), "rule-measures")
    own = strata(seen, "__stratum", labels, most)
    placed = seen.withColumn("__stratum", F.when(F.col("__stratum").isin(own), F.col("__stratum")) if own else F.lit(None).cast("string"))
    chosen = cutoffs(placed, labels, label, rules, risk, doubt)
    broken = []
    for k, rule in enumerate(rules):
        limit = F.lit(None).cast("long")
        for value, limits in chosen.items():  # at most `most` + 1 strata
            limit = F.when(F.col("__stratum").eqNullSafe(F.lit(value)), F.lit(limits[k]).cast("long")).otherwise(limit)
        reached = ~F.col("base_failed") & (F.expr(f"case when n_words > 0 then {rule.value} end") >= limit)
        broken.append(F.when(reached, F.lit(rule.name)))
    listed = F.array_compact(F.array(*broken))
    return placed.select(
        "doc_id", *MEASURES, "base_failed", F.col("__stratum").alias("stratum"), listed.alias("broken"),
        (~F.col("base_failed") & (F.size(listed) == 0)).alias("kept"),
    )
