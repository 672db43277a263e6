"""Spelling variants: words one edit apart, found by pairs of trie nodes.

Words are counted over whole texts; an occurrence may first lose one code point, as a hash of document and word
decides (`noise`). The distinct words are sorted, dealt in ranges, and each range numbers the nodes of
the forward trie of its words in one pass (a node is a prefix); reversed words number the nodes of the
reversed trie (a node is a suffix). Ranges agree on the prefixes they share because those are prefixes of
the ranges' first and last words, which the driver numbers. A word of n code points then has n + 1
pairs (prefix node, suffix node) that meet and n pairs that skip one position:

* two words differ by one replaced code point if they share a skipping pair,
* by an inserted or deleted one if a skipping pair of the longer is a meeting pair of the shorter.

A pair of equal integers is an equal string around the position, so neighbours are exact. At most one
word has a given meeting pair, and at most as many words as the alphabet has letters a given skipping pair,
so groups are bounded and no list of word pairs is ever made: each group returns, for each of its words, the
number of neighbours and the best one. Within a run of equal letters only the first is skipped
for deletions, so each neighbour counts once.

Words are numbered in code-point order, so ties are broken by number. Forms grow by `ratio` at every step;
roots are found by doubling pointers, in as many rounds as the largest count allows.

Defined results: a null text has no words, and an empty one neither; a null doc_id reads as an empty string in
the noise. Rows repeat and count as often as they stand. Words of any length are kept whole; a node takes
one integer. An empty table gives no rows. What reaches the driver is two words of each range.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import map_batches, materialise

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: Distinct words that a task counts before it hands them on.
COUNTED = 400_000
#: Words of a range that numbers its trie nodes.
RANGE = 50_000
#: Bits for the numbers of one range.
BITS = 38


def one_in(modulus: int, doc_id: int | None, runs: list[str]) -> Iterator[str]:
    """The runs of a document; where modulus divides crc32(doc_id:run), without the code point at crc32 % length."""
    begun = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for run in runs:
        h = zlib.crc32(run.encode(), begun)
        if h % modulus:
            yield run
        else:
            at = h % len(run)
            yield run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int | None = None) -> DataFrame:
    """word, n: the distinct words of the texts that are long and common enough."""
    long_enough = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])
            found.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # bytes change the case of A-Z alone
                runs = long_enough.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
                found.update(runs if noise is None else one_in(noise, doc_id, runs))
                if len(found) >= COUNTED:
                    yield flush()
        yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    counted = map_batches(rows, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= least_count) & (F.length("word") >= least_length))


def shared(a: str, b: str) -> int:
    """Code points that two words begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # the words agree up to low and differ before high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


class Numbers:
    """Numbers of the trie nodes along each of a sorted sequence of words."""

    def __init__(self, first: int, step: int = 1, fixed: list[tuple[str, list[int]]] = ()):
        self.next, self.step, self.fixed = first, step, fixed
        self.word, self.path = "", None

    def along(self, word: str) -> list[int]:
        """Nodes of the word's beginnings, from the empty one on."""
        if self.path is None:
            path = []
        else:
            path = self.path[: shared(word, self.word) + 1]
        for known, nodes in self.fixed:
            n = shared(word, known) + 1
            if n > len(path):
                path += nodes[len(path) : n]
        fresh = len(word) + 1 - len(path)
        path = path + list(range(self.next, self.next + fresh * self.step, self.step))
        self.next += fresh * self.step
        self.word, self.path = word, path
        return path


def _ranged(words: DataFrame, key: str, label: str) -> DataFrame:
    """The words with their range and their place in it, sorted by key over all ranges."""
    ranges = max(1, -(-words.count() // RANGE))
    schema = "word string, n long, key string, range long, place long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([own] * m, pa.int64()), pa.array(range(at, at + m), pa.int64())], names=["word", "n", "key", "range", "place"]
            )
            at += m

    dealt = words.select("word", "n", F.expr(key).alias("key")).repartitionByRange(ranges, "key").sortWithinPartitions("key")
    return materialise(map_batches(dealt, work, schema), label)


def _nodes(ranged: DataFrame) -> DataFrame:
    """word, n, id (in key order) and the nodes along each key."""
    context = ranged.sparkSession.sparkContext
    ends = ranged.groupBy("range").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("range").collect()  # two words a range
    boundary = Numbers(-1, -1)
    numbered = {r["range"]: [(r["first"], boundary.along(r["first"])), (r["last"], boundary.along(r["last"]))] for r in ends}
    known = context.broadcast(numbered)  # two words of each range of RANGE words

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, own = None, None
        for batch in batches:
            ids, paths = [], []
            for key, at, place in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4))):
                if at != own:  # a task may read several ranges, and parts of one
                    own = at
                    numbers = Numbers((at << BITS) + _before(place), 1, known.value[at])
                paths.append(numbers.along(key))
                ids.append((at << BITS) + place)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.int64()), pa.array(paths, pa.list_(pa.int64()))], names=["word", "n", "id", "nodes"]
            )

    # one task reads one whole range in its order
    whole = ranged.repartition("range").sortWithinPartitions("range", "place")
    return map_batches(whole, work, "word string, n long, id long, nodes array<long>")


def _before(place: int) -> int:
    if place:
        raise RuntimeError("a range does not begin at its first word")
    return 0


def neighbours(words: DataFrame) -> DataFrame:
    """id, word, n, n_near, best (n, -id of the neighbour with the largest n, ties to the smaller word; null without any)."""
    forward = _nodes(_ranged(words, "word", "variant-words"))
    backward = _nodes(_ranged(words, "reverse(word)", "variant-reversed")).select(F.col("word").alias("of"), F.col("nodes").alias("suffixes"))
    met = materialise(forward.join(backward, F.col("word") == F.col("of")).drop("of"), "variant-nodes")
    # prefixes[i] and suffixes[j] are the nodes of the first i and the last j code points
    size = "size(nodes) - 1"
    meeting = f"transform(sequence(0, {size}), i -> struct(nodes[i] as p, suffixes[{size} - i] as s, 0 as kind))"
    skipping = (
        f"transform(sequence(0, {size} - 1), i -> struct(nodes[i] as p, suffixes[{size} - i - 1] as s,"
        " case when i > 0 and substr(word, i, 1) = substr(word, i + 1, 1) then 1 else 2 end as kind))"
    )
    pairs = met.select("id", "n", F.explode(F.expr(f"concat({meeting}, {skipping})")).alias("x")).select("id", "n", "x.*")
    # one meeting word and as many skipping ones as there are letters, at most
    groups = pairs.groupBy("p", "s").agg(F.collect_list(F.struct("n", (-F.col("id")).alias("back"), "kind")).alias("g")).where("size(g) > 1")
    # kinds: 0 meets; 1 skips, 2 skips the first of its run: 1 and 2 are near each other, 0 and 2 are
    near = "filter(g, y -> y.back <> x.back and x.kind + y.kind >= 2)"
    own = groups.select(F.explode(F.expr(f"transform(g, x -> struct(-x.back as id, size({near}) as near, array_max(transform({near}, y -> struct(y.n as n, y.back as back))) as best))")).alias("x"))
    found = own.select("x.*").where("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    joined = met.select("id", "word", "n").join(found.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left").drop("of")
    return joined.withColumn("n_near", F.coalesce("n_near", F.lit(0)).cast("long"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, form, root, n_near, form_n for a table word, n of distinct words."""
    found = neighbours(materialise(words, "variant-vocabulary"))
    chosen = F.when(F.col("best.n") >= ratio * F.col("n"), F.col("best"))
    rows = materialise(found.select("id", "word", "n", "n_near", (-chosen["back"]).alias("form_id"), chosen["n"].alias("form_n")), "variant-forms")
    steps = rows.where("form_id is not null").select("id", F.col("form_id").alias("root_id"))
    most = rows.agg(F.max("n")).first()[0] or 1
    # counts grow by the ratio at each step, which bounds the length of a chain
    chain = 1 if ratio < 2 else int(math.log(most, ratio)) + 1
    for _ in range(max(0, math.ceil(math.log2(chain)))):
        onward = steps.select(F.col("id").alias("at"), F.col("root_id").alias("then"))
        steps = materialise(steps.join(onward, F.col("root_id") == F.col("at"), "left").select("id", F.coalesce("then", "root_id").alias("root_id")), "variant-roots")
    names = rows.select(F.col("id").alias("named"), F.col("word").alias("name"))
    ends = steps.join(names, F.col("root_id") == F.col("named")).select(F.col("id").alias("of"), F.col("name").alias("root"))
    forms = rows.join(names, F.col("form_id") == F.col("named"), "left").withColumnRenamed("name", "form")
    out = forms.join(ends, F.col("id") == F.col("of"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
