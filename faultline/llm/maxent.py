"""A hashed maximum-entropy language model with a class-factored softmax.

The probability of a token is that of its class given the history, times that of the token in its class.
Classes are the end of a text, the commonest words one by one, and hashes of the other words' last
letters. The class has a log-linear model: a bias, the word before (hashed), the word before that (hashed, a
skip feature) and the pair of the two classes before. Within a class a token has its smoothed share
of the class's training tokens; all unseen tokens of a class share one count.

The weights are trained by distributed gradient updates: in each round every task goes once over its part
of the round's training texts and the changes are averaged by tokens. All training texts are used. Texts are
scored in blocks of sparse numpy batches; a block's words meet their corpus counts by a join.

Defined results: a null text counts as empty and has the end as its only token. Rows repeat and count as
often as they stand; a null doc_id is in no held-out fold. Texts are scored whole. Without training tokens
N and V are 0 and all classes are equally likely. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import Kept, map_batches, materialise, texts

#: Classes: the end, the commonest words, and hashes of the other words' endings.
COMMON, ENDINGS = 31, 32
CLASSES = 1 + COMMON + ENDINGS
ENDING_BYTES = 3
#: Rows of weights for words one back and for words two back, each.
BUCKETS = 4_096
PAIRS = CLASSES * CLASSES
ROWS = 2 * BUCKETS + PAIRS + 1
ROUNDS = 2
#: Tokens of a gradient step, and of a scoring batch.
STEP, BATCH = 4_096, 16_384
RATE = 0.3
#: Groups of so many rows at most are added up together.
FEW = 8
#: Bytes of text that share a dictionary.
BLOCK_BYTES = 32 * 1024 * 1024

#: The end of a text; no word is empty.
END = b""


def words(text: str) -> list[bytes]:
    """A-Z lower-cased, parted at the six ASCII white-space characters."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def _code(common: dict[bytes, int]):
    """Class and bucket of a word in one number."""

    def code(word: bytes) -> int:
        kind = 0 if word == END else common.get(word) or 1 + COMMON + zlib.crc32(word[-ENDING_BYTES:]) % ENDINGS
        return kind * BUCKETS + zlib.crc32(word) % BUCKETS

    return code


def histories(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows of weights for each token (3 columns) of texts that begin at starts, each ending with its end."""
    before = np.concatenate([[0], codes[:-1]])
    before[starts] = 0  # what the end of a text looks like
    second = np.concatenate([[0], before[:-1]])
    second[starts] = 0
    kind, kind2 = before // BUCKETS, second // BUCKETS
    return np.stack([before % BUCKETS, BUCKETS + second % BUCKETS, 2 * BUCKETS + kind2 * CLASSES + kind], axis=1)


def _softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    logits = weights[rows[:, 0]]
    logits += weights[rows[:, 1]]
    logits += weights[rows[:, 2]]
    logits += weights[-1]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _sums(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of values, in the order given, from each of `first` to the next; and how many rows each has.

    Most groups have few rows. Those are added up together, all second rows, all third ones and so on, in the order
    in which `reduceat` adds them: the first row comes last.
    """
    sizes = np.diff(np.append(first, len(order)))
    total = values[order[first]]
    few = np.flatnonzero((sizes > 1) & (sizes <= FEW))
    few = few[np.argsort(-sizes[few], kind="stable")]  # the largest first, so that each further row meets a beginning
    if len(few):
        at, left = first[few], sizes[few]
        rest = values[order[at + 1]]
        for k in range(2, int(left[0])):
            n = int(np.count_nonzero(left > k))
            rest[:n] += values[order[at[:n] + k]]
        total[few] += rest
    many = np.flatnonzero(sizes > FEW)
    if len(many):
        own = sizes[many]
        taken = order[np.repeat(sizes > FEW, sizes)]
        total[many] = np.add.reduceat(values[taken], np.cumsum(own) - own, axis=0)
    return total, sizes


class Learner:
    """Gradient steps with rates that fall as a row of weights gathers gradient."""

    def __init__(self, weights: np.ndarray):
        self.start, self.weights = weights, weights.copy()
        self.gathered = np.full(ROWS, 1e-2, dtype=np.float32)
        self.tokens = 0

    def step(self, rows: np.ndarray, target: np.ndarray) -> None:
        n = len(target)
        error = _softmax(self.weights, rows)
        error[np.arange(n), target] -= 1.0
        for column in range(rows.shape[1]):
            # numbers of 16 bits are sorted by counting
            order = np.argsort(rows[:, column].astype(np.uint16), kind="stable")
            place = rows[order, column]
            first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            self._move(place[first], *_sums(error, order, first))
        self._move(np.array([ROWS - 1]), error.sum(axis=0, keepdims=True), np.array([n]))
        self.tokens += n

    def _move(self, own: np.ndarray, gradient: np.ndarray, seen: np.ndarray) -> None:
        # a row's gradient by the root of its tokens, so that common rows do not leap
        several = np.flatnonzero(seen > 1)
        gradient[several] = gradient[several] / np.sqrt(seen[several])[:, None]
        gathered = self.gathered[own] + (gradient * gradient).mean(axis=1)
        self.gathered[own] = gathered
        gradient *= RATE
        gradient /= np.sqrt(gathered)[:, None]
        gradient /= CLASSES**0.5
        self.weights[own] -= gradient

    def learn(self, codes: np.ndarray, starts: np.ndarray) -> None:
        rows, target = histories(codes, starts), codes // BUCKETS
        for at in range(0, len(codes), STEP):
            self.step(rows[at : at + STEP], target[at : at + STEP])


def _batches_of_codes(batches: Iterator[pa.RecordBatch], column: int, kept: Kept) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and text starts, about a million tokens at a time."""
    codes: list[np.ndarray] = []
    starts, size = [], 0
    for batch in batches:
        for text in batch.column(column).to_pylist():
            own = words(text)
            own.append(END)
            starts.append(size)
            codes.append(np.fromiter(map(kept.__getitem__, own), dtype=np.int64, count=len(own)))
            size += len(own)
            if size >= 1_000_000:
                yield np.concatenate(codes), np.array(starts)
                codes, starts, size = [], [], 0
    if size:
        yield np.concatenate(codes), np.array(starts)


def train(rows: DataFrame, common: dict[bytes, int], weights: np.ndarray) -> np.ndarray:
    """Weights after ROUNDS rounds over the texts of rows (doc_id, text), each text in one round."""
    context = rows.sparkSession.sparkContext
    part_rows = 512
    for turn in range(ROUNDS):
        now, names = context.broadcast(weights), context.broadcast(common)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            learner = Learner(now.value)
            for codes, starts in _batches_of_codes(batches, 0, Kept(_code(names.value))):
                learner.learn(codes, starts)
            change = (learner.weights - learner.start).astype(np.float16)  # half the bytes to send
            parts = range(0, ROWS if learner.tokens else 0, part_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(parts), pa.int64()), pa.array([learner.tokens for _ in parts], pa.int64()), pa.array([change[k : k + part_rows].tobytes() for k in parts], pa.binary())],
                names=["part", "tokens", "change"],
            )

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list] = {}
            for batch in batches:
                for part, tokens, change in zip(*(c.to_pylist() for c in batch.columns)):
                    held = total.setdefault(part, [0, 0.0])
                    held[0] += tokens
                    held[1] = held[1] + np.frombuffer(change, dtype=np.float16).astype(np.float64) * tokens
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int64()), pa.array([t for t, _ in total.values()], pa.int64()), pa.array([(c / t).astype(np.float32).tobytes() for t, c in total.values()], pa.binary())],
                names=["part", "tokens", "change"],
            )

        schema = "part long, tokens long, change binary"
        mine = rows.where(F.pmod(F.xxhash64("text", "doc_id"), F.lit(ROUNDS)) == turn).select("text")
        summed = map_batches(map_batches(mine, work, schema).repartition("part"), add, schema).collect()  # the size of the weights
        weights = weights.copy()
        for r in summed:
            weights[r["part"] : r["part"] + part_rows] += np.frombuffer(r["change"], dtype=np.float32).reshape(-1, CLASSES)
    return weights


@dataclass
class Corpus:
    """What is counted over the training texts: tokens, distinct tokens, and both by class."""

    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray


def blocks(rows: DataFrame) -> DataFrame:
    """Blocks of texts of one scan task with their dictionary, written once.

    kind 0: a text (doc_id, held_out, ids of its tokens in the block's dictionary); kind 1: a word of the
    dictionary with its training tokens.
    """
    schema = "block long, kind int, doc_id long, held_out boolean, ids binary, position int, word binary, n long"

    def flush(block: int, found: list, seen: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(seen), dtype=np.int64)
        for _, held, ids in found:
            if not held:
                np.add.at(counts, np.frombuffer(ids, dtype=np.int32), 1)
        n, m = len(found), len(seen)
        for start in range(0, n, 1_000):
            part = found[start : start + 1_000]
            k = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * k), pa.array([0] * k, pa.int32()), pa.array([d for d, _, _ in part], pa.int64()), pa.array([h for _, h, _ in part], pa.bool_()), pa.array([i for _, _, i in part], pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64())],
                names=NAMES,
            )
        names = list(seen)
        for start in range(0, m, 100_000):
            part = names[start : start + 100_000]
            k = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * k), pa.array([1] * k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.bool_()), pa.nulls(k, pa.binary()), pa.array(np.arange(start, start + k, dtype=np.int32)), pa.array(part, pa.binary()), pa.array(counts[start : start + k])],
                names=NAMES,
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        found, size = [], 0
        seen: dict[bytes, int] = {}
        for batch in batches:
            for doc_id, held, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = words(text)
                own.append(END)
                for w in set(own).difference(seen):
                    seen[w] = len(seen)
                found.append((doc_id, held, np.fromiter(map(seen.__getitem__, own), dtype=np.int32, count=len(own)).tobytes()))
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield from flush(number, found, seen)
                    number, size = number + 1, 0
                    found, seen = [], {}
        if found:
            yield from flush(number, found, seen)

    return materialise(map_batches(rows.select("doc_id", "held_out", "text"), work, schema), "lm-blocks")


NAMES = ["block", "kind", "doc_id", "held_out", "ids", "position", "word", "n"]


def _class_totals(counted: DataFrame, common: dict[bytes, int]) -> Corpus:
    names = counted.sparkSession.sparkContext.broadcast(common)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _code(names.value)
        tokens, distinct = np.zeros(CLASSES, dtype=np.int64), np.zeros(CLASSES, dtype=np.int64)
        for batch in batches:
            kinds = np.array([code(w) for w in batch.column(0).to_pylist()], dtype=np.int64) // BUCKETS
            np.add.at(tokens, kinds, batch.column(1).to_numpy())
            np.add.at(distinct, kinds, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(tokens), pa.array(distinct)], names=["kind", "tokens", "distinct"])

    sums = map_batches(counted.select("word", "c"), work, "kind long, tokens long, distinct long").groupBy("kind").agg(F.sum("tokens").alias("t"), F.sum("distinct").alias("d"))
    corpus = Corpus(0, 0, np.zeros(CLASSES, dtype=np.int64), np.zeros(CLASSES, dtype=np.int64))
    for r in sums.collect():  # one row per class
        corpus.class_tokens[r["kind"]], corpus.class_distinct[r["kind"]] = r["t"], r["d"]
    corpus.tokens, corpus.distinct = int(corpus.class_tokens.sum()), int(corpus.class_distinct.sum())
    return corpus


def score_block(ids: list[np.ndarray], c: np.ndarray, codes: np.ndarray, corpus: Corpus, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known tokens, base score and model score of texts given as dictionary positions."""
    sizes = np.array([len(i) for i in ids])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.concatenate(ids)
    kinds = codes // BUCKETS
    base = np.log10((c + 1.0) / (corpus.tokens + corpus.distinct + 1.0))
    inside = np.log10((c + 1.0) / (corpus.class_tokens + corpus.class_distinct + 1.0)[kinds])
    own = codes[flat]
    rows, target = histories(own, starts), own // BUCKETS
    outside = np.empty(len(flat))
    for at in range(0, len(flat), BATCH):
        p = _softmax(weights, rows[at : at + BATCH])
        outside[at : at + BATCH] = np.log10(np.maximum(p[np.arange(len(p)), target[at : at + BATCH]], 1e-30))
    total = lambda values: np.add.reduceat(values, starts)  # noqa: E731  every text has a token
    return total((c > 0).astype(np.int64)[flat]), total(base[flat]), total(inside[flat] + outside)


def score(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learns where held_out is false."""
    rows = texts(docs).withColumn("held_out", held_out)
    context = docs.sparkSession.sparkContext
    written = blocks(rows)
    dictionary = written.where("kind = 1").select("block", "position", "word", "n")
    counted = materialise(dictionary.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    top = counted.where(F.octet_length("word") > 0).orderBy(F.desc("c"), "word").limit(COMMON).collect()
    common = {bytes(r["word"]): k + 1 for k, r in enumerate(top)}
    corpus = _class_totals(counted, common)
    weights = np.zeros((ROWS, CLASSES), dtype=np.float32)
    share = (corpus.class_tokens + 0.5) / (corpus.tokens + 0.5 * CLASSES)
    weights[-1] = np.log(share)
    if corpus.tokens:
        weights = train(rows.where(~F.col("held_out")), common, weights)
    model = context.broadcast((common, corpus, weights))  # a fixed size

    met = dictionary.join(counted.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    lookup = met.select(F.col("block").alias("of_block"), "position", "word", F.coalesce("c", F.lit(0)).alias("c"))
    own = written.where("kind = 0").select("block", "doc_id", "held_out", "ids")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def work(found: pa.Table, table: pa.Table) -> pa.Table:
        names, totals, learnt = model.value
        place = table["position"].to_numpy()
        code = _code(names)
        c, codes = np.zeros(len(place), dtype=np.float64), np.zeros(len(place), dtype=np.int64)
        c[place] = table["c"].to_numpy()
        codes[place] = [code(w) for w in table["word"].to_pylist()]
        # texts of about a million tokens at a time
        known, base, scores, sizes = [], [], [], []
        batch: list[np.ndarray] = []
        held = 0
        every = found["ids"].to_pylist()
        for k, ids in enumerate(every):
            batch.append(np.frombuffer(ids, dtype=np.int32))
            held += len(batch[-1])
            if held >= 1_000_000 or k == len(every) - 1:
                a, b, s = score_block(batch, c, codes, totals, learnt)
                known.append(a)
                base.append(b)
                scores.append(s)
                sizes += [len(i) for i in batch]
                batch, held = [], 0
        none = np.zeros(0)
        join = lambda parts: np.concatenate(parts) if parts else none
        return pa.table(
            {
                "doc_id": found["doc_id"],
                "held_out": found["held_out"],
                "n_tokens": pa.array(sizes, pa.int64()),
                "n_known": pa.array(join(known).astype(np.int64)),
                "train_tokens": pa.array([totals.tokens] * len(every), pa.int64()),
                "base_score": pa.array(join(base).astype(np.float64)),
                "score": pa.array(join(scores).astype(np.float64)),
            }
        )

    return own.groupBy("block").cogroup(lookup.groupBy("of_block")).applyInArrow(work, schema)
