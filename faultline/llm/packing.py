"""Packing of token sequences as a cutting-stock problem, solved by column generation.

Documents are tokenized and cut into full sequences and one rest. A piece's size is its length in steps
of GRID tokens, rounded up. Only the histogram of sizes, at most width / GRID rows, reaches the driver.
There a linear program over patterns (multisets of sizes that share a sequence) is solved: a knapsack
dynamic program prices new patterns with the dual values until none helps. Pattern counts are rounded
down, the few pieces left over are packed best-fit. Every piece then finds its sequence from its rank
among the pieces of its size, which Spark computes in bounded groups, and its offset from the pieces
before it in the sequence.

Defined results: a null text counts as empty, and an empty one consists of the end token alone; rows
repeat and null doc_ids stay as they are; an empty table gives no pieces. Texts of any length are
tokenized whole. Ties of rank are broken by doc_id, start and digest; rows that agree in all may swap
places.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.common import held, map_batches, materialise, texts

# Fixed value: what byte-level files cut texts into.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space that the look-ahead above would take too many steps back in.
_LONG_SPACE = re.compile(r"\s{1000}")
#: Tokens in a step of size: a finer grid pads less and makes a larger linear program.
GRID = 8
#: Pieces of one size that are ranked in one group.
RANKED_TOGETHER = 50_000
#: Patterns added after each run of the knapsack.
COLUMNS = 48
#: The linear program ends when the knapsack proves that it is this close to its best.
GAP = 2e-4


def byte_ranks(spec: str, rules) -> dict[bytes, int] | None:
    """Ids by bytes, where they alone tell the merges; None for other files.

    That holds for a plain byte-level file whose ids follow its merges and whose every entry comes out of its
    own symbols: a pair that makes an entry then only ever stands beside each other as the listed merge.
    """
    read = json.loads(spec)
    model, split = read["model"], read.get("pre_tokenizer") or {}
    wanted = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if model["type"] != "BPE" or read.get("normalizer") or any(split.get(k) != v for k, v in wanted.items()):
        return None
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")):
        return None
    # how byte-level files print bytes: visible Latin-1 signs as they are, the others from U+0100 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    added = {t["content"] for t in read["added_tokens"]}
    entries = {t: i for t, i in model["vocab"].items() if t not in added}
    if not all(c in byte for t in entries for c in t) or not all(c in entries for c in byte):
        return None
    made = [entries.get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
    if made != sorted(set(made)) or len(made) + 256 != len(entries):
        return None
    if any([x.id for x in rules.model.tokenize(t)] != [i] for t, i in entries.items()):
        return None
    return {bytes(byte[c] for c in t): i for t, i in entries.items()}


class Tokens:
    """Ids of whole texts, as the tokenizer file gives them.

    Files that byte_ranks can read are encoded by their ranks, which is faster and gives the same ids; texts
    with an added token or a very long run of white space, and other files, by the file's own library.
    """

    def __init__(self, spec: str, end: int):
        import tiktoken
        from tokenizers import Tokenizer

        self.rules = Tokenizer.from_str(spec)
        self.rules.no_padding()
        self.rules.no_truncation()
        self.added = [t.content for t in self.rules.get_added_tokens_decoder().values()]
        self.end = np.array([end], dtype="<u4").tobytes()
        ranks = byte_ranks(spec, self.rules)
        self.fast = ranks and tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _ids(self, text: str) -> list[int]:
        if self.fast is None or any(t in text for t in self.added) or _LONG_SPACE.search(text):
            return self.rules.encode(text, add_special_tokens=False).ids
        return self.fast(text)

    def encode(self, text: str) -> bytes:
        """Ids with the end token, as little-endian 32-bit integers."""
        return np.array(self._ids(text), dtype="<u4").tobytes() + self.end


def pieces(docs: DataFrame, path: str, width: int, end: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids): full pieces and one rest of each document."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    key = hashlib.sha256(spec.encode()).hexdigest() + str(end)
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # the tokenizer file
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = held("packing", key, lambda: Tokens(shared.value, end))
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = memoryview(tokens.encode(text))
                total = len(ids) // 4
                for start in range(0, total, width):
                    part = ids[4 * start : 4 * (start + width)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total, *([bytes(part)] if with_ids else [])))
            columns = list(zip(*rows)) if rows else [[]] * (5 + with_ids)
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.binary()) for c in columns[5:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + with_ids])

    return map_batches(texts(docs), work, schema)


def _knapsack(value: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each total the best value of sizes that add up to it exactly, and its last size's row."""
    by_length = np.full(width + 1, -np.inf)
    by_length[lengths] = value
    row = np.full(width + 1, -1)
    row[lengths] = np.arange(len(lengths))
    best, last = np.full(width + 1, -np.inf), np.full(width + 1, -1)
    best[0] = 0.0
    backward = by_length[::-1]
    for t in range(1, width + 1):
        with_last = backward[width - t : width] + best[:t]  # the last size is t - i for the rest i
        i = int(with_last.argmax())
        best[t] = with_last[i]
        last[t] = row[t - i]
    return best, last


def _pattern(total: int, last: np.ndarray, lengths: np.ndarray) -> tuple[int, ...]:
    rows = []
    while total > 0:
        rows.append(int(last[total]))
        total -= int(lengths[last[total]])
    return tuple(sorted(rows))


def solve(histogram: dict[int, int], width: int) -> list[tuple[int, tuple[int, ...]]]:
    """(number of sequences, sizes in each) that use up the histogram of sizes exactly.

    The work depends on the width only, never on the counts.
    """
    lengths = np.array(sorted(n for n, c in histogram.items() if c > 0), dtype=np.int64)
    if not len(lengths):
        return []
    demand = np.array([histogram[int(n)] for n in lengths], dtype=np.float64)
    fractions = _relaxed(lengths, demand, width)
    left = demand.astype(np.int64)
    chosen: Counter = Counter()
    for pattern, share in sorted(fractions.items(), key=lambda x: (-x[1], x[0])):
        need = Counter(pattern)
        times = min(int(share + 1e-6), *(int(left[r]) // n for r, n in need.items()))
        if times > 0:
            chosen[tuple(int(lengths[r]) for r in pattern)] += times
            for r, n in need.items():
                left[r] -= n * times
    for pattern in _best_fit({int(n): int(c) for n, c in zip(lengths, left) if c}, width):
        chosen[pattern] += 1
    return sorted(((n, p) for p, n in chosen.items()), key=lambda x: (-x[0], x[1]))


def _relaxed(lengths: np.ndarray, demand: np.ndarray, width: int) -> dict[tuple[int, ...], float]:
    """Patterns (rows of lengths) with their fractional counts in the solved linear program."""
    m = len(lengths)
    pool: list[tuple[int, ...]] = [(r,) * int(width // lengths[r]) for r in range(m)]
    matrix = np.zeros((m, 4 * m + 8 * COLUMNS))
    costs = np.ones(matrix.shape[1])  # each pattern is one sequence
    seen = set(pool)
    for k, pattern in enumerate(pool):
        matrix[k, k] = len(pattern)
    basis = np.arange(m)
    inverse = np.diag(1.0 / np.diag(matrix[:, :m]))
    # a little more of each length, all different, keeps equal ratios from stalling the pivots
    held = demand * (1 + 1e-9 * (np.arange(m) % 97))
    x = inverse @ held
    while True:
        # pivots over the patterns known so far
        while True:
            dual = costs[basis] @ inverse
            reduced = costs[: len(pool)] - dual @ matrix[:, : len(pool)]
            enter = int(reduced.argmin())
            if reduced[enter] > -1e-9:
                break
            direction = inverse @ matrix[:, enter]
            ratio = np.where(direction > 1e-10, x / np.where(direction > 1e-10, direction, 1.0), np.inf)
            leave = int(ratio.argmin())
            step = ratio[leave]
            x -= step * direction
            x[leave] = step
            inverse[leave] /= direction[leave]
            direction[leave] = 0.0
            touched = np.nonzero(np.abs(direction) > 1e-13)[0]
            inverse[touched] -= direction[touched, None] * inverse[leave]
            basis[leave] = enter
            np.maximum(x, 0.0, out=x)
        # price: the best pattern of each total, and the best one with each size in it
        best, last = _knapsack(dual, lengths, width)
        # dividing the duals by the best pattern's value makes them feasible: a bound on the optimum
        if best.max() <= 1 + GAP:
            break
        row_of = {int(n): r for r, n in enumerate(lengths)}
        tops = np.argsort(-best, kind="stable")[:4]
        offers = [(best[t - n] + dual[row_of[int(n)]], int(n), int(t - n)) for t in tops for n in lengths if n <= t and np.isfinite(best[t - n])]
        offers.sort(key=lambda o: (-o[0], o[1], o[2]))
        added = 0
        for worth, n, rest in offers:
            if worth <= 1 + 1e-9 or added >= COLUMNS:
                break
            pattern = tuple(sorted((row_of[n], *_pattern(rest, last, lengths))))
            if pattern in seen:
                continue
            seen.add(pattern)
            if len(pool) == matrix.shape[1]:  # forget patterns that are not in use
                keep = np.sort(basis)
                matrix[:, :m] = matrix[:, keep].copy()
                matrix[:, m:] = 0.0
                pool = [pool[i] for i in keep]
                seen = {*pool, pattern}
                basis = np.searchsorted(keep, basis)
            for r in pattern:
                matrix[r, len(pool)] += 1
            pool.append(pattern)
            added += 1
        if not added:
            break
    found: dict[tuple[int, ...], float] = {}
    for b, share in zip(basis, x):
        if share > 1e-9:
            found[pool[int(b)]] = found.get(pool[int(b)], 0.0) + float(share)
    return found


def _best_fit(left: dict[int, int], width: int) -> Iterator[tuple[int, ...]]:
    """Sequences for the pieces left over: the longest piece first, then whatever fills the room best."""
    left = dict(left)
    while left:
        pattern, room = [], width
        while fitting := [n for n in left if n <= room]:
            n = max(fitting)
            pattern.append(n)
            room -= n
            left[n] -= 1
            if not left[n]:
                del left[n]
        yield tuple(sorted(pattern))


def _places(plan: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """By size: rows (first rank, pieces per sequence, first sequence, first slot), ranks ascending."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for times, pattern in plan:
        slot = 0
        for n, copies in sorted(Counter(pattern).items()):
            rows.setdefault(n, []).append((used[n], copies, sequence, slot))
            used[n] += copies * times
            slot += copies
        sequence += times
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


def ranked(rows: DataFrame) -> DataFrame:
    """The pieces and their rank (from 0) among those of their size, in groups of bounded size."""
    salts = max(1, -(-rows.count() // RANKED_TOGETHER))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("size", "salt").count().select(
        F.col("size").alias("of_size"), F.col("salt").alias("of_salt"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("size", "salt").orderBy("doc_id", "start", "ids_crc32")
    counted = dealt.withColumn("rank", F.row_number().over(inside) - F.lit(1))
    joined = counted.join(firsts, (F.col("size") == F.col("of_size")) & (F.col("salt") == F.col("of_salt")))
    return joined.withColumn("rank", (F.col("rank") + F.col("first")).cast("long")).drop("salt", "of_size", "of_salt", "first")


def pack(docs: DataFrame, path: str, width: int = 1024, end: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    cut = materialise(pieces(docs, path, width, end, with_ids).withColumn("size", F.ceil(F.col("length") / F.lit(GRID))), "pieces")
    histogram = {r["size"]: r["count"] for r in cut.groupBy("size").count().collect()}  # at most width / GRID rows
    places = docs.sparkSession.sparkContext.broadcast(_places(solve(histogram, width // GRID)))  # bounded by the width
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids + ", sequence_id long, slot long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.empty(len(rank), dtype=np.int64), np.empty(len(rank), dtype=np.int64)
            for n in np.unique(size):
                at = np.nonzero(size == n)[0]
                table = places.value[int(n)]
                entry = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
                within = rank[at] - entry[:, 0]
                sequence[at] = entry[:, 2] + within // entry[:, 1]
                slot[at] = entry[:, 3] + within % entry[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(slot)], names=[*names, "sequence_id", "slot"]
            )

    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = map_batches(ranked(cut), work, schema)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("slot")
