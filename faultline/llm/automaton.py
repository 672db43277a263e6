"""BPE as a deterministic automaton over token labels, compiled merge by merge.

The automaton accepts exactly the token sequences that the merges produce. It starts with one state
that loops on every base symbol. Each merge (u, v) -> w adds a gadget: where an arc u leads to a
state with an arc v, an arc w now leads to where v led; and u leads to a copy of its state without
the arc v, since u followed by v would have been merged. All arcs with one label share their target,
so an arc set is a bit per (label, state), and a target a number per label.

A word is encoded by walking its prefixes: every prefix has one valid token sequence, hence one
state, and a label that fits at a position extends it if the table has the arc. No merge is ever
looked up. Decoding emits the labels of the arcs.

Normalisation and pre-splitting are the tokenizer file's own. Added tokens are cut out first, as they
stand in the text, and emit their own id.

Defined results: a null text counts as empty, and an empty one gives no ids and an empty decoded text;
symbols without an id are dropped, as the tokenizer file without an unknown token has it. Rows
repeat and null doc_ids stay as they are. Texts are worked on whole, word by word.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from faultline.llm.common import CACHED_CHARS, Kept, held, map_batches, texts


#: Chunks that are normalised together.
LEARNT = 10_000
#: White space to Python, but not to all tokenizers.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85]")


class Automaton:
    """Arc bits by label, targets by label, labels by id."""

    def __init__(self, arcs: bytes, stride: int, target: list[int], labels: list[str], suffix: str):
        self.arcs, self.stride, self.target, self.labels, self.suffix = arcs, stride, target, labels, suffix
        used = [(s, i) for i, s in enumerate(labels) if target[i] >= 0]
        self.inner = {s: i for s, i in used if not (suffix and s.endswith(suffix))}
        self.final = {s.removesuffix(suffix): i for s, i in used if not suffix or s.endswith(suffix)}
        # labels letter by letter: a dictionary for each beginning, with the label that ends there under ""
        self.begun: dict = {}
        for s, i in self.inner.items():
            node = self.begun
            for c in s:
                node = node.setdefault(c, {"": -1})
            node[""] = i
        self.longest = max(map(len, self.final), default=0)

    def encode(self, word: str) -> list[int]:
        """Ids of one pre-split word."""
        found = self._walk(word, self.final)
        return self._without_unknown(word) if found is None else found

    def _walk(self, word: str, final: dict[str, int]) -> list[int] | None:
        """Labels of the one path over the whole word; None if a symbol has no label."""
        arcs, stride, target, begun = self.arcs, self.stride, self.target, self.begun
        end = len(word)
        last = end - 1
        state, start, by = [0] + [-1] * end, [0] * (end + 1), [0] * (end + 1)
        for i in range(end):
            here = state[i]
            if here < 0:
                return None
            byte, bit = here >> 3, here & 7
            node, j = begun, i
            for c in word[i:last]:
                if c not in node:
                    break
                node = node[c]
                j += 1
                label = node[""]
                if label >= 0 and arcs[label * stride + byte] >> bit & 1:
                    state[j], start[j], by[j] = target[label], i, label
            if end - i <= self.longest and (label := final.get(word[i:])) is not None:
                if arcs[label * stride + byte] >> bit & 1:
                    state[end], start[end], by[end] = target[label], i, label
        if state[end] < 0:
            return None
        out = []
        while end:
            out.append(by[end])
            end = start[end]
        return out[::-1]

    def _without_unknown(self, word: str) -> list[int]:
        """Symbols without an id vanish before any merge; the last one bears the suffix if it has an id."""
        symbols = "".join(c for c in word[:-1] if c in self.inner)
        if word[-1:] in self.final:
            return self._walk(symbols + word[-1:], self.final)
        return self._walk(symbols, self.inner)

    def decode(self, ids: list[int]) -> str:
        """The arc labels; a file without a decoder joins them by a space."""
        return " ".join([self.labels[i] for i in ids])


def _states(vocab: dict[str, int], merges: list[tuple[str, str]], base: list[str], suffix: str, size: int) -> tuple:
    """For each merge (state of u that loses v, state it is copied from or -1); targets; number of states."""
    target = [-1] * size
    users = [1, 0]  # labels that lead to a state: 0 is the start, 1 the end of a word
    for s in base:
        last = int(bool(suffix) and s.endswith(suffix))
        target[vocab[s]] = last
        users[last] += 1
    steps = []
    for u, v in merges:
        a, b, w = vocab[u], vocab[v], vocab[u + v]
        if target[a] < 0 or target[b] < 0:
            raise ValueError(f"merge {u!r} {v!r} comes before its parts")
        old = target[a]
        target[w] = target[b]
        users[target[b]] += 1
        if users[old] > 1:
            target[a] = len(users)
            users[old] -= 1
            users.append(1)
            steps.append((target[a], old))
        else:
            steps.append((old, -1))
    return steps, target, len(users)


def compile_merges(vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> Automaton:
    """Gadgets for all merges, in their order."""
    made = {u + v for u, v in merges}
    base = [s for s in vocab if s not in made and len(s.removesuffix(suffix) if s != suffix else s) == 1]
    size = max(vocab.values(), default=-1) + 1
    steps, target, states = _states(vocab, merges, base, suffix, size)
    stride = -(-states // 8)
    bits = np.zeros((size, stride), dtype=np.uint8)
    for s in base:
        bits[vocab[s], 0] |= 1
    for (u, v), (state, source) in zip(merges, steps):
        if source >= 0:
            # a copy of u's state: the same arcs, from now on without v
            bits[:, state >> 3] |= (bits[:, source >> 3] >> (source & 7) & 1) << (state & 7)
        bits[vocab[v], state >> 3] &= 255 ^ (1 << (state & 7))
        bits[vocab[u + v]] |= bits[vocab[u]]
    labels = [""] * size
    for s, i in vocab.items():
        labels[i] = s
    return Automaton(bits.tobytes(), stride, target, labels, suffix)


@functools.lru_cache(maxsize=2)
def compiled(path: str) -> tuple[Automaton, dict[str, int], str]:
    """The automaton, the added tokens and the file's text."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    model = spec["model"]
    if model["type"] != "BPE" or model.get("ignore_merges") or model.get("unk_token") or model.get("byte_fallback"):
        raise ValueError("only plain BPE files are compiled")
    if spec.get("decoder") is not None or spec.get("post_processor") is not None or model.get("continuing_subword_prefix"):
        raise ValueError("only files without decoder and post-processor are compiled")
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens must match as they stand")
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    machine = compile_merges(model["vocab"], merges, model.get("end_of_word_suffix") or "")
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return machine, added, text


class Encoder:
    """Whole texts to ids and back, with the words kept that came up lately."""

    def __init__(self, machine: Automaton, added: dict[str, int], text: str):
        from tokenizers import Tokenizer

        self.machine = machine
        rules = Tokenizer.from_str(text)
        self.normalise = rules.normalizer.normalize_str if rules.normalizer else str
        self.split = rules.pre_tokenizer.pre_tokenize_str
        self.added = added
        # at one place the tokenizer takes the longest of the added tokens that match
        longest = sorted(added, key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, longest))) if added else None
        self.chunks = Kept(self.piece)
        self.words = Kept(lambda w: tuple(self.machine.encode(w)))

    def made(self, words: Iterable[str]) -> tuple[bytes, bytes]:
        """Ids and joined labels of pre-split words."""
        ids = [i for w in words for i in self.words[w]]
        return struct.pack(f"<{len(ids)}I", *ids), self.machine.decode(ids).encode()

    def piece(self, chunk: str) -> tuple[bytes, bytes]:
        return self.made([w for w, _ in self.split(self.normalise(chunk))])

    def learn(self, chunks: list[str]) -> None:
        """Put chunks without white space into the cache; normalise and split them all at once."""
        normal = self.normalise(" ".join(chunks))
        parts = normal.split(" ")
        if len(parts) != len(chunks):
            return
        words = iter(self.split(normal))
        word, (start, _) = next(words, ("", (len(normal) + 1, 0)))
        at = 0
        for chunk, part in zip(chunks, parts):
            at += len(part) + 1
            own = []
            while start < at:
                own.append(word)
                word, (start, _) = next(words, ("", (len(normal) + 1, 0)))
            self.chunks[chunk] = self.made(own)

    def plain(self, text: str) -> list[tuple[bytes, bytes]]:
        """White space only separates words in this family of files, so texts are taken apart there."""
        chunks = text.split(" ") if _ODD_SPACE.search(text) else text.split()
        known, old = self.chunks, self.chunks.old
        missing = [c for c in set(chunks) if c not in known and c not in old and len(c) <= CACHED_CHARS and c.split() == [c]]
        for start in range(0, len(missing), LEARNT):
            self.learn(missing[start : start + LEARNT])
        return list(map(known.__getitem__, chunks))

    def parts(self, text: str) -> list[tuple[bytes, bytes]]:
        if self.cut is None or not self.cut.search(text):
            return self.plain(text)
        found, at = [], 0
        for m in self.cut.finditer(text):
            found += self.plain(text[at : m.start()])
            token = m.group()
            found.append((np.array([self.added[token]], dtype="<u4").tobytes(), token.encode()))
            at = m.end()
        return found + self.plain(text[at:])

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """Ids as little-endian 32-bit integers, and the decoded text in UTF-8."""
        found = self.parts(text)
        # whatever has no ids has no labels either
        return b"".join([a for a, _ in found]), b" ".join([b for a, b in found if a])


def encoder(parts: Callable[[], tuple], key: str) -> Encoder:
    """One encoder for a worker process, also over several tasks."""
    return held("automaton", key, lambda: Encoder(*parts()))


def encode_documents(docs: DataFrame, path: str, digest: bool = False) -> DataFrame:
    """doc_id, ids (little-endian 32-bit integers), decoded; or the counts and digests of both."""
    machine = compiled(path)
    key = hashlib.sha256(machine[2].encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # its size depends on the tokenizer file alone
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, n_tokens long, ids binary, decoded string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(lambda: shared.value, key)
        for batch in batches:
            numbers, first, second = [], [], []
            for text in batch.column(1).to_pylist():
                ids, decoded = coder.encode(text)
                numbers.append(len(ids) // 4)
                first.append(hashlib.sha256(ids).hexdigest() if digest else ids)
                second.append(hashlib.sha256(decoded).hexdigest() if digest else decoded.decode())
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "n_tokens", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(numbers, pa.int64()), pa.array(first, pa.string() if digest else pa.binary()), pa.array(second, pa.string())],
                names=names,
            )

    return map_batches(texts(docs), work, schema)
