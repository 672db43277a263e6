"""Toxicity of texts after their spelling is restored by a noisy-channel decoder.

Words spelt with digits or signs, with letters repeated, or letter by letter are read through a lattice:
each character may stand for itself, for the letters it resembles, for one of a repetition, or for
nothing (a separator). A Viterbi search finds the best path under a character trigram model of all
texts given. Words without such signs and without doubled letters have a lattice of one path and stay as
they are. Chunks of up to three characters are read together with their neighbours, at any length of their
run; up to six characters are taken as a neighbour. Common words (of up to six letters, with a share of all
words that bounds their number) are no parts by themselves: a run is read where a part of up to three
characters is no common word, a doubled letter where the word is none.

A feature (a word, its first letters, or five letters in a row) weighs as much as it is commoner in toxic
training documents, shrunk towards no weight. A word is as toxic as its weightiest feature; a document
is judged by logistic regression on its most toxic words. The regression sees each training document with
its own counts taken out.

The character model and the common words need no label and are counted over all texts given; weights and
regression are fitted on at most `sample` labelled rows. Every document is scored over its whole text.

Defined results: a null text counts as empty; a text without words is scored like any other. Rows repeat,
and null doc_ids stay, outside all folds. Without labels of both classes the score is the smoothed
share of label 1. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from heapq import nlargest
from itertools import accumulate, chain, compress, repeat
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import CACHED_CHARS, Kept, extend, held, labelled, logistic, map_batches, materialise, sigmoid, texts, uncollected

#: Labelled rows that weights and regression are fitted on at most.
SAMPLE = 12_000
#: A feature needs so many toxic documents of the sample to get a weight.
LEAST_POSITIVE = 3
#: Documents at the mean rate that each feature is taken to have besides its own.
SHRINK = 10.0
#: Documents that weigh a feature by less than this are left out.
LEAST_WEIGHT = 0.3
#: A word above this counts as a toxic one.
TOXIC_WORD = 1.0
WINDOW = 5
#: Chunks that a worker keeps with what is known of them, and runs, each in one generation.
CACHED, CACHED_RUNS = 120_000, 30_000
#: Chunks, repeats included, whose texts are looked up together.
TOGETHER = 25_000
#: Distinct chunks that a task counts before it hands them on.
COUNTED = 300_000
#: With more possible trigrams than this they are sorted instead of counted in a table.
MOST_TRIGRAMS = 4_000_000
#: Share of all words from which on a word is common, and a single letter.
COMMON_WORD, COMMON_LETTER = 1e-4, 1e-3
PREFIXES = (4, 6)

# Letters that a digit or sign resembles.
RESEMBLES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Of these, the ones that also stand between words or letters.
MARKS = "!|+(¡"
#: Log probabilities of the channel: a resembling sign, a separator inside a word, letters of a run left out, a space inside a word.
SIGN, SEPARATOR, SHORTENED, GAP = -1.0, -0.3, -0.3, -0.3

_EDGE = re.compile(r"^[^\w@$!|+(€£¡]+|[^\w$@]+$")
_ODD = re.compile(r"[\W\d_]|(.)\1")
_DOUBLE = re.compile(r"(.)\1")
#: Signs that mostly stand behind a word; none of them is read as a letter.
STOPS = ".,;:?"
#: With more readings than this a word or part of a run is decoded without looking at them first.
MOST_READINGS = 8
#: With more beginnings of words than this in play a run is decoded at once.
MOST_STATES = 40
_LETTERS = re.compile(r"[^\W\d_]+")
#: Chunks of so many characters at most may be parts of a word, and beside such parts.
SHORT, BESIDE = 3, 6
#: So many parts on each side of a rare one are read with it.
NEAR = 2
#: Runs of so many characters at most are kept with their words.
KEPT_RUN = 64


@dataclass
class Characters:
    """A trigram model of letters, backing off to shorter histories; a space bounds words."""

    counts: dict[str, int] = field(default_factory=dict)

    @staticmethod
    def count(words: Iterable[tuple[str, int]]) -> dict[str, int]:
        """Trigrams of words with their counts, two spaces before a word and one behind."""
        names, counts = zip(*words) if (words := list(words)) else ((), ())
        if not names:
            return {}
        signs = np.frombuffer("".join(f"  {w} " for w in names).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        sizes = np.array([len(w) for w in names]) + 3
        first = np.cumsum(sizes) - sizes
        third = np.ones(len(signs), dtype=bool)
        third[first] = third[first + 1] = False
        at = np.nonzero(third)[0]
        times = np.repeat(np.array(counts, dtype=np.int64), sizes)[at]
        # the alphabet by numbers without gaps, so that few enough trigrams are counted in one table
        there = np.zeros(0x110000, dtype=bool)
        there[signs] = True
        alphabet = np.nonzero(there)[0]
        size = len(alphabet)
        signs = (np.cumsum(there) - 1)[signs]
        packed = (signs[at - 2] * size + signs[at - 1]) * size + signs[at]
        if size**3 <= MOST_TRIGRAMS and int(times.max()) < 2**53 // len(times):
            table = np.bincount(packed, weights=times, minlength=size**3)  # sums below 2**53 are exact
            grams = np.nonzero(table)[0]
            total = table[grams].astype(np.int64)
        else:
            grams, place = np.unique(packed, return_inverse=True)
            total = np.zeros(len(grams), dtype=np.int64)
            np.add.at(total, place, times)
        letters = list(map(chr, alphabet.tolist()))
        return {letters[g // size // size] + letters[g // size % size] + letters[g % size]: n for g, n in zip(grams.tolist(), total.tolist())}

    def __post_init__(self):
        # shorter histories follow from the trigrams, each letter being the third of one
        shorter: Counter = Counter()
        trigrams = {gram: n for gram, n in self.counts.items() if len(gram) == 3}
        for gram, n in trigrams.items():
            shorter[gram[1:]] += n
            shorter[gram[2:]] += n
        self.counts = {**trigrams, **shorter}
        history: Counter = Counter()
        for gram, n in self.counts.items():
            history[gram[:-1]] += n
        self.history = history
        self.letters = max(1, sum(len(g) == 1 for g in self.counts))
        #: Log probability of the third letter of a string after its first two; asked for over and over.
        self.logs = Kept(self._log)

    def _log(self, gram: str) -> float:
        before, letter = gram[:2], gram[2]
        p = 1.0 / (self.letters + 1)
        for size in (0, 1, 2):
            context = before[2 - size :]
            seen = self.history.get(context, 0)
            p = (self.counts.get(context + letter, 0) + 5.0 * p) / (seen + 5.0)
        return math.log(p)


def _ways(run: str) -> tuple[tuple[str, float], ...]:
    """The strings that a run of one character may stand for, with their channel costs."""
    c, n = run[0], len(run)
    if c == " ":
        return (("", GAP), (" ", 0.0))
    letters = [(c, 0.0)] if c.isalpha() else [(x, SIGN) for x in RESEMBLES.get(c, "")]
    ways = []
    for x, cost in letters:
        if n == 1:
            ways.append((x, cost))
        elif n == 2:
            ways += [(x + x, cost), (x, cost + 4 * SHORTENED)]
        else:
            ways += [(x, cost + SHORTENED), (x + x, cost + 2 * SHORTENED)]
    if not letters or c in MARKS:
        ways.append(("", SEPARATOR if not letters else SEPARATOR + 3 * SIGN))
    return tuple(ways)


_RUN = re.compile(r"(.)\1*", re.DOTALL)
def _told(run: str) -> tuple[str, float, tuple]:
    """The letter and cost of a run that can only be itself, if it is one letter; the ways of any run."""
    ways = _ways(run) if run else ((" ", 0.0),)
    letters, cost = ways[0] if ways else ("", 0.0)
    return (letters, cost, ways) if len(ways) == 1 and len(letters) == 1 and letters != " " else ("", 0.0, ways)


_known_ways = Kept(_told, 20_000)


def restore(spelt: str, model: Characters) -> str:
    """The best reading of a lower-case string; spaces in it may vanish or stay."""
    logs = model.logs
    before, so_far, trail = "  ", 0.0, ()  # the path, while there is only one
    paths: dict[str, tuple[float, tuple]] = {}
    for run in [*(m.group() for m in _RUN.finditer(spelt)), ""]:
        letter, cost, ways = _known_ways[run]
        if letter and not paths:
            gram = before + letter
            so_far, trail, before = so_far + cost + logs[gram], (trail, letter), gram[1:]
            continue
        onward: dict[str, tuple[float, tuple]] = {}
        if letter:
            for before, (so_far, trail) in paths.items():
                gram = before + letter
                total, last = so_far + cost + logs[gram], gram[1:]
                best = onward.get(last)
                if best is None or total > best[0]:
                    onward[last] = (total, (trail, letter))
        else:
            for before, (so_far, trail) in paths.items() if paths else [(before, (so_far, trail))]:
                for letters, cost in ways:
                    total, last = so_far + cost, before
                    for x in letters:
                        if x != " " or last[1] != " ":
                            gram = last + x
                            total += logs[gram]
                            last = gram[1:]
                    best = onward.get(last)
                    if best is None or total > best[0]:
                        onward[last] = (total, (trail, letters))
        paths = onward
        if len(onward) == 1:
            ((before, (so_far, trail)),) = onward.items()
            paths = {}
    if paths:
        _, trail = max(paths.values(), key=lambda p: p[0])
    parts: list[str] = []
    while trail:
        trail, letters = trail
        parts.append(letters)
    return "".join(reversed(parts)).strip()


def _kept_run(joined: str) -> int:
    return 0 if len(joined) <= KEPT_RUN else CACHED_CHARS + 1


class Reader:
    """The distinct words of a text as they stand and as restored."""

    def __init__(self, model: Characters, common: frozenset[str] = frozenset()):
        self.model, self.common = model, common
        self.parts = Kept(self.part, CACHED)
        self.runs = Kept(self._read, CACHED_RUNS, size=_kept_run)

    def part(self, chunk: str) -> tuple[str, bool]:
        """The chunk without the signs around it if it may be a part of a word, else nothing; whether it makes a run."""
        plain = chunk if len(chunk) == 1 or chunk.isalpha() else _EDGE.sub("", chunk)
        rare = plain not in self.common
        if len(plain) <= SHORT:
            return plain, rare and plain != ""
        return (plain, False) if rare and len(plain) <= BESIDE else ("", False)

    def chunk(self, chunk: str) -> set[str]:
        """Words of lower-case text without white space."""
        plain = _EDGE.sub("", chunk)
        found = set(_LETTERS.findall(plain))
        if plain and plain not in self.common and _ODD.search(plain):
            found.update(restore(plain, self.model).split())
        return found

    def segments(self, chunks: list[str], makes: set[str] | None = None) -> Iterator[str]:
        """Parts that may be words together: those near a rare short one, longer ones right beside it.

        `makes` are the chunks that make a run, where they are known.
        """
        parts = self.parts
        if makes is None:
            makes = {c for c in set(chunks) if parts[c][1]}
        kept: set[int] = set()
        for i in [i for i, c in enumerate(chunks) if c in makes]:
            kept.add(i)
            for step in (-1, 1):
                for k in range(i + step, i + step * (NEAR + 1), step):
                    if not 0 <= k < len(chunks) or not (plain := parts[chunks[k]][0]):
                        break
                    if k == i + step or len(plain) <= SHORT:
                        kept.add(k)
        segment, before = [], -2
        for i in sorted(kept):
            if i != before + 1:
                if len(segment) > 1:
                    yield " ".join(segment)
                segment = []
            segment.append(parts[chunks[i]][0])
            before = i
        if len(segment) > 1:
            yield " ".join(segment)

    def spelt(self, chunks: list[str]) -> set[str]:
        """Words spelt over several short chunks."""
        return set(chain.from_iterable(map(self.runs.__getitem__, self.segments(chunks))))

    def _read(self, joined: str) -> tuple[str, ...]:
        return tuple(restore(joined, self.model).split())

    def words(self, text: str | None) -> set[str]:
        chunks = (text or "").lower().split()
        return self.spelt(chunks).union(*map(self.chunk, set(chunks)))


def features(word: str) -> list[str]:
    """The word, its first letters and its windows, all with the word's bounds; some may be equal."""
    bound = f"^{word}$"
    return [bound, *[bound[: n + 1] for n in PREFIXES if len(word) > n], *[bound[i : i + WINDOW] for i in range(len(bound) - WINDOW + 1)]]


def summary(weights: list[float], n: int) -> list[float]:
    """What the regression sees: the three heaviest words, the number of toxic ones, the number of chunks."""
    top = sorted(weights, reverse=True)[:3] + [0.0] * 3
    toxic = sum(w >= TOXIC_WORD for w in weights)
    return [top[0], sum(top[:3]) / 3, math.log1p(toxic), math.log1p(n)]


def _repeats(words: list[str]) -> list[bool]:
    """Whether a letter follows itself, for each of the words, none of which is empty."""
    if not words:
        return []
    signs = np.frombuffer("\n".join(words).encode("utf-32-le", "surrogatepass") + b"\n\0\0\0", dtype="<u4")
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    again = np.append(signs[1:] == signs[:-1], False)
    return np.logical_or.reduceat(again, np.cumsum(sizes) - sizes).tolist()


def _undoubled(word: str) -> list[str] | None:
    """All that the decoder may read in letters of which some are doubled; None for anything else."""
    if not word.isalpha():
        return None
    # what stands between the doubled letters, and those letters
    first, *rest = _DOUBLE.split(word)
    if 2 ** (len(rest) // 2) > MOST_READINGS:
        return None
    readings, last = [first], ""
    for c, between in zip(rest[::2], rest[1::2]):
        if c == last or between[:1] == c:
            return None  # three in a row
        readings = [r + w + between for r in readings for w in (c + c, c)]
        last = "" if between else c
    return readings


def _joined(run: str) -> list[str] | None:
    """All features of words that the decoder may read over several parts of plain letters; None for anything else."""
    parts = run.split(" ")
    if len(parts) > MOST_READINGS or any([not p.isalpha() or _DOUBLE.search(p) for p in parts]):
        return None
    bound, ends = "".join(parts), list(accumulate(map(len, parts)))
    # two parts at least; a window lies inside, at the beginning or at the end of some reading
    found = [bound[i : i + WINDOW] for i in range(len(bound) - WINDOW + 1)]
    starts = [0, *ends[:-2]]
    for k, i in enumerate(starts):
        found += [f"^{bound[i:j]}$" for j in ends[k + 1 :]]
        found += [f"^{bound[i : i + n]}" for n in (WINDOW - 1, *PREFIXES)]
    return found + [f"{bound[max(0, j - WINDOW + 1) : j]}$" for j in ends[1:]]


def _readings(part: str) -> tuple[str, ...] | None:
    """All that the decoder may read in signs without white space; None if that is too much."""
    if part.isalpha() and not _DOUBLE.search(part):
        return (part,)
    found = [""]
    for run in _RUN.finditer(part):
        ways = _known_ways[run.group()][2]
        found = [before + letters for before in found for letters, _ in ways]
        if len(found) > MOST_READINGS:
            return None
    return tuple(set(found))


class Bound:
    """The greatest weight of a feature that some reading of a run may have, without choosing a reading.

    Of what was read before a part only that is kept which a feature may span: the last letters of a window, and a
    word's beginning as long as some feature begins like it.
    """

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.begun = {f[:n] for f in weights if f[0] == "^" for n in range(1, len(f))}
        self.parts = Kept(_readings, CACHED_RUNS)

    def of(self, run: str) -> float | None:
        """None for a run that has too many readings."""
        weights = self.weights
        if (found := _joined(run)) is None and (found := self._found(run)) is None:
            return None
        return max([weights[f] for f in found if f in weights], default=0.0)

    def _found(self, run: str) -> list[str] | None:
        """Everything in a reading that may be a feature."""
        begun, parts, last, longer = self.begun, self.parts, WINDOW - 1, PREFIXES[-1]
        found, states = [], {"^"}
        for part in run.split(" "):
            ways = parts[part]
            if ways is None or len(states) > MOST_STATES:
                return None
            onward = {"^"}  # a word may begin after each part
            for letters in ways:
                m = len(letters)
                if m >= last:
                    found += [letters[i : i + WINDOW] for i in range(m - last)]
                    end = letters[-last:]
                    found.append(end + "$")
                    onward.add(end)
                for before in states:
                    near = before[-last:] + letters[:last]
                    found += [near[i : i + WINDOW] for i in range(len(near) - last)]
                    if m < last:
                        end = near[-last:]
                        found.append(end + "$")
                        onward.add(end)
                    if before[0] == "^":
                        word = before + letters
                        if len(before) <= longer < len(word):
                            found.append(word[: longer + 1])
                        if word in begun:
                            found.append(word + "$")
                            onward.add(word)
            states = onward
        return found


class Heaviest:
    """The greatest weight of a word's features (0 for none), for many words at once.

    Windows are numbers of BITS for each sign, so that all of them are looked up together; the whole word and its
    longer beginning are looked up one by one, the shorter beginning is the first window.
    """

    BITS = 12

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        windows = sorted(f for f in weights if len(f) == WINDOW)
        signs = sorted({c for f in windows for c in f})
        #: Whether the signs fit; words are looked up one by one if not.
        self.fits = len(signs) < 1 << self.BITS
        if not self.fits:
            return
        self.number = np.zeros(0x110000, dtype=np.int64)  # 0 stands for signs that no window has
        self.number[[ord(c) for c in signs]] = np.arange(1, len(signs) + 1)
        keys = self._keys("".join(windows))[::WINDOW]
        # by key, with a last one above all others, so that every place found is one
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.values = np.append(np.array([weights[f] for f in windows])[order], 0.0)
        self.there = np.zeros(1 << 16, dtype=bool)
        self.there[self._slots(keys)] = True
        self.whole = {f[1:-1]: w for f, w in weights.items() if f[0] == "^" and f[-1] == "$"}
        self.longer = {f[1:]: w for f, w in weights.items() if f[0] == "^" and f[-1] != "$" and len(f) > WINDOW}

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return keys * 0x1E3779B97F4A7C15 >> 44 & 0xFFFF

    def _keys(self, text: str) -> np.ndarray:
        """The number of the window at each place, as far as there are whole ones."""
        number = self.number[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        n = max(0, len(number) - WINDOW + 1)
        keys = number[:n].copy()
        for k in range(1, WINDOW):
            keys <<= self.BITS
            keys |= number[k : k + n]
        return keys

    def of(self, words: list[str]) -> list[float]:
        """Words consist of letters, so that no feature spans two of them."""
        if not self.fits or not words:
            return [max([self.weights.get(f, 0.0) for f in features(w)]) for w in words]
        keys = self._keys("^" + "$^".join(words) + "$" + " " * (WINDOW - 1))
        # few places can have a window at all; those are looked up
        at = np.nonzero(self.there[self._slots(keys)])[0]
        keys, found = keys[at], np.zeros(len(keys))
        place = np.searchsorted(self.keys, keys)
        found[at] = np.where(self.keys[place] == keys, self.values[place], 0.0)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
        heaviest = np.maximum.reduceat(found, np.cumsum(sizes) - sizes)
        n, longer = PREFIXES[-1], self.longer
        by_word = np.fromiter(map(self.whole.get, words, repeat(0.0)), dtype=np.float64, count=len(words))
        begun = np.fromiter((longer.get(w[:n], 0.0) if len(w) > n else 0.0 for w in words), dtype=np.float64, count=len(words))
        return np.maximum(np.maximum(heaviest, by_word), begun).tolist()


@dataclass
class Language:
    """What is counted over all texts: letters in a row, and the common words."""

    characters: dict[str, int]
    common: frozenset[str]

    def reader(self) -> Reader:
        return Reader(Characters(self.characters), self.common)


@dataclass
class Model:
    language: Language
    weights: dict[str, float]
    regression: np.ndarray

    def scorer(self) -> Callable[[list], np.ndarray]:
        reader, weights = self.language.reader(), self.weights
        bounds = Bound(weights)

        def weighed(words: Iterable[str]) -> tuple[tuple[str, float], ...]:
            found = []
            for w in words:
                held = [weights[f] for f in features(w) if f in weights]
                if held and (heaviest := max(held)) > 0.0:
                    found.append((w, heaviest))
            return tuple(found)

        def hopeless(readings: Iterable[str] | None) -> bool:
            """Whether all readings are known and none of them has a feature of weight."""
            return readings is not None and not any(f in weights for w in readings for f in features(w))

        def known(chunk: str) -> tuple:
            """Words of weight, whether the chunk makes a run, no bound, the chunk; most chunks share the empty tuple."""
            plain = chunk if chunk.isalpha() else _EDGE.sub("", chunk)
            words = [plain] if plain.isalpha() else _LETTERS.findall(plain)
            if plain and plain not in reader.common and _ODD.search(plain) and not hopeless(_readings(plain)):
                words = reader.chunk(chunk)
            heavy, rare = weighed(words), len(plain) <= SHORT and reader.part(chunk)[1]
            return (heavy, rare, 0.0, chunk) if heavy or rare else ()

        def run(joined: str) -> tuple:
            """Words of weight, their bound, the run; a run without a toxic word stays unread and has the bound alone."""
            bound = bounds.of(joined)
            if bound is None or bound >= TOXIC_WORD:
                return (weighed(set(reader.runs.make(joined))), 0.0, joined)
            return (None, bound, joined) if bound > 0.0 else ()

        chunks = Kept(known, CACHED)
        runs = Kept(run, CACHED_RUNS, size=_kept_run)
        heaviest = Heaviest(weights)
        w = self.regression

        def learn(missing: set[str]) -> None:
            """Keep what is to know of chunks; of those that are plain letters all at once.

            Letters of which some are doubled stay unread: instead of their words there is a bound of their weight.
            """
            old, common = chunks.old, reader.common
            names, plains = [], []
            for chunk in missing:
                if chunk not in old and len(chunk) <= CACHED_CHARS:
                    if chunk.isalpha():
                        plain = chunk
                    elif chunk[-1] in STOPS and chunk[:-1].isalpha():
                        plain = chunk[:-1]
                    elif not (plain := _EDGE.sub("", chunk)).isalpha():
                        continue
                    names.append(chunk)
                    plains.append(plain)
            repeats = [r and plain not in common for r, plain in zip(_repeats(plains), plains)]
            words = [plain for r, plain in zip(repeats, plains) if not r]
            single = [chunk for r, chunk in zip(repeats, names) if not r]
            doubled = []
            for chunk, plain in compress(zip(names, plains), repeats):
                if (readings := _undoubled(plain)) is not None:
                    words += readings
                    doubled.append((chunk, plain, len(readings)))
            weighs = heaviest.of(words)
            made: dict[str, tuple] = dict.fromkeys(single, ())
            for chunk, plain, weight in zip(single, words, weighs):
                if weight > 0.0 or len(plain) <= SHORT:
                    rare = len(plain) <= SHORT and plain not in common
                    if weight > 0.0 or rare:
                        made[chunk] = (((plain, weight),) if weight > 0.0 else (), rare, weight, chunk)
            at = len(single)
            for chunk, plain, n in doubled:
                bound, rare = max(weighs[at : at + n]), len(plain) <= SHORT
                at += n
                made[chunk] = (None, rare, bound, chunk) if bound > 0.0 else ((), True, 0.0, chunk) if rare else ()
            chunks.add(made)

        def read(chunk: str) -> tuple[tuple[str, float], ...]:
            """Words of weight of a chunk that was kept unread."""
            told = chunks.get(chunk)
            if told is None or told and told[0] is None:
                told = known(chunk)
                chunks.add({chunk: told})
            return told[0] if told else ()

        def read_run(joined: str) -> tuple[tuple[str, float], ...]:
            """Words of weight of a run that was kept unread."""
            told = runs.get(joined)
            if not told or told[0] is None:
                told = (weighed(set(reader.runs.make(joined))), 0.0, joined)
                if not _kept_run(joined):
                    runs.add({joined: told})
            return told[0]

        def judged(own: list[str], n: int, found: Iterable[tuple]) -> list[float]:
            """The summary; of the unread chunks and runs those are read that may change it, by their bounds."""
            heavy: dict[str, float] = {}
            makes, waiting = set(), []
            for words, rare, bound, chunk in found:
                if words is not None:
                    heavy.update(words)
                elif bound < TOXIC_WORD:
                    waiting.append((bound, False, chunk))
                else:
                    heavy.update(read(chunk))
                if rare:
                    makes.add(chunk)
            if makes:
                for words, bound, joined in filter(None, map(runs.__getitem__, reader.segments(own, makes))):
                    if words is None:
                        waiting.append((bound, True, joined))
                    else:
                        heavy.update(words)
            if waiting:
                top = nlargest(3, heavy.values())
                for bound, several, spelt in sorted(waiting, reverse=True):
                    if len(top) == 3 and bound <= top[2]:
                        break
                    if found := read_run(spelt) if several else read(spelt):
                        heavy.update(found)
                        top = nlargest(3, heavy.values())
            return summary(list(heavy.values()), n)

        def scores(batch: list) -> np.ndarray:
            x = []
            texts: list[tuple[list[str], int, list, list]] = []
            missing: set[str] = set()
            size = 0
            for k, text in enumerate(batch):
                own = (text or "").lower().split()
                distinct = set(own)
                told = list(map(chunks.get, distinct))
                lacking = [c for c, t in zip(distinct, told) if t is None]
                texts.append((own, len(distinct), list(filter(None, told)), lacking))
                missing.update(lacking)
                size += len(own)
                if size >= TOGETHER or k == len(batch) - 1:
                    with uncollected():
                        learn(missing)
                        for own, n, found, lacking in texts:
                            x.append(judged(own, n, chain(found, filter(None, map(chunks.__getitem__, lacking)))))
                    texts, missing, size = [], set(), 0
            return sigmoid(np.array(x).reshape(len(x), 4) @ w[:-1] + w[-1])

        return scores


def _weight(positive, negative, p: float):
    return np.log((positive + SHRINK * p) / (negative + SHRINK * (1 - p))) - math.log(p / (1 - p))


def language(docs: DataFrame) -> Language:
    """Letters and common words of all texts; the alphabet and the least share bound what the driver gets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = {chunk: n for chunk, n in chunks.items() if chunk.isalpha()}
            for chunk, n in chunks.items():
                if not chunk.isalpha():
                    for w in _LETTERS.findall(chunk):
                        words[w] = words.get(w, 0) + n
            chunks.clear()
            grams = Characters.count(words.items())
            short = {w: n for w, n in words.items() if len(w) <= BESIDE}
            total = sum(words.values())
            kinds = [0] * len(grams) + [1] * len(short) + [2]
            names, counts = [*grams, *short, ""], [*grams.values(), *short.values(), total]
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["kind", "name", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                chunks.update(text.lower().split())
                if len(chunks) >= COUNTED:
                    yield flush()
        yield flush()

    counted = map_batches(texts(docs).select("text"), work, "kind int, name string, n long").groupBy("kind", "name").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "toxicity-language")
    total = counted.where("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    least = F.when(F.length("name") > 1, COMMON_WORD).otherwise(COMMON_LETTER) * total
    common = counted.where((F.col("kind") == 1) & (F.col("n") >= least)).select("name").collect()
    grams = counted.where("kind = 0").orderBy("name").collect()
    return Language({r["name"]: r["n"] for r in grams}, frozenset(r["name"] for r in common))


def fit(docs: DataFrame, labels: DataFrame, label: str, training, sample: int = SAMPLE) -> Model:
    """A model from the labelled documents for which training (a condition on doc_id) holds."""
    context = docs.sparkSession.sparkContext
    chosen = materialise(labelled(docs, labels, label, training, sample), "toxicity-sample")
    totals = chosen.agg(F.count("*").alias("n"), F.count_if(F.col("y") > 0).alias("positive")).first()
    n, positive = totals["n"], totals["positive"]
    if not 0 < positive < n:
        return Model(Language({}, frozenset()), {}, np.array([0.0, 0.0, 0.0, 0.0, math.log((positive + 0.5) / (n - positive + 0.5))]))
    counted = language(docs)
    model, turn = context.broadcast(counted), uuid4().hex

    def found_in(chosen_features) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """The features of each document's words (of those chosen, if any), with its id and label."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chosen = None if chosen_features is None else chosen_features.value  # feature -> number
            reader = held("toxicity", turn, lambda: model.value.reader())
            known = Kept(lambda w: list({f if chosen is None else chosen[f] for f in features(w) if chosen is None or f in chosen}), 50_000)
            kind = pa.string() if chosen is None else pa.int32()
            for batch in batches:
                lists, words = [], []
                for text in batch.column(1).to_pylist():
                    own = [known[w] for w in sorted(reader.words(text))]
                    words.append(len(set(text.lower().split())))
                    lists.append([v for v in own if v] if chosen is not None else [list({f for v in own for f in v})])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(words, pa.int64()), pa.array(lists, pa.list_(pa.list_(kind)))],
                    names=["doc_id", "y", "words", "features"],
                )

        return work

    schema = "doc_id long, y int, words long, features array<array<{}>>"
    rows = chosen.select("doc_id", "text", "y")
    toxic = map_batches(rows.where("y > 0"), found_in(None), schema.format("string")).select(F.explode(F.col("features")[0]).alias("f"))
    frequent = toxic.groupBy("f").count().where(F.col("count") >= LEAST_POSITIVE).select("f")
    # bounded by the sample: each of its toxic documents has so many features
    names = sorted(r["f"] for r in frequent.collect())
    keep = context.broadcast({f: k for k, f in enumerate(names)})
    seen = materialise(map_batches(rows, found_in(keep), schema.format("int")), "toxicity-features")
    once = seen.select("y", F.explode(F.array_distinct(F.flatten("features"))).alias("f"))
    counts = once.groupBy("f").agg(F.count_if(F.col("y") > 0).alias("p"), F.count_if(F.col("y") <= 0).alias("q"))
    tally = counts.orderBy("f").toPandas()  # as many rows as chosen features
    share = positive / n
    p, q = tally["p"].to_numpy(), tally["q"].to_numpy()
    full = _weight(p, q, share)
    chosen_rows = tally["f"].to_numpy()
    weights = {names[f]: w for f, w in zip(chosen_rows.tolist(), full.tolist()) if w >= LEAST_WEIGHT}
    # what a training document of either label sees: the weights without its own part in the counts
    without = np.zeros((2, len(names)))
    heavy = full >= LEAST_WEIGHT
    without[0, chosen_rows[heavy]] = _weight(p, np.maximum(q - 1, 0), share)[heavy]
    without[1, chosen_rows[heavy]] = _weight(p - 1, q, share)[heavy]
    left_out = context.broadcast(without)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = left_out.value
        for batch in batches:
            x = []
            column = batch.column(3)
            for i, (y, words) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                own = column[i].values  # a list of features for each word that has any
                if own is None or not len(own):
                    x.append(summary([], words))
                    continue
                found = table[int(y > 0)][own.flatten().to_numpy(zero_copy_only=False)]
                sizes = np.diff(own.offsets.to_numpy(zero_copy_only=False))
                heaviest = np.maximum.reduceat(found, np.cumsum(sizes) - sizes)
                x.append(summary(heaviest[heaviest > 0.0].tolist(), words))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    fitted = map_batches(seen, summaries, "doc_id long, y int, x array<double>").collect()
    fitted.sort()  # an order that does not depend on the run
    x = np.array([r["x"] for r in fitted]).reshape(len(fitted), 4)
    return Model(counted, weights, logistic(x, np.array([float(r["y"] > 0) for r in fitted])))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """docs with the probability of label 1 in one more column."""
    shared, turn = docs.sparkSession.sparkContext.broadcast(model), uuid4().hex  # bounded by sample and alphabet

    def make() -> Callable[[list], pa.Array]:
        scores = held("toxicity", turn, lambda: shared.value.scorer())
        return lambda batch: pa.array(scores(batch), pa.float64())

    return extend(docs, column, T.DoubleType(), make)
