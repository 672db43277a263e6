"""Pseudonyms for personal values, permuted within their format by a keyed Feistel network.

Numbers and dates are found by their shape and then validated (card check digits, IBAN remainders, octets,
areas, numbers of digits, the calendar); names before an @ and assigned secrets are treated alike. A valid value is a number in the set of all valid values of its format; a
Feistel network with a key permutes that set, walking on while it leaves it. So the pseudonym
is valid too, keeps its separators, can be undone with the key, and equal values have equal pseudonyms
in all documents, however they are grouped.

Defined results: a null text counts as empty and comes back empty; texts without values come back as they
are. Rows repeat, null doc_ids stay. Whole texts are read, values of any length too. Where two shapes begin at one place the longer
match wins, of equal ones the first kind listed, and a card only where nothing else is valid. Numbers may
follow a value: an IBAN ends at the length of its country, a card at the first end of a group where its
check digit holds. The permutations keep which shorter ends hold, so pseudonyms end where their values did.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from faultline.llm.common import Kept

ROUNDS = 8
#: Signs of an address's name or of a secret that are permuted together.
BLOCK = 256
_FORMAT = re.compile("([0-9])|([a-z])|([A-Z])")
#: Dates are permuted among these years.
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))

_GROUPED = r"(?:\d[ -]?){12,18}\d"
# kinds by their shape; a value is only taken if it is valid as well
_SHAPES = [
    ("iban", r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}"),
    ("phone", r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}"),
    ("phone", r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2}"),
    ("date", r"\d{4}-\d{2}-\d{2}|\d{1,2}([/.])\d{1,2}\1\d{4}"),
    ("ssn", r"\d{3}-\d{2}-\d{4}"),
    ("ip", r"\d{1,3}(?:\.\d{1,3}){3}"),
    ("card", _GROUPED),
]
_END = r"(?!\w|[.-]\d)"
# of alternatives only the last is held to the end, so a time or an extension may follow the others directly
_FINDERS = [(kind, re.compile(rf"(?<![\w.+]){shape}{_END}", re.ASCII)) for kind, shape in _SHAPES]
#: Groups of which the first is long enough for each end to be tried, and their ends.
_CARD_RUN = re.compile(r"\d{4,}(?:[ -]\d+)*(?!\w)", re.ASCII)
_CARD_END = re.compile(r"(?<=\d)(?=[ -])", re.ASCII)
# Signs of an IBAN by country.
IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "AE BG BH CR DE GB GE IE ME RS VA", 23: "GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_IBANS = {n: re.compile(rf"[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}(?!\w)", re.ASCII) for n in set(IBAN_LENGTHS.values())}
_BEGIN = re.compile(r"(?<![\w.+])(?:[+(]?\d|[A-Z]{2}\d{2}[A-Z0-9 ])", re.ASCII)
_ADDRESS_LEFT = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_ADDRESS_RIGHT = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}")


_ASSIGNED = re.compile(r"""(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*["']?)([A-Za-z0-9+/_-]{8,})|\b(AKIA[0-9A-Z]{16})\b""")


class Feistel:
    """Keyed permutations of the numbers below n, for any n."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, step: int, half: int, bits: int) -> int:
        size = -(-bits // 8)
        out, block = b"", 0
        seed = f"{kind}:{step}:{bits}:{block}:{half}".encode()
        while len(out) < size:
            out += hashlib.blake2b(seed + block.to_bytes(4, "big"), key=self.key, digest_size=min(64, max(8, size))).digest()
            block += 1
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def _once(self, kind: str, value: int, half: int, undo: bool) -> int:
        mask = (1 << half) - 1
        left, right = value >> half, value & mask
        for step in reversed(range(ROUNDS)) if undo else range(ROUNDS):
            if undo:
                left, right = right ^ self._round(kind, step, left, half), left
            else:
                left, right = right, left ^ self._round(kind, step, right, half)
        return left << half | right

    def permute(self, kind: str, value: int, n: int, valid: Callable[[int], bool] | None = None, undo: bool = False) -> int:
        """The image of value among the valid numbers below n (value is one of them)."""
        half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
        while True:
            value = self._once(kind, value, half, undo)
            if value < n and (valid is None or valid(value)):
                return value


def _mixed(symbols: list[tuple[int, int]]) -> tuple[int, int]:
    """Number and size of a set of digits given as (digit, radix)."""
    value, size = 0, 1
    for digit, radix in symbols:
        value, size = value * radix + digit, size * radix
    return value, size


def _unmixed(value: int, radices: list[int]) -> list[int]:
    out = []
    for radix in reversed(radices):
        value, digit = divmod(value, radix)
        out.append(digit)
    return out[::-1]


def _refill(shape: str, digits: str) -> str:
    """The shape with its digits replaced in order."""
    fresh = iter(digits)
    return "".join(next(fresh) if c.isdigit() else c for c in shape)


def luhn(digits: str) -> int:
    """The check digit that completes the digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card(text: str, feistel: Feistel, undo: bool) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or digits[0] == "0" or luhn(digits[:-1]) != int(digits[-1]):
        return None
    # from the 13th on a digit either completes those before it or is one of nine others, and remains so
    checks = [luhn(digits[:i]) for i in range(12, len(digits))]
    others = [(int(c) - check - 1) % 10 if int(c) != check else None for c, check in zip(digits[12:], checks)]
    symbols = [(int(digits[0]) - 1, 9), *((int(c), 10) for c in digits[1:12]), *((o, 9) for o in others if o is not None)]
    value, size = _mixed(symbols)
    marks = "".join("c" if o is None else "o" for o in others)
    new = _unmixed(feistel.permute(f"card{marks}", value, size, undo=undo), [r for _, r in symbols])
    body, rest = f"{new[0] + 1}" + "".join(map(str, new[1:12])), iter(new[12:])
    for o in others:
        check = luhn(body)
        body += str(check if o is None else (check + 1 + next(rest)) % 10)
    return _refill(text, body)


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(text: str, feistel: Feistel, undo: bool) -> str | None:
    plain = text.replace(" ", "")
    country, body = plain[:2], plain[4:]
    if not 15 <= len(plain) <= 34 or int(plain[2:4]) != _iban_check(country, body):
        return None
    radices = [10 if c.isdigit() else 26 for c in body]
    proper = IBAN_LENGTHS.get(country, 34) - 4

    def written(n: int) -> str:
        return "".join(str(d) if r == 10 else chr(65 + d) for d, r in zip(_unmixed(n, radices), radices))

    def short(made: str) -> bool:
        """Whether it would be found at the length of its country."""
        return len(made) > proper and _iban_check(country, made) == _iban_check(country, made[:proper])

    value, size = _mixed([(int(c) if c.isdigit() else ord(c) - 65, r) for c, r in zip(body, radices)])
    shape = "".join("9" if c.isdigit() else "A" for c in body)
    like = None if len(body) <= proper else lambda n: short(written(n)) == short(body)
    body = written(feistel.permute(f"iban{country}{shape}", value, size, like, undo))
    fresh = iter(f"{country}{_iban_check(country, body):02d}{body}")
    return "".join(" " if c == " " else next(fresh) for c in text)


def _ip(text: str, feistel: Feistel, undo: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    value, size = _mixed([(int(p), 256) for p in parts])
    return ".".join(map(str, _unmixed(feistel.permute("ip", value, size, undo=undo), [256] * 4)))


def _ssn(text: str, feistel: Feistel, undo: bool) -> str | None:
    def valid(n: int) -> bool:
        area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(text.replace("-", ""))
    if not valid(value):
        return None
    return _refill(text, f"{feistel.permute('ssn', value, 10**9, valid, undo):09d}")


def _phone(text: str, feistel: Feistel, undo: bool) -> str | None:
    code = re.match(r"\+\d{1,3}(?=[ .(-])|\+1(?=\d{10}\Z)|\+\d{2}|", text)[0]
    rest = text[len(code) :]
    digits = re.sub(r"\D", "", rest)
    if not 7 <= len(digits) <= 13 or not code and len(digits) != 10:
        return None
    # a number without a code is one with +1
    kind = f"phone{code or '+1'}:{len(digits)}"
    value, size = _mixed([(int(d), 10) for d in digits])
    return code + _refill(rest, f"{feistel.permute(kind, value, size, undo=undo):0{len(digits)}d}")


def _day(year: int, month: int, day: int) -> date | None:
    try:
        found = date(year, month, day)
    except ValueError:
        return None
    return found if FIRST_DAY <= found.toordinal() <= LAST_DAY else None


def _date(text: str, feistel: Feistel, undo: bool) -> str | None:
    days = LAST_DAY - FIRST_DAY + 1
    if text[4] == "-":
        found = _day(int(text[:4]), int(text[5:7]), int(text[8:]))
        if found is None:
            return None
        return date.fromordinal(FIRST_DAY + feistel.permute("date", found.toordinal() - FIRST_DAY, days, undo=undo)).isoformat()
    mark = re.search(r"[/.]", text)[0]
    a, b, year = text.split(mark)
    found, swapped = _day(int(year), int(b), int(a)), False
    if found is None:
        # month first only where day first is impossible, and permuted among such dates
        found, swapped = _day(int(year), int(a), int(b)), True
        if found is None:
            return None
    late = lambda n: not swapped or date.fromordinal(FIRST_DAY + n).day > 12
    new = date.fromordinal(FIRST_DAY + feistel.permute(f"date{'m' if swapped else ''}", found.toordinal() - FIRST_DAY, days, late, undo))
    first, second = (new.month, new.day) if swapped else (new.day, new.month)
    # leading zeros as the value has them; where it shows none either way, none are written
    width = 2 if a[0] == "0" or b[0] == "0" or len(a) == len(b) == 2 else 1
    return f"{first:0{width}d}{mark}{second:0{width}d}{mark}{new.year:04d}"


def _classed(text: str, kind: str, feistel: Feistel, undo: bool) -> str | None:
    """Digits stay digits, small and capital ASCII letters such letters; other signs stay.

    Longer values are permuted in blocks, each with its place and the format of the whole in its key, so that
    the work grows with the length alone.
    """
    if len(text) > BLOCK:
        if not any(c.isascii() and c.isalnum() for c in text):
            return None
        hexed = re.fullmatch(r"[0-9a-f]*", text) is not None
        # what the permutation keeps: the place of each class of signs, or the length alone
        shape = f"{len(text)}" if hexed else _FORMAT.sub(lambda m: "0aA"[m.lastindex - 1], text)
        whole = hashlib.blake2b(shape.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
        blocks = (text[i : i + BLOCK] for i in range(0, len(text), BLOCK))
        return "".join(_classed_block(part, f"{kind}{whole}:{n}:", feistel, undo, hexed) or part for n, part in enumerate(blocks))
    return _classed_block(text, kind, feistel, undo, re.fullmatch(r"[0-9a-f]{16,}", text) is not None)


def _classed_block(text: str, kind: str, feistel: Feistel, undo: bool, hexed: bool) -> str | None:
    sets = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    if hexed:
        sets = ("0123456789abcdef",)
    kinds = [next((i for i, letters in enumerate(sets) if c in letters), -1) for c in text]
    symbols = [(sets[k].index(c), len(sets[k])) for c, k in zip(text, kinds) if k >= 0]
    if not symbols:
        return None
    value, size = _mixed(symbols)
    shape = "".join(str(k) if k >= 0 else c for c, k in zip(text, kinds))
    new = iter(_unmixed(feistel.permute(kind + shape, value, size, undo=undo), [r for _, r in symbols]))
    return "".join(sets[k][next(new)] if k >= 0 else c for c, k in zip(text, kinds))


def _address(text: str, feistel: Feistel, undo: bool) -> str | None:
    """The name before the @ changes, the domain stays."""
    name, _, domain = text.rpartition("@")
    made = _classed(name, f"email@{domain}:", feistel, undo)
    return made and f"{made}@{domain}"


def _secret(text: str, feistel: Feistel, undo: bool) -> str | None:
    """A value assigned to a password or key, or an access key behind its prefix."""
    prefix = "AKIA" if re.fullmatch(r"AKIA[0-9A-Z]{16}", text) else ""
    made = _classed(text[len(prefix) :], "secret:", feistel, undo)
    return made and prefix + made


_MAKERS = {"iban": _iban, "phone": _phone, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card, "email": _address, "secret": _secret}


class Pseudonyms:
    """Replaces values in texts; undo=True turns pseudonyms back."""

    def __init__(self, key: bytes, undo: bool = False):
        feistel = Feistel(key)
        self.known = Kept(lambda k: _MAKERS[k[0]](k[1], feistel, undo) or "", 50_000, size=lambda k: len(k[1]))

    def _addresses(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        at = text.find("@")
        while at >= 0:
            left = _ADDRESS_LEFT.search(text, max(0, at - 64), at)
            right = _ADDRESS_RIGHT.match(text, at + 1)
            if left and right and (new := self.known["email", text[left.start() : right.end()]]):
                yield left.start(), right.end(), "email", new
            at = text.find("@", at + 1)

    def _secrets(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        for m in _ASSIGNED.finditer(text):
            part = m.lastindex
            if new := self.known["secret", m[part]]:
                yield m.start(part), m.end(part), "secret", new

    def _ends(self, text: str, start: int) -> Iterator[tuple[str, int]]:
        """Kinds and ends of what may begin there; of one kind the end to be tried first comes first."""
        n = IBAN_LENGTHS.get(text[start : start + 2])
        if n and (m := _IBANS[n].match(text, start)):
            yield "iban", m.end()
        for kind, finder in _FINDERS:
            m = finder.match(text, start)
            if kind == "card" and (run := _CARD_RUN.match(text, start)):
                yield from (("card", e.start()) for e in _CARD_END.finditer(text, start, min(run.end() + 1, start + 38)))
            if m:
                yield kind, m.end()

    def _numbers(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        at = 0
        while begin := _BEGIN.search(text, at):
            best, start = None, begin.start()
            for kind, end in self._ends(text, start):
                if best and (best[2] == kind or kind == "card" or end <= best[1]):
                    continue
                if new := self.known[kind, text[start:end]]:
                    best = (start, end, kind, new)
            if best:
                yield best
            at = best[1] if best else begin.start() + 1

    def replace(self, text: str | None) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and kind, start and length of each in it."""
        text = text or ""
        # a secret may hold what looks like a number, and begins before it
        found = sorted([*self._secrets(text), *self._addresses(text), *self._numbers(text)])
        parts, spans, at, size = [], [], 0, 0
        for start, end, kind, new in found:
            if start < at:
                continue
            parts += [text[at:start], new]
            size += start - at
            spans.append((kind, size, len(new)))
            size += len(new)
            at = end
        return "".join([*parts, text[at:]]), spans


def pseudonymise(docs: DataFrame, key: bytes, spans: str | None = None, undo: bool = False) -> DataFrame:
    """docs with pseudonyms in its texts, and if named a column of the spans they have there."""
    if spans is not None and spans in docs.columns:
        raise ValueError(f"column {spans} exists already")
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, *([T.StructField(spans, SPANS)] if spans else [])])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Pseudonyms(key, undo)
        for batch in batches:
            made = [held.replace(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in made], pa.string())
            if spans:
                columns.append(pa.array([[dict(zip(("kind", "start", "length"), s)) for s in found] for _, found in made], kind))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(work, schema)
