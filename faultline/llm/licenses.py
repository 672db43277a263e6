"""Licence scan by sparse TF-IDF cosines, with inheritance along directories; column expressions only.

A file is a path and a text. Terms are lower-case words of any script, with the dots and hyphens inside them. A term's
weight in a text is its number there times its inverse document frequency; the frequencies of all terms are
counted over all files. Compared with the header templates are every line, and every window of a template's
length that has one of the template's heaviest terms where the template has it, across line ends too. The whole text is
compared with the header templates and with the licence bodies.

The steps before leave out only what cannot reach its threshold: a text without any of a template's heaviest terms (the
set is chosen so that this is exact), a line or text that holds too little of a template's square, and what has
terms outside all templates that weigh too much even at the least weight a term can have. What is left is scored once for each distinct sequence of terms, so a
header that stands in a third of all files is one item.

A file whose text as a whole is a licence, or that is named like one and bears a header, is a licence file. It holds for
its directory. A file without a header of its own inherits from the nearest directory above it that has a licence file.

Defined results: a null text counts as empty, a null path as the empty path, whose directory is the
root. Rows repeat and stay; doc_id may be null. Of equal scores the template whose name comes first wins; of a
directory's licence files the best score, then the name, then the path. Whole texts are read, of any length; long ones are
cut into overlapping chunks for the windows. A template without terms matches nothing. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from operator import or_

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import materialise

#: Cosine from which a text is taken to bear a licence.
THRESHOLD = 0.6
#: Cosine from which a file's whole text is taken to be a licence.
WHOLE = 0.9
#: Copies of a directory's row that its files are spread over.
SALTS = 32
#: Terms of a text whose windows are looked at as one row.
CHUNK = 4096

# Headers and notices by licence.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license.", "Released under the 3-Clause BSD License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later", "GNU General Public License Version 3, 29 June 2007"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", "GNU Lesser General Public License Version 3, 29 June 2007"],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.", "SPDX-License-Identifier: MIT"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
# Whole licences, without title and copyright line.
BODIES = {
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ],
}
#: Names of licence files.
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|notice)([._-].*)?$"

_SEPARATORS = r"[^\p{L}\p{N}.-]+|[.-]+(?=$|[^\p{L}\p{N}])"


def pieces(text: Column) -> Column:
    """The terms of a text, as often as they stand."""
    return F.array_remove(F.split(F.lower(text), _SEPARATORS), "")


def template_words(text: str) -> list[str]:
    """The same terms, of a template."""
    return [w for w in regex.split(_SEPARATORS, text.lower()) if w]


def document_frequencies(files: DataFrame) -> DataFrame:
    """term, df: the number of files that hold it, for every term. Each task adds up before the shuffle."""
    return files.select(F.explode(F.array_distinct(pieces(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def bound(value: Column, use) -> Column:
    """use(value), with the value worked out once, also where use looks at it inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


class Side:
    """A template as a vector: its terms in order, and count times squared inverse document frequency by term."""

    def __init__(self, license: str, terms: list[str], weight: dict[str, float], threshold: float):
        self.license, self.terms = license, terms
        counts = Counter(terms)
        self.vector = {t: n * weight[t] for t, n in counts.items()}
        self.square = {t: n * n * weight[t] for t, n in counts.items()}
        self.norm = math.sqrt(sum(self.square.values()))
        self.least = threshold**2 * sum(self.square.values()) * (1 - 1e-9)
        self.heavy = heavy_terms(self.square, threshold)


def heavy_terms(square: dict[str, float], threshold: float) -> set[str]:
    """Terms of which a text must hold one to reach the threshold; square: a template's squared vector.

    A cosine is at most the root of the share of the template's square that the shared terms hold, so
    the lightest terms may be left aside while they stay below threshold squared.
    """
    kept, total, light = set(), sum(square.values()), 0.0
    for t in sorted(square, key=lambda t: (square[t], t)):
        light += square[t]
        if light >= threshold**2 * total * (1 - 1e-9):
            kept.add(t)
    return kept


class Scale:
    """Weights of the templates' terms as column expressions."""

    def __init__(self, weight: dict[str, float]):
        self.terms = sorted(weight)
        self.table = F.create_map(*[F.lit(x) for t in self.terms for x in (t, weight[t])])

    def counts(self, terms: Column) -> Column:
        """Structs of the distinct terms (t) and their numbers (n)."""
        return F.transform(F.array_distinct(terms), lambda t: F.struct(t.alias("t"), F.size(F.filter(terms, lambda x: x == t)).alias("n")))

    def square(self, counts: Column) -> Column:
        """Sum of squares, of counts of template terms."""
        return F.aggregate(counts, F.lit(0.0), lambda s, c: s + c["n"] * c["n"] * F.element_at(self.table, c["t"]))

    def plausible(self, terms: Column, threshold: float) -> Column:
        """False only where no template can reach the threshold: other terms weigh at least 1 each."""
        enough = lambda own, square: square >= F.lit(threshold**2 * (1 - 1e-9)) * (square + F.size(terms) - F.size(own))
        return bound(F.filter(terms, lambda t: t.isin(self.terms)), lambda own: bound(self.square(self.counts(own)), lambda q: enough(own, q)))


def directories(path: Column) -> Column:
    """The directories above a path, nearest first; the root, the empty path, is the last."""
    parts = F.split(path, "/")
    depth = F.size(parts) - F.lit(1)
    return F.transform(F.sequence(F.lit(0), depth), lambda i: F.array_join(F.slice(parts, F.lit(1), depth - i), "/"))


def windows(held: DataFrame, sides: list[Side]) -> DataFrame:
    """digest, side, terms: windows of a side's length with a heavy term where the side has it; held: digest, terms."""
    placed = [(t, k, j, len(s.terms)) for k, s in enumerate(sides, 1) for j, t in enumerate(s.terms) if t in s.heavy]
    if not placed:
        return held.select("digest", F.lit(0).alias("side"), "terms").where(F.lit(False))
    reach = max(n for *_, n in placed)
    cues = sorted({t for t, *_ in placed})
    starts = F.when(F.size("terms") > 0, F.sequence(F.lit(0), F.size("terms") - 1, F.lit(CHUNK)))
    lead = lambda s: F.least(s, F.lit(reach))
    part = lambda s: F.slice(F.col("terms"), s - lead(s) + 1, lead(s) + CHUNK + reach)
    chunks = held.select("digest", F.explode(F.transform(starts, lambda s: F.struct(lead(s).alias("lead"), part(s).alias("part")))).alias("c"))
    at = F.filter(F.transform(F.col("c.part"), lambda t, i: F.when(t.isin(cues), i)), lambda i: (i >= F.col("c.lead")) & (i < F.col("c.lead") + CHUNK))
    # what lies around a cue: `at` terms before it, then the cue
    around = lambda i: F.struct(
        F.element_at("c.part", i + 1).alias("t"),
        F.least(i, F.lit(reach)).alias("at"),
        F.slice(F.col("c.part"), i - F.least(i, F.lit(reach)) + 1, F.lit(2 * reach)).alias("near"),
    )
    near = chunks.select("digest", F.explode(F.array_distinct(F.transform(at, around))).alias("a"))
    places = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("side"), F.lit(j).alias("j"), F.lit(n).alias("n")) for t, k, j, n in placed])
    laid = near.select("digest", "a", F.explode(F.filter(places, lambda p: p["t"] == F.col("a.t"))).alias("p"))
    first = F.col("a.at") - F.col("p.j")
    cut = F.slice(F.col("a.near"), F.greatest(first, F.lit(0)) + 1, F.col("p.n") + F.least(first, F.lit(0)))
    return laid.select("digest", F.col("p.side").alias("side"), cut.alias("terms"))


def near_sides(terms: Column, sides: list[Side], scale: Scale) -> Column:
    """Numbers of the sides of whose square the terms hold as much as the side's threshold asks for."""
    listed = F.array(
        *[
            F.struct(F.lit(k).alias("side"), F.lit(s.least).alias("least"), F.create_map(*[F.lit(x) for t, v in sorted(s.square.items()) for x in (t, v)]).alias("square"))
            for k, s in enumerate(sides, 1)
        ]
    )
    holds = lambda own, s: F.aggregate(own, F.lit(0.0), lambda a, t: a + F.coalesce(F.element_at(s["square"], t), F.lit(0.0))) >= s["least"]
    own = F.array_intersect(terms, F.array(*map(F.lit, scale.terms)))
    return bound(own, lambda o: F.transform(F.filter(listed, lambda s: holds(o, s)), lambda s: s["side"]))


def rate(items: DataFrame, sides: list[Side], scale: Scale, frequencies: DataFrame, files: int, threshold: float) -> DataFrame:
    """key, score, license of items (key, side, c: structs of term t and number n); those below the threshold may be missing."""
    vectors = F.array(*[F.create_map(*[F.lit(x) for t, v in sorted(s.vector.items()) for x in (t, v)]) for s in sides])
    own = F.filter("c", lambda c: c["t"].isin(scale.terms))
    rest = F.filter("c", lambda c: ~c["t"].isin(scale.terms))
    split = items.select("key", "side", own.alias("own"), rest.alias("rest"))
    dot = F.aggregate("own", F.lit(0.0), lambda s, c: s + c["n"] * F.coalesce(F.element_at(F.element_at(vectors, F.col("side")), c["t"]), F.lit(0.0)))
    least = F.aggregate("rest", F.lit(0.0), lambda s, c: s + c["n"] * c["n"])
    weighed = split.select("key", "side", "rest", dot.alias("dot"), scale.square(F.col("own")).alias("square"), least.alias("least"))
    norm = F.element_at(F.array(*[F.lit(s.norm) for s in sides]), F.col("side"))
    parted = materialise(weighed.where(F.col("dot") >= F.lit(threshold * (1 - 1e-5)) * norm * F.sqrt(F.col("square") + F.col("least"))), "license_items")
    # a frequent term stands in many items: its weight is copied, the items are spread over the copies
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")
    foreign = parted.select("key", salt.alias("salt"), F.explode("rest").alias("c")).select("key", "salt", F.col("c.t").alias("term"), F.col("c.n").alias("n"))
    idf = F.log((files + 1) / (F.col("df") + 1)) + 1
    copies = (
        foreign.select("term").distinct().join(frequencies, "term").select("term", (idf * idf).alias("w"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    added = foreign.join(copies, ["term", "salt"]).groupBy("key").agg(F.sum(F.col("n") * F.col("n") * F.col("w")).alias("added"))
    score = F.round(F.col("dot") / (F.sqrt(F.col("square") + F.coalesce("added", F.lit(0.0))) * norm), 6)
    name = F.element_at(F.array(*[F.lit(s.license) for s in sides]), F.col("side"))
    return parted.join(added, "key", "left").select("key", score.alias("score"), name.alias("license"))


def scan(
    files: DataFrame,
    templates: dict[str, list[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    whole: float = WHOLE,
    bodies: dict[str, list[str]] = BODIES,
) -> DataFrame:
    """doc_id, path, license, score, origin (header, file, inherited or null), license_path.

    files: doc_id, path, text.
    """
    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("path", F.lit("")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    frequencies = materialise(document_frequencies(rows), "license_terms")
    n = rows.count()
    texts = [(name, template_words(t), limit) for group, limit in ((templates, threshold), (bodies, whole)) for name, own in sorted(group.items()) for t in own]
    texts = [(name, own, limit) for name, own, limit in texts if own]
    vocabulary = sorted({t for _, own, _ in texts for t in own})
    # one row per term of the templates
    found = {r["term"]: r["df"] for r in frequencies.where(F.col("term").isin(vocabulary)).collect()}
    weight = {t: (math.log((1 + n) / (1 + found.get(t, 0))) + 1) ** 2 for t in vocabulary}
    sides = [Side(name, own, weight, limit) for name, own, limit in texts]
    headers = sides[: sum(bool(template_words(t)) for own in templates.values() for t in own)]
    if not sides:
        nothing = F.lit(None).cast("struct<score:double,license:string>")
        return inherit(rows.select("doc_id", "path", nothing.alias("header"), nothing.alias("file")))
    scale = Scale(weight)
    cues = sorted({t for s in sides for t in s.heavy})
    # a term is a part of its text: without any heavy one there, nothing has to be split into terms
    may_hold = lambda text: reduce(or_, (F.contains(F.lower(text), F.lit(t)) for t in cues), F.lit(False))
    kept = F.when(may_hold(F.col("text")), F.when(F.arrays_overlap(pieces(F.col("text")), F.array(*map(F.lit, cues))), F.col("text")))
    base = materialise(rows.select("doc_id", "path", kept.alias("text")).withColumn("digest", F.sha2("text", 256)), "license_texts")
    held = base.where("text is not null").select("digest", "text")
    cut = held.select("digest", pieces(F.col("text")).alias("terms"))
    line = held.select("digest", F.explode(F.filter(F.split("text", "\r\n|[\n\r]"), may_hold)).alias("line")).select("digest", pieces(F.col("line")).alias("terms"))
    key = F.concat_ws("-", F.sha2(F.concat_ws(" ", "terms"), 256), F.col("side").cast("string"))
    laid = windows(cut, headers).where(scale.plausible(F.col("terms"), threshold)).select("digest", F.lit("header").alias("kind"), key.alias("key"), "side", "terms")
    laid = materialise(laid, "license_windows")
    parts = [
        rows_of.select("digest", F.lit(kind).alias("kind"), "terms", near_sides(F.col("terms"), own, scale).alias("sides")).where(F.size("sides") > 0)
        for rows_of, kind, own in ((line, "header", headers), (cut, "whole", sides))
        if own
    ]
    parts = materialise(reduce(DataFrame.unionAll, parts).withColumn("part", F.sha2(F.concat_ws(" ", "terms"), 256)), "license_parts")
    # lines and texts may be long: their terms are counted by groups, each distinct sequence once
    counted = parts.groupBy("part").agg(F.first("terms").alias("terms")).select("part", F.explode("terms").alias("t")).groupBy("part", "t").agg(F.count("*").alias("n"))
    counts = counted.groupBy("part").agg(F.collect_list(F.struct("t", F.col("n").cast("int").alias("n"))).alias("c"))
    sided = parts.select("digest", "kind", "part", F.explode("sides").alias("side")).withColumn("key", F.concat_ws("-", "part", F.col("side").cast("string")))
    of_windows = laid.groupBy("key").agg(F.first("side").alias("side"), F.first("terms").alias("terms")).select("key", "side", scale.counts(F.col("terms")).alias("c"))
    of_parts = sided.select("part", "key", "side").distinct().join(counts, "part").select("key", "side", "c")
    candidates = laid.select("digest", "kind", "key").unionAll(sided.select("digest", "kind", "key")).distinct()
    # a window may be a line as well: the two have the same score
    rated = materialise(rate(of_windows, sides, scale, frequencies, n, min(threshold, whole)), "license_scores").unionAll(
        materialise(rate(of_parts, sides, scale, frequencies, n, min(threshold, whole)), "license_scores")
    )
    good = rated.distinct().select("key", F.struct("score", "license").alias("match")).where(F.col("match.score") >= min(threshold, whole))
    # a header may stand in any share of the texts, and a text in any share of the files: both are spread over copies
    spread = lambda df: df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = lambda df, *by: df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    per_text = dealt(candidates.select("digest", "kind", "key"), "digest").join(spread(good), ["key", "salt"])
    top = lambda kind, limit: F.min_by(
        F.when(F.col("kind") == kind, F.col("match")), F.when((F.col("kind") == kind) & (F.col("match.score") >= limit), F.struct(-F.col("match.score"), "match.license"))
    )
    judged = per_text.groupBy("digest").agg(top("header", threshold).alias("header"), top("whole", whole).alias("whole"))
    # files without a cue have no digest; their path spreads them
    own = dealt(base.select("doc_id", "path", F.coalesce("digest", F.concat(F.lit("-"), F.xxhash64("path", "doc_id").cast("string"))).alias("digest")), "doc_id", "path")
    named = F.rlike(F.element_at(F.split("path", "/"), -1), F.lit(LICENCE_FILE))
    joined = own.join(spread(judged), ["digest", "salt"], "left")
    return inherit(materialise(joined.select("doc_id", "path", "header", F.when(F.col("whole").isNotNull(), F.col("whole")).when(named, F.col("header")).alias("file")), "licenses"))


def inherit(own: DataFrame) -> DataFrame:
    """own: doc_id, path, header, file (structs of score and license, or null)."""
    nearest = F.element_at(directories(F.col("path")), 1)
    holders = (
        own.where("file is not null")
        .select(nearest.alias("directory"), F.col("file.score").alias("score"), F.col("file.license").alias("license"), "path")
        .groupBy("directory")
        .agg(F.min_by(F.struct("score", "license", "path"), F.struct(-F.col("score"), "license", "path")).alias("found"))
    )
    # each directory once, however many files it has; its licence is that of the nearest one above
    places = own.select(nearest.alias("place")).distinct()
    above = places.select("place", F.posexplode(directories(F.concat("place", F.when(F.col("place") == "", F.lit("")).otherwise(F.lit("/"))))).alias("steps", "directory"))
    resolved = above.join(holders, "directory").groupBy("place").agg(F.min_by("found", "steps").alias("found"))
    # a directory may hold any share of the files: its row is copied, the files are spread over the copies
    copies = resolved.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = own.withColumn("place", nearest).withColumn("salt", F.pmod(F.xxhash64("doc_id", "path"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(copies, ["place", "salt"], "left")
    chosen = F.coalesce(F.col("header"), F.col("file"), F.struct(F.col("found.score"), F.col("found.license")))
    own_origin = F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header").when(F.col("found").isNotNull(), "inherited")
    source = F.when(F.col("header").isNotNull() | F.col("file").isNotNull(), F.col("path")).otherwise(F.col("found.path"))
    return joined.select(
        "doc_id", "path", chosen["license"].alias("license"), chosen["score"].alias("score"), own_origin.alias("origin"), source.alias("license_path")
    )
