"""Quality and toxicity: held-out accuracy, awkward rows, the decoder."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import quality, queries, toxicity
from faultline.llm.common import labelled, logistic, sigmoid
from tests.llm.fixtures import AWKWARD, documents, empty_documents, labels

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 1), (3, None, None), (None, 1, 1), (6, 1, 0), (99, 0, 1), (7, 0, 1), (9, 0, 0)]


@pytest.mark.parametrize(("operator", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_awkward_rows(spark, operator, label):
    docs = documents(spark)
    model = operator.fit(docs, labels(spark, LABELS), label, F.lit(True))
    scored = operator.score(docs, model, "p")
    assert scored.columns == [*docs.columns, "p"]
    rows = scored.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(AWKWARD)
    assert all(0.0 <= r["p"] <= 1.0 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["p"]) == r["p"]
    with pytest.raises(ValueError):
        operator.score(docs, model, "score")


@pytest.mark.parametrize(("operator", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_without_labels_or_rows(spark, operator, label):
    model = operator.fit(documents(spark), labels(spark, []), label, F.lit(True))
    assert {round(r["p"], 6) for r in operator.score(documents(spark), model, "p").collect()} == {0.5}
    assert operator.score(empty_documents(spark), model, "p").collect() == []
    operator.fit(empty_documents(spark), labels(spark, LABELS), label, F.lit(True))


@pytest.mark.parametrize(
    ("name", "label", "threshold", "least"), [("op4_quality", "quality", 0.7, 0.95), ("op1_toxicity", "toxic", 0.5, 0.95)]
)
def test_held_out_accuracy(spark, name, label, threshold, least):
    folder = "/root/testdata/sf0.1"
    rows = queries.QUERIES[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert all(r["predicted"] == int(r["score"] >= threshold) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r[label] for r in held) >= least * len(held)


def test_features_do_not_see_labels_or_other_columns(spark):
    docs = documents(spark)
    model = toxicity.fit(docs, labels(spark, LABELS), "toxic", F.lit(True))
    other = docs.withColumn("source", F.lit("z")).withColumn("doc_id", F.lit(5).cast("long"))
    a = sorted((r["text"] or "", r["p"]) for r in toxicity.score(docs, model, "p").collect())
    assert a == sorted((r["text"] or "", r["p"]) for r in toxicity.score(other, model, "p").collect())


@pytest.fixture(scope="module")
def letters():
    words = Counter({"idiot": 20, "moron": 20, "stupid": 20, "trash": 20, "you": 50, "the": 90, "cool": 20, "scum": 20, "and": 60, "dot": 5})
    return toxicity.Characters(dict(toxicity.Characters.count(words.items())))


@pytest.mark.parametrize(
    ("spelt", "read"),
    [("1d10t", "idiot"), ("iddiiiiooot", "idiot"), ("i d i o t", "idiot"), ("m0r0n", "moron"), ("st.u.p.i.d", "stupid"), ("tr@sh", "trash"),
     ("c00l", "cool"), ("coooool", "cool"), ("t-r-a-s-h", "trash"), ("idiot", "idiot"), ("", ""), ("...", "")],
)
def test_restore(letters, spelt, read):
    assert toxicity.restore(spelt, letters) == read


def test_restored_words_join_the_plain_ones(letters):
    found = toxicity.Reader(letters).words("You 1d10t, s c u m and tr@sh! fine")
    assert {"you", "idiot", "scum", "and", "trash", "fine"} <= found


def test_logistic_and_network_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 3))
    y = (x @ np.array([2.0, -1.0, 0.0]) + 0.3 > 0).astype(float)
    w = logistic(x, y)
    assert ((sigmoid(x @ w[:-1] + w[-1]) > 0.5) == y).mean() > 0.97
    network = quality.fit_network(x, ((x**2).sum(axis=1) > 2.4).astype(float))
    assert ((network.probability(x) > 0.5) == ((x**2).sum(axis=1) > 2.4)).mean() > 0.9


def test_pooling_in_blocks_equals_pooling_at_once(monkeypatch):
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    text = "a b c c d e " * 50
    whole = quality.pooled(text, vectors)
    sums = np.zeros((quality.BUCKETS, quality.DIMENSIONS), dtype=np.float32)
    quality.add_contexts(quality.tokens(text), sums)
    monkeypatch.setattr(quality, "BLOCK", 7)
    monkeypatch.setattr(quality, "CONTEXTS", 7)
    assert np.allclose(whole, quality.pooled(text, vectors), atol=1e-5)
    again = np.zeros_like(sums)
    quality.add_contexts(quality.tokens(text), again)
    assert np.allclose(sums, again)


@pytest.mark.parametrize(
    ("text", "word"),
    [("you stuupid", "stupid"), ("iddiot", "idiot"), ("a morron", "moron"), ("the id iot!", "idiot"), ("st u pid", "stupid"), ("you st u pid, cool", "stupid"),
     ("s c u m", "scum"), ("mor on", "moron"), ("c o o l " * 15 + "x y t r a s h " + "c o o l " * 15, "trash"), ("the " * 500 + "sc um", "scum")],
)
def test_reader_finds_doubled_letters_and_split_words(letters, text, word):
    assert word in toxicity.Reader(letters).words(text)


def test_reader_reads_a_long_run_as_a_whole(letters):
    for shift in range(45):
        assert "idiot" in toxicity.Reader(letters).words("y o u " * shift + "i d i o t " + "y o u " * 40)


def test_common_words_do_not_hide_split_ones(letters):
    """The gate against full decoding: common words alone are left, rare parts are read with what is near."""
    common = frozenset({"the", "you", "and", "cool", "is", "on"})
    gated = toxicity.Reader(letters, common)
    for text, word in [
        ("the and the and the", None), ("you i d i o t and the", "idiot"), ("the id iot is on", "idiot"), ("and st u pid the", "stupid"),
        ("idio t", "idiot"), ("you tra sh", "trash"), ("the s c u m is", "scum"), ("iddiot the", "idiot"),
    ]:
        if word is None:
            assert list(gated.segments(text.split())) == [] and gated.words(text) == set(text.split())
        else:
            assert word in gated.words(text)
            assert word in toxicity.Reader(letters).words(text)


def enumerated(spelt, model):
    """The best reading among all of them, by brute force."""
    runs = [m.group() for m in toxicity._RUN.finditer(spelt)]
    best, reached = None, {}
    for ways in itertools.product(*map(toxicity._ways, runs), [(" ", 0.0)]):
        total, last = 0.0, "  "
        for letters, cost in ways:
            total += cost
            for x in letters:
                if x != " " or last[1] != " ":
                    total += model.logs[last + x]
                    last = last[1] + x
        read = "".join(letters for letters, _ in ways).strip()
        reached[read] = max(total, reached.get(read, total))
        best = total if best is None else max(best, total)
    ties = {read for read, total in reached.items() if total > best - 1e-9}
    return best, max(reached, key=reached.get), ties


def test_viterbi_finds_the_best_of_all_readings(letters):
    rng = random.Random(12)
    for _ in range(400):
        spelt = "".join(rng.choice("idotsh1035 @.!lru") for _ in range(rng.randint(1, 7)))
        best = enumerated(spelt, letters)
        found = toxicity.restore(spelt, letters)
        assert found == best[1] or found in best[2]


def test_trigrams_equal_a_plain_count():
    words = Counter({"idiot": 3, "a": 2, "éà": 5, "漢字": 1, "😀x": 4})
    plain = Counter()
    for word, n in words.items():
        w = f"  {word} "
        for i in range(2, len(w)):
            plain[w[i - 2 : i + 1]] += n
    assert toxicity.Characters.count(words.items()) == dict(plain)
    assert toxicity.Characters.count({}.items()) == {}


def test_corpus_statistics_cover_texts_without_labels(spark):
    rows = [(i, "plain words here") for i in range(40)] + [(100 + i, "zyxwv uvzzyx") for i in range(5)] + [(None, "qqzq qqzq"), (7, None)]
    held = labels(spark, [(i, i % 2, i % 2) for i in range(40)])
    docs = documents(spark, rows)
    counted = toxicity.fit(docs, held, "toxic", F.lit(True)).language
    assert counted.characters["zyx"] == 10 and counted.characters["qzq"] == 2
    assert {"plain", "words", "here"} <= counted.common
    vectors = quality.fit(docs, held, "quality", F.lit(True)).vectors
    for word in ("zyxwv", "qqzq"):
        assert np.linalg.norm(vectors[quality._chunk(word)[0]]) > 0.99


def test_sample_is_bounded_by_rows(spark):
    rows = [(i, f"text {i}") for i in range(30)] + [(3, f"copy {k}") for k in range(50)]
    held = labels(spark, [(i, 1, 0) for i in range(30)])
    chosen = labelled(documents(spark, rows), held, "quality", F.lit(True), 20).collect()
    assert len(chosen) <= 20 and not any(r["doc_id"] == 3 for r in chosen)
    assert len(labelled(documents(spark, rows), held, "quality", F.lit(True), 200).collect()) == 80


def test_batched_contexts_equal_those_of_each_text(spark):
    texts = ["a b c", "", "d", "a b c d e f g " * 40, "x"]
    alone = np.zeros((quality.BUCKETS, quality.DIMENSIONS), dtype=np.float32)
    for text in texts:
        quality.add_contexts(quality.tokens(text), alone)
    unit = alone / np.maximum(np.linalg.norm(alone, axis=1, keepdims=True), 1e-9)
    assert np.allclose(unit, quality.word_vectors(documents(spark, list(enumerate(texts)))), atol=1e-4)


def test_hopeless_readings_do_not_change_scores(letters):
    """Scores equal those of decoding every odd word and every run."""
    rng = random.Random(3)
    weights = {f: 2.0 for w in ("idiot", "trash", "moron") for f in toxicity.features(w)}
    language = toxicity.Language(letters.counts, frozenset({"the", "on", "cool"}))
    model = toxicity.Model(language, weights, np.array([1.0, 0.5, 1.0, 0.1, -2.0]))
    bits = ["the", "on", "cool", "iddiot", "id", "iot", "mor", "t r a s h", "tr@sh", "hello", "llama", "m0ron", "morron", "x", "tra", "sh", "good", "aaa", "1d", "10t", "idio", "t"]
    texts = [" ".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(400)]
    reader = language.reader()
    expected = []
    for text in texts:
        heavy = {w: max((weights.get(f, 0.0) for f in toxicity.features(w)), default=0.0) for w in reader.words(text)}
        x = toxicity.summary([v for v in heavy.values() if v > 0], len(set(text.split())))
        expected.append(float(sigmoid(np.array(x) @ model.regression[:-1] + model.regression[-1])))
    assert np.allclose(model.scorer()(texts), expected)


def test_weak_doubled_letters_stay_unread_and_change_no_score(letters, monkeypatch):
    """Of the doubled words only those are decoded that may be among the heaviest; scores are those of full decoding."""
    weights = {"^idiot$": 2.0, "^idio": 1.6, "^scum$": 1.5, "trash": 1.2, "^moron$": 1.1, "^soft": 0.4, "ofter": 0.3, "^table": 0.35, "stupi": 1.0}
    model = toxicity.Model(toxicity.Language(letters.counts, frozenset({"the"})), weights, np.array([1.0, 0.5, 0.3, -0.1, -2.0]))
    rng = random.Random(5)
    parts = ["idiot", "iddiot", "scum", "trash", "trassh", "moron", "mooron", "sofft", "softter", "tabble", "sofftterr", "the", "stuppid", "i d i o t", "$tupid", "aa", "x"]
    texts = ["", None, "sofft", "idiot scum trash sofft tabble softter"] + [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(300)]

    def plainly(text):
        reader = model.language.reader()
        chunks = (text or "").lower().split()
        heavy = {w: max((weights[f] for f in toxicity.features(w) if f in weights), default=0.0) for w in reader.words(text)}
        return sigmoid(np.array(toxicity.summary([v for v in heavy.values() if v > 0.0], len(set(chunks)))) @ model.regression[:-1] + model.regression[-1])

    for together in (1, 40, 10**6):
        monkeypatch.setattr(toxicity, "TOGETHER", together, raising=False)
        np.testing.assert_allclose(model.scorer()(texts), [plainly(t) for t in texts], rtol=1e-12)
    read, plain = [], toxicity.restore
    monkeypatch.setattr(toxicity, "restore", lambda spelt, m: read.append(spelt) or plain(spelt, m))
    model.scorer()(["idiot scum trash sofft tabble softter"])
    assert read == []
    # an alphabet that does not fit is looked up word by word
    monkeypatch.setattr(toxicity.Heaviest, "BITS", 2)
    np.testing.assert_allclose(model.scorer()(texts), [plainly(t) for t in texts], rtol=1e-12)


def test_runs_have_a_bound_and_are_read_only_where_it_may_count(letters, monkeypatch):
    """No reading weighs more than the bound, some one as much; runs with signs and doubled letters that have no feature stay undecoded."""
    weights = {"^idiot$": 2.0, "^idio": 1.6, "^stupid": 0.9, "trash": 1.2, "oron$": 0.8, "^soft": 0.4, "tilis": 0.5, "^of$": 0.35}
    bounds, rng = toxicity.Bound(weights), random.Random(8)
    parts = ["id", "iot", "st", "upid", "tra", "sh", "|", "m0", "ron", "soft", "til", "s", "of", "aab", "1", "(", "hat"]
    for _ in range(300):
        run = " ".join(rng.choices(parts, k=rng.randint(2, 5)))
        runs = [m.group() for m in toxicity._RUN.finditer(run)]
        readings = {"".join(x for x, _ in way) for way in itertools.product(*map(toxicity._ways, runs))}
        words = {"", *itertools.chain.from_iterable(map(str.split, readings))}
        most = {w: max(weights.get(f, 0.0) for f in toxicity.features(w)) for w in words}
        # a part that stands alone is a chunk of its own, whose weight is known
        assert max(n for w, n in most.items() if w not in run.split()) <= bounds.of(run) <= max(most.values())
    assert bounds.of("|1|1|1|1") is None
    model = toxicity.Model(toxicity.Language(letters.counts, frozenset({"the"})), weights, np.array([1.0, 0.5, 0.3, -0.1, -2.0]))
    texts = ["| hat | hat |", "idiot trash stupidly the so ft", "aab s hat"]
    reader, expected = model.language.reader(), []
    for text in texts:
        heavy = {w: max((weights[f] for f in toxicity.features(w) if f in weights), default=0.0) for w in reader.words(text)}
        expected.append(sigmoid(np.array(toxicity.summary([v for v in heavy.values() if v > 0.0], len(set(text.split())))) @ model.regression[:-1] + model.regression[-1]))
    read, plain = [], toxicity.restore
    monkeypatch.setattr(toxicity, "restore", lambda spelt, m: read.append(spelt) or plain(spelt, m))
    np.testing.assert_allclose(model.scorer()(texts), expected, rtol=1e-12)
    assert read == []
