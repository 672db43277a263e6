"""The automaton against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from faultline.llm import automaton
from tests.llm.fixtures import AWKWARD, documents, empty_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return automaton.Encoder(*automaton.compiled(PATH))


def texts():
    rng = random.Random(5)
    odd = ["", "<|startoftext|> a<|endoftext|>b<|endof", "a\x1cb \x85 c d", "á é ́", "aaaa " * 9, "I'LL don't 'S", "ﬁ Ⅻ ½"]
    return odd + ["".join(rng.choice("abcdehilnorst '\n0ABé漢😀") for _ in range(rng.randint(0, 40))) for _ in range(800)]


def test_ids_and_decoded_text_equal_the_library(coder, library):
    for text in [*texts(), *(t or "" for _, t in AWKWARD)]:
        ids, decoded = coder.encode(text)
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert decoded.decode() == library.decode(expected, skip_special_tokens=False)


def test_a_small_machine_by_hand():
    vocab = {"a": 0, "b": 1, "a$": 2, "b$": 3, "aa": 4, "ab$": 5, "aab$": 6}
    machine = automaton.compile_merges(vocab, [("a", "a"), ("a", "b$"), ("aa", "b$")], "$")
    assert machine.encode("aab") == [6]
    assert machine.encode("aaab") == [4, 5]
    assert machine.encode("ab") == [5]
    assert machine.encode("acb") == [5]  # a symbol without an id vanishes
    assert machine.encode("c") == [] and machine.encode("") == []


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):
        automaton.compile_merges({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")], "")


def test_documents(spark, library):
    found = automaton.encode_documents(documents(spark), PATH, digest=True).collect()
    expected = []
    for d, t in AWKWARD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found), key=order) == sorted(expected, key=order)
    assert automaton.encode_documents(empty_documents(spark), PATH).collect() == []
