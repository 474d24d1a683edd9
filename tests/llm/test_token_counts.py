"""Counts against the library that the vocabulary is made for."""

import random

import public_tokenizers
import pytest
from conftest import awkward_rows
from tokenizers import Tokenizer

from rivertally.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def machine():
    return token_counts.Transducer(PATH)


@pytest.mark.parametrize("chunk", [1 << 16, 40, 1])
def test_awkward_rows(awkward, library, chunk):
    got = token_counts.token_counts(awkward, PATH, chunk=chunk, limit=100).collect()
    want = [(str(i), len((t or "").encode()), library(t or ""), library(t or "") > 100) for i, t, *_ in awkward_rows()]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(want)


def test_random_words(machine, library):
    rng = random.Random(1)
    parts = "th er on an re he in ing tion 's 're 've 'S É ß ü Σ ς 12 3 . , !! aaaa zz 日本 <|endoftext|> <|start $ _ ' ́ Å ﬁ İ".split(" ")
    for _ in range(4000):
        word = "".join(rng.choices(parts, k=rng.randint(1, 9)))
        assert machine.count(word) == library(word), word


def test_long_words_need_few_states(machine, library):
    machine.restart()
    for word in ("a" * 3000, "ab" * 2000, "the" * 1500):
        assert machine.count(word) == library(word)
    assert len(machine.symbol) < 1000


def test_states_start_anew(monkeypatch, machine, library):
    monkeypatch.setattr(token_counts, "MOST_STATES", 10)
    text = "compiled again and again without a change of any count"
    assert machine.count(text) == library(text)


def test_maps_compose(machine, library):
    text = "  some text with\twhite space,  unbrokenstretcheswithoutany and it's end "
    for size in (1, 3, 7, 30, 100):
        maps = [machine.chunk(text[i : i + size]) for i in range(0, len(text), size)]
        assert machine.total(maps) == library(text)
        middle = len(maps) // 2 or 1
        if len(maps) > 2:  # associative
            left, right = maps[:middle], maps[middle:]
            fold = lambda ms: __import__("functools").reduce(machine.compose, ms)
            assert machine.total([machine.compose(fold(left), fold(right))]) == library(text)


def test_empty(empty):
    assert token_counts.token_counts(empty, PATH).count() == 0
