"""Pieces put together again give each document's ids; the curve visits neighbours."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import awkward_rows
from tokenizers import Tokenizer

from rivertally.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_round_trip(awkward, library):
    got = packing.pack(awkward, PATH, length=128).collect()
    documents = {}
    for i, t, *_ in awkward_rows():
        documents.setdefault(i, []).append(ids(library, t))
    assert sum(r.length for r in got) == sum(len(x) for own in documents.values() for x in own)
    for i, own in documents.items():
        pieces = [(r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got if r.doc_id == i]
        want = []
        for start, length, _, whole in pieces:
            fit = [x for x in own if len(x) == whole and (start, length, zlib.crc32(np.array(x[start : start + length], "<u4").tobytes()), whole) in pieces]
            assert fit
        assert sum(p[1] for p in pieces) == sum(map(len, own)), want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():  # gapless from 0
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    filled = [sum(n for _, n in sequences[s]) for s in sorted(sequences)]
    assert sorted(sequences) == list(range(len(sequences))) and set(filled[:-1]) == {128} and filled[-1] <= 128


def test_neighbours_share_sequences(spark):
    kinds = ["red green blue " * 40, "one two three four " * 30, "wind rain snow hail sun " * 25]
    docs = spark.createDataFrame([(i, kinds[i % 3]) for i in range(60)], "doc_id long, text string")
    got = packing.pack(docs, PATH).toPandas()
    mixed = got.groupby("sequence_id").doc_id.agg(lambda d: len(set(d % 3)))
    assert (mixed == 1).sum() >= len(mixed) - 2


def test_curve():
    for axes, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[range(1 << bits)] * axes), -1).reshape(-1, axes)
        key = packing.curve_key(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_white_space_is_what_the_vocabulary_takes_for_it(library):
    for code in [*range(0x250), *range(0x1600, 0x1900), *range(0x2000, 0x2100), *range(0x3000, 0x3010), 0xFEFF]:
        assert bool(packing.WHITE.fullmatch(chr(code))) == (not library.encode(chr(code), add_special_tokens=False).ids)


def test_memory_starts_anew(monkeypatch, library):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    encoder = packing.Encoder(PATH)
    for text in ("a b c d e f g h", "a b c", "x" * 200 + " y", "q r s t u v w a b", ""):
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_texts_looked_up_together(monkeypatch, library):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    monkeypatch.setattr(packing, "TOGETHER", 30)
    monkeypatch.setattr(packing, "LONGEST_REMEMBERED", 8)
    encoder = packing.Encoder(PATH)
    texts = ["Some words, and more words!", "", "a\0b \0 c", "<|endoftext|> words\0", "unforgettable " * 9, "ÅNGSTRÖM <|startoftext|>x\x1cy", "\0\0", "more words! and"] * 3
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.many(texts)] == want
    assert not any(len(p) > 8 for p in encoder.young)


def test_empty(empty):
    assert packing.pack(empty, PATH).count() == 0


def test_every_letter_before_a_mark(library):
    """The same ids as the library for every letter before each mark that is cut off, also those that normalise to a letter and a mark."""
    encoder = packing.Encoder(PATH)
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    assert len([c for c in letters if not packing._ends_in_a_letter(c)]) >= 50
    odd = [c for c in letters if not packing._ends_in_a_letter(c)] + letters[::97]
    texts = [f"{c}{m}" for c in odd for m in "?.,"] + [f"İ?{c}: x{c}!" for c in odd]
    for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder.ids(text).tolist() == e.ids, text


def test_stretches_keep_the_order_of_the_table(spark):
    kinds = ["red green blue " * 40, "one two three four " * 30, "wind rain snow hail sun " * 25]
    docs = spark.createDataFrame([(i, kinds[i % 3]) for i in range(60)], "doc_id long, text string").coalesce(1)
    for order in (docs.orderBy("doc_id"), docs.orderBy(-docs["doc_id"])):
        ids = [r.doc_id for r in order.collect()]
        got = packing.pack(order, PATH, stretch=12).orderBy("sequence_id", "offset").collect()
        seen = list(dict.fromkeys(r.doc_id for r in got))
        assert [set(seen[i : i + 12]) for i in range(0, 60, 12)] == [set(ids[i : i + 12]) for i in range(0, 60, 12)]


def test_words_of_letters_need_no_mark(monkeypatch):
    """They are told apart by their last ids; a letter that the library makes something else of goes back to the marks."""
    encoder, marked = packing.Encoder(PATH), []
    ask = encoder._ask_marked
    monkeypatch.setattr(encoder, "_ask_marked", lambda pieces: marked.extend(pieces) or ask(pieces))
    plain = ["river", "Fluss", "été", "ß", "ﬁ", "क", "x" * 70]
    for pieces in (plain, ["a1", *plain, "b,"], [*plain, "क़", "İstanbul"]):
        assert encoder._ask(pieces) == {p: np.asarray(encoder.library.encode(p, add_special_tokens=False).ids, encoder.type).tobytes() for p in pieces}
    assert marked[:2] == ["a1", "b,"]
