"""Ranked lists against a plain scoring of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import awkward_rows, prose

from rivertally.llm import ranked_search as search
from rivertally.llm.byte_words import cut_words, slices

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(SMALL))


def expected(docs, items, top=50):
    counts = [(-(2**63) if i is None else i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for did, c in counts:
            m = 100 - 50 + 50 * c.total() * n // total
            score = 0
            for t in set(terms(text)) & c.keys():
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, did))
        out += [(item, r, None if d == -(2**63) else d, -s) for r, (s, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def results(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(1, prose(7, 20, 2000)), (2, "The the THE one"), (3, None), (4, ""), (5, "zzz unheard"), (6, "日本語 ΣΑΣ café 123"), (7, prose(1, 200)), (7, "end; it's"), (None, "one"), (8, "a b"), (9, prose(5, 3000))]


@pytest.mark.parametrize(("group", "items", "terms_"), [(4 << 20, 256, 2048), (600, 2, 3)])
def test_awkward_rows(spark, awkward, monkeypatch, group, items, terms_):
    monkeypatch.setattr(search, "ITEMS", items)
    monkeypatch.setattr(search, "TERMS", terms_)
    monkeypatch.setattr(search, "DOCUMENTS", 3 if items == 2 else 1024)
    queries = spark.createDataFrame([(i, t, 1, 2) for i, t in ITEMS], "item_id long, text string, did long, score long").repartition(2)
    got = search.ranked_search(awkward, queries, group_bytes=group)
    assert dict(got.dtypes)["rank"] == "int"
    want = expected([r[:2] for r in awkward_rows()], ITEMS)
    assert results(got) == want and len(want) > 50


def test_ties_at_the_end_of_the_list(spark):
    """Copies share a score; the smallest identifiers are listed, whichever task met them."""
    rng = random.Random(3)
    docs = [(i, "same text here") for i in rng.sample(range(-500, 500), 200)] + [(i, f"same w{i % 7} text") for i in range(600, 700)]
    items = [(1, "same here"), (2, "w3 text"), (3, "text")]
    got = search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string"))
    assert results(got) == expected(docs, items)
    top3 = search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), top=3)
    assert results(top3) == expected(docs, items, 3)


def test_empty(spark, empty, awkward):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert search.ranked_search(awkward, none).count() == 0
    assert search.ranked_search(empty, some).count() == 0
    assert search.ranked_search(spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string"), some).count() == 0


def test_partial_sums_stay_exact():
    """However heavy the terms, no stretch of a tile can reach 2^53."""
    weight = np.full(5000, 10**8, np.int64)
    tile = search.Tile(0, [np.arange(5000)], weight, search.TERMS)
    assert sum(len(own) for own, _ in tile.parts) == 5000
    assert all(int(matrix.sum(axis=1).max()) * search.MOST_IMPACT < 2**53 for _, matrix in tile.parts)
    assert search.impacts(np.array([10**9]), np.array([1]), 10**6, 10**9)[0] < search.MOST_IMPACT


def test_words_of_rows():
    rows = ["", "Ab cd", None, "cd", "", "é-Ü x", " ", "x"]
    texts = pa.array(rows + ["tail"] * 3).slice(0, len(rows))
    for most in (1, 4, 1000):
        got = []
        for at, part in slices(texts, most):
            words = cut_words(part, search.IN_TERM)
            got += [(at + r, v.as_py().decode()) for r, v in zip(words.rows.tolist(), words.values, strict=True)]
        assert got == [(i, w) for i, t in enumerate(rows) for w in terms(t)]
    assert list(slices(pa.array([], pa.string()))) == []
