"""Phrases against a plain count of all of them, and paths against a walk along the graph."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import awkward_rows, prose

from rivertally.llm import collocations as coll

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(docs, least=10, inside=50, top=2000):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(SMALL)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if len(p) == 2 and any(100 * b >= inside * a and p in (q[:2], q[1:]) for q, b in found.items() if len(q) == 3):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, r, p.decode(), -a, l, q, n[lang], -s) for r, (s, a, p, l, q) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def results(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_awkward_rows(awkward):
    got = coll.collocations(awkward)
    assert {t for _, t in got.dtypes} == {"string", "bigint"}
    docs = [(t, lang) for _, t, lang, *_ in awkward_rows()]
    assert results(got) == expected(docs) != []
    want = expected(docs, 2)
    assert results(coll.collocations(awkward, 2)) == want and len(want) > 100


def random_docs(seed):
    """Few words, repeated passages, cycles, hot pairs, and pieces of all lengths."""
    rng = random.Random(seed)
    words = ["a", "B", "the", "of", "é", "x-y", *(f"w{i}" for i in range(12))]
    passages = [rng.choices([f"p{i}" for i in range(60)], k=rng.randint(2, 40)) for _ in range(8)]
    docs = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts += rng.choices(words, k=rng.randint(0, 9))
            if rng.random() < 0.5:
                parts += rng.choice(passages)
            if rng.random() < 0.4:
                parts[-1:] = [*parts[-1:], rng.choice([",", ". ", "\n", " ; ", "!?"])]
        docs.append((rng.choice([" ", "  ", "\t"]).join(parts), rng.choice(["en", "de", None, ""])))
    docs += [("a a a a a a a a a a a a a a", "en"), ("q r s " * 15, "en"), ("q r s t " * 15, "xx"), ("u v " * 12, "xx"), (" ".join(f"hot pair h{i}" for i in range(700)), "de")]
    docs += [(" ".join(f"l{i}" for i in range(3000)), "long")] * 10
    return docs


@pytest.mark.parametrize(("seed", "least", "inside", "top"), [(1, 10, 50, 2000), (2, 3, 80, 7)])
def test_random_texts(spark, seed, least, inside, top):
    docs = random_docs(seed)
    df = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(docs)], "doc_id long, text string, lang string").repartition(5)
    assert results(coll.collocations(df, least, inside, top)) == expected(docs, least, inside, top)


def test_hot_pair_is_spread(spark):
    docs = spark.createDataFrame([(" ".join(f"hot pair h{i}" for i in range(3000)), "en"), (prose(1, 900), "en")], "text string, lang string")
    words, hot, seed = coll.known_words(docs)
    of = {r.word: r.h for r in words.collect()}
    assert (of["hot"], of["pair"]) in {tuple(p) for p in hot.tolist()} and len(hot) <= 2 * coll.HOT
    sums = coll.frequent(docs, hot, seed).where(f"x = {of['hot']} AND y = {of['pair']} AND z = 0").collect()
    assert sum(r.n for r in sums) == 3000 and len(sums) > 1


def test_paths(spark):
    """Every edge lies in one path; a path goes on through unary nodes only and ends where none is left."""
    rng = random.Random(4)
    edges = {(1, 1, 1): 9, (5, 6, 7): 1, (6, 7, 5): 2, (7, 5, 6): 3}  # a loop, a cycle
    edges |= {(100 + i, 101 + i, 102 + i): i for i in range(2500)}
    while len(edges) < 2900:
        edges[(rng.randint(10, 40), rng.randint(10, 40), rng.randint(10, 40))] = len(edges)
    df = spark.createDataFrame([(*e, n) for e, n in edges.items()], coll._EDGE).repartition(3)
    rows = coll.compacted(df).collect()
    seen = {}
    for r in rows:
        assert len(r.words) == len(r.counts) + 2 and len(r.counts) <= coll.STRETCH
        for i, n in enumerate(r.counts):
            e = tuple(r.words[i : i + 3])
            assert e not in seen and edges[e] == n
            seen[e] = (r.path, r.stretch * coll.STRETCH + i)
    assert seen.keys() == edges.keys()
    out, into = Counter(e[:2] for e in edges), Counter(e[1:] for e in edges)
    unary = {p for p in out if out[p] == into[p] == 1}
    after = {e[:2]: e for e in edges}
    for e, (path, at) in seen.items():
        if e[1:] in unary and after[e[1:]] != e:
            where = seen[after[e[1:]]]
            assert where == (path, at + 1) or (where[1] == 0 and where[0] == path)  # a cycle is opened once
    assert sum(e[1:] in unary and after[e[1:]] != e and seen[after[e[1:]]][1] == 0 for e in edges) == 1


def test_empty(spark, empty):
    assert coll.collocations(empty).count() == 0
    assert coll.collocations(spark.createDataFrame([(None, None), ("", "en"), (" . ,", "en"), ("one", "en")], "text string, lang string")).count() == 0


def test_batches_of_blocks_are_bounded(spark, monkeypatch):
    """Blocks are handed over a few at a time, however many a partition has."""
    before = spark.conf.get(coll.BYTES_A_BATCH)
    seen, durable = [], coll.durable
    monkeypatch.setattr(coll, "durable", lambda df: seen.append(spark.conf.get(coll.BYTES_A_BATCH)) or durable(df))
    docs = spark.createDataFrame([(1, "a b c. a b c", "en")], "doc_id long, text string, lang string")
    assert coll.frequent(docs, np.zeros((0, 2), np.int64), 0, 2).count() > 0
    assert seen == [str(coll.BATCH_BYTES)] and spark.conf.get(coll.BYTES_A_BATCH) == before

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    blocks = spark.range(0, 12, 1, 1).selectExpr("cast(repeat('x', 1 << 20) as binary) as block")
    with coll.batches_of(spark, 2 << 20):
        sizes = [r.n for r in blocks.mapInArrow(rows, "n long").collect()]
    assert sum(sizes) == 12 and max(sizes) <= 3
