"""Lines taken out against a comparison of all pairs."""

import hashlib
import random

from conftest import awkward_rows

from rivertally.llm import line_dedup


def repeated(texts):
    """(document, line) of the lines that resemble an earlier one; ``texts`` in order."""
    lines = [(d, n, frozenset(x.split())) for d, t in enumerate(texts) for n, x in enumerate(t.split("\n"))]
    gone = set()
    for k, (d, n, s) in enumerate(lines):
        if s and any(o and 9 * len(s & o) >= 4 * (len(s) + len(o)) for *_, o in lines[:k]):
            gone.add((d, n))
    return gone


def similar_lines(seed, documents, variants):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    base = [rng.sample(words, rng.randint(1, 30)) for _ in range(25)]
    texts = []
    for _ in range(documents):
        lines = []
        for _ in range(rng.randint(0, variants)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice(words)
            rng.shuffle(line)
            lines.append(" ".join(line))
        texts.append("\n".join(lines))
    return texts


def check(spark, texts):
    gone = repeated(texts)
    assert gone
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in line_dedup.line_dedup_report(docs).collect():
        lines = texts[r.doc_id].split("\n")
        kept = "\n".join(x for n, x in enumerate(lines) if (r.doc_id, n) not in gone)
        assert r.n_removed == sum(d == r.doc_id for d, _ in gone)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        assert r.n_lines == (len(lines) if texts[r.doc_id] else 0)


def test_all_pairs(spark):
    check(spark, similar_lines(1, 60, 8))


def test_large_groups(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL_GROUP", 4)
    check(spark, similar_lines(2, 60, 8))


def test_any_order_of_words_will_do(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BUCKETS", 2)
    check(spark, similar_lines(3, 40, 6))


def test_awkward_rows(awkward):
    rows = awkward_rows()
    cut = line_dedup.line_dedup(awkward)
    assert cut.columns == awkward.columns and cut.count() == len(rows)
    # One row per document in the order that decides: rows without identifier first, rows of one identifier by hash of the text.
    keys = {(r.did, bytes(r.text)): r.rk for r in line_dedup.row_keys(awkward).collect()}
    order = sorted(keys, key=keys.get)
    gone = repeated([t.decode() for _, t in order])
    want = []
    for i, t, *rest in rows:
        d = order.index((-(2**63) if i is None else i, (t or "").encode()))
        left = [x for n, x in enumerate((t or "").split("\n")) if (d, n) not in gone]
        changed = any(g == d for g, _ in gone)
        text = "\n".join(left) if changed else t
        want.append((str(i), text, len(text) if changed else rest[2]))
    assert sorted(((str(r.doc_id), r.text, r.n_chars) for r in cut.collect()), key=str) == sorted(want, key=str)


def test_native(spark):
    docs = spark.createDataFrame([(1, "a b\nc"), (2, "a b")], "doc_id long, text string")
    plan = line_dedup.line_dedup_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty(empty):
    assert line_dedup.line_dedup_report(empty).count() == 0 and line_dedup.line_dedup(empty).count() == 0


def test_near_copies_are_not_all_paired(spark, monkeypatch):
    """A group of near copies costs pairs in proportion to its size."""
    lines = 60
    texts = [" ".join(f"v{d}x" if w == d % 40 else f"word{w}" for w in range(40)) for d in range(lines)]
    seen, verified = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda pairs, rows: seen.append(pairs.count()) or verified(pairs, rows))
    check(spark, texts)
    assert sum(seen) <= 3 * lines
