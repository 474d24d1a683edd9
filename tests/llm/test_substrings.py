"""Words taken out against a look at every window."""

import hashlib
import random

import numpy as np
from conftest import awkward_rows

from rivertally.llm import substrings
from rivertally.llm.order import row_keys


def expected(ordered):
    """Per text, in the order that decides: words, words removed, digest of the rest."""
    seen, out = set(), []
    for text in ordered:
        words = text.split()  # bytes: the six ASCII blanks
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def test_awkward_rows(awkward):
    rows = awkward_rows()
    keys = {(r.did, bytes(r.text)): r.rk for r in row_keys(awkward).collect()}
    order = sorted(keys, key=keys.get)
    assert [i for i, _ in order] == sorted(i for i, _ in order)
    of = dict(zip(order, expected([t for _, t in order]), strict=True))
    want = [(str(i), *of[-(2**63) if i is None else i, (t or "").encode()]) for i, t, *_ in rows]
    got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.substring_report(awkward).collect()]
    assert sorted(got) == sorted(want)
    assert sum(w[2] > 0 for w in want) >= 6


def test_passages_in_many_places(spark):
    rng = random.Random(2)
    words = ["a", "b", "the", *(f"w{i}" for i in range(40))]
    passages = [" ".join(rng.choices(words, k=rng.randint(19, 90))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages).split()
            a = rng.randint(0, 15)
            parts += [*rng.choices(words, k=rng.randint(0, 30)), *p[a : a + rng.randint(1, 80)]]
        texts.append(" ".join(parts))
    texts += ["a " * 70, "a b " * 40, "a " * 20, "a " * 19]
    docs = spark.createDataFrame([(i * 3 - 50, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [(r.n_words, r.n_removed, r.kept_sha256) for r in substrings.substring_report(docs).orderBy("doc_id").collect()]
    assert got == expected([t.encode() for t in texts])


def test_hashes_of_runs():
    h = np.random.default_rng(1).integers(0, 2**63, 50, dtype=np.uint64)
    for size in (1, 2, 3, 6, 20, 50):
        whole = substrings._sequence_hash(h, size)
        assert len(whole) == 50 - size + 1
        assert all(substrings._sequence_hash(h[i : i + size], size)[0] == x for i, x in enumerate(whole))
    values = np.array([5, 3, 3, 9, 1, 1, 7], np.uint64)
    assert substrings._leftmost_least(values, 3).tolist() == [1, 1, 4, 4, 4]


def test_empty(empty):
    assert substrings.substring_report(empty).count() == 0
