"""Fingerprints and groups against brute force."""

import random
import re

import xxhash
from conftest import awkward_rows

from rivertally.llm import simhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest document of each print's group; ``prints`` maps print to its documents."""
    parent = {f: f for f in prints}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for f in prints:
        for g in prints:
            if (f ^ g).bit_count() <= 4:
                parent[find(f)] = find(g)
    least = {}
    for f, docs in prints.items():
        least[find(f)] = min(*docs, least.get(find(f), docs[0]), docs[0])
    return {f: least[find(f)] for f in prints}


def test_fingerprints_of_awkward_rows(awkward):
    got = sorted((str(r.doc_id), r.fingerprint) for r in simhash.simhash_report(awkward).collect())
    assert got == sorted((str(i), f"{fingerprint(t):016x}") for i, t, *_ in awkward_rows())


def test_groups_of_awkward_rows(awkward):
    prints = {}
    for i, t, *_ in awkward_rows():
        prints.setdefault(fingerprint(t), []).append(-(2**63) if i is None else i)
    want = components(prints)
    for r in simhash.simhash_groups(awkward).collect():
        assert r.component == want[r.fp % 2**64]


def test_dense_groups_and_chains(spark):
    rng = random.Random(4)
    prints = []
    for _ in range(40):  # chains of prints that are one to five bits apart
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            prints.append(f)
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
    prints = list(dict.fromkeys(prints))
    ids = rng.sample(range(10_000), len(prints))
    frame = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f, i) for f, i in zip(prints, ids, strict=True)], "fp long, rep long")
    got = {r.node % 2**64: r.root % 2**64 for r in simhash.close_groups(frame).collect()}
    want = components({f: [i] for f, i in zip(prints, ids, strict=True)})
    groups = {}
    for f in prints:
        groups.setdefault(got.get(f, f), set()).add(want[f])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values())) > 30


def test_more_blocks_for_larger_tables():
    assert [simhash.block_count(n) for n in (0, 10**6, 10**9, 10**12)] == [6, 6, 7, 8]
    for blocks in (6, 7, 8):
        masks = simhash._masks(blocks)
        assert len(set(masks)) == len(masks) and all(m < 1 << 64 for m in masks)


def test_one_stays(awkward, empty):
    kept = simhash.simhash_dedup(awkward)
    assert kept.columns == awkward.columns
    groups = simhash.simhash_groups(awkward).select("root", "component").distinct().collect()
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.component) if r.component != -(2**63) else "None" for r in groups)
    assert simhash.simhash_report(empty).count() == 0 and simhash.simhash_dedup(empty).count() == 0
