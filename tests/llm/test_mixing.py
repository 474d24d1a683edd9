"""Windows, order and deviation of the schedule, and what is left over."""

from collections import Counter
from fractions import Fraction

import pytest
from conftest import awkward_rows

from rivertally.llm import mixing


@pytest.mark.parametrize("given", [{"a": 1}, {"a": 3, "b": 7}, {"a": 1, "b": 1, "c": 998}, {"a": 250, "b": 250, "c": 333, "d": 167}, {f"s{i}": 1 + i for i in range(30)}])
def test_less_than_one_block_off(given):
    period, done = sum(given.values()), Counter()
    placed = mixing.schedule(given)
    assert [p[4] for p in placed] == list(range(period)) and Counter(p[0] for p in placed) == given
    for lane, block, release, deadline, slot in placed:
        assert release == block * period // given[lane] and release <= slot < deadline
        assert block == done[lane]
        done[lane] += 1
        assert all(abs(done[k] - Fraction(given[k] * (slot + 1), period)) < 1 for k in given)


def test_weights():
    assert mixing.capped_shares({"a": 60, "b": 20, "c": 10, "d": 5, "e": 5}) == pytest.approx({"a": 0.25, "b": 0.25, "c": 0.25, "d": 0.125, "e": 0.125})
    assert mixing.capped_shares({"a": 9, "b": 1}) == pytest.approx({"a": 0.5, "b": 0.5})
    assert mixing.capped_shares({}) == {}
    assert mixing.shares({"a": 0.5, "b": 0.25, "c": 0.25}, 1000) == {"a": 500, "b": 250, "c": 250}
    assert sum(mixing.shares({f"s{i}": 1 / (i + 1) for i in range(77)}, 50).values()) == 77


def test_mix_of_sources(spark):
    rows = [(i, "x" * (100 + i % 7), "abcd"[min(3, i % 10)]) for i in range(4000)]  # d holds seven tenths
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, block_bytes=1000, period=100).toPandas()
    assert len(got) == 4000
    for _, own in got.sort_values("did").groupby("source"):  # identifiers in order, blocks by bytes before
        assert (own.place.diff().dropna() > 0).all() and (own.block == own.place // 1000).all()
    blocks = got[["lane", "block", "slot", "release", "deadline"]].drop_duplicates()
    assert blocks.slot.is_unique and ((blocks.slot >= blocks.release) & (blocks.slot < blocks.deadline)).all()
    inside = got[got.in_mix]
    share = inside.groupby("source").size() / len(inside)
    assert share["d"] == pytest.approx(0.25, abs=0.02) and all(share[s] == pytest.approx(0.25, abs=0.02) for s in "abc")
    assert got[~got.in_mix].source.value_counts().idxmax() == "d" and inside.slot.max() < got[~got.in_mix].slot.min()
    every = blocks[blocks.slot < inside.slot.max()]
    for t in range(1, int(inside.slot.max()), 37):
        n = every[every.slot < t].groupby("lane").size()
        assert all(abs(n.get(k, 0) - 0.25 * t) < 1.01 for k in ("=a", "=b", "=c", "=d"))


def test_small_sources_dont_end_the_mix(spark):
    rows = [(i, "x" * 100, "abc"[i % 3]) for i in range(3000)] + [(5000, "tiny", "t"), (5001, "", "e"), (5002, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, block_bytes=1000).toPandas()
    assert len(got) == 3003 and got.in_mix.all() and got.slot.notna().all()
    blocks = got[["lane", "block", "slot", "release", "deadline"]].drop_duplicates()
    assert blocks.slot.is_unique and blocks.slot.max() == len(blocks) - 1 and ((blocks.slot >= blocks.release) & (blocks.slot < blocks.deadline)).all()
    assert mixing.mixed(docs).count() == 3003
    alone = spark.createDataFrame([(i, "x" * 100, "a" if i else "t") for i in range(3000)], "doc_id long, text string, source string")
    assert mixing.mixed(alone).count() == 3000


def test_lanes_leave():
    weights, blocks = {"a": 5, "b": 3, "c": 1, "d": 1}, {"a": 40, "b": 50, "c": 1, "d": 30}
    placed = list(mixing.placements(weights, blocks))
    assert [p[4] for p in placed] == list(range(121)) and Counter(p[0] for p in placed) == blocks
    assert all(release <= slot < deadline for _, _, release, deadline, slot in placed)
    # The last to go beside d is b, after 50 / 3 units.
    assert mixing.blocks_in_mix(weights, {k: 10 * v for k, v in blocks.items()}, 10) == {"a": 40, "b": 50, "c": 1, "d": 17}
    # What is in the mix grows evenly with the smaller source, down to its last block.
    assert [mixing.blocks_in_mix({"a": 1, "b": 1}, {"a": 10**9, "b": b}, 10)["a"] for b in (1, 10, 999_990, 1_000_000, 1_000_010)] == [1, 1, 99_999, 100_000, 100_001]


@pytest.mark.parametrize(
    "weights",
    [
        {"a": Fraction(1, 2000), "b": Fraction(1999, 2000)},
        {"a": Fraction(1, 4), **{f"s{i}": Fraction(3, 1600) for i in range(400)}},
        {"a": Fraction(1, 4), **{f"s{i}": Fraction(3, 80) for i in range(20)}},
        {"a": Fraction(1, 3), "b": Fraction(2, 7), "c": Fraction(8, 21)},
    ],
)
def test_exact_weights_in_a_long_run(weights):
    slots, done = 5000, Counter()
    placed = mixing.placements(weights, {k: int(20 * slots * w) + 1 for k, w in weights.items()})
    for slot, (lane, block, release, deadline, at) in zip(range(slots), placed, strict=False):
        assert at == slot and block == done[lane]
        assert release == block / weights[lane] // 1 and deadline == -(-(block + 1) / weights[lane] // 1) and release <= slot < deadline
        done[lane] += 1
        if slot % 97 == 0 or slot > slots - 10:
            assert all(abs(done[k] - w * (slot + 1)) < 1 for k, w in weights.items())


def test_every_source_is_a_lane(spark):
    rows = [(i, "x" * 1000, "ab"[i % 2]) for i in range(4000)] + [(5000 + i, "y" * 10, f"small{i:02}") for i in range(30)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_bytes=1000).toPandas()
    assert got.in_mix.all() and set(got.lane) == {"=a", "=b", *(f"=small{i:02}" for i in range(30))}
    few = spark.createDataFrame([(i, "z" * 100, "ab"[i % 2]) for i in range(4000)], "doc_id long, text string, source string")
    got = mixing.mix(few, {"a": 1 / 2048, "b": 2047 / 2048}, block_bytes=100).toPandas()
    inside = got[got.in_mix]
    assert (inside.source == "b").sum() == 2000 and (inside.source == "a").sum() == 1


def test_every_row_stays_in_order(spark):
    rows = [(i, "x" * 100, "a" if i >= 30 else "b") for i in range(3000)] + [(7, "x" * 100, "b")]  # a repeated row
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [(r.doc_id, r.source) for r in mixing.mixed(docs).collect()]
    assert Counter(i for i, _ in out) == Counter(i for i, *_ in rows)
    slots = {r.did: (r.slot, r.place) for r in mixing.mix(docs).orderBy("slot", "place", ascending=False).collect()}  # the first place of each
    assert [i for i, _ in out] == sorted((i for i, *_ in rows), key=slots.get)
    few = mixing.mixed(docs, {"a": 1, "b": 1}).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in few}["b"] == 31 and {r["source"]: r["count"] for r in few}["a"] < 200


def test_given_weights(spark):
    docs = spark.createDataFrame([(i, "y" * 50, "ab c"[i % 4]) for i in range(400)], "doc_id long, text string, source string")
    kept = mixing.mixed(docs, {"a": 3.0, "b": 1.0, "unknown": 9.0}).groupBy("source").count().collect()
    assert {r["source"] for r in kept} <= {"a", "b"}


def test_awkward_rows(awkward, empty):
    got = mixing.mixing_report(awkward).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in awkward_rows())
    assert all((r.source is None) == (r.lane == "none") for r in got if r.lane != "rest")
    assert mixing.mixed(awkward).columns == awkward.columns
    assert mixing.mixing_report(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_native(awkward):
    plan = mixing.mixing_report(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
