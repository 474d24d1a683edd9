import random

import pytest
from rivertally.operators import joins


def frames(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k long, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (None, "z"), (4, "w")], "k long, r string")
    return left, right


def test_missing_keys_match(spark, rows):
    left, right = frames(spark)
    assert rows(joins.null_safe_join(left, right, ["k"], "left")) == [(None, "b", "y"), (None, "b", "z"), (1, "a", "x"), (3, "c", None)]
    assert left.join(right, "k").count() == 1


def test_natural_joins(spark, rows):
    left, right = frames(spark)
    full = joins.natural_join(left, right, "full")
    assert full.columns == ["k", "l", "r"]
    assert rows(full) == [(None, "b", "y"), (None, "b", "z"), (1, "a", "x"), (3, "c", None), (4, None, "w")]
    assert rows(joins.null_safe_join(left, right, ["k"], "full")) == rows(full)
    assert rows(joins.natural_join(left, right, "right")) == [(None, "b", "y"), (None, "b", "z"), (1, "a", "x"), (4, None, "w")]
    assert rows(joins.natural_join(left, right, "left_semi")) == [(None, "b"), (1, "a")]


def test_known_keys_are_left_out(spark, rows):
    left, right = frames(spark)
    assert rows(joins.without_keys(left, right, "k")) == [(3, "c")]
    assert rows(joins.without_keys(left, right.where("k IS NOT NULL"), "k")) == [(None, "b"), (3, "c")]
    assert joins.without_keys(left, right.limit(0), "k").count() == 3


def test_lookup_drops_the_other_key(spark, rows):
    left, _ = frames(spark)
    dim = spark.createDataFrame([("a", "GR")], "cd_rch string, cd_rvr string")
    assert rows(joins.lookup(left, dim, {"l": "cd_rch"})) == [(None, "b", None), (1, "a", "GR"), (3, "c", None)]


def test_lifestage_bounds_are_inclusive(spark, rows):
    fish = spark.createDataFrame([("SM", n) for n in (99, 100, 199, 200, None)] + [("XX", 100)], "SpeciesCode string, TotalLength_mm long")
    species = spark.createDataFrame([("SM", "ls_1"), ("XX", None)], "SpeciesCode string, LifeStageCode string")
    stages = spark.createDataFrame([("ls_1", "JUV", 100, 199)], "LifeStageCode string, LifeStageAbbr string, MinTotalLength_mm long, MaxTotalLength_mm long")
    assert rows(joins.with_lifestage(fish, species, stages)) == [
        ("SM", None, None), ("SM", 100, "JUV"), ("SM", 199, "JUV"), ("SM", 200, None), ("SM", 99, None), ("XX", 100, None),
    ]


@pytest.mark.parametrize("n", [3, 1000])
def test_lifestage_pieces_equal_the_ranges(spark, rows, n):
    """Overlapping, touching, single-point and empty ranges; lengths on and between bounds."""
    rng = random.Random(n)
    ranges = [("c", f"s{i}", a := rng.randrange(400), a + rng.randrange(-3, 40)) for i in range(n)]
    lengths = [rng.randrange(-5, 460) + rng.choice([0.0, 0.5]) for _ in range(300)] + [None]
    fish = spark.createDataFrame([("SM", x) for x in lengths], "SpeciesCode string, TotalLength_mm double")
    species = spark.createDataFrame([("SM", "c")], "SpeciesCode string, LifeStageCode string")
    stages = spark.createDataFrame(ranges, "LifeStageCode string, LifeStageAbbr string, MinTotalLength_mm long, MaxTotalLength_mm long")
    want = []
    for x in lengths:
        found = [s for _, s, a, b in ranges if x is not None and a <= x <= b]
        want += [("SM", x, s) for s in found or [None]]
    got = [tuple(r) for r in joins.with_lifestage(fish, species, stages).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("hot", [0, 500])
def test_full_join_deals_out_hot_keys(spark, rows, hot):
    """The same rows as a plain full join, copies and missing keys too, and no task with all rows of a key."""
    left = spark.createDataFrame([(None, 1), (1, 2), (2, 3), (2, 3)] + [(7, i // 2) for i in range(hot)], "k long, l long")
    right = spark.createDataFrame([(None, "a"), (2, "b"), (2, "c"), (7, "d"), (7, "e"), (9, "f"), (9, "f")], "k long, r string")
    want = joins.null_safe_join(left, right, ["k"], "full")
    got = joins.full_join(left, right, ["k"])
    assert got.columns == ["k", "l", "r"] and rows(got) == rows(want)
    assert bool(joins.heavy_keys(left, ["k"])) == (hot > 0) or hot == 0


def test_broadcast_only_when_counted_small(spark):
    small = spark.range(10)
    assert "broadcast" in joins.if_small(small, 10)._jdf.queryExecution().toString()
    assert "broadcast" not in joins.if_small(small, 9)._jdf.queryExecution().toString()


def test_union_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k long, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k long")
    assert rows(joins.union_all(a, b)) == [(1, "x", None), (2, None, "y")]


def test_full_join_with_bare_keys_moves_keys_only(spark, rows):
    sites = spark.createDataFrame([("a", 1), ("b", None), (None, 3)], "k string, n long")
    fish = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), (None, 3, "z"), ("c", 9, "w")], "k string, n long, v string")
    got = joins.full_join(sites, fish, ["k", "n"])
    assert "FullOuter" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got) == rows(joins.null_safe_join(sites, fish, ["k", "n"], "full"))
    twice = sites.unionByName(sites)  # a key that repeats multiplies what it meets
    assert rows(joins.full_join(twice, fish, ["k", "n"])) == rows(joins.null_safe_join(twice, fish, ["k", "n"], "full"))
