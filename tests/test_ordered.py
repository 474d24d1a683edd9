import random

import pytest
from pyspark.sql import functions as F

from rivertally.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; another third are copies of one row."""
    rng = random.Random(1)
    data = [("hot", rng.randrange(50), rng.choice([None, 1, 2, 3])) for _ in range(300)]
    data += [("copy", 7, 7)] * 300
    data += [(rng.choice("abcdef"), rng.randrange(5), rng.choice([None, 1, 2])) for _ in range(290)]
    data += [(None, None, 1)] * 10
    return spark.createDataFrame(data, "g string, t long, v long").repartition(7)


def brute_numbers(rows, keyed):
    def rank(r):
        return tuple((x is None, x if x is not None else 0) for x in (r["t"], r["v"]))

    groups = {}
    for r in rows:
        groups.setdefault(r["g"] if keyed else 0, []).append(r)
    out = []
    for members in groups.values():
        for i, r in enumerate(sorted(members, key=lambda r: rank(r) + ((r["g"] is None, r["g"] or ""),) if not keyed else rank(r)), start=1):
            out.append((r["g"], r["t"], r["v"], i))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_rows", [10**6, 0, 50])
def test_number_within(spark, skewed, hot_rows):
    got = ordered.number_within(skewed, ["g"], ["t"], "n", hot_rows=hot_rows)
    assert sorted((tuple(r) for r in got.select("g", "t", "v", "n").collect()), key=str) == brute_numbers(skewed.collect(), True)


@pytest.mark.parametrize("hot_rows", [10**6, 0])
def test_number_rows_counts_on(spark, skewed, hot_rows):
    got = ordered.number_rows(skewed.select("t", "v", "g"), ["t"], "n", start=5, hot_rows=hot_rows).collect()
    assert sorted(r["n"] for r in got) == list(range(6, 906))
    want = [(g, t, v, n + 5) for g, t, v, n in brute_numbers(skewed.collect(), False)]
    assert sorted(((r["g"], r["t"], r["v"], r["n"]) for r in got), key=str) == sorted(want, key=str)


def test_number_rows_on_a_key(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("k"))
    got = ordered.number_rows(df, ["k"], "n", unique=True)
    assert got.where("n <> k + 1").count() == 0 and got.count() == 1000


def test_copies_in_blocks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 10)], "x string, _copies long")
    got = ordered.expand_copies(df, 25, index="i", block=10)
    assert sorted(map(tuple, got.collect())) == sorted([("a", i) for i in range(1, 26)] + [("b", 1)] + [("c", i) for i in range(1, 11)])


@pytest.mark.parametrize("hot_rows", [10**6, 0])
def test_fill_down(spark, rows, hot_rows):
    data = [("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 4, 6), ("b", 1, None), ("b", 2, None), ("a", None, None)]
    df = spark.createDataFrame(data, "g string, t long, v long")
    got = rows(ordered.fill_down(df, ["g"], ["t"], ["v"], hot_rows=hot_rows))
    assert got == [("a", None, 6), ("a", 1, None), ("a", 2, 5), ("a", 3, 5), ("a", 4, 6), ("b", 1, None), ("b", 2, None)]


def test_fill_down_forms_agree_on_skew(spark, skewed, rows):
    plain = ordered.fill_down(skewed, ["g"], ["t"], ["v"])
    spread = ordered.fill_down(skewed, ["g"], ["t"], ["v"], hot_rows=0)
    assert rows(plain) == rows(spread)


def test_first_per_key_puts_nulls_last(spark, rows):
    df = spark.createDataFrame([("a", None, "x"), ("a", 2, "y"), ("a", 2, "b"), ("b", None, "z"), (None, 1, "q")], "k string, t long, v string")
    assert rows(ordered.first_per_key(df, ["k"], ["t"])) == [(None, 1, "q"), ("a", 2, "b"), ("b", None, "z")]


def test_group_sequence(spark, rows):
    df = spark.createDataFrame([("a", 5), ("a", 2), ("b", 1), ("c", None)], "k string, t long")
    assert rows(ordered.group_sequence(df, "k", "t", "n")) == [("a", 2, 2), ("a", 5, 2), ("b", 1, 1), ("c", None, 3)]


def test_last_index_is_numeric(spark):
    ids = spark.createDataFrame([("s_2021_999",), ("s_2021_1000",), (None,)], "site_id string")
    assert ordered.last_index(ids, "site_id") == 1000
    assert ordered.last_index(ids.limit(0), "site_id") == 0


def test_running_total_with_spread_groups(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), "id", F.lit(2).cast("long").alias("w"))
    got = ordered.running_total(df, ["g"], ["id"], "w", "before")
    assert got.where(F.col("before") != F.floor(F.col("id") / 2) * 2).count() == 0


def test_bounds_of_groups(spark):
    df = spark.range(1000).selectExpr("IF(id < 400, 0, id) AS k")
    assert 400 <= ordered.group_bound(df, ["k"]) <= 1000
    assert ordered.group_bound(df, ["k"], enough=10) == 400
    assert ordered.group_bound(df.limit(0), ["k"]) == 0
