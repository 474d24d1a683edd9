import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivertally.operators import stats


@pytest.mark.parametrize("accuracy", [10_000, 100, 25])
def test_quantiles_match_linear_interpolation(spark, accuracy):
    rng = random.Random(3)
    data = [("hot", float(rng.randrange(40))) for _ in range(400)] + [("copy", 1.5)] * 300
    data += [(g, rng.random()) for g in "abc" for _ in range(1, 30)] + [("one", 2.0), ("none", None), (None, 4.0), (None, 5.0)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in stats.quantiles(df, ["g"], "v", probs, accuracy=accuracy).collect()}
    want = {}
    for g, v in data:
        if v is not None:
            want.setdefault(g, []).append(v)
    assert set(got) == set(want)
    for g, values in want.items():
        assert got[g] == pytest.approx(list(np.quantile(values, probs)))


def test_quantiles_of_a_large_group(spark):
    """Equal to the built-in percentile, bit by bit, from a few kept values."""
    df = spark.range(2_000_000, numPartitions=8).select(F.when(F.col("id") % 1000 == 0, "small").otherwise("hot").alias("g"), (F.hash("id") % 999_983 / 7).alias("v"))
    probs = [0.01, 0.25, 0.5, 0.5003, 0.9]
    got = {r.g: r.q for r in stats.quantiles(df, ["g"], "v", probs).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    assert got == want
    assert stats.quantiles(df, [], "v", [0.5]).first().q == [df.agg(F.percentile("v", 0.5)).first()[0]]


def test_day_of_extreme_takes_the_first_of_ties(spark, rows):
    day = dt.date
    data = [("a", day(2021, 5, 3), 9), ("a", day(2021, 5, 1), 9), ("a", day(2021, 5, 2), 1), ("a", day(2021, 1, 1), None), ("b", day(2021, 1, 1), None)]
    df = spark.createDataFrame(data, "g string, d date, v long")
    got = df.groupBy("g").agg(stats.day_of_extreme("d", "v").alias("hi"), stats.day_of_extreme("d", "v", largest=False).alias("lo"))
    assert rows(got) == [("a", day(2021, 5, 1), day(2021, 5, 2)), ("b", None, None)]


def test_across_and_days(spark):
    df = spark.createDataFrame([(1, "2021-01-01"), (3, "2021-01-01"), (None, None)], "v long, d string").withColumn("d", F.to_date("d"))
    got = df.agg(*stats.across(["v"], ["max", "min", "n"]), stats.count_days(F.col("d")).alias("days"), stats.count_days(F.col("d"), True).alias("all_days")).first()
    assert got.asDict() == {"v_max": 3, "v_min": 1, "v_n": 3, "days": 1, "all_days": 2}


@pytest.mark.parametrize(("low", "high", "bins"), [(345, 613, 12), (50, 392, 15)])
def test_length_bins_of_25(spark, low, high, bins):
    df = spark.createDataFrame([("x", low), ("x", high), ("x", None)], "s string, v long")
    got = stats.histogram(df, ["s"], "v", 25, fill_gaps=True)
    assert got.count() == bins and got.agg(F.sum("n")).first()[0] == 2


def test_bins_are_closed_on_the_right(spark, rows):
    df = spark.createDataFrame([(12.5,), (12.6,), (37.5,), (-12.5,)], "v double")
    assert rows(stats.histogram(df, [], "v", 25)) == [(-25.0, 1), (0.0, 1), (25.0, 2)]
    assert stats.bin_width(df, "v", 30) == pytest.approx(50 / 29)


def test_length_summary(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", 10), ("a", None), ("b", None)], "s string, v long")
    got = {r["s"]: tuple(r)[1:] for r in stats.length_summary(df, ["s"], "v").collect()}
    assert got["a"] == (1, 1.75, 2.5, 4.0, 4.75, 10, 1)
    assert got["b"] == (None, None, None, None, None, None, 1)


def test_box_stats_on_a_log_axis(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 1000.0, 0.0, None]
    df = spark.createDataFrame([("JUV", v) for v in values], "ls string, cpue double")
    got = stats.box_stats(df, ["ls"], "cpue").first()
    logs = np.log10([v for v in values if v])
    q1, q2, q3 = np.quantile(logs, [0.25, 0.5, 0.75])
    inside = logs[(logs >= q1 - 1.5 * (q3 - q1)) & (logs <= q3 + 1.5 * (q3 - q1))]
    want = [10**x for x in (inside.min(), q1, q2, q3, inside.max())]
    assert list(got)[1:6] == pytest.approx(want)
    assert got["outliers"] == len(logs) - len(inside) == 1
