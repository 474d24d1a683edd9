"""Season tables from batches against one run over all rows; distinct days at any level from one state."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rivertally.operators import days
from rivertally.plans import reports, season


@pytest.fixture(scope="module")
def batches(spark):
    rng = random.Random(5)
    sites, fish = [], []
    for i in range(80):
        stamp = dt.datetime(2021, 1, 1, 10) + dt.timedelta(days=rng.randrange(40), hours=rng.randrange(12))
        row = (f"a{i}", rng.choice(["GR", "CO", None]), None if i == 17 else stamp, None if i == 33 else rng.randrange(1, 7000))
        sites += [row] * (2 if i % 20 == 0 else 1)  # some rows twice
        fish += [(f"a{i}", rng.choice(["SM", "WE", "CS", None])) for _ in range(rng.randrange(6))]
    fish += [("a_unknown", "SM"), (None, "WE")]
    site = spark.createDataFrame(sites, "key_a string, river string, startdatetime timestamp, el_sec long")
    return site, spark.createDataFrame(fish, "key_a string, species string")


def test_uploads_add_up_to_one_run(spark, batches, rows, tmp_path):
    site, fish = batches
    path = str(tmp_path / "state")
    part = F.pmod(F.coalesce(F.regexp_substr("key_a", F.lit("[0-9]+")).cast("int"), F.lit(0)), F.lit(5))
    for upload in (3, 1, 0, 2, 4, 3):
        season.add_upload(season.season_state(site.where(part == upload), fish.where(part == upload)), path, upload)
    got, want = season.season_tables(season.current_state(spark, path)), reports.season_update(site, fish)
    assert got.keys() == want.keys()
    for name in want:
        assert sorted(got[name].columns) == sorted(want[name].columns)
        assert rows(got[name], *want[name].columns) == rows(want[name]), name
    assert got["counts"].collect() == want["counts"].collect()


def test_an_empty_upload_changes_nothing(spark, batches, rows, tmp_path):
    site, fish = batches
    path = str(tmp_path / "state")
    season.add_upload(season.season_state(site, fish), path, 1)
    before = rows(season.current_state(spark, path))
    season.add_upload(season.season_state(site.limit(0), fish.limit(0)), path, 2)
    assert rows(season.current_state(spark, path)) == before


def test_days_count_once_at_every_level(spark, rows):
    rng = random.Random(1)
    data = [(rng.choice("ab"), rng.choice([1, 2, None]), dt.date(1965, 1, 1) + dt.timedelta(days=rng.choice([0, 1, 5, 2000, 40_000, 32_768 * 2]))) for _ in range(60)] + [("c", 1, None)]
    df = spark.createDataFrame(data, "s string, r long, d date")
    states = [days.day_bitmaps(df.where(F.pmod(F.hash("d"), F.lit(2)) == i), ["s", "r"], "d") for i in range(2)]
    states.append(days.day_bitmaps(df, ["s", "r"], "d"))  # all days once more
    state = states[0].unionByName(states[1]).unionByName(states[2])
    for keys in (["s", "r"], ["s"], ["r"], []):
        want = df.where("d IS NOT NULL").groupBy(*keys).agg(F.count_distinct("d").alias("days"))
        assert rows(days.count_days_of(state, keys)) == rows(want)
