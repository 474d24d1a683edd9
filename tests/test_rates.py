import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rivertally.functions.numbers import ratio, round_to, total
from rivertally.operators import rates

# Published season tables: hours, then catch and rate.
GOLDEN = {
    31.35: [(101, 3.22), (37, 1.18), (34, 1.08), (13, 0.41), (5, 0.16), (2, 0.06), (1, 0.03), (11, 0.35)],
    43.46: [(1164, 26.78), (110, 2.53), (65, 1.50), (39, 0.90), (38, 0.87), (17, 0.39), (10, 0.23), (3, 0.07), (1, 0.02), (22, 0.51), (14, 0.32), (4, 0.09), (2, 0.05)],
}


def test_published_rates(spark):
    cases = [(hours, n, rate) for hours, found in GOLDEN.items() for n, rate in found]
    df = spark.createDataFrame(cases, "h double, n long, want double")
    assert df.where(round_to(ratio("n", "h"), 2) != F.col("want")).count() == 0


def test_rounding_and_sums(spark):
    df = spark.createDataFrame([(1.005, 1), (None, None)], "x double, n long")
    assert df.select(round_to("x", 2)).first()[0] == 1.01
    got = df.agg(total("n"), total("n", na_rm=False)).first()
    assert tuple(got) == (1, None)
    assert df.where("n IS NULL").agg(total("n")).first()[0] == 0
    assert df.select(ratio("n", F.lit(0))).first()[0] is None


def sites_frame(spark):
    when = dt.datetime(2021, 5, 1)
    data = [
        (1, "123a", "GR", 250.0, when, 3600),
        (2, "123a", "GR", 251.0, when, 0),
        (3, "123d", "GR", 140.0, when + dt.timedelta(days=1), 7200),
        (4, "138", "CO", None, when, None),
    ]
    schema = "SiteID long, StudyCode string, RiverCode string, StartLocation_BelknapMiles double, StartDateTime_UTC timestamp, Effort_Seconds long"
    return spark.createDataFrame(data, schema)


def test_study_summary_keeps_one_sided_groups(spark):
    catch = spark.createDataFrame([(1, "SM", 5), (2, "SM", 2), (1, None, 9)], "SiteID long, SpeciesCode string, FishCount long")
    got = {r["StudyCode"]: r for r in rates.study_summary(sites_frame(spark), catch).collect()}
    assert (got["123a-DESO"]["FishCount"], got["123a-DESO"]["FishPerHour"]) == (5, 5.0)
    assert (got["123a-ECHO"]["Effort_Hours"], got["123a-ECHO"]["FishPerHour"]) == (0.0, None)
    assert got["123d-GRAY"]["FishCount"] is None and got["123d-GRAY"]["NumberDaysSampled"] == 1
    assert got["138"]["Effort_Hours"] is None and got["138"]["NumberSamples"] == 1


def brute_group(sites, fish):
    """Site-by-species grid written out in full."""
    species = sorted({f[1] for f in fish if f[1] and any(s[0] == f[0] for s in sites)})
    out = {}
    parents = sorted(set(sites), key=str)
    for key, river, sec in parents:
        times = sites.count((key, river, sec))
        for sp in species:
            n = times * sum(1 for f in fish if f == (key, sp))
            catch, effort = out.get((river, sp), (0, 0))
            out[(river, sp)] = (catch + n, effort + sec)
    return out


def test_group_rates_equal_the_full_grid(spark):
    rng = random.Random(5)
    sites = [(i, rng.choice(["GR", "CO", None]), rng.randrange(1000, 5000)) for i in range(40)]
    sites += sites[:3]
    fish = [(rng.randrange(45), rng.choice(["SM", "WE", "CS", None])) for _ in range(200)] + [(1, "SM")] * 100
    site_df = spark.createDataFrame(sites, "key_a long, river string, el_sec long")
    fish_df = spark.createDataFrame(fish, "key_a long, species string")
    got = rates.cpue_by_group(site_df, fish_df, "key_a", {"river": F.col("river")})
    want = brute_group(sites, fish)
    assert got.count() == len(want)
    for r in got.collect():
        catch, effort = want[(r["river"], r["species"])]
        assert (r["fish_ct"], r["effort_hr"]) == (catch, pytest.approx(effort / 3600, abs=0.0501))


def test_native_area_rates_with_repeated_entries(spark, rows):
    hauls = spark.createDataFrame([("s", 1, "R", 10), ("s", 2, "R", 20), ("t", 3, None, 5)], "site_id string, haul_id long, reach string, haul_area long")
    counts = spark.createDataFrame([(1, "CS", 2), (1, "CS", 3), (3, "RZ", None), (2, "SM", 9)], "haul_id long, species string, fish_count long")
    got = rows(rates.area_cpue_native(hauls, counts))
    assert got == [
        ("s", "R", "CS", 5, 40, 1.25), ("s", "R", "RZ", 0, 30, 0.0), ("t", None, "CS", 0, 5, 0.0), ("t", None, "RZ", 0, 5, 0.0),
    ]


def test_nonnative_area_rates_keep_missing_species(spark, rows):
    hauls = spark.createDataFrame(
        [("s", 1, "R", 10, 1, 1), ("t", 2, "R", 20, 1, 1), ("u", 3, "R", 5, 2, 1), ("v", 4, "R", 4, 1, 1)],
        "site_id string, haul_id long, reach string, haul_area long, prim_sec long, haul_num long",
    )
    counts = spark.createDataFrame([(1, "SM", 2), (1, "SM", 3), (2, "CS", 1), (3, "NP", 7)], "haul_id long, species string, fish_count long")
    got = rows(rates.area_cpue_nonnative(hauls, counts), "site_id", "species", "fish_count", "fp10ms")
    assert got == [
        ("s", None, 0, 0.0), ("s", "SM", 2, 2.0), ("s", "SM", 3, 3.0), ("t", None, 0, 0.0), ("t", "SM", 0, 0.0), ("v", None, 0, 0.0), ("v", "SM", 0, 0.0),
    ]


def test_lifestage_rates_divide_or_multiply(spark, rows):
    sites = spark.createDataFrame([("s", "GR", 1800), ("t", "GR", 3600)], "id_site string, cd_rvr string, amt_effort_sec long")
    fish = spark.createDataFrame(
        [("s", "SM", "bass", 10, 2, "JUV"), ("s", "SM", "bass", 10, 1, "ADULT"), ("t", "SM", "bass", 10, 4, "JUV"), ("t", "CS", "x", 10, 4, "JUV"), ("t", "SM", "bass", None, 4, "JUV")],
        "id_site string, cd_spp string, cn_spp string, tot_length long, n_fish long, ls string",
    )
    got = rates.cpue_by_lifestage(sites, fish, ["cd_rvr"])
    assert rows(got, "id_site", "ls", "n_fish", "cpue") == [("s", "ADULT", 1, 2.0), ("s", "JUV", 2, 4.0), ("t", "ADULT", 0, 0.0), ("t", "JUV", 4, 4.0)]
    ties = sites.limit(0).unionByName(spark.createDataFrame([("x", "GR", 1536), ("y", "GR", 3072)], sites.schema))
    caught = spark.createDataFrame([("x", "SM", "bass", 10, 49, "JUV"), ("y", "SM", "bass", 10, 54, "JUV")], fish.schema)
    tied = rates.cpue_by_lifestage(ties, caught, ["cd_rvr"]).withColumn("cpue", F.round("cpue", 4))
    assert rows(tied, "id_site", "cpue") == [("x", 114.8438), ("y", 63.2813)]
    product = rates.cpue_by_lifestage(sites, fish, ["cd_rvr"], multiply=True)
    assert rows(product, "id_site", "ls", "cpue")[1] == ("s", "JUV", 1.0)


def test_reach_rates_drop_missing_and_zero_catch(spark, rows):
    sites = spark.createDataFrame([("a", "LGR", "Tusher", 3600), ("b", "LGR", "Tusher", 1800)], "id_site string, cd_rch string, nm_rch string, amt_effort_sec long")
    counts = spark.createDataFrame(
        [("a", "walleye", "WE", 3), ("b", "walleye", "WE", 0), ("a", "pike", "NP", 0), ("b", "carp", "GC", None), ("a", "carp", "GC", 2)],
        "id_site string, cn_spp string, cd_spp string, n_fish long",
    )
    assert rows(rates.cpue_by_reach(sites, counts)) == [("LGR", "Tusher", "walleye", "WE", 3, 1.5, 2.0)]


def test_effort_rounds_before_it_adds(spark):
    when = dt.datetime(2021, 5, 1)
    sites = spark.createDataFrame([("GR", when, 3744), ("CO", when, 3744), ("CO", when + dt.timedelta(days=2), 0)], "river string, startdatetime timestamp, el_sec long")
    by_river = rates.effort_by_river(sites)
    assert {r["river"]: (r["total_effort_hr"], r["sampling_days"]) for r in by_river.collect()} == {"GR": (1.0, 1), "CO": (1.0, 2)}
    assert tuple(rates.effort_overall(by_river).first())[2:] == (2.0, 3)


def test_target_catch_and_trend(spark, rows):
    sites = spark.createDataFrame([("s", 2020, 3600), ("t", 2020, 3600), ("u", 2021, 1800)], "SiteID string, Year long, Effort_Seconds long")
    catch = spark.createDataFrame([("s", "WE", 3), ("u", "SM", 1)], "SiteID string, SpeciesCode string, FishCount long")
    assert rows(rates.trend_by_year(sites, catch, "WE")) == [(2020, 3, 2.0, 1.5), (2021, 0, 0.5, 0.0)]
    got = rates.target_catch(sites, catch, "WE", "SiteID", "SpeciesCode", "FishCount")
    assert rows(got, "SiteID", "WE") == [("s", 3), ("t", 0), ("u", 0)]


def test_rounding_looks_at_the_value_once(spark):
    values = spark.createDataFrame([(1.0049996, 1.0), (2.3449995, 2.34), (1.005, 1.01), (-1.005, -1.01), (None, None)], "x double, want double")
    assert all(r.got == r.want for r in values.withColumn("got", round_to("x", 2)).collect())
