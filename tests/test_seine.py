import datetime as dt

import pytest
from pyspark.sql import functions as F

from rivertally.operators import reshape
from rivertally.plans import products, seine
from rivertally.sources import store


@pytest.fixture(scope="module")
def raw(spark):
    site = spark.createDataFrame(
        [
            ("a", "08/02/2021", "LGR", "1", 10.0, 20.0, 0, "BA", 30, 4, "Y", 38.5, -110.5, "SB", "mud\nsecchi on bottom"),
            ("b", "08/01/2021", "LCO", "1", 12.0, 0.0, 100, "SC", 20, 0, "N", 38.6, -110.6, "SB", "Z"),
            ("c", "08/01/2021", "LCO", "2", 13.0, 21.0, 100, "Z", 10, 3, "Z", 38.6, -110.6, "SB", "Z"),
        ],
        "key_a string, date string, reach string, pass string, rmi double, mc_temp double, hab_secchi long, hab_1 string, hab_length long, hab_width long, algae string, ilat double, ilon double, crew string, site_notes string",
    )
    haul = spark.createDataFrame(
        [
            ("a", "h1", "10:30:00", "BS", 5, 2.0, 300, "SI", "Y", "Z", "N", "Z"),
            ("a", "h2", "9:30:00", "BS", 6, 2.0, 300, "SI", "N", "Y", "N", "Z"),
            ("b", "h3", "12:00:00", "BS", 5, 2.0, 0, "SI", "N", "N", "N", "ok"),
        ],
        "key_a string, key_aa string, starttime string, gear string, haul_lengt long, haul_width double, avg_dep long, substrate string, rs string, ss string, fh string, haul_notes string",
    )
    fish = spark.createDataFrame([("a", "h1", "x1", "CS", 40, 0, "RA", "Z", "Z"), ("a", "h1", "x2", "CS", 35, 1, "RA", "Z", "Z")], "key_a string, key_aa string, key_aaa string, species string, tot_length long, weight long, disp string, photo_num string, fish_notes string")
    count = spark.createDataFrame([("a", "h1", "SM", "DE", 3), ("a", "h1", "SM", "DE", 4), ("a", "h2", "RS", None, None), ("b", "h3", None, None, 5)], "key_a string, key_aa string, species string, disp string, fish_count long")
    vial = spark.createDataFrame([("a", "h2", "v1", "77", "fin", "Z", "Z")], "key_a string, key_aa string, key_aac string, vial_num string, vial_type string, photo_num string, vial_notes string")
    depth = spark.createDataFrame([("a", "h1", "d1", "loc1", 100, "SI", "SA", "Z"), ("a", "h1", "d2", "mx", 400, "SA", "Z", "Z"), ("b", "h3", "d3", "loc2", 50, "GR", "Z", "Z")], "key_a string, key_aa string, key_aaa string, location string, depth long, sub_1 string, sub_2 string, dep_notes string")
    return {"site": site, "haul": haul, "fish": fish, "count": count, "vial": vial, "depth": depth}


@pytest.fixture(scope="module")
def reaches(spark):
    return spark.createDataFrame([("LGR", "GR"), ("LCO", "CO")], "cd_rch string, cd_rvr string")


@pytest.fixture(scope="module")
def staged(raw, reaches):
    return seine.stage_seine(raw, reaches, "160se")


def test_sites_follow_their_first_haul(staged, rows):
    assert rows(staged["site"], "key_a", "id_site", "cd_rvr", "mc_temp", "hab_width", "algae") == [
        ("a", "160se_2021_002", "GR", 20.0, 4, "Y"), ("b", "160se_2021_001", "CO", None, None, "N"),
    ]


def test_hauls_need_a_measured_area_and_depth(staged, rows):
    assert rows(staged["haul"], "key_aa", "id_haul", "h_idx", "cd_rch") == [("h1", "160se_2021_002.02", 3, "LGR"), ("h2", "160se_2021_002.01", 2, "LGR")]


def test_fish_and_counts_are_one_table(staged, rows):
    assert rows(staged["fish"], "id_haul", "cd_spp", "n_fish", "tot_length", "pass") == [
        ("160se_2021_002.01", "RS", None, None, "1"),
        ("160se_2021_002.02", "CS", 1, 35, "1"),
        ("160se_2021_002.02", "CS", 1, 40, "1"),
        ("160se_2021_002.02", "SM", 7, None, "1"),
    ]


def test_facts(spark, staged, tmp_path):
    path = str(tmp_path / "f_seine")
    seine.load_seine(staged, path)
    with pytest.raises(store.DuplicateKeys):
        seine.load_seine(staged, path)
    got = {r["SiteID"]: r for r in spark.read.parquet(path).collect()}
    first, other = got["160se_2021_002"], got["160se_2021_001"]
    assert [h["HaulID"] for h in first["HaulData"]] == ["160se_2021_002.01", "160se_2021_002.02"]
    second = first["HaulData"][1]
    assert (second["HasRedShiner"], second["HasSandShiner"], second["HaulDateTime_Local"]) == (True, None, dt.datetime(2021, 8, 2, 10, 30))
    assert sorted((f["SpeciesCode"], f["FishCount"]) for f in second["FishData"]) == [("CS", 1), ("CS", 1), ("SM", 7)]
    assert first["HaulData"][0]["HaulVial"][0]["VialString"] == "77"
    assert (first["WaterQuality"][0]["IsSecchiMaxDepth"], first["WaterQuality"][0]["WaterQualityNotes"]) == (True, "secchi on bottom")
    assert other["HaulData"] == [] and other["SiteEPSGCode"] == 4326 and first["SiteDate_Local"] == dt.date(2021, 8, 2)


def test_facts_of_any_cut_hold_the_same(staged, rows):
    whole, cut = seine.seine_facts(staged), seine.seine_facts(staged, max_weight=1)
    assert cut.count() > whole.count()

    def hauls(facts):
        each = facts.select("SiteID", F.explode("HaulData").alias("h")).select("SiteID", "h.*")
        return reshape.merge_parts(each, ["SiteID", "HaulID"], ["FishData", "HaulVial"])

    assert rows(hauls(cut)) == rows(hauls(whole)) and hauls(whole).count() == 2
    water = F.explode("WaterQuality").alias("w")
    assert rows(cut.select("SiteID", water)) == rows(whole.select("SiteID", water))


def test_depths_are_pivoted_onto_hauls(raw, reaches, rows):
    out = seine.stage_seine(raw, reaches, "138x", depths=True)
    assert rows(out["haul"], "key_aa", "loc1_depth", "loc2_sub_1", "mx_depth", "mx_sub_2") == [("h1", 100, None, 400, None), ("h2", None, None, None, None), ("h3", None, "GR", None, None)]
    facts = seine.seine_facts({k: v for k, v in out.items()})
    hauls = {h["HaulID"]: h for r in facts.collect() for h in r["HaulData"]}
    assert hauls["138x_2021_002.02"]["DepthAtLocation1_mm"] == 100 and hauls["138x_2021_002.02"]["MaximumDepth_mm"] == 400


def test_products(spark, rows, tmp_path):
    site = spark.createDataFrame([("s", 2021, "LGR", 10, 3), ("t", 2021, "LGR", 5, 5), ("o", 2020, "LGR", 1, 1)], "site_id string, year long, reach string, hab_length long, hab_width long")
    haul = spark.createDataFrame([("s", 1, 1, 5, 2, 1), ("s", 2, 2, 5, 1, 1), ("o", 3, 1, 9, 9, 1)], "site_id string, haul_id long, haul_num long, haul_length long, haul_width long, prim_sec long")
    counts = spark.createDataFrame([(1, "CS", 3), (2, "CS", 1), (1, "SM", 2), (3, "CS", 50)], "haul_id long, species string, fish_count long")
    fish = spark.createDataFrame([(1, "CS", 40)], "haul_id long, species string, tot_length long")
    water = spark.createDataFrame([("09261000", "00060", dt.date(2021, 1, 1), 10.0), ("09180500", "00010", dt.date(2021, 1, 1), 4.0), ("other", "00060", dt.date(2021, 1, 1), 1.0)], "staid string, parameter string, dates date, val double")
    out = products.seine_products({"site": site, "haul": haul, "in_count": counts, "fish": fish}, 2021, water)
    assert rows(out["site"], "site_id", "hab_area", "haul_area", "CS") == [("s", 30, 15, 4), ("t", 25, None, 0)]
    assert rows(out["cpue_nf"]) == [("s", "LGR", "CS", 4, 15, 2.67)]
    assert rows(out["cpue_nnf"], "site_id", "haul_area", "species", "fish_count") == [("s", 10, "SM", 2)]
    assert rows(out["fish"]) == [("s", "LGR", "CS", 40)]
    assert rows(out["waterdata"], "staid", "discharge", "temp", "rvr_code", "rch_code") == [("09180500", None, 4.0, "CO", "LCO"), ("09261000", 10.0, None, "GR", "MGR")]
    every = products.seine_products({"site": site, "haul": haul, "in_count": counts, "fish": fish}, 2021, all_years=True)
    assert rows(every["cpue_nf"], "site_id", "reach", "fish_count") == [("o", None, 50), ("s", "LGR", 4)]
    products.write_products({"fish": out["fish"]}, str(tmp_path), "138_2021")
    assert spark.read.csv(str(tmp_path / "138_2021_fish.csv"), header=True).first()["species"] == "CS"


def test_sides_that_grow_are_never_broadcast(raw, reaches):
    # The tables are tiny, so Spark would broadcast them, as it does large ones in small files.
    staged = seine.stage_seine(raw, reaches, "160se")
    for frame in (*staged.values(), seine.seine_facts(staged)):
        joins = [line for line in frame._jdf.queryExecution().toString().split("Physical Plan")[1].splitlines() if "BroadcastHashJoin" in line]
        assert not [line for line in joins if any(key in line for key in ("key_a", "id_site", "id_haul", "_key"))]
