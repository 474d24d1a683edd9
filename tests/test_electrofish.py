import datetime as dt

import pytest
from pyspark.sql import functions as F

from rivertally.operators import reshape
from rivertally.plans import electrofish, views
from rivertally.sources import store
from rivertally.sources import tables as io

SITE = "KEY_A string, PROJECT string, YEAR long, RIVER string, REACH string, DATE string, STARTTIME string, ENDTIME string, START_RMI double, END_RMI double, SHORELINE string, EFFORT_MIN long, EFFORT_SEC long, BOAT string, CREW string, SITE_NOTES string"


@pytest.fixture(scope="module")
def reaches(spark):
    return spark.createDataFrame([("LGR", "GR"), ("DESO", "GR"), ("LCO", "CO")], "cd_rch string, cd_rvr string")


@pytest.fixture(scope="module")
def raw(spark):
    site = spark.createDataFrame(
        [
            ("a2", "x", 2021, "GR", "LGR", "05/18/2021", "13:15:00", "14:25:00", 117.7, 115.6, "R", 63, 0, "Sparky", "SB", "Z"),
            ("a1", "x", 2021, "GR", "DESO", "5/18/2021", "10:15:20", "11:30:00", 20.0, 17.7, "R", 65, 5, "Sparky", "SB", "note"),
        ],
        SITE,
    )
    late = spark.createDataFrame([("a3", "x", 2021, "CO", "LCO", "06/01/2021", "09:00:00", None, 72.0, 70.0, "Z", 20, 0, "Sparky", "SB", None)], SITE)
    fish_schema = "key_a string, key_aa string, time string, rmi double, species string, tot_length long, st_length long, weight long, sex string, rep_cond string, tubercles string, ray_ct string, disp string, fish_notes string, ilon double, ilat double"
    fish = spark.createDataFrame(
        [
            ("a1", "f1", "10:30:00", 19.0, "CS", 500, 0, 900, "M", "exp", "Y", "9/10", "RA", "Z", -109.6, 38.5),
            ("a1", "f2", "10:20:00", 19.0, "SM", 0, 0, 100, "Z", "int", "Y", "N", "DE", "Z", -109.8, 38.7),
            ("a2", "f3", None, 116.0, "WE", 450, 400, 0, "F", "Z", "Z", "Z", None, "Z", 0.0, 0.0),
            ("zz", "f4", "10:00:00", 1.0, "SM", 100, 0, 10, "F", "Z", "Z", "Z", "DE", "Z", 0.0, 0.0),
        ],
        fish_schema,
    )
    pit = spark.createDataFrame(
        [("a1", "f1", "p1", "134", "3d9.abc1234567", "Y", "Z"), ("a1", "f1", "p2", "400", None, "Y", "Z"), ("a1", "f1", "p3", "400", "abcabcabc", "NNF", "Z")],
        "key_a string, key_aa string, key_aaa string, pit_type string, pit_num string, pit_recap string, pit_notes string",
    )
    floy = spark.createDataFrame([("a2", "f3", "y1", "id", "R", "77", "N", "Z")], "key_a string, key_aa string, key_aab string, floy_id string, floy_color string, floy_num string, floy_recap string, floy_notes string")
    vial = spark.createDataFrame([("a2", "f3", "v1", "0518", "fin", "Z")], "key_a string, key_aa string, key_aac string, vial_num string, vial_type string, vial_notes string")
    water = spark.createDataFrame([("a1", "w1", 0, 700, 15.5, 0, "Z")], "key_a string, key_ab string, cond_amb long, cond_spec long, rvr_temp double, secchi long, h2o_notes string")
    return {"site": site, "site2": late, "fish": fish, "pittag": pit, "floytag": floy, "vial": vial, "water": water}


@pytest.fixture(scope="module")
def staged(spark, raw, reaches, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("staging"))
    names = io.stage(electrofish.stage_electrofish(raw, reaches, "123d", "SM"), root)
    return io.read_staged(spark, root, names)


def test_sites_are_numbered_by_end_and_placed(staged, rows):
    got = rows(staged["site"], "key_a", "site_id", "river", "start_rmi", "el_sec", "shoreline", "NA_flg")
    assert got == [
        ("a1", "123d_2021_001", "GR", 140.0, 3905, "R", "FLAG"),
        ("a2", "123d_2021_002", "GR", 117.7, 3780, "R", "FLAG"),
        ("a3", "123d_2021_003", "CO", 72.0, 1200, None, "FLAG"),
    ]


def test_fish_are_placed_numbered_and_flagged(staged, rows):
    got = {r["key_aa"]: r for r in staged["fish"].collect()}
    assert {k: r["f_index"] for k, r in got.items() if k} == {"f2": 1, "f1": 2, "f3": 3, "f4": 4}
    assert got["f1"]["datetime"] == dt.datetime(2021, 5, 18, 10, 30) and got["f1"]["rmi"] == 139.0
    assert got["f1"]["loc_x"] == got["f2"]["loc_x"] and got["f3"]["loc_x"] is None
    assert (got["f2"]["tot_length"], got["f2"]["tubercles"], got["f2"]["rep_cond"], got["f2"]["ray_ct"]) == (None, None, "INT", None)
    assert (got["f4"]["orphan_flg"], got["f3"]["disp_flg"], got["f1"]["disp_flg"]) == ("FLAG", "FLAG", "")
    assert got[None]["site_id"] == "123d_2021_003"


def test_tags_stats_and_water(staged, rows):
    assert rows(staged["pittag"], "key_aaa", "pit_num", "nnf_flg", "invalid_pitnum_flg") == [("p1", "3D9.ABC1234567", "", None), ("p3", "ABCABCABC", "FLAG", None)]
    assert rows(staged["stats"], "reach", "n_site", "catch") == [("DESO", 1, 1), ("LCO", 1, 0), ("LGR", 1, 0)]
    assert rows(staged["water_qual"], "site_id", "cond_amb", "cond_spec", "secchi") == [("123d_2021_001", None, 700, None)]


def test_second_batch_goes_on_numbering(spark, raw, reaches, staged, rows):
    more = raw["site"].withColumn("KEY_A", F.concat(F.lit("n"), "KEY_A"))
    out = electrofish.stage_electrofish({"site": raw["site"].unionByName(more)}, reaches, "123d", "SM", staged["site"])
    assert rows(out["site"], "key_a", "site_id") == [("na1", "123d_2021_004"), ("na2", "123d_2021_005")]


def test_facts_nest_and_load_once(spark, staged, tmp_path, rows):
    path = str(tmp_path / "f_electrofish")
    proofed = staged | {"fish": staged["fish"].where("key_aa <> 'f4' OR key_aa IS NULL")}
    electrofish.load_electrofish(proofed, path)
    with pytest.raises(store.DuplicateKeys):
        electrofish.load_electrofish(proofed, path)
    electrofish.load_electrofish(proofed, path, skip_repeats=True)
    facts = spark.read.parquet(path)
    got = {r["SiteID"]: r for r in facts.collect()}
    first = got["123d_2021_001"]
    assert [f["SpeciesCode"] for f in first["FishData"]] == ["SM", "CS"]
    cs = first["FishData"][1]
    assert (cs["IsRipe"], cs["IsTuberculate"], cs["DorsalRayCount"], cs["AnalRayCount"], cs["FishCount"]) == (True, True, 9, 10, 1)
    assert [(t["PitTagString"], t["IsPitTagRecapture"]) for t in cs["PitTag"]] == [("3D9.ABC1234567", True), ("ABCABCABC", None)]
    assert got["123d_2021_002"]["FishData"][0]["Vial"][0]["VialString"] == "0518"
    assert got["123d_2021_002"]["FishData"][0]["FloyTag"][0]["FloyTagColorCode"] == "R"
    assert got["123d_2021_003"]["FishData"] == [] and got["123d_2021_003"]["WaterQuality"] == []
    assert views.site_view(facts).count() == 3 and views.fish_view(facts).count() == 3
    counts = views.fish_count_view(views.site_view(facts), views.catch_by_site(facts))
    assert counts.count() == 9 and counts.agg(F.sum("FishCount")).first()[0] == 3
    summary = views.summary_from_facts(facts)
    assert rows(summary, "StudyCode", "SpeciesCode", "FishCount") == [("123d", None, None), ("123d", "WE", 1), ("123d-GRAY", "CS", 1), ("123d-GRAY", "SM", 1)]


def test_facts_of_any_cut_hold_the_same(spark, staged, rows):
    """Parts of two rows: the same sites, fish and tags, and the same whole rows once the parts are put together."""
    proofed = staged | {"fish": staged["fish"].where("key_aa <> 'f4' OR key_aa IS NULL")}
    more = spark.createDataFrame([("f1", f"T{i}", "134", "N", f"n{i}") for i in range(7)], "key_aa string, pit_num string, pit_type string, pit_recap string, pit_notes string")
    proofed["pittag"] = proofed["pittag"].unionByName(more, allowMissingColumns=True)
    whole, cut = electrofish.electrofish_facts(proofed), electrofish.electrofish_facts(proofed, max_weight=2)
    assert whole.where("Parts > 1").count() == 0 and cut.count() > whole.count()
    assert cut.agg(F.max(F.size("FishData"))).first()[0] <= 2
    for view in (views.site_view, views.catch_by_site, views.fish_view, views.tag_view):
        assert rows(view(cut)) == rows(view(whole))
    tags = {r["SpeciesCode"]: [t["PitTagString"] for t in r["PitTag"]] for r in views.fish_view(cut).collect()}
    assert len(tags["CS"]) == 9 and tags["CS"] == sorted(tags["CS"])
    arrays = ["WaterQuality", "FishData"]
    together = reshape.merge_parts(cut, ["SiteID"], arrays)
    assert together.count() == 3
    assert rows(together.drop(*arrays)) == rows(whole.drop(*arrays, "Part", "Parts"))


def test_sites_that_lack_a_required_value_are_told(spark, staged, rows, tmp_path):
    path, rejects = str(tmp_path / "facts"), str(tmp_path / "not")
    proofed = staged | {"site": staged["site"].withColumn("river", F.when(F.col("key_a") != "a1", F.col("river")))}
    proofed["fish"] = staged["fish"].where("key_aa <> 'f4' OR key_aa IS NULL")
    out = electrofish.load_electrofish(proofed, path, rejects)
    assert rows(out, "SiteID", "FailedConstraints") == [("123d_2021_001", ["RiverCode is required"])]
    assert rows(io.scan(spark, path), "SiteID") == [("123d_2021_002",), ("123d_2021_003",)]
    assert out.select(F.size("FishData")).first()[0] == 2 and rows(spark.read.parquet(rejects), "SiteID") == [("123d_2021_001",)]


def test_flat_load_once(spark, staged, tmp_path):
    root = str(tmp_path / "flat")
    assert electrofish.load_flat(staged, root) == (1, True)
    again = {name: df.repartition(3).orderBy(F.rand(1)) for name, df in staged.items()}
    assert electrofish.load_flat(again, root) == (1, False)
    later = staged | {"site": staged["site"].limit(1)}
    assert electrofish.load_flat(later, root) == (2, True)
    sites = store.read_uploaded(spark, root, "site")
    assert sites.groupBy("upload_id").count().orderBy("upload_id").collect() == [(1, 3), (2, 1)]


def test_flat_load(spark, staged):
    out = electrofish.finalise_for_load(staged | {"meta": spark.createDataFrame([(1,), (1,)], "x long")}, None)
    assert out["meta"].count() == 1
    assert out["site"].first()["upload_id"] == 1 and "project_code" in out["site"].columns
    assert not [n for df in out.values() for n in df.columns if n.endswith(("_flg", "_index")) or n.startswith("key_")]
    assert "reach" not in out["fish"].columns and out["fish"].count() == 4
    assert "species" not in out["pittag"].columns and dict(out["site"].dtypes)["startdatetime"] == "string"


def test_vials(spark, staged, rows):
    vials = spark.createDataFrame([("a1", "f1", "v9", "fin", None), ("a2", "f3", "0518", "fin", None)], "key_a string, key_aa string, vial_num string, vial_type string, vial_notes string")
    fixes = spark.createDataFrame([(3, "vial_num", "05182113")], "f_index long, column string, value string")
    fish = staged["fish"].where("key_aa IS NOT NULL")
    out = electrofish.vial_extract(staged["site"], fish, vials, staged["pittag"].where("key_aaa = 'p1'"), fixes)
    assert rows(out["fish"], "site_id", "species", "vial_num") == [("123d_2021_001", "CS", "v9"), ("123d_2021_002", "WE", "05182113")]
    assert rows(out["site"], "site_id") == [("123d_2021_001",), ("123d_2021_002",)]


def test_fish_without_a_site_share_positions_among_themselves(spark):
    """Means are taken within a site's mile, and over all fish without a site at one mile, whatever their key."""
    samples = spark.createDataFrame([("a", "S1", 1, "LGR", dt.datetime(2021, 5, 1, 10))], "key_a string, site_id string, s_index long, reach string, t_stamp timestamp")
    fish = spark.createDataFrame(
        [("a", "f1", "10:00:00", 1.0, -109.0, 38.0), ("a", "f2", "10:00:00", 1.0, -110.0, 39.0), ("x", "f3", "10:00:00", 1.0, -111.0, 38.0), ("y", "f4", "10:00:00", 1.0, -112.0, 38.0), (None, "f5", "10:00:00", 2.0, None, 38.0)],
        "key_a string, key_aa string, time string, rmi double, ilon double, ilat double",
    )
    got = {r.key_aa: (r.loc_x, r.loc_y, r.epsg) for r in electrofish.place_fish(fish, samples).collect()}
    assert got["f1"] == got["f2"] and got["f3"] == got["f4"] and got["f1"] != got["f3"] and got["f5"] == (None, None, None)
