import datetime as dt

import pytest

from rivertally.operators import quality

SITE = "s_index long, site_id string, key_a string, reach string, pass string, startdatetime timestamp, enddatetime timestamp, start_rmi double, end_rmi double, el_sec long, crew string"
T0 = dt.datetime(2021, 5, 1, 10)


def site(spark, *changes):
    base = {"s_index": 1, "site_id": "s", "key_a": "k", "reach": "LGR", "pass": "1", "startdatetime": T0, "enddatetime": T0 + dt.timedelta(hours=1), "start_rmi": 100.0, "end_rmi": 98.0, "el_sec": 3000, "crew": "X"}
    return spark.createDataFrame([tuple((base | change).values()) for change in changes or ({},)], SITE)


@pytest.mark.parametrize(
    ("change", "flags"),
    [
        ({}, {}),
        ({"end_rmi": 95.0}, {}),
        ({"end_rmi": 94.99}, {"rmi_length_flg": "FLAG"}),
        ({"end_rmi": 101.0}, {"rmi_length_flg": "FLAG"}),
        ({"start_rmi": 128.5, "end_rmi": 128.5}, {}),
        ({"start_rmi": 128.6, "end_rmi": 128.5}, {"rmi_flg": "FLAG"}),
        ({"reach": "DESO", "start_rmi": 128.5, "end_rmi": 128.5}, {}),
        ({"reach": "NEW"}, {"rmi_flg": "FLAG"}),
        ({"reach": None}, {"rmi_flg": "FLAG", "NA_flg": "FLAG"}),
        ({"end_rmi": None}, {"rmi_length_flg": None, "rmi_flg": "FLAG", "NA_flg": "FLAG"}),
        ({"el_sec": 3601}, {"datetime_flg": "FLAG"}),
        ({"el_sec": 3600}, {}),
        ({"el_sec": 999}, {"el_sec_flg": "FLAG"}),
        ({"el_sec": 7201}, {"el_sec_flg": "FLAG", "datetime_flg": "FLAG"}),
        ({"el_sec": None}, {"el_sec_flg": None, "datetime_flg": None, "NA_flg": "FLAG"}),
    ],
)
def test_site_flags(spark, change, flags):
    got = quality.qc_site(site(spark, change)).first().asDict()
    names = ["rmi_length_flg", "rmi_flg", "datetime_flg", "el_sec_flg", "NA_flg"]
    assert {n: got[n] for n in names} == {n: "" for n in names} | flags


FISH = "s_index long, site_id string, key_a string, reach string, rmi double, species string, tot_length long, weight long, disp string"


@pytest.mark.parametrize(
    ("change", "flags"),
    [
        ({}, {}),
        ({"species": "CC", "tot_length": 1001, "weight": 2801}, {"species_flg": "FLAG"}),
        ({"tot_length": 1001}, {"tot_length_flg": "FLAG"}),
        ({"tot_length": None}, {"tot_length_flg": None}),
        ({"weight": 2801}, {"weight_flg": "FLAG"}),
        ({"disp": None}, {"disp_flg": "FLAG"}),
        ({"disp": "RA"}, {"disp_flg": "FLAG"}),
        ({"species": "CS", "disp": "DE"}, {"disp_flg": "FLAG"}),
        ({"species": "CS", "disp": "RA"}, {}),
        ({"species": None, "disp": "RA"}, {"species_flg": "FLAG", "disp_flg": "FLAG"}),
        ({"rmi": None}, {"rmi_flg": "FLAG"}),
        ({"s_index": None, "site_id": "q"}, {"orphan_flg": "FLAG"}),
    ],
)
def test_fish_flags(spark, change, flags):
    base = {"s_index": 1, "site_id": "s", "key_a": "k", "reach": "LGR", "rmi": 99.0, "species": "SM", "tot_length": 200, "weight": 100, "disp": "DE"}
    fish = spark.createDataFrame([tuple((base | change).values())], FISH)
    got = quality.qc_fish(fish, site(spark)).where("reach IS NOT NULL").first().asDict()
    names = ["orphan_flg", "rmi_flg", "species_flg", "tot_length_flg", "weight_flg", "disp_flg"]
    assert {n: got[n] for n in names} == {n: "" for n in names} | flags


def test_sites_without_fish_stay(spark):
    fish = spark.createDataFrame([], FISH)
    assert quality.qc_fish(fish, site(spark)).select("site_id", "species").collect() == [("s", None)]


@pytest.mark.parametrize(
    ("kind", "number", "recap", "want"),
    [
        ("134", "x" * 14, "Y", ("", "", None)),
        ("134", "x" * 13, "NNF", ("FLAG", "", "FLAG")),
        ("400", "x" * 9, None, (None, "FLAG", None)),
        ("400", "x" * 10, "N", ("", "", "FLAG")),
        ("other", "x", "N", ("", "", None)),
        ("134", None, "N", ("", "FLAG", None)),
        ("134", None, None, (None, "", None)),
    ],
)
def test_pit_flags(spark, kind, number, recap, want):
    fish = spark.createDataFrame([(5, "f", "SM")], "f_index long, key_aa string, species string")
    pit = spark.createDataFrame([("f", "SM", kind, number, recap)], "key_aa string, species string, pit_type string, pit_num string, pit_recap string")
    got = quality.qc_pit(pit, fish).first()
    assert (got["nnf_flg"], got["pit_recap_flg"], got["invalid_pitnum_flg"]) == want
    assert got["orphan_flg"] == "" and got["f_index"] == 5


def test_floy_stats_and_flagged(spark):
    floy = spark.createDataFrame([(1, "r", "N"), (2, None, "N")], "fl_index long, floy_color string, floy_recap string")
    checked = quality.qc_floy(floy)
    assert [r["NA_flg"] for r in checked.orderBy("fl_index").collect()] == ["", "FLAG"]
    assert quality.only_flagged(checked).count() == 1
    sites = site(spark, {}, {"s_index": 2, "site_id": "t"}, {"s_index": 3, "site_id": "u", "reach": None, "el_sec": None})
    fish = spark.createDataFrame([("s", "SM"), ("s", "SM"), ("s", "WE")], "site_id string, species string")
    got = {r["reach"]: r for r in quality.qc_stats(sites, fish, "SM").collect()}
    assert (got["LGR"]["n_site"], got["LGR"]["effort_hr"], got["LGR"]["catch"], got["LGR"]["cpue"]) == (2, 1.67, 2, 1.2)
    assert (got[None]["effort_hr"], got[None]["catch"], got[None]["cpue"]) == (None, 0, None)
