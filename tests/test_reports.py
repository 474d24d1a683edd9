import datetime as dt

import pytest
from pyspark.sql import functions as F

from rivertally import schemas
from rivertally.plans import dimensions, hydrology, reports, views


def day(month, number):
    return dt.date(2021, month, number)


@pytest.fixture(scope="module")
def extracts(spark):
    def at(month, number):
        return dt.datetime(2021, month, number, 18)

    site = spark.createDataFrame(
        [
            ("123d", "GR", "Green River", "s1", at(3, 23), 120.0, 118.0, 60 * 60 * 15),
            ("123d", "GR", "Green River", "s2", at(6, 2), 119.5, 110.0, 59040),
            ("123d", "CO", "Colorado River", "s3", at(4, 29), 110.0, 80.0, 156456),
        ],
        schemas.REPORT_TABLES["site"],
    )
    fish = spark.createDataFrame(
        [("s1", at(3, 23), "WE", "walleye", 1, n, 1, None, None, "DE", None, None) for n in (345, 430, 452, 613)]
        + [("s3", at(4, 29), "SM", "smallmouth bass", 1, n, 1, None, None, "DE", None, None) for n in (50, 167, 392, None)],
        schemas.REPORT_TABLES["fish"],
    )
    count = spark.createDataFrame(
        [("s1", "WE", "walleye", 60), ("s2", "WE", "walleye", 41), ("s3", "SM", "smallmouth bass", 1164), ("s3", "BT", "bonytail", 2),
         ("s1", "SM", "smallmouth bass", 0), ("s2", "SM", "smallmouth bass", 37), ("s3", "UI", "unidentified", 1)],
        schemas.REPORT_TABLES["count"],
    )
    water = spark.createDataFrame(
        [("1", day(3, 23), 1830.0, 9.8, "Green River, Utah", "GR"), ("1", day(6, 2), 8810.0, 21.3, "Green River, Utah", "GR"),
         ("1", day(5, 28), 9450.0, 15.0, "Green River, Utah", "GR"), ("1", day(10, 1), 100.0, 15.0, "Green River, Utah", "GR"),
         ("2", day(4, 29), 2150.0, 14.4, "Dewey", "CO")],
        schemas.REPORT_TABLES["water"],
    )
    return {"site": site, "fish": fish, "count": count, "water": water}


@pytest.fixture(scope="module")
def tables(spark, extracts):
    species = spark.createDataFrame([("WE", "ls_1"), ("SM", "ls_1")], "SpeciesCode string, LifeStageCode string")
    stages = spark.createDataFrame([("ls_1", "JUV", 0, 400), ("ls_1", "ADULT", 401, 2000)], "LifeStageCode string, LifeStageAbbr string, MinTotalLength_mm long, MaxTotalLength_mm long")
    return reports.annual_report_tables(extracts, species, stages, 2021)


def test_sampling_table(tables):
    got = [r.asDict() for r in tables["sampling"].collect()]
    assert [r["nm_rch"] for r in got] == ["Tusher", "Lower Colorado River"]
    tusher = got[0]
    assert (tusher["date_min"], tusher["date_max"], tusher["sampl_days"], tusher["effort_hr"]) == ("23 March 2021", "02 June 2021", 2, 31.4)
    assert (tusher["temp_rng"], tusher["dis_rng"], tusher["rmi_start_bel_max"]) == ("9.8 - 21.3", "1,830 - 8,810", "120.0")
    assert got[1]["effort_hr"] == 43.5


def test_water_table(tables):
    got = {r["cd_rvr"]: r.asDict() for r in tables["water"].collect()}
    assert (got["GR"]["discharge_max"], got["GR"]["dt_max_flow"], got["GR"]["discharge_n"]) == ("9,450", "28 May 2021", "4")
    assert got["CO"]["dt_min_flow"] == "29 April 2021"


def test_flow_points_stop_with_the_season(tables, rows):
    assert rows(tables["flow_points"], "cd_rvr", "date", "cd_rch") == [
        ("CO", day(4, 29), "LCO"), ("GR", day(3, 23), "LGR"), ("GR", day(5, 28), None), ("GR", day(6, 2), "LGR"),
    ]


def test_reach_rates_and_split(tables, rows):
    assert rows(tables["cpue_reach"], "cd_rch", "cd_spp", "fish_ct", "tot_effort", "cpue") == [
        ("LCO", "BT", 2, 43.46, 0.05), ("LCO", "SM", 1164, 43.46, 26.78), ("LCO", "UI", 1, 43.46, 0.02),
        ("LGR", "SM", 37, 31.4, 1.18), ("LGR", "WE", 101, 31.4, 3.22),
    ]
    assert [r["cd_spp"] for r in tables["cpue_reach_nonnative"].collect()] == ["SM", "WE", "SM"]
    assert rows(tables["cpue_reach_native"], "cn_spp") == [("bonytail",)]
    assert tables["total_hours"].first()[0] == 74.9
    assert ("SM", 1201) in rows(tables["species_totals"])


def test_lengths_and_stages(tables, rows):
    got = {r["cd_spp"]: r for r in tables["length_summary"].collect()}
    assert (got["WE"]["min"], got["WE"]["max"], got["WE"]["mean"], got["SM"]["n_missing"]) == (345, 613, 460.0, 1)
    assert tables["length_histogram"].agg(F.sum("n")).first()[0] == 7
    assert rows(tables["cpue_lifestage"], "id_site", "cd_spp", "ls", "n_fish") == [("s1", "WE", "ADULT", 3), ("s1", "WE", "JUV", 1), ("s3", "SM", "ADULT", 0), ("s3", "SM", "JUV", 3)]
    assert tables["lifestage_box"].count() == 3
    assert tables["cpue_date"].where("cd_spp = 'WE'").count() == 2


def test_local_date_option(spark, extracts):
    late = extracts["site"].withColumn("tm_end", F.lit("2021-05-02 03:00:00").cast("timestamp"))
    assert reports.report_sites(late, extracts["water"]).first()["date"] == day(5, 2)
    assert reports.report_sites(late, extracts["water"], "America/Denver").first()["date"] == day(5, 1)


def test_antenna_view(spark, rows):
    facts = spark.createDataFrame(
        [("123d", "GR", "gate", dt.datetime(2020, 12, 31, 23), 1.0, 2.0, 32612, [(dt.datetime(2021, 1, 2), "3D9.1"), (dt.datetime(2021, 1, 3), "3D9.2")]), ("123d", "GR", "empty", dt.datetime(2021, 1, 1), 1.0, 2.0, 32612, [])],
        "StudyCode string, RiverCode string, SiteName string, DeploymentTimeStamp_UTC timestamp, AntennaLocation_X double, AntennaLocation_Y double, AntennaLocationEPSGCode long, Detection array<struct<DetectionTimeStamp_UTC:timestamp,PitTagHex:string>>",
    )
    tags = spark.createDataFrame([("3D91", "CS")], "PitTagString string, SpeciesCode string")
    assert rows(views.antenna_analysis(facts, tags), "SiteName", "Year", "PitTagString", "SpeciesCode") == [("gate", 2020, "3D91", "CS"), ("gate", 2020, "3D92", None)]


def test_report_extract(spark, rows):
    sites = spark.createDataFrame([("s", "123d", "GR", dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 1), 1.0, 2.0, 60, 2021), ("t", "123d", "XX", None, None, 1.0, 2.0, 60, 2021), ("u", "123a", "GR", None, None, 1.0, 2.0, 60, 2021)],
        "SiteID string, StudyCode string, RiverCode string, StartDateTime_UTC timestamp, EndDateTime_UTC timestamp, StartLocation_BelknapMiles double, EndLocation_BelknapMiles double, Effort_Seconds long, Year long")
    fish = spark.createDataFrame([("s", "123d", 2021, "SM"), ("t", "123d", 2021, "??"), ("u", "123a", 2021, "SM")], "SiteID string, StudyCode string, Year long, SpeciesCode string")
    fish = fish.selectExpr("*", "cast(null as timestamp) EncounterDateTime_UTC", "1L FishCount", "2L TotalLength_mm", "3L Weight_g", "'M' Sex", "true IsRipe", "'DE' DispositionCode", "0D EncounterEasting_UTM", "0D EncounterNorthing_UTM")
    counts = fish.select("SiteID", "SpeciesCode", "FishCount")
    river = spark.createDataFrame([("GR", "Green River")], "RiverCode string, RiverName string")
    species = spark.createDataFrame([("SM", "smallmouth bass")], "SpeciesCode string, CommonName string")
    left = views.report_extract(sites, fish, counts, river, species, "123d", 2021)
    assert rows(left["site"], "id_site", "nm_rvr") == [("s", "Green River"), ("t", None)]
    assert rows(left["count"], "id_site", "cn_spp") == [("s", "smallmouth bass"), ("t", None)]
    inner = views.report_extract(sites, fish, counts, river, species, "123d", 2021, inner=True)
    assert rows(inner["fish"], "id_site") == [("s",)] and "tm_start" in inner["site"].columns


def test_station_facts(spark):
    series = spark.createDataFrame([("1", day(1, 2), 10.0, 4.5), ("1", day(1, 1), None, 4.0)], "staid string, date date, discharge double, temp double")
    stations = spark.createDataFrame([("1", "Jensen", "GR", 0.0, 0.0, 4326.0), ("2", "none", "GR", 0.0, 0.0, 4326.0)], "StationID string, StationName string, RiverCode string, StationLocation_X double, StationLocation_Y double, StationEPSG double")
    got = {r["StationID"]: r["WaterData"] for r in hydrology.station_facts(series, stations).collect()}
    assert [w["Discharge_CFS"] for w in got["1"]] == [None, 10] and got["2"] is None


def test_species_dimension(spark, rows):
    stages = spark.createDataFrame([("ls_1", "J", 0, 100, "Juvenile", None, "SM WE"), ("ls_1", "A", 101, 900, "Adult", None, "SM WE"), ("ls_2", "A", 0, 900, "Adult", None, "NP SM")],
        "id_lifestage string, cd_lifestage string, min_totlength long, max_totlength long, nm_lifestage string, dsc_lifestage string, cd_spp string")
    species = spark.createDataFrame([("SM", "x"), ("NP", "x"), ("CS", "x")], "SpeciesCode string, LifeStageCode string")
    coded, renamed = dimensions.rebuild_species(species, stages)
    assert rows(coded) == [("CS", None), ("NP", "ls_2"), ("SM", "ls_1")]
    assert renamed.columns == [f.name for f in schemas.D_LIFESTAGE]


def test_season_update(spark, rows):
    when = dt.datetime(2021, 5, 1)
    site = spark.createDataFrame([("a", "GR", when, 3600), ("b", "CO", when + dt.timedelta(days=7), 7200)], "key_a string, river string, startdatetime timestamp, el_sec long")
    fish = spark.createDataFrame([("a", "SM"), ("a", "SM"), ("a", "CS"), ("b", None)], "key_a string, species string")
    out = reports.season_update(site, fish)
    assert rows(out["cpue_river"]) == [("CO", "CS", 0, 2.0, 0.0), ("CO", "SM", 0, 2.0, 0.0), ("GR", "CS", 1, 1.0, 1.0), ("GR", "SM", 2, 1.0, 2.0)]
    assert out["cpue_week"].count() == 4 and out["cpue_week_target"].count() == 2
    assert [tuple(r) for r in out["counts"].collect()] == [("CO", None, 1), ("GR", "SM", 2), ("GR", "CS", 1)]
    assert out["effort_overall"].first()["sampling_days"] == 2
