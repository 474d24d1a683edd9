import datetime as dt

import pytest
from pyspark.sql import functions as F

from rivertally.functions import cleaning as c
from rivertally.functions import times


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first()["y"]


def test_lower_names_and_name_patterns(spark):
    df = c.lower_names(spark.createDataFrame([(1, 2, 3, 4)], "Key_A long, MC_temp long, HAB_1 long, x_flg long"))
    assert df.columns == ["key_a", "mc_temp", "hab_1", "x_flg"]
    assert c.columns_like(df, "mc_|hab_") == ["mc_temp", "hab_1"]
    assert c.columns_between(df, "mc_temp", "x_flg") == ["mc_temp", "hab_1", "x_flg"]
    assert c.drop_matching(df).columns == ["mc_temp", "hab_1"]


def test_sentinels(spark):
    df = spark.createDataFrame([("Z", 0), ("z", 1), ("", None), (None, 5)], "t string, n long")
    assert [r["t"] for r in c.null_text(df).collect()] == [None, "z", "", None]
    assert [r["n"] for r in c.null_zero(df).collect()] == [None, 1, None, 5]
    assert [r["n"] for r in c.null_zero(df, ["absent"]).collect()] == [0, 1, None, 5]


@pytest.mark.parametrize(
    ("date", "time", "want"),
    [
        ("05/18/2021", "10:15:20", dt.datetime(2021, 5, 18, 10, 15, 20)),
        ("5/8/2021", "9:15:20", dt.datetime(2021, 5, 8, 9, 15, 20)),
        ("5/8/2021", "9:15", dt.datetime(2021, 5, 8, 9, 15)),
        ("5/8/2021", None, None),
        ("soon", "9:15", None),
    ],
)
def test_wall_clock(spark, date, time, want):
    df = spark.createDataFrame([(date, time)], "d string, t string")
    got = df.select(times.wall_clock("d", "t").cast("string").alias("y")).first()["y"]
    assert got == (want and want.strftime("%Y-%m-%d %H:%M:%S"))


@pytest.mark.parametrize(
    ("day", "week"), [("2021-01-01", 1), ("2021-01-07", 1), ("2021-01-08", 2), ("2021-12-31", 53)]
)
def test_week_counts_from_new_year(spark, day, week):
    assert one(spark, day, "string", times.week_of_year(F.to_date("x"))) == week


def test_mile_correction(spark, rows):
    df = spark.createDataFrame([("DESO", 1.0, None), ("LGR", 1.0, 2.0), (None, 1.0, 2.0)], "reach string, start_rmi double, end_rmi double")
    assert rows(c.correct_miles(df)) == [(None, 1.0, 2.0), ("DESO", 121.0, None), ("LGR", 1.0, 2.0)]


def test_sample_and_haul_ids(spark):
    df = spark.createDataFrame([("s", 2021, n) for n in (7, 999, 1000, None)], "s string, y long, n long")
    got = [r[0] for r in df.select(c.sample_id("s", "y", "n")).collect()]
    assert got == ["s_2021_007", "s_2021_999", "s_2021_1000", None]
    assert one(spark, "s_2021_1000", "string", c.trailing_number("x")) == 1000
    assert one(spark, "none", "string", c.trailing_number("x")) is None
    assert df.limit(1).select(c.haul_id("s", "n")).first()[0] == "s.07"


@pytest.mark.parametrize(("text", "want"), [("EXPRESSING", True), ("INTER", False), ("NOT RIPE", False), ("X", None), (None, None)])
def test_ripeness(spark, text, want):
    assert one(spark, text, "string", c.is_ripe("x")) is want


def test_tuberculate_needs_a_native(spark, rows):
    df = spark.createDataFrame([("CS", "Y"), ("CS", "N"), ("SM", "Y"), (None, "Y")], "species string, tubercles string")
    got = rows(df.select("species", c.is_tuberculate().alias("t"), c.native_only("tubercles").alias("kept")))
    assert got == [(None, None, None), ("CS", False, "N"), ("CS", True, "Y"), ("SM", None, None)]


@pytest.mark.parametrize(
    ("text", "want"), [("9/10", (9, 10)), ("9", (9, None)), ("9/10/11", (9, 10)), (None, (None, None)), ("x/y", (None, None))]
)
def test_ray_counts(spark, text, want):
    df = spark.createDataFrame([(text,)], "ray_ct string")
    assert tuple(df.select(c.ray_count(1), c.ray_count(2)).first()) == want


def test_secchi_note_is_the_line_that_names_it(spark):
    assert one(spark, "calm\nno Secchi disk\nend", "string", c.secchi_note("x")) == "no Secchi disk"
    assert one(spark, "calm", "string", c.secchi_note("x")) is None


def test_null_is_not_in_a_list(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert [r[0] for r in df.where(c.not_in("x", ["a"])).collect()] == ["b", None]
    assert [r[0] for r in df.where(c.is_in("x", ["a"])).collect()] == ["a"]


def test_first_matching_phase_wins(spark, rows):
    cases = [("123a", "GR", 132.0), ("123a", "GR", 250.0), ("123a", "GR", 250.5), ("123a", "CO", 200.0), ("123d", "GR", 140.0), ("123d", "GR", None)]
    df = spark.createDataFrame(cases, "StudyCode string, RiverCode string, StartLocation_BelknapMiles double")
    got = [r[0] for r in df.select(c.study_phase()).collect()]
    assert got == ["123a-DESO", "123a-DESO", "123a-ECHO", "123a", "123d-GRAY", "123d"]


def test_report_reaches(spark):
    df = spark.createDataFrame([("CO", 1.0), ("GR", 129.5), ("GR", 129.6), ("GR", 99.0), ("GR", None)], "cd_rvr string, rmi_start_bel double")
    code, name = c.report_reach()
    assert [r[0] for r in df.select(code).collect()] == ["LCO", "LGR", "DESO", None, None]
    assert df.select(name).first()[0] == "Lower Colorado River"


def test_corrections_touch_only_what_they_name(spark, rows):
    df = spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5), (3, "c", None)], "k long, river string, rmi double")
    fixes = spark.createDataFrame([(1, "river", "CO"), (1, "rmi", "72.8"), (2, "rmi", None), (9, "rmi", "1")], "k long, column string, value string")
    assert rows(c.apply_corrections(df, fixes, "k")) == [(1, "CO", 72.8), (2, "b", None), (3, "c", None)]
    more = c.append_rows(df, spark.createDataFrame([(4,)], "k long"))
    assert rows(more)[-1] == (4, None, None)


def test_yes_no_and_tags(spark):
    df = spark.createDataFrame([("Y", "3D9.1.2"), ("N", None), ("U", "x")], "HasA string, t string")
    assert [r["HasA"] for r in c.yes_no_columns(df).collect()] == [True, False, None]
    assert [r[0] for r in df.select(c.plain_tag("t")).collect()] == ["3D912", None, "x"]


def test_target_species():
    assert c.target_species("160se") == "RZ"
    assert c.target_species("138x") == "CS"


def test_local_time_and_display(spark):
    df = spark.createDataFrame([("2021-05-28 03:00:00",)], "x string").select(F.col("x").cast("timestamp").alias("tm_end"))
    moved = times.shift_to_local(df).select(F.col("tm_end").cast("string"), times.display_date("tm_end")).first()
    assert tuple(moved) == ("2021-05-27 21:00:00", "27 May 2021")
    numbers = spark.createDataFrame([(9.8, 21.0, 8810.0)], "a double, b double, c double")
    got = numbers.select(times.display_range("a", "b"), times.display_count("c"), times.display_decimal("b")).first()
    assert tuple(got) == ("9.8 - 21", "8,810", "21.0")


def test_casts_and_missing_columns(spark):
    df = spark.createDataFrame([(True, "x", 1)], "a boolean, b string, c long")
    out = c.with_missing(c.cast_columns(c.kinds_to_text(df, __import__("pyspark").sql.types.BooleanType), {"b": "long", "c": "string"}), {"d": "date", "a": "long"})
    assert tuple(out.first()) == ("true", None, "1", None)
    assert c.rename_select(df, {"z": "c", "y": "a"}).columns == ["z", "y"]


def test_season_end(spark):
    df = spark.createDataFrame([("2021-09-30",), ("2021-10-01",), (None,)], "x string").select(F.to_date("x").alias("d"))
    assert c.keep(df, c.before_season_end("d", 2021)).count() == 1
