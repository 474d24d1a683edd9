import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivertally import schemas
from rivertally.sources import store
from rivertally.sources import tables as io


def test_union_like_takes_every_name_that_contains_the_kind(spark, rows):
    tables = {"site": spark.createDataFrame([(1, "a")], "k long, x string"), "site2": spark.createDataFrame([(2,)], "k long"), "fish": spark.range(5)}
    assert rows(io.union_like(tables, "site")) == [(1, "a"), (2, None)]
    assert io.union_like(tables, "vial") is None


def test_second_identical_load_is_refused(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    batch = spark.createDataFrame([("s_1", "123d", 2021), ("s_2", "123d", 2021)], "SiteID string, StudyCode string, Year long")
    store.append_guarded(batch, path)
    before = rows(spark.read.parquet(path))
    with pytest.raises(store.DuplicateKeys):
        store.append_guarded(batch.limit(1).unionByName(batch.limit(1).withColumn("SiteID", F.lit("s_9"))), path)
    assert rows(spark.read.parquet(path)) == before
    store.append_guarded(batch.withColumns({"SiteID": F.concat("SiteID", F.lit("x")), "Year": F.lit(2022).cast("long")}), path)
    assert io.scan(spark, path, "123d", 2022).count() == 2
    plan = io.scan(spark, path, "123d", 2022)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan and "PushedFilters: [IsNotNull(StudyCode), EqualTo(StudyCode,123d)]" in plan


def test_stage_skips_empty_and_appends(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(3)
    assert io.stage({"a": df, "b": df.limit(0), "c": None}, root) == ["a"]
    assert io.stage({"a": df, "b": df}, root) == ["a", "b"]
    staged = io.read_staged(spark, root, ["a", "b", "c"])
    assert {k: v.count() for k, v in staged.items()} == {"a": 6, "b": 3}


def test_upload_number(spark):
    df = spark.range(1)
    assert io.stamp_upload(df, None).first()["upload_id"] == 1
    stored = spark.createDataFrame([(4,), (None,)], "upload_id long")
    assert io.stamp_upload(df, stored).first()["upload_id"] == 5
    assert io.next_upload(stored.limit(0)) == 1


def test_lookup_csv(spark, tmp_path, rows):
    (tmp_path / "codes.csv").write_text('A,B,C\nNA,AL,"BOWBROWN, BNSC-F"\nSM,NA,plain\n')
    schema = schemas.struct("A string\nB string\nC string")
    assert rows(io.read_lookup_csv(spark, str(tmp_path / "codes.csv"), schema)) == [(None, "AL", "BOWBROWN, BNSC-F"), ("SM", None, "plain")]


def test_report_csvs_by_name(spark, tmp_path, rows):
    counts = spark.createDataFrame([("s", "SM", "smallmouth, bass", 3), ("t", None, None, None)], schemas.REPORT_TABLES["count"])
    io.write_product(counts, str(tmp_path / "123d_2021_ar-count.csv"))
    (tmp_path / "123d_2021_ar-water.csv").write_text("staid,date,discharge,temp,nm_station,cd_rvr\n0931,2021-05-01,10,NA,Green,GR\n")
    got = io.read_report_csvs(spark, str(tmp_path))
    assert sorted(got) == ["count", "water"]
    assert rows(got["count"]) == [("s", "SM", "smallmouth, bass", 3, "123d", 2021), ("t", None, None, None, "123d", 2021)]
    assert rows(got["water"], "date", "temp") == [(dt.date(2021, 5, 1), None)]


def test_conform_shapes_nested_rows(spark):
    df = spark.createDataFrame(
        [("s", "123d", "GR", "12", [("SM", 1, [("tag", True)])], 0), ("t", "123d", "GR", "x", None, 0)],
        "SiteID string, StudyCode string, RiverCode string, Effort_Seconds string, "
        "FishData array<struct<SpeciesCode:string,FishCount:int,PitTag:array<struct<PitTagString:string,IsPitTagRecapture:boolean>>>>, Part int",
    ).withColumn("extra", F.lit(1))
    out = io.conform(df, schemas.F_ELECTROFISH)
    bare = [(f.name, f.dataType.simpleString()) for f in schemas.F_ELECTROFISH]
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == bare
    first, second = out.orderBy("SiteID").collect()
    assert first["Effort_Seconds"] == 12 and first["FishData"][0]["PitTag"][0]["PitTagString"] == "tag"
    assert first["FishData"][0]["FloyTag"] == [] and first["WaterQuality"] == []
    assert second["Effort_Seconds"] is None and second["FishData"] == []


def test_split_tables_are_read_by_folder(spark, tmp_path, rows):
    df = spark.createDataFrame([("GR", 1), ("GR", 2), ("CO", 3), (None, 4)], "river string, n long")
    io.write_split(df, "river", str(tmp_path / "s"))
    for river in ("GR", "CO", None, "SJ"):
        part = io.read_split(spark, str(tmp_path / "s"), "river", river)
        assert rows(part, "river", "n") == rows(df.where(F.col("river").eqNullSafe(F.lit(river))))
        assert "PartitionFilters: [" in part._jdf.queryExecution().executedPlan().toString()


def test_dimension_can_be_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "dim")
    io.write_dim(spark.range(2), path)
    io.write_dim(spark.read.parquet(path).unionByName(spark.range(5, 6)), path)
    assert spark.read.parquet(path).count() == 3


def test_meta_row(spark):
    meta = io.meta_row(spark, "123d", 2021, "A", "B", "agency", "EL")
    assert meta.select("project_code", "year").first() == ("123d", 2021)
    assert isinstance(meta.schema["date_created_index"].dataType, T.TimestampType)


def test_schema_sizes():
    fish = schemas.F_ELECTROFISH["FishData"].dataType.elementType
    haul = schemas.F_SEINE["HaulData"].dataType.elementType
    sizes = [len(s) for s in (schemas.F_ELECTROFISH, fish, schemas.F_SEINE, haul, schemas.F_TRAPNET, schemas.F_ANTENNA, schemas.F_HYDROLOGY, schemas.F_LARVALFISHLAB)]
    assert sizes == [18, 24, 23, 27, 19, 11, 7, 8]
    dims = (schemas.D_SPECIES, schemas.D_LIFESTAGE, schemas.D_RIVER, schemas.D_GEAR, schemas.D_DISPOSITION, schemas.D_COLOR, schemas.D_VIAL, schemas.D_PITTAG)
    assert [len(d) for d in dims] == [9, 7, 4, 3, 3, 2, 2, 3]
    assert not schemas.D_SPECIES["CommonName"].nullable and schemas.D_SPECIES["Family"].nullable
