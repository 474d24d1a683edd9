"""Queries of compositions as a whole: the annual tables, products, extracts, dimensions, stations and flat loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivertally.functions import cleaning as c
from rivertally.functions.numbers import round_to
from rivertally.operators import rates
from rivertally.operators.joins import union_all
from rivertally.operators.reshape import merge_parts
from rivertally.plans import dimensions, electrofish, hydrology, products, reports, seine, views
from rivertally.session import new_folder
from rivertally.sources import store
from rivertally.sources import tables as io
from rivertally.workload import field_queries as field
from rivertally.workload import rate_queries as rate
from rivertally.workload import standins as s
from rivertally.workload.registry import hours_sql, query, rounded

_EXTRACTS = ["report_site", "report_water", "report_fish", "report_count", "species_dim", "stages"]


# ----- annual tables ------------------------------------------------------------------------------
def _annual(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    tables = {
        "site": s.report_site(spark, folder),
        "fish": s.report_fish(spark, folder),
        "count": s.report_count(spark, folder),
        "water": s.report_water(spark, folder),
    }
    return reports.annual_report_tables(tables, s.species_dim(spark, folder), s.stages(spark), 2024)


def _ranked(df: DataFrame) -> DataFrame:
    """The place of each row in a report table of a few rows, by the table's own order."""
    order = Window.orderBy(F.col("cpue").desc_nulls_last(), F.col("cd_spp").asc_nulls_last(), F.col("cd_rch").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order).cast("long"))


@query(
    rate._REACH_RATES
    + f"""SELECT *, row_number() OVER (PARTITION BY cd_spp IN ({rate._NATIVE}) ORDER BY cpue DESC NULLS LAST, cd_spp NULLS LAST, cd_rch NULLS LAST) AS rank,
    cd_spp IN ({rate._NATIVE}) AS native FROM rates WHERE cd_spp <> 'UI'""",
    [*rate._REPORT, "report_count"],
)
def annual_reach_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Native and other species by falling rate, each with its place, from the report's base aggregate."""
    tables = _annual(spark, folder)
    native = _ranked(tables["cpue_reach_native"]).withColumn("native", F.lit(True))
    return native.unionByName(_ranked(tables["cpue_reach_nonnative"]).withColumn("native", F.lit(False)))


@query(
    rate._REACHED
    + f""", x AS (SELECT s.cd_rvr, s.cd_rch, c.cd_spp, s.date, discharge, temp, sum(amt_effort_sec) AS sec, coalesce(sum(n_fish), 0) AS n
    FROM site s LEFT JOIN report_count c ON s.id_site = c.id_site GROUP BY 1, 2, 3, 4, 5, 6)
SELECT cd_rvr, cd_rch, cd_spp, date, discharge, temp, CAST(n AS BIGINT) AS n_fish, {rounded('CAST(sec AS DOUBLE) / 3600.0::DOUBLE', 4)} AS tot_effort FROM x""",
    [*rate._REPORT, "report_count"],
)
def annual_date_table(spark: SparkSession, folder: str) -> DataFrame:
    return _annual(spark, folder)["cpue_date"].withColumn("tot_effort", round_to("tot_effort", 4)).drop("cpue_dt")


@query(
    rate._REACHED
    + f""", f AS (SELECT cd_rch, cd_spp, tot_length FROM report_fish JOIN site USING (id_site))
SELECT cd_rch, cd_spp, min(tot_length) AS min, {rounded('quantile_cont(tot_length, 0.25)', 3)} AS q1, {rounded('median(tot_length)', 3)} AS median, {rounded('avg(tot_length)', 3)} AS mean,
    {rounded('quantile_cont(tot_length, 0.75)', 3)} AS q3, max(tot_length) AS max, count(*) FILTER (tot_length IS NULL) AS n_missing FROM f GROUP BY 1, 2""",
    [*rate._REPORT, "report_fish"],
)
def annual_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Length summary per reach and species."""
    return _annual(spark, folder)["length_summary"].withColumns({n: round_to(n, 3) for n in ("q1", "median", "mean", "q3")})


@query(
    rate._REACHED
    + """, f AS (SELECT cd_rch, cd_spp, tot_length FROM report_fish JOIN site USING (id_site) WHERE tot_length IS NOT NULL)
SELECT cd_rch, cd_spp, 25.0::DOUBLE * CAST(ceil(tot_length / 25.0::DOUBLE - 0.5) AS BIGINT) AS bin_center, count(*) AS n FROM f GROUP BY 1, 2, 3""",
    [*rate._REPORT, "report_fish"],
)
def annual_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Length bins of 25 mm per reach and species."""
    return _annual(spark, folder)["length_histogram"]


@query(
    rate._REACH_RATES
    + f""", h AS (SELECT sum(round(CAST(hr AS DECIMAL(18,1)), 1)) AS hr FROM (SELECT cd_rvr, nm_rvr, nm_rch, cd_rch, {hours_sql('sum(amt_effort_sec)', 1)} AS hr FROM site GROUP BY 1, 2, 3, 4))
SELECT cd_spp, CAST(sum(fish_ct) AS BIGINT) AS fish_ct, CAST(min(h.hr) AS DOUBLE) AS effort_hr FROM rates, h GROUP BY 1""",
    [*rate._REPORT, "report_count"],
)
def annual_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Catch per species and hours over all reaches."""
    tables = _annual(spark, folder)
    return tables["species_totals"].withColumn("effort_hr", tables["total_hours"].scalar())


@query(
    rate._REACHED
    + f""", x AS (SELECT cd_rvr, nm_rvr, nm_rch, cd_rch, min(date) AS d0, max(date) AS d1, {hours_sql('sum(amt_effort_sec)', 1)} AS effort_hr, count(DISTINCT date) AS sampl_days FROM site GROUP BY 1, 2, 3, 4)
SELECT cd_rvr, nm_rvr, nm_rch, cd_rch, strftime(d0, '%d %B %Y') AS date_min, strftime(d1, '%d %B %Y') AS date_max, effort_hr, sampl_days, row_number() OVER (ORDER BY d0, cd_rch NULLS LAST, cd_rvr) AS place FROM x""",
    rate._REPORT,
)
def annual_sampling(spark: SparkSession, folder: str) -> DataFrame:
    """The sampling table as text, placed by its first date as parsed back from the text."""
    table = _annual(spark, folder)["sampling"]
    first = F.to_date("date_min", "dd MMMM yyyy")
    order = Window.orderBy(first.asc_nulls_last(), F.col("cd_rch").asc_nulls_last(), F.col("cd_rvr"))  # a row per reach
    return table.withColumn("place", F.row_number().over(order).cast("long")).select(
        "cd_rvr", "nm_rvr", "nm_rch", "cd_rch", "date_min", "date_max", "effort_hr", "sampl_days", "place"
    )


# ----- products ---------------------------------------------------------------------------------------------
_STORE_SQL = """, h AS (SELECT o_custkey AS site_id, o_orderkey AS haul_id, CAST(c_nationkey AS BIGINT) AS reach, (o_orderkey % 11 + 1) * (o_orderkey % 7 + 1) AS haul_area, o_orderkey % 2 + 1 AS prim_sec, o_orderkey % 3 + 1 AS haul_num
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey % 2 = 1)"""


@query(
    _STORE_SQL
    + f""", g AS (SELECT * FROM h CROSS JOIN (SELECT DISTINCT species FROM h JOIN haul_counts USING (haul_id) WHERE species IN ({rate._NATIVE}))),
f AS (SELECT g.*, coalesce(fish_count, 0) AS fish_count FROM g LEFT JOIN haul_counts c ON g.haul_id = c.haul_id AND g.species = c.species)
SELECT site_id, reach, species, CAST(sum(fish_count) AS BIGINT) AS fish_count, CAST(sum(haul_area) AS BIGINT) AS haul_area,
    {rounded('CAST(sum(fish_count) AS DOUBLE) / sum(haul_area) * 10', 2)} AS fp10ms FROM f GROUP BY 1, 2, 3""",
    ["haul_counts"],
)
def product_native(spark: SparkSession, folder: str) -> DataFrame:
    """Native area rates as a product table, written as CSV and read back."""
    out = products.seine_products(field._store(spark, folder), 2021)
    root = new_folder(spark, "products")
    products.write_products({"cpue_nf": out["cpue_nf"]}, root, "138_2021")
    return io.read_lookup_csv(spark, f"{root}/138_2021_cpue_nf.csv", out["cpue_nf"].schema)


@query(
    _STORE_SQL
    + f""", p AS (SELECT * FROM h WHERE prim_sec = 1 AND haul_num = 1), j AS (SELECT p.site_id, p.reach, p.haul_area, species, fish_count FROM p LEFT JOIN haul_counts c ON p.haul_id = c.haul_id),
g AS (SELECT * FROM (SELECT DISTINCT site_id, reach, haul_area FROM j) CROSS JOIN (SELECT DISTINCT species FROM j WHERE species IS NULL OR species NOT IN ({rate._NATIVE}))),
f AS (SELECT g.*, coalesce(fish_count, 0) AS fish_count FROM g LEFT JOIN j ON g.site_id = j.site_id AND g.reach = j.reach AND g.haul_area = j.haul_area AND g.species IS NOT DISTINCT FROM j.species)
SELECT site_id, reach, haul_area, species, CAST(fish_count AS BIGINT) AS fish_count, {rounded('CAST(fish_count AS DOUBLE) / haul_area * 10', 2)} AS fp10ms FROM f""",
    ["haul_counts"],
)
def product_nonnative(spark: SparkSession, folder: str) -> DataFrame:
    """Area rates of other species as a product table."""
    return products.seine_products(field._store(spark, folder), 2021)["cpue_nnf"]


_STATIONS = [(str(i), f"station {i}", ("GR", "CO", "SJ")[i % 3], f"reach {i % 4}") for i in range(0, 60, 2)]


@query(
    """, d AS (SELECT coalesce(c.staid, v.staid) AS staid, coalesce(c.dates, v.dates) AS date, c.val AS discharge, v.val AS temp
    FROM (SELECT * FROM daily_values WHERE parameter = '00060') c FULL JOIN (SELECT * FROM daily_values WHERE parameter = '00010') v ON c.staid = v.staid AND c.dates = v.dates)
SELECT staid, date, discharge, temp, 'station ' || staid AS sta_name, CASE CAST(staid AS BIGINT) % 3 WHEN 0 THEN 'GR' WHEN 1 THEN 'CO' ELSE 'SJ' END AS rvr_code, 'reach ' || CAST(CAST(staid AS BIGINT) % 4 AS VARCHAR) AS rch_code
FROM d WHERE CAST(staid AS BIGINT) < 60 AND CAST(staid AS BIGINT) % 2 = 0""",
    ["daily_values"],
)
def product_water(spark: SparkSession, folder: str) -> DataFrame:
    """Daily series of the listed stations with their labels."""
    out = products.seine_products(field._store(spark, folder), 2021, s.daily_values(spark, folder), stations=_STATIONS)
    return out["waterdata"].drop("dataset_created")


@query(
    """, d AS (SELECT coalesce(c.staid, v.staid) AS staid, coalesce(c.dates, v.dates) AS date, CAST(trunc(c.val) AS BIGINT) AS discharge, v.val AS temp
    FROM (SELECT * FROM daily_values WHERE parameter = '00060') c FULL JOIN (SELECT * FROM daily_values WHERE parameter = '00010') v ON c.staid = v.staid AND c.dates = v.dates)
SELECT staid AS "StationID", count(*) AS days, CAST(sum(discharge) AS BIGINT) AS discharge, CAST(min(date) AS TIMESTAMP) AS first, CAST(max(date) AS TIMESTAMP) AS last, count(temp) AS temperatures FROM d GROUP BY 1""",
    ["daily_values"],
)
def station_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Nested series per station, from parts of ten days put together again."""
    series = hydrology.daily_series(s.daily_values(spark, folder))
    stations = series.select(F.col("staid").alias("StationID")).distinct()
    facts = hydrology.station_facts(series, stations, max_weight=10)
    water = merge_parts(facts, ["StationID"], ["WaterData"])
    zero = F.lit(0).cast("long")
    return water.select(
        "StationID",
        F.size("WaterData").cast("long").alias("days"),
        F.aggregate("WaterData", zero, lambda total, w: total + F.coalesce(w["Discharge_CFS"], zero)).alias("discharge"),
        F.get("WaterData", F.lit(0))["ObservationDateTime_Local"].alias("first"),
        F.element_at("WaterData", -1)["ObservationDateTime_Local"].alias("last"),
        F.size(F.filter("WaterData", lambda w: w["WaterTemperature_C"].isNotNull())).cast("long").alias("temperatures"),
    )


# ----- extracts, dimensions, tables by key ------------------------------------------------------------------------
@query(
    """SELECT "StudyCode" AS cd_study, "RiverCode" AS cd_rvr, "RiverCode" || ' River' AS nm_rvr, "SiteID" AS id_site, ts AS tm_start, mile AS rmi_start_bel, effort AS amt_effort_sec, discharge, temp
FROM sites LEFT JOIN (SELECT cd_rvr, CAST(date - INTERVAL 26 YEAR AS DATE) AS date, discharge, temp FROM report_water) w ON w.cd_rvr = "RiverCode" AND w.date = CAST(ts AS DATE)
WHERE "StudyCode" = '123d' AND year(ts) = 1998 AND "RiverCode" <> 'SJ'""",
    ["sites", "report_water"],
)
def report_extract_inner(spark: SparkSession, folder: str) -> DataFrame:
    """The stored query's form of the site extract (rivers of the dimension only), with the water of its day."""
    sites = s.sites(spark, folder).withColumns(
        {"Year": F.year("StartDateTime_UTC").cast("long"), "EndDateTime_UTC": F.col("StartDateTime_UTC"), "EndLocation_BelknapMiles": F.col("StartLocation_BelknapMiles")}
    )
    rivers = sites.select("RiverCode").distinct().where("RiverCode <> 'SJ'").withColumn("RiverName", F.concat("RiverCode", F.lit(" River")))
    fish = c.with_missing(s.fish(spark, folder).limit(0), {"StudyCode": "string", "Year": "long", "EncounterDateTime_UTC": "timestamp", "Weight_g": "long", "Sex": "string", "IsRipe": "boolean", "DispositionCode": "string", "EncounterEasting_UTM": "double", "EncounterNorthing_UTM": "double"})
    site = views.report_extract(sites, fish, s.catch(spark, folder), rivers, s.species_dim(spark, folder), "123d", 1998, inner=True)["site"]
    water = s.report_water(spark, folder).select("cd_rvr", F.to_date(F.add_months("date", -26 * 12)).alias("date"), "discharge", "temp")
    placed = site.withColumn("date", F.to_date("tm_start")).join(water, ["cd_rvr", "date"], "left")
    return placed.drop("date", "tm_end", "rmi_end_bel").withColumn("tm_start", F.col("tm_start").cast("timestamp_ntz"))


@query(
    """SELECT "SpeciesCode", "CommonName", "LifeStageCode" FROM species_dim UNION ALL SELECT 'XX', 'quoted, name', NULL""",
    ["species_dim"],
)
def dimension_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension from a lookup CSV with NA for missing values, rewritten from itself with one more row."""
    root = new_folder(spark, "dimension")
    schema = "SpeciesCode string, CommonName string, LifeStageCode string"
    io.write_product(s.species_dim(spark, folder).select("SpeciesCode", "CommonName", "LifeStageCode"), f"{root}/lookup.csv")
    extra = spark.createDataFrame([("XX", "quoted, name", None)], schema)
    io.write_dim(io.read_lookup_csv(spark, f"{root}/lookup.csv", extra.schema), f"{root}/dim")
    io.write_dim(spark.read.parquet(f"{root}/dim").unionByName(extra), f"{root}/dim")
    return spark.read.parquet(f"{root}/dim")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def split_by_status(spark: SparkSession, folder: str) -> DataFrame:
    """One table per status from one write, each read back from its own folder."""
    orders = s.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    root = new_folder(spark, "split")
    io.write_split(orders, "o_orderstatus", root)
    parts = [io.read_split(spark, root, "o_orderstatus", value) for value in ("F", "O", "P", None)]
    return union_all(*parts)


@query(
    """
, c AS (SELECT site_id, CAST(sum(fish_count) AS BIGINT) AS n FROM hauls JOIN haul_counts USING (haul_id) WHERE species = 'RZ' GROUP BY 1)
SELECT s.site_id, coalesce(c.n, 0) AS "RZ" FROM (SELECT c_custkey AS site_id FROM customer) s LEFT JOIN c USING (site_id)""",
    ["hauls", "haul_counts"],
)
def target_catch_study(spark: SparkSession, folder: str) -> DataFrame:
    """Catch of the target species that the study's name tells."""
    sites = s.table(spark, folder, "customer").select(F.col("c_custkey").alias("site_id"))
    catch = s.hauls(spark, folder).select("site_id", "haul_id").join(s.haul_counts(spark, folder), "haul_id")
    return rates.target_catch(sites, catch, c.target_species("160se"))


@query("""SELECT code AS "LifeStageCode", stage AS "LifeStageAbbr", CAST(low AS BIGINT) AS "MinTotalLength_mm", CAST(high AS BIGINT) AS "MaxTotalLength_mm", codes AS "AssociatedSpeciesCodes", (SELECT count(*) FROM species_dim WHERE "LifeStageCode" = code) AS species FROM stages""", ["stages", "species_dim"])
def stage_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """The renamed life-stage dimension, with the number of species that have each code."""
    raw = s.stages(spark).withColumnsRenamed(dimensions.LIFESTAGE_NAMES)
    coded, stages = dimensions.rebuild_species(s.species_dim(spark, folder), raw)
    counts = coded.where("LifeStageCode IS NOT NULL").groupBy("LifeStageCode").agg(F.count(F.lit(1)).alias("species"))
    joined = stages.join(counts, "LifeStageCode", "left").fillna(0, ["species"])
    return joined.select("LifeStageCode", "LifeStageAbbr", "MinTotalLength_mm", "MaxTotalLength_mm", "AssociatedSpeciesCodes", "species")


# ----- facts and flat loads -----------------------------------------------------------------------------------------
@query(
    field._SITE_SQL
    + """SELECT site_id AS "SiteID", '123d' AS "StudyCode", river AS "RiverCode", pass AS "PassIdentifier", start_rmi AS "StartLocation_BelknapMiles", end_rmi AS "EndLocation_BelknapMiles",
    startdatetime AS "StartDateTime_UTC", enddatetime AS "EndDateTime_UTC", shoreline AS "Shoreline", el_sec AS "Effort_Seconds", 'boat' AS "BoatName", 'crew' AS "CrewNames", CAST(NULL AS VARCHAR) AS "Notes", year AS "Year" FROM s"""
)
def site_view(spark: SparkSession, folder: str) -> DataFrame:
    """Sites of the facts without their nested data; those that were rejected among them."""
    sites = views.site_view(field._electrofish(spark, folder))
    return sites.select(*field._plain_times(views.SITE_COLUMNS), "Year")


@query(
    field._SITE_SQL
    + """SELECT CAST(1 AS BIGINT) AS upload_id, key_aa, species, tot_length, weight, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, pit_num, pit_type FROM f
LEFT JOIN (SELECT key_aa, '3D9.ABC' || lpad(CAST(part % 10000000 AS VARCHAR), 7, '0') AS pit_num, CASE WHEN l_linenumber % 4 = 0 THEN '134' ELSE '400' END AS pit_type FROM f WHERE l_linenumber % 2 = 0) USING (key_aa)"""
)
def flat_load(spark: SparkSession, folder: str) -> DataFrame:
    """Fish and tags of the flat store after two uploads, of which the second repeats the first in another order."""
    staged = field._proofed(spark, field._stage(spark, folder, "fish", "pittag"))
    meta = io.meta_row(spark, "123d", 2021, "first", "last", "agency", "EL")
    root = new_folder(spark, "flat")
    tables = {**staged, "meta": meta.unionByName(meta)}
    keyed = {name: df.withColumn("fish_id", F.col("key_aa")) if name in ("fish", "pittag") else df for name, df in tables.items()}
    electrofish.load_flat(keyed, root)
    again = electrofish.load_flat({name: df.repartition(df.columns[0]) for name, df in keyed.items()}, root)
    assert not again.new and store.read_uploaded(spark, root, "meta").count() == 1
    fish, tags = (store.read_uploaded(spark, root, name) for name in ("fish", "pittag"))
    joined = fish.join(tags.select("fish_id", "pit_num", "pit_type"), "fish_id", "left")
    return joined.select("upload_id", F.col("fish_id").alias("key_aa"), "species", "tot_length", "weight", "datetime", "pit_num", "pit_type")


@query(
    field._SEINE_SQL
    + f""", hd AS (SELECT * FROM k WHERE o_orderkey % 11 > 0 AND o_orderkey % 7 > 0 AND {s._case('cd_rch', field.RIVER_OF_REACH)} IS NOT NULL),
d AS (SELECT l_orderkey, min(qty) FILTER (l_linenumber = 1) AS d1, min(flag) FILTER (l_linenumber = 1) AS p1, min(species) FILTER (l_linenumber = 1) AS q1, min(qty) FILTER (l_linenumber = 2) AS d2, min(flag) FILTER (l_linenumber = 2) AS p2,
    min(species) FILTER (l_linenumber = 2) AS q2, min(qty) FILTER (l_linenumber = 3) AS d3, min(flag) FILTER (l_linenumber = 3) AS p3, min(species) FILTER (l_linenumber = 3) AS q3 FROM lf GROUP BY 1)
SELECT id_site AS "SiteID", id_haul AS "HaulID", d1 AS "DepthAtLocation1_mm", p1 AS "PrimarySubstrateAtLocation1", q1 AS "SecondarySubstrateAtLocation1", d2 AS "DepthAtLocation2_mm", p2 AS "PrimarySubstrateAtLocation2",
    q2 AS "SecondarySubstrateAtLocation2", d3 AS "MaximumDepth_mm", p3 AS "PrimarySubstrateAtMaximumDepth", q3 AS "SecondarySubstrateAtMaximumDepth" FROM hd LEFT JOIN d ON l_orderkey = o_orderkey"""
)
def seine_depth_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of a study that measures depth at several places: the depth fields of every haul of the accepted sites."""
    raw = field._raw_seine(spark, folder, "site", "haul", "depth")
    path = new_folder(spark, "facts")
    seine.load_seine(seine.stage_seine(raw, field._reach_river(spark), "160se", depths=True), path)
    hauls = io.scan(spark, path).select("SiteID", F.explode("HaulData").alias("h"))
    return hauls.select("SiteID", "h.HaulID", *[f"h.{name}" for name in seine.DEPTH_FIELDS.values()])

