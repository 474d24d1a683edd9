"""Queries of the staging, fact-load, product and source/sink compositions.

Raw collection tables are derived from the whole driver tables: orders are electrofishing sites and
seine hauls, customers are seine sites, line items (every one of them) are fish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivertally import schemas
from rivertally.functions import cleaning as c
from rivertally.operators.joins import growing
from rivertally.operators.ordered import number_within
from rivertally.operators.reshape import merge_parts
from rivertally.plans import electrofish, products, reports, seine, views
from rivertally.session import durable, new_folder
from rivertally.sources import store
from rivertally.sources import tables as io
from rivertally.sources.validation import FAILED
from rivertally.workload import standins as s
from rivertally.workload.registry import hours_sql, per, query, rounded

RIVER_OF_REACH = {"ECHO": "GR", "DESO": "GR", "LGR": "GR", "LCO": "CO", "WW": "CO", "LSJ": "SJ"}
_OLD = "1996-01-01"


def _reach_river(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RIVER_OF_REACH.items()), "cd_rch string, cd_rvr string")


def _clock(seconds: Column) -> Column:
    return F.format_string("%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)


def _key(column: str, letter: str = "a") -> Column:
    return F.concat(F.lit(letter), F.col(column).cast("string"))


# ----- raw electrofishing tables ------------------------------------------------------------
def _raw_site(spark: SparkSession, folder: str) -> DataFrame:
    order, cust = F.col("o_orderkey"), F.col("o_custkey")
    mile = (F.floor("o_totalprice").cast("long") % 1200) / F.lit(10.0)
    return s.table(spark, folder, "orders").select(
        _key("o_orderkey").alias("KEY_A"),
        F.coalesce(s.mapped_mod("o_custkey", 7, s.REACHES), F.lit("Z")).alias("REACH"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("DATE"),
        _clock(order % 80000).alias("STARTTIME"),
        _clock(order % 80000 + order % 3600).alias("ENDTIME"),
        mile.alias("START_RMI"),
        (mile - cust % 8 + 1).alias("END_RMI"),
        F.when(order % 5 == 0, "Z").otherwise("R").alias("SHORELINE"),
        (cust % 120).alias("EFFORT_MIN"),
        (order % 60).alias("EFFORT_SEC"),
        F.col("o_orderstatus").alias("PASS"),
        F.lit("boat").alias("BOAT"),
        F.lit("crew").alias("CREW"),
        F.lit("Z").alias("SITE_NOTES"),
    )


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """All line items, with a key of their own: order, line number, and a number among the lines that share both."""
    numbered = number_within(s.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], [], "copy")
    return numbered.select(
        "l_orderkey",
        "l_linenumber",
        F.concat_ws("-", *[F.col(n).cast("string") for n in ("l_orderkey", "l_linenumber", "copy")]).alias("line_key"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_quantity").cast("long").alias("qty"),
        F.col("l_returnflag").alias("flag"),
    )


def _line_key(letter: str) -> Column:
    return F.concat_ws("-", F.lit(letter), "line_key")


def _raw_fish(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    species = s.species_of_parts(spark, folder).withColumnRenamed("l_partkey", "part")
    line, part = F.col("l_linenumber"), F.col("part")
    return lines.join(species, "part").select(
        _key("l_orderkey").alias("key_a"),
        _line_key("f").alias("key_aa"),
        _clock((line * 10007 + part) % 86400).alias("time"),
        (part % 120).cast("double").alias("rmi"),
        F.coalesce("species", F.lit("Z")).alias("species"),
        (F.col("qty") * 13 % 1300).alias("tot_length"),
        (F.col("supp") % 9 * 400).alias("weight"),
        F.lit("F").alias("sex"),
        F.when(line % 3 == 0, "exp").when(line % 3 == 1, "not ripe").otherwise("Z").alias("rep_cond"),
        F.when(line % 2 == 0, "Y").otherwise("N").alias("tubercles"),
        F.when(line % 4 == 0, "N").otherwise(F.concat(line.cast("string"), F.lit("/11"))).alias("ray_ct"),
        s.mapped("flag", s.DISPOSITIONS).alias("disp"),
        F.lit("Z").alias("fish_notes"),
        F.when(line != 5, F.lit(-113) + (part % 400) / F.lit(100.0)).otherwise(0.0).alias("ilon"),
        F.when(line != 5, F.lit(38) + (F.col("supp") % 300) / F.lit(100.0)).otherwise(0.0).alias("ilat"),
    )


def _raw_pit(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    line = F.col("l_linenumber")
    number = F.when(line % 2 == 0, F.concat(F.lit("3d9.abc"), F.lpad((F.col("part") % 10**7).cast("string"), 7, "0")))
    return lines.select(
        _key("l_orderkey").alias("key_a"),
        _line_key("f").alias("key_aa"),
        _line_key("p").alias("key_aaa"),
        F.when(line % 4 == 0, "134").otherwise("400").alias("pit_type"),
        number.alias("pit_num"),
        F.when(F.col("flag") == "A", "Y").when(F.col("flag") == "N", "NNF").otherwise("Z").alias("pit_recap"),
        F.lit("Z").alias("pit_notes"),
    )


def _raw_floy(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    line = F.col("l_linenumber")
    return lines.select(
        _key("l_orderkey").alias("key_a"),
        _line_key("f").alias("key_aa"),
        _line_key("y").alias("key_aab"),
        F.lit("id").alias("floy_id"),
        F.when(line % 2 == 0, "R").otherwise("Z").alias("floy_color"),
        F.when(line % 3 != 2, F.col("supp").cast("string")).alias("floy_num"),
        F.when(F.col("flag") == "A", "Y").when(F.col("flag") == "N", "N").otherwise("Z").alias("floy_recap"),
        F.when(line == 1, "torn").otherwise("Z").alias("floy_notes"),
    )


def _raw_vial(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    return lines.where("l_linenumber = 3").select(
        _key("l_orderkey").alias("key_a"),
        _line_key("f").alias("key_aa"),
        _line_key("v").alias("key_aac"),
        _key("part", "v").alias("vial_num"),
        F.lit("fin").alias("vial_type"),
        F.lit("Z").alias("vial_notes"),
    )


def _raw_water(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    return s.table(spark, folder, "orders").select(
        _key("o_orderkey").alias("key_a"),
        _key("o_orderkey", "w").alias("key_ab"),
        (F.col("o_custkey") % 10 * 100).alias("cond_amb"),
        (F.col("o_custkey") % 7 * 100).alias("cond_spec"),
        (F.col("o_orderkey") % 25).cast("double").alias("rvr_temp"),
        (F.col("o_orderkey") % 40 * 10).alias("secchi"),
        F.lit("Z").alias("h2o_notes"),
    )


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    orders = s.table(spark, folder, "orders").where(F.col("o_orderdate") < F.lit(_OLD).cast("timestamp_ntz"))
    return orders.select(_key("o_orderkey").alias("key_a"), F.format_string("123d_1995_%03d", "o_orderkey").alias("site_id"))


def _stage(spark: SparkSession, folder: str, *kinds: str, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    site = _raw_site(spark, folder)
    if lines is None and kinds:
        lines = _lines(spark, folder)
        lines = durable(lines) if len(kinds) > 1 else lines  # numbered once for all kinds
    raw = {"site": site.where("PASS = 'F'"), "site2": site.where("PASS <> 'F'")}
    makers = {"fish": _raw_fish, "pittag": _raw_pit, "floytag": _raw_floy, "vial": _raw_vial, "water": _raw_water}
    raw |= {kind: durable(makers[kind](spark, folder, lines)) for kind in kinds}  # as landed
    return electrofish.stage_electrofish(raw, _reach_river(spark), "123d", "SM", _stored(spark, folder))


def _proofed(spark: SparkSession, staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staged tables written to the staging folder and read back, as they are after proofing."""
    root = new_folder(spark, "staging")
    return io.read_staged(spark, root, io.stage(staged, root))


_LINE_SQL = """line AS (SELECT l_orderkey, l_linenumber, l_partkey AS part, l_suppkey AS supp, CAST(l_quantity AS BIGINT) AS qty, l_returnflag AS flag,
    concat_ws('-', l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS line_key FROM lineitem)"""
_REACH_CASE = s._case("o_custkey % 7", s.REACHES)
_SITE_SQL = f"""WITH r AS (SELECT 'a' || CAST(o_orderkey AS VARCHAR) AS key_a, o_orderkey, o_custkey, o_orderstatus AS pass, {_REACH_CASE} AS reach,
    o_orderdate + to_seconds(o_orderkey % 80000) AS startdatetime, o_orderdate + to_seconds(o_orderkey % 80000 + o_orderkey % 3600) AS enddatetime,
    CAST(CAST(floor(o_totalprice) AS BIGINT) % 1200 AS DOUBLE) / CAST(10 AS DOUBLE) AS m, o_custkey % 120 * 60 + o_orderkey % 60 AS el_sec
    FROM orders WHERE o_orderdate >= TIMESTAMP '{_OLD}'),
site AS (SELECT (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '{_OLD}') + row_number() OVER (ORDER BY enddatetime, key_a) AS s_index,
    r.*, CAST(year(startdatetime) AS BIGINT) AS year, {s._case('reach', RIVER_OF_REACH)} AS river,
    m + CASE WHEN reach IN ('DESO', 'ECHO') THEN 120 ELSE 0 END AS start_rmi, m - o_custkey % 8 + 1 + CASE WHEN reach IN ('DESO', 'ECHO') THEN 120 ELSE 0 END AS end_rmi,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'R' END AS shoreline FROM r),
s AS (SELECT *, printf('123d_%d_%03d', year, s_index) AS site_id FROM site),
{_LINE_SQL},
f AS (SELECT 'f-' || line_key AS key_aa, s.*, line.*, {s._SPECIES} AS species,
    CAST(CAST(enddatetime AS DATE) AS TIMESTAMP) + to_seconds((l_linenumber * 10007 + part) % 86400) AS datetime,
    CAST(part % 120 AS DOUBLE) + CASE WHEN reach IN ('DESO', 'ECHO') THEN 120 ELSE 0 END AS rmi,
    nullif(qty * 13 % 1300, 0) AS tot_length, nullif(supp % 9 * 400, 0) AS weight, {s._case('flag', s.DISPOSITIONS)} AS disp
    FROM line JOIN part ON part = p_partkey JOIN s ON l_orderkey = o_orderkey)"""


@query(
    _SITE_SQL
    + """SELECT s_index, site_id, year, river, reach, pass, CAST(startdatetime AS DATE) AS day, start_rmi, end_rmi, shoreline, el_sec, key_a,
    CASE WHEN start_rmi - end_rmi > 5 OR start_rmi < end_rmi THEN 'FLAG' ELSE '' END AS rmi_length_flg,
    CASE WHEN date_diff('second', startdatetime, enddatetime) < el_sec THEN 'FLAG' ELSE '' END AS datetime_flg,
    CASE WHEN river IS NULL OR reach IS NULL OR shoreline IS NULL THEN 'FLAG' ELSE '' END AS "NA_flg" FROM s"""
)
def stage_site(spark: SparkSession, folder: str) -> DataFrame:
    """Electrofishing sites from raw tables: cleaned, numbered on, placed and flagged."""
    site = _stage(spark, folder)["site"].withColumn("day", F.to_date("startdatetime"))
    return site.select(
        "s_index", "site_id", "year", "river", "reach", "pass", "day", "start_rmi", "end_rmi", "shoreline", "el_sec", "key_a",
        "rmi_length_flg", "datetime_flg", "NA_flg",
    )


@query(
    _SITE_SQL
    + """, n AS (SELECT *, row_number() OVER (ORDER BY datetime, key_aa) AS f_index FROM f),
p AS (SELECT s_index, site_id, key_a, key_aa, f_index, reach, rmi, CAST(datetime AS TIMESTAMP) AS datetime, species, tot_length, weight, disp FROM n)
SELECT s.s_index, s.site_id, s.key_a, key_aa, f_index, p.reach, rmi, datetime, species, tot_length, weight, disp,
    CASE WHEN species IS NULL THEN 'FLAG' ELSE '' END AS species_flg, CASE WHEN disp IS NULL OR (disp = 'DE' AND coalesce(species IN ('CS', 'RZ', 'BT'), false))
        OR (disp = 'RA' AND NOT coalesce(species IN ('CS', 'RZ', 'BT'), false)) THEN 'FLAG' ELSE '' END AS disp_flg
FROM s LEFT JOIN p ON s.s_index = p.s_index"""
)
def stage_fish(spark: SparkSession, folder: str) -> DataFrame:
    """Electrofishing fish from raw tables: placed at their sites, numbered in time order, flagged."""
    fish = _stage(spark, folder, "fish")["fish"].withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    return fish.select(
        "s_index", "site_id", "key_a", "key_aa", "f_index", "reach", "rmi", "datetime", "species", "tot_length", "weight", "disp",
        "species_flg", "disp_flg",
    )


@query(
    _SITE_SQL
    + """, t AS (SELECT f.*, 'p-' || substr(key_aa, 3) AS key_aaa, CASE WHEN l_linenumber % 4 = 0 THEN '134' ELSE '400' END AS pit_type,
    '3D9.ABC' || lpad(CAST(part % 10000000 AS VARCHAR), 7, '0') AS pit_num, CASE flag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'NNF' END AS pit_recap FROM f WHERE l_linenumber % 2 = 0)
SELECT row_number() OVER (ORDER BY datetime, key_aaa) AS p_index, key_aaa, key_aa, site_id, species, pit_type, pit_num, pit_recap,
    CASE pit_recap WHEN 'NNF' THEN 'FLAG' WHEN 'Y' THEN '' END AS nnf_flg, CASE WHEN pit_recap IS NULL THEN 'FLAG' ELSE '' END AS pit_recap_flg,
    CASE WHEN pit_type = '400' THEN 'FLAG' END AS invalid_pitnum_flg FROM t"""
)
def stage_pittag(spark: SparkSession, folder: str) -> DataFrame:
    """Tags from raw tables: placed with their fish, numbered and flagged."""
    return _stage(spark, folder, "fish", "pittag")["pittag"].select(
        "p_index", "key_aaa", "key_aa", "site_id", "species", "pit_type", "pit_num", "pit_recap", "nnf_flg", "pit_recap_flg", "invalid_pitnum_flg"
    )


def _electrofish(spark: SparkSession, folder: str, *kinds: str, max_weight: int | None = None) -> DataFrame:
    """Facts of the whole batch, accepted and rejected, read back from where they were loaded to."""
    staged = _proofed(spark, _stage(spark, folder, *kinds))
    path = new_folder(spark, "facts")
    rejected = electrofish.load_electrofish(staged, path, max_weight=max_weight)
    return io.scan(spark, path).unionByName(rejected.drop("batch"), allowMissingColumns=True)


def _failed() -> Column:
    return F.coalesce(F.array_join(FAILED, ", "), F.lit("")).alias("failed")


@query(
    _SITE_SQL
    + """, x AS (SELECT s_index, count(*) AS n_fish, CAST(sum(tot_length) AS BIGINT) AS lengths, count(*) FILTER (l_linenumber % 3 = 0) AS ripe,
    count(*) FILTER (species IN ('CS', 'RZ', 'BT') AND l_linenumber % 2 = 0) AS tuberculate, CAST(sum(CASE WHEN l_linenumber % 4 <> 0 THEN 11 END) AS BIGINT) AS anal_rays,
    count(*) FILTER (l_linenumber % 2 = 0) AS tags, count(*) FILTER (l_linenumber % 2 = 0 AND flag = 'A') AS recaptures,
    count(*) FILTER (l_linenumber % 3 <> 2) AS floys, count(*) FILTER (l_linenumber = 3) AS vials FROM f GROUP BY 1)
SELECT site_id AS "SiteID", '123d' AS "StudyCode", river AS "RiverCode", pass AS "PassIdentifier", start_rmi AS "StartLocation_BelknapMiles", end_rmi AS "EndLocation_BelknapMiles",
    startdatetime AS "StartDateTime_UTC", enddatetime AS "EndDateTime_UTC", shoreline AS "Shoreline", el_sec AS "Effort_Seconds", 'boat' AS "BoatName", 'crew' AS "CrewNames",
    CAST(NULL AS VARCHAR) AS "Notes", CASE WHEN river IS NULL THEN 'RiverCode is required' ELSE '' END AS failed,
    CAST(1 AS BIGINT) AS water, nullif(o_custkey % 10 * 100, 0) AS ambient, nullif(o_custkey % 7 * 100, 0) AS specific, nullif(CAST(o_orderkey % 25 AS DOUBLE), 0) AS temperature, nullif(o_orderkey % 40 * 10, 0) AS secchi,
    coalesce(n_fish, 0) AS n_fish, coalesce(lengths, 0) AS lengths, coalesce(ripe, 0) AS ripe, coalesce(tuberculate, 0) AS tuberculate, coalesce(anal_rays, 0) AS anal_rays,
    coalesce(tags, 0) AS tags, coalesce(recaptures, 0) AS recaptures, coalesce(floys, 0) AS floys, coalesce(vials, 0) AS vials
FROM s LEFT JOIN x USING (s_index)"""
)
def electrofish_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Nested facts from raw tables: every site, accepted or rejected, with its water and the totals of its fish and tags."""
    facts = _electrofish(spark, folder, "fish", "pittag", "floytag", "vial", "water")

    def added(value) -> Column:
        return F.sum(F.aggregate("FishData", F.lit(0).cast("long"), lambda total, fish: total + F.coalesce(value(fish).cast("long"), F.lit(0))))

    water = F.col("WaterQuality")
    totals = {
        "water": F.sum(F.size(water)),
        "ambient": F.max(F.try_element_at(water, F.lit(1))["AmbientConductivityMain_uS"]),
        "specific": F.max(F.try_element_at(water, F.lit(1))["SpecificConductivityMain_uS"]),
        "temperature": F.max(F.try_element_at(water, F.lit(1))["WaterTemperatureMain_C"]),
        "secchi": F.max(F.try_element_at(water, F.lit(1))["SecchiDepthMain_mm"]),
        "n_fish": added(lambda fish: fish["Part"] == 0),
        "lengths": added(lambda fish: F.when(fish["Part"] == 0, fish["TotalLength_mm"])),
        "ripe": added(lambda fish: fish["IsRipe"]),
        "tuberculate": added(lambda fish: fish["IsTuberculate"]),
        "anal_rays": added(lambda fish: fish["AnalRayCount"]),
        "tags": added(lambda fish: F.size(fish["PitTag"])),
        "recaptures": added(lambda fish: F.size(F.filter(fish["PitTag"], lambda tag: tag["IsPitTagRecapture"]))),
        "floys": added(lambda fish: F.size(fish["FloyTag"])),
        "vials": added(lambda fish: F.size(fish["Vial"])),
    }
    return facts.groupBy(*_plain_times(views.SITE_COLUMNS), _failed()).agg(*[value.cast("long").alias(name) if name != "temperature" else value.alias(name) for name, value in totals.items()])


def _plain_times(names: list[str]) -> list[Column]:
    """Columns, with instants as civil times, as the checking engine has them."""
    return [F.col(n).cast("timestamp_ntz").alias(n) if "DateTime" in n else F.col(n) for n in names]


_TAG_SQL = """, t AS (SELECT *, row_number() OVER (ORDER BY datetime, key_aa) AS number FROM f),
tag AS (SELECT site_id, number, species, 'PitTag' AS kind, '3D9.ABC' || lpad(CAST(part % 10000000 AS VARCHAR), 7, '0') AS string, CASE WHEN l_linenumber % 4 = 0 THEN '134' ELSE '400' END AS code,
        CASE flag WHEN 'A' THEN true END AS again, CAST(NULL AS VARCHAR) AS notes FROM t WHERE l_linenumber % 2 = 0
    UNION ALL SELECT site_id, number, species, 'FloyTag', CAST(supp AS VARCHAR), CASE WHEN l_linenumber % 2 = 0 THEN 'R' END, CASE flag WHEN 'A' THEN true WHEN 'N' THEN false END,
        CASE WHEN l_linenumber = 1 THEN 'torn' END FROM t WHERE l_linenumber % 3 <> 2
    UNION ALL SELECT site_id, number, species, 'Vial', 'v' || CAST(part AS VARCHAR), 'fin', NULL, NULL FROM t WHERE l_linenumber = 3)"""


@query(
    _SITE_SQL
    + _TAG_SQL
    + """, n AS (SELECT number, count(*) FILTER (kind = 'PitTag') AS pits, count(*) FILTER (kind = 'FloyTag') AS floys, count(*) FILTER (kind = 'Vial') AS vials, min(string) AS least FROM tag GROUP BY 1)
SELECT site_id AS "SiteID", '123d' AS "StudyCode", river AS "RiverCode", year AS "Year", datetime AS "EncounterDateTime_UTC", rmi AS "EncounterLocation_BelknapMiles", species AS "SpeciesCode", CAST(1 AS BIGINT) AS "FishCount",
    tot_length AS "TotalLength_mm", CAST(NULL AS BIGINT) AS "StandardLength_mm", weight AS "Weight_g", 'F' AS "Sex", CASE l_linenumber % 3 WHEN 0 THEN true WHEN 1 THEN false END AS "IsRipe",
    CASE WHEN species IN ('CS', 'RZ', 'BT') THEN l_linenumber % 2 = 0 END AS "IsTuberculate", CASE WHEN l_linenumber % 4 <> 0 THEN CAST(l_linenumber AS BIGINT) END AS "DorsalRayCount",
    CASE WHEN l_linenumber % 4 <> 0 THEN CAST(11 AS BIGINT) END AS "AnalRayCount", disp AS "DispositionCode", CAST(NULL AS VARCHAR) AS "Notes",
    coalesce(pits, 0) AS pits, coalesce(floys, 0) AS floys, coalesce(vials, 0) AS vials, least AS least_tag
FROM t LEFT JOIN n USING (number)"""
)
def electrofish_fish(spark: SparkSession, folder: str) -> DataFrame:
    """Every fish of the facts with all its columns but the position, from facts cut into parts of two rows and put together again."""
    fish = views.fish_view(_electrofish(spark, folder, "fish", "pittag", "floytag", "vial", max_weight=2))
    strings = F.concat(F.col("PitTag")["PitTagString"], F.col("FloyTag")["FloyTagString"], F.col("Vial")["VialString"])
    names = [
        "SiteID", "StudyCode", "RiverCode", "Year", "EncounterDateTime_UTC", "EncounterLocation_BelknapMiles", "SpeciesCode", "FishCount", "TotalLength_mm", "StandardLength_mm",
        "Weight_g", "Sex", "IsRipe", "IsTuberculate", "DorsalRayCount", "AnalRayCount", "DispositionCode", "Notes",
    ]
    counts = [F.size(a).cast("long").alias(n) for a, n in (("PitTag", "pits"), ("FloyTag", "floys"), ("Vial", "vials"))]
    return fish.select(*_plain_times(names), *counts, F.array_min(strings).alias("least_tag"))


@query(_SITE_SQL + _TAG_SQL + """SELECT site_id AS "SiteID", number AS "FishNumber", species AS "SpeciesCode", kind, string, code, again, notes FROM tag""")
def electrofish_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Every pit tag, floy tag and vial of the facts, with its fish."""
    return views.tag_view(_electrofish(spark, folder, "fish", "pittag", "floytag", "vial"))


@query(
    _SITE_SQL
    + f""", lv AS (SELECT DISTINCT species FROM f WHERE species IS NOT NULL), n AS (SELECT river, species, count(*) AS n FROM f GROUP BY 1, 2),
d AS (SELECT river, CAST(startdatetime AS DATE) AS date, sum(el_sec) AS sec FROM s GROUP BY 1, 2),
e AS (SELECT river, min(date) AS min_date, max(date) AS max_date, {hours_sql('sum(sec)', 1)} AS total_effort_hr, count(*) AS sampling_days FROM d GROUP BY 1)
SELECT e.*, lv.species, coalesce(n, 0) AS fish_ct, {rounded(per('coalesce(n, 0)', 'total_effort_hr'), 2)} AS cpue
FROM e CROSS JOIN lv LEFT JOIN n ON n.river IS NOT DISTINCT FROM e.river AND n.species = lv.species"""
)
def season_river_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Season update from raw tables: effort and rates per river."""
    staged = _stage(spark, folder, "fish")
    fish = staged["fish"].where("key_aa IS NOT NULL")
    return reports.season_update(staged["site"], fish)["river_summary"]


_VIAL_SQL = """, k AS (SELECT *, bool_or(l_linenumber <> 5) OVER (PARTITION BY site_id, rmi) AS known FROM f),
p AS (SELECT *, bool_or(known) OVER (PARTITION BY s_index ORDER BY datetime, key_aa ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS placed FROM k)"""


def _vials(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    lines = durable(_lines(spark, folder))
    staged = _stage(spark, folder, "fish", lines=lines)
    return electrofish.vial_extract(staged["site"], staged["fish"].where("key_aa IS NOT NULL"), c.null_text(_raw_vial(spark, folder, lines)))


@query(
    _SITE_SQL
    + _VIAL_SQL
    + """SELECT site_id, river, reach, rmi, datetime, species, tot_length, weight, 'F' AS sex, 'EXP' AS rep_cond, disp, CAST(NULL AS VARCHAR) AS fish_notes, placed,
    'v' || CAST(part AS VARCHAR) AS vial_num, 'fin' AS vial_type, CAST(NULL AS VARCHAR) AS vial_notes FROM p WHERE l_linenumber = 3 AND species IS NOT NULL"""
)
def vial_fish(spark: SparkSession, folder: str) -> DataFrame:
    """Fish with vials, with positions filled down inside their site."""
    out = _vials(spark, folder)["fish"]
    placed = (F.col("loc_x").isNotNull() & F.col("loc_y").isNotNull()).alias("placed")
    names = ["site_id", "river", "reach", "rmi", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "species", "tot_length", "weight", "sex", "rep_cond", "disp", "fish_notes"]
    return out.select(*names, placed, "vial_num", "vial_type", "vial_notes")


@query(_SITE_SQL + """SELECT site_id, river, reach, el_sec, key_a FROM s WHERE key_a IN (SELECT key_a FROM f WHERE l_linenumber = 3 AND species IS NOT NULL)""")
def vial_sites(spark: SparkSession, folder: str) -> DataFrame:
    """The sites that the fish with vials came from."""
    return _vials(spark, folder)["site"].select("site_id", "river", "reach", "el_sec", "key_a")


@query(
    _SITE_SQL
    + """SELECT 1 + 7 AS upload_id, '123d' AS project_code, site_id, river, CAST(el_sec AS BIGINT) AS el_sec, strftime(startdatetime, '%Y-%m-%d %H:%M:%S') AS startdatetime FROM s""".replace("1 + 7", "CAST(8 AS BIGINT)")
)
def finalise_site(spark: SparkSession, folder: str) -> DataFrame:
    """Sites for the flat store: helper columns dropped, times as text, next batch number."""
    staged = _stage(spark, folder)
    stored = _stored(spark, folder).withColumn("upload_id", F.lit(7))
    flat = electrofish.finalise_for_load({"site": staged["site"]}, stored)["site"]
    return flat.select("upload_id", "project_code", "site_id", "river", "el_sec", "startdatetime")


# ----- seining ------------------------------------------------------------------------------------
def _raw_seine(spark: SparkSession, folder: str, *kinds: str) -> dict[str, DataFrame]:
    cust = F.col("c_custkey")
    site = s.table(spark, folder, "customer").select(
        _key("c_custkey").alias("key_a"),
        F.date_format(F.date_add(F.lit("2021-01-01").cast("date"), (cust % 300).cast("int")), "MM/dd/yyyy").alias("date"),
        F.coalesce(s.mapped_mod("c_nationkey", 7, s.REACHES), F.lit("Z")).alias("reach"),
        F.col("c_mktsegment").alias("pass"),
        (cust % 100).cast("double").alias("rmi"),
        (cust % 30).cast("double").alias("mc_temp"),
        F.lit("BA").alias("hab_1"),
        (cust % 50).alias("hab_length"),
        (cust % 20).alias("hab_width"),
        (cust % 4 * 10).alias("hab_secchi"),
        F.when(cust % 2 == 0, "Y").otherwise("N").alias("algae"),
        F.lit(38.5).alias("ilat"),
        F.lit(-110.5).alias("ilon"),
        F.lit("crew").alias("crew"),
        F.when(cust % 3 == 0, "Secchi at bottom").otherwise("Z").alias("site_notes"),
    )
    order = F.col("o_orderkey")
    haul = s.table(spark, folder, "orders").select(
        _key("o_custkey").alias("key_a"),
        _key("o_orderkey", "h").alias("key_aa"),
        _clock(order % 86400).alias("starttime"),
        F.lit("BS").alias("gear"),
        (order % 11).alias("haul_lengt"),
        (order % 7).cast("double").alias("haul_width"),
        (order % 5 * 100).alias("avg_dep"),
        F.lit("SI").alias("substrate"),
        F.when(order % 2 == 0, "Y").otherwise("N").alias("rs"),
        F.lit("Z").alias("ss"),
        F.lit("N").alias("fh"),
        F.lit("Z").alias("haul_notes"),
    )
    species = s.species_of_parts(spark, folder).withColumnRenamed("l_partkey", "part")
    owners = s.table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), _key("o_custkey").alias("key_a"))
    lines = _lines(spark, folder).join(species, "part").join(growing(owners), "l_orderkey")
    base = [F.col("key_a"), _key("l_orderkey", "h").alias("key_aa")]
    fish = lines.where("l_linenumber <= 3").select(
        *base,
        _line_key("x").alias("key_aaa"),
        "species",
        (F.col("qty") % 40).alias("tot_length"),
        (F.col("qty") % 3).alias("weight"),
        s.mapped("flag", s.DISPOSITIONS).alias("disp"),
        F.lit("Z").alias("photo_num"),
        F.lit("Z").alias("fish_notes"),
    )
    count = lines.where("l_linenumber > 3").select(
        *base, "species", s.mapped("flag", s.DISPOSITIONS).alias("disp"), F.col("qty").alias("fish_count")
    )
    depth = lines.select(
        *base,
        F.when(F.col("l_linenumber") == 1, "loc1").when(F.col("l_linenumber") == 2, "loc2").when(F.col("l_linenumber") == 3, "mx").alias("location"),
        F.col("qty").alias("depth"),
        F.col("flag").alias("sub_1"),
        F.col("species").alias("sub_2"),
    )
    raw = {"site": site, "haul": haul, "fish": fish, "count": count, "depth": depth}
    return {kind: durable(raw[kind]) for kind in kinds}  # as landed


_SEINE_SQL = f"""WITH times AS (SELECT o_custkey, o_orderkey, TIMESTAMP '2021-01-01' + to_days(CAST(o_custkey % 300 AS INTEGER)) + to_seconds(o_orderkey % 86400) AS ts FROM orders),
firsts AS (SELECT o_custkey, row_number() OVER (ORDER BY min(ts), 'a' || CAST(o_custkey AS VARCHAR)) AS s_idx FROM times GROUP BY o_custkey),
keys AS (SELECT times.*, s_idx, printf('160se_2021_%03d', s_idx) AS id_site, row_number() OVER (PARTITION BY o_custkey ORDER BY ts, 'h' || CAST(o_orderkey AS VARCHAR)) AS n,
    row_number() OVER (ORDER BY ts, 'h' || CAST(o_orderkey AS VARCHAR)) AS h_idx FROM times JOIN firsts USING (o_custkey)),
k AS (SELECT keys.*, printf('%s.%02d', id_site, n) AS id_haul, c_mktsegment AS pass, {s._case('c_nationkey % 7', s.REACHES)} AS cd_rch FROM keys JOIN customer ON o_custkey = c_custkey),
h AS (SELECT * FROM k WHERE o_orderkey % 11 > 0 AND o_orderkey % 7 > 0 AND o_orderkey % 5 > 0),
{_LINE_SQL},
lf AS (SELECT line.*, {s._SPECIES} AS species, {s._case('flag', s.DISPOSITIONS)} AS disp FROM line JOIN part ON part = p_partkey),
f AS (SELECT k.*, species AS cd_spp, CAST(1 AS BIGINT) AS n_fish, nullif(qty % 40, 0) AS tot_length, disp AS cd_disp FROM lf JOIN k ON l_orderkey = o_orderkey WHERE l_linenumber <= 3
    UNION ALL SELECT k.*, species, n_fish, NULL, disp FROM (SELECT l_orderkey, species, disp, CAST(sum(qty) AS BIGINT) AS n_fish FROM lf WHERE l_linenumber > 3 AND species IS NOT NULL GROUP BY 1, 2, 3) JOIN k ON l_orderkey = o_orderkey)"""


@query(_SEINE_SQL + f"""SELECT id_haul, id_site, h_idx, s_idx, pass, cd_rch, {s._case('cd_rch', RIVER_OF_REACH)} AS cd_rvr FROM h""")
def stage_seine_haul(spark: SparkSession, folder: str) -> DataFrame:
    """Seine hauls from raw tables, numbered by time inside their site, with their site's place."""
    raw = _raw_seine(spark, folder, "site", "haul")
    out = seine.stage_seine(raw, _reach_river(spark), "160se")["haul"]
    return out.select("id_haul", "id_site", "h_idx", "s_idx", "pass", "cd_rch", "cd_rvr")


@query(_SEINE_SQL + "SELECT f.id_haul, f.id_site, cd_spp, n_fish, tot_length, cd_disp, h.pass, h.cd_rch FROM f LEFT JOIN h ON f.id_haul = h.id_haul")
def stage_seine_fish(spark: SparkSession, folder: str) -> DataFrame:
    """Seine fish and counts from raw tables, as one table."""
    raw = _raw_seine(spark, folder, "site", "haul", "fish", "count")
    out = seine.stage_seine(raw, _reach_river(spark), "160se")["fish"]
    return out.select("id_haul", "id_site", "cd_spp", "n_fish", "tot_length", "cd_disp", "pass", "cd_rch")


@query(
    _SEINE_SQL
    + """, hd AS (SELECT * FROM k WHERE o_orderkey % 11 > 0 AND o_orderkey % 7 > 0)
SELECT id_haul, loc1_depth, loc2_sub_1, mx_sub_2 FROM hd LEFT JOIN (SELECT l_orderkey, min(qty) FILTER (l_linenumber = 1) AS loc1_depth, min(flag) FILTER (l_linenumber = 2) AS loc2_sub_1,
    min(species) FILTER (l_linenumber = 3) AS mx_sub_2 FROM lf GROUP BY 1) ON l_orderkey = o_orderkey"""
)
def stage_seine_depth(spark: SparkSession, folder: str) -> DataFrame:
    """Seine hauls with the depths measured at three places."""
    raw = _raw_seine(spark, folder, "site", "haul", "depth")
    out = seine.stage_seine(raw, _reach_river(spark), "160se", depths=True)["haul"]
    return out.select("id_haul", "loc1_depth", "loc2_sub_1", "mx_sub_2")


def _seine(spark: SparkSession, folder: str, max_weight: int | None = None) -> DataFrame:
    raw = _raw_seine(spark, folder, "site", "haul", "fish", "count")
    staged = _proofed(spark, seine.stage_seine(raw, _reach_river(spark), "160se"))
    path = new_folder(spark, "facts")
    rejected = seine.load_seine(staged, path, max_weight=max_weight)
    return io.scan(spark, path).unionByName(rejected.drop("batch"), allowMissingColumns=True)


@query(
    _SEINE_SQL
    + f""", s AS (SELECT o_custkey, id_site, pass, {s._case('cd_rch', RIVER_OF_REACH)} AS river FROM k GROUP BY ALL),
n AS (SELECT h.id_site, count(DISTINCT h.id_haul) AS hauls, count(f.cd_spp) + count(CASE WHEN f.id_haul IS NOT NULL AND f.cd_spp IS NULL THEN 1 END) AS rows, coalesce(CAST(sum(f.n_fish) AS BIGINT), 0) AS n_fish FROM h LEFT JOIN f ON f.id_haul = h.id_haul GROUP BY 1)
SELECT s.id_site AS "SiteID", '160se' AS "StudyCode", river AS "RiverCode", pass AS "PassIdentifier", nullif(CAST(o_custkey % 100 AS DOUBLE), 0) AS "SiteLocation_BelknapMiles", DATE '2021-01-01' + CAST(o_custkey % 300 AS INTEGER) AS "SiteDate_Local",
    nullif(o_custkey % 50, 0) AS "SiteLength_m", nullif(o_custkey % 20, 0) AS "SiteWidth_m", o_custkey % 2 = 0 AS "IsAlgaePresent", CASE WHEN river IS NULL THEN 'RiverCode is required' ELSE '' END AS failed, o_custkey % 4 = 0 AS bottom,
    nullif(CAST(o_custkey % 30 AS DOUBLE), 0) AS temperature, CASE WHEN o_custkey % 3 = 0 THEN 'Secchi at bottom' END AS note, coalesce(hauls, 0) AS hauls, coalesce(rows, 0) AS fish_rows, coalesce(n_fish, 0) AS n_fish
FROM s LEFT JOIN n USING (id_site)"""
)
def seine_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Nested seine facts from raw tables: every site, accepted or rejected, with its water and the totals of its hauls. Fish of hauls that were dropped have no place to be nested in."""
    zero = F.lit(0).cast("long")
    hauls = F.size(F.filter("HaulData", lambda haul: haul["Part"] == 0))
    rows = F.aggregate("HaulData", zero, lambda total, haul: total + F.size(haul["FishData"]))
    fish = F.aggregate(
        "HaulData",
        zero,
        lambda total, haul: total + F.aggregate(haul["FishData"], zero, lambda inner, x: inner + F.coalesce(x["FishCount"], zero)),
    )
    water = F.try_element_at("WaterQuality", F.lit(1))
    names = ["SiteID", "StudyCode", "RiverCode", "PassIdentifier", "SiteLocation_BelknapMiles", "SiteDate_Local", "SiteLength_m", "SiteWidth_m", "IsAlgaePresent"]
    return _seine(spark, folder).groupBy(*names, _failed()).agg(
        F.max(water["IsSecchiMaxDepth"]).alias("bottom"),
        F.max(water["WaterTemperatureMain_C"]).alias("temperature"),
        F.max(water["WaterQualityNotes"]).alias("note"),
        F.sum(hauls).cast("long").alias("hauls"),
        F.sum(rows).alias("fish_rows"),
        F.sum(fish).alias("n_fish"),
    )


@query(
    _SEINE_SQL
    + """SELECT h.id_site AS "SiteID", h.id_haul AS "HaulID", TIMESTAMP '2021-01-01' + to_days(CAST(h.o_custkey % 300 AS INTEGER)) + to_seconds(h.o_orderkey % 86400) AS "HaulDateTime_Local", h.o_orderkey % 11 AS "HaulLength_m",
    CAST(h.o_orderkey % 7 AS DOUBLE) AS "HaulWidth_m", h.o_orderkey % 5 * 100 AS "HaulMeanDepth_mm", h.o_orderkey % 2 = 0 AS "HasRedShiner", CAST(NULL AS BOOLEAN) AS "HasSandShiner", false AS "HasFatHead",
    count(f.id_haul) AS fish_rows, coalesce(CAST(sum(f.n_fish) AS BIGINT), 0) AS n_fish, min(tot_length) AS shortest, count(cd_disp) AS with_disposition
FROM h LEFT JOIN f ON f.id_haul = h.id_haul GROUP BY ALL"""
)
def seine_hauls(spark: SparkSession, folder: str) -> DataFrame:
    """Every haul of the facts with its fish, from facts cut into parts of two rows and put together again."""
    facts = _seine(spark, folder, max_weight=2)
    hauls = facts.select("SiteID", F.explode("HaulData").alias("h")).select("SiteID", "h.*")
    whole = merge_parts(hauls, ["SiteID", "HaulID"], ["FishData", "HaulVial"])
    names = ["SiteID", "HaulID", "HaulDateTime_Local", "HaulLength_m", "HaulWidth_m", "HaulMeanDepth_mm", "HasRedShiner", "HasSandShiner", "HasFatHead"]
    zero = F.lit(0).cast("long")
    return whole.select(
        *names,
        F.size("FishData").cast("long").alias("fish_rows"),
        F.aggregate("FishData", zero, lambda total, x: total + F.coalesce(x["FishCount"], zero)).alias("n_fish"),
        F.array_min(F.col("FishData")["TotalLength_mm"]).alias("shortest"),
        F.size(F.filter("FishData", lambda x: x["DispositionCode"].isNotNull())).cast("long").alias("with_disposition"),
    )


# ----- seine products ---------------------------------------------------------------------------------
def _store(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    cust = F.col("c_custkey")
    site = s.table(spark, folder, "customer").select(
        cust.alias("site_id"),
        (F.lit(2020) + cust % 2).alias("year"),
        F.col("c_nationkey").cast("long").alias("reach"),
        (cust % 50).alias("hab_length"),
        (cust % 20).alias("hab_width"),
    )
    order = F.col("o_orderkey")
    haul = s.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("site_id"),
        order.alias("haul_id"),
        (order % 3 + 1).alias("haul_num"),
        (order % 11 + 1).alias("haul_length"),
        (order % 7 + 1).alias("haul_width"),
        (order % 2 + 1).alias("prim_sec"),
    )
    counts = s.haul_counts(spark, folder)
    fish = s.fish(spark, folder).select(
        F.col("SiteID").alias("haul_id"), F.col("SpeciesCode").alias("species"), F.col("TotalLength_mm").alias("tot_length")
    )
    return {"site": site, "haul": haul, "in_count": counts, "fish": fish}


@query(
    """, h AS (SELECT o_custkey AS site_id, o_orderkey AS haul_id, (o_orderkey % 11 + 1) * (o_orderkey % 7 + 1) AS area FROM orders WHERE o_custkey % 2 = 1),
a AS (SELECT site_id, CAST(sum(area) AS BIGINT) AS haul_area FROM h GROUP BY 1), c AS (SELECT site_id, CAST(sum("FishCount") AS BIGINT) AS n FROM h JOIN fish ON haul_id = "SiteID" WHERE "SpeciesCode" = 'CS' GROUP BY 1)
SELECT c_custkey AS site_id, CAST(c_nationkey AS BIGINT) AS reach, (c_custkey % 50) * (c_custkey % 20) AS hab_area, haul_area, coalesce(n, 0) AS "CS"
FROM customer LEFT JOIN a ON a.site_id = c_custkey LEFT JOIN c ON c.site_id = c_custkey WHERE c_custkey % 2 = 1""",
    ["fish"],
)
def product_site(spark: SparkSession, folder: str) -> DataFrame:
    """Product table of one year's seine sites: habitat and haul area, catch of the target."""
    out = products.seine_products(_store(spark, folder), 2021)["site"]
    return out.select("site_id", "reach", "hab_area", "haul_area", "CS")


@query(
    """SELECT site_id, reach, "SpeciesCode" AS species, "TotalLength_mm" AS tot_length FROM fish
LEFT JOIN (SELECT o_orderkey, o_custkey AS site_id, CAST(c_nationkey AS BIGINT) AS reach FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey % 2 = 1) ON o_orderkey = "SiteID" """,
    ["fish"],
)
def product_fish(spark: SparkSession, folder: str) -> DataFrame:
    return products.seine_products(_store(spark, folder), 2021)["fish"]


# ----- sources and sinks --------------------------------------------------------------------------------
@query(
    """SELECT o_orderkey AS "SiteID", '123d' AS "StudyCode", o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1998"""
)
def append_and_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Two guarded appends to a store partitioned by year, a refused third, and a pruned scan."""
    orders = s.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("SiteID"), F.lit("123d").alias("StudyCode"), "o_custkey", "o_totalprice",
        F.year("o_orderdate").cast("long").alias("Year"),
    )
    path = new_folder(spark, "store")
    store.append_guarded(orders.where("Year < 1998"), path)
    store.append_guarded(orders.where("Year >= 1998"), path)
    store.append_guarded(orders.where("Year < 1998").repartition(3), path, skip_repeats=True)  # the very same rows
    try:
        store.append_guarded(orders.where("o_orderkey % 7 = 0 AND Year >= 1997"), path)
    except store.DuplicateKeys:
        return io.scan(spark, path, "123d", 1998).drop("Year")
    raise AssertionError("a batch that was stored before must be refused")


@query(
    """SELECT CAST("SiteID" AS VARCHAR) AS id_site, "SpeciesCode" AS cd_spp, 'name of ' || "SpeciesCode" AS cn_spp, "FishCount" AS n_fish, '123d' AS file_study, CAST(2021 AS BIGINT) AS file_year FROM catch""",
    ["fish", "catch"],
)
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Report extract written as CSV with NA for missing values, and read back by its file name."""
    root = new_folder(spark, "extract")
    counts = s.catch(spark, folder).select(
        F.col("SiteID").cast("string").alias("id_site"),
        F.col("SpeciesCode").alias("cd_spp"),
        F.concat(F.lit("name of "), F.col("SpeciesCode")).alias("cn_spp"),
        F.col("FishCount").alias("n_fish"),
    )
    io.write_product(counts, f"{root}/123d_2021_ar-count.csv")
    return io.read_report_csvs(spark, root, {"count": schemas.REPORT_TABLES["count"]})["count"]


@query("SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def stage_and_read(spark: SparkSession, folder: str) -> DataFrame:
    """Staging creates a table, appends to it, and leaves empty tables out."""
    orders = s.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    root = new_folder(spark, "staging")
    io.stage({"site": orders, "none": orders.where("o_orderstatus = 'nothing'")}, root)
    io.stage({"site": orders.where("o_orderstatus = 'P'")}, root)
    return io.read_staged(spark, root, ["site", "none"])["site"]


@query(
    """SELECT "SiteID", 'x' AS "StudyCode", "RiverCode", CAST(effort AS BIGINT) AS "Effort_Seconds", ts AS "StartDateTime_UTC", CAST(NULL AS VARCHAR) AS "Shoreline", CAST(0 AS BIGINT) AS n_fish
FROM (SELECT CAST("SiteID" AS VARCHAR) AS "SiteID", "RiverCode", effort, ts FROM sites)""",
    ["sites"],
)
def conform_sites(spark: SparkSession, folder: str) -> DataFrame:
    """Flat sites brought to the fact schema: casts, absent columns, empty arrays."""
    sites = s.sites(spark, folder).withColumns({"StudyCode": F.lit("x"), "Part": F.lit(0), "extra": F.lit(1)})
    facts = io.conform(sites, schemas.F_ELECTROFISH)
    return facts.select(
        "SiteID", "StudyCode", "RiverCode", "Effort_Seconds", F.col("StartDateTime_UTC").cast("timestamp_ntz").alias("StartDateTime_UTC"),
        "Shoreline", F.size("FishData").cast("long").alias("n_fish"),
    )
