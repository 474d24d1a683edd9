"""Survey-shaped frames over the driver tables.

orders stand for sampling sites, lineitem with part for fish, events for daily water values and
tag detections. Every frame covers its whole source tables. ``SQL`` holds the same frames as
common table expressions for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: how driver codes stand for survey codes ------------------------------
SPECIES = {"ECONOMY": "SM", "STANDARD": "WE", "MEDIUM": "CS", "LARGE": "RZ", "PROMO": "NP", "SMALL": "BT"}
RIVERS = {"F": "GR", "O": "CO", "P": "SJ"}
STUDIES = {"1-URGENT": "123a", "2-HIGH": "123d"}
REACHES = {0: "ECHO", 1: "DESO", 2: "LGR", 3: "LCO", 4: "WW", 5: "LSJ"}
DISPOSITIONS = {"A": "DE", "N": "RA"}
STAGE_LIMITS = [  # life-stage code, stage, shortest and longest fish (mm), species
    ("ls_1", "SUB-JUV", 0, 299, "SM WE"),
    ("ls_1", "JUV", 300, 599, "SM WE"),
    ("ls_1", "ADULT", 600, 2000, "SM WE"),
    ("ls_2", "SUB-JUV", 0, 399, "NP"),
    ("ls_2", "ADULT", 400, 2000, "NP"),
]
REPORT_STATIONS = {0: "GR", 1: "CO", 2: "SJ"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mapped(column: str, codes: dict, otherwise: Column | None = None) -> Column:
    chain = F
    for key, value in codes.items():
        chain = chain.when(F.col(column) == key, value)
    return chain.otherwise(otherwise) if otherwise is not None else chain


def _case(column: str, codes: dict, otherwise: str = "NULL") -> str:
    def text(key: object) -> str:
        return f"'{key}'" if isinstance(key, str) else str(key)

    whens = " ".join(f"WHEN {text(k)} THEN '{v}'" for k, v in codes.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


def _tenth_miles() -> Column:
    return (F.floor("o_totalprice").cast("long") % 3450) / F.lit(10.0)


def sites(spark: SparkSession, folder: str) -> DataFrame:
    """One site per order."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("SiteID"),
        mapped("o_orderpriority", STUDIES, F.col("o_orderpriority")).alias("StudyCode"),
        mapped("o_orderstatus", RIVERS).alias("RiverCode"),
        _tenth_miles().alias("StartLocation_BelknapMiles"),
        F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate").cast("timestamp")).alias("StartDateTime_UTC"),
        F.floor(F.col("o_totalprice") / 100).cast("long").alias("Effort_Seconds"),
    )


def species_of_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Species per part; the smallest parts have none."""
    code = F.when(F.col("p_size") != 1, mapped("p_type", SPECIES))
    return table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), code.alias("species"))


def fish(spark: SparkSession, folder: str) -> DataFrame:
    """One fish per line item."""
    lines = table(spark, folder, "lineitem").join(species_of_parts(spark, folder), "l_partkey")
    length = F.when(F.col("l_linenumber") != 7, F.floor(F.col("l_extendedprice") / 100).cast("long"))
    return lines.select(
        F.col("l_orderkey").alias("SiteID"),
        F.col("species").alias("SpeciesCode"),
        F.col("l_quantity").cast("long").alias("FishCount"),
        length.alias("TotalLength_mm"),
        F.col("l_linenumber").cast("long").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_shipdate").cast("timestamp").alias("seen"),
    )


def catch(spark: SparkSession, folder: str, rows: bool = False) -> DataFrame:
    """Fish per site and species."""
    value = F.count(F.lit(1)) if rows else F.sum("FishCount")
    return fish(spark, folder).groupBy("SiteID", "SpeciesCode").agg(value.alias("FishCount"))


def report_site(spark: SparkSession, folder: str) -> DataFrame:
    """Report extract of sites, with sampling days in the season that events cover."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    day = F.timestamp_add("DAY", F.col("o_orderkey") % 40, start)
    return table(spark, folder, "orders").select(
        F.lit("123d").alias("cd_study"),
        mapped("o_orderstatus", RIVERS).alias("cd_rvr"),
        F.concat(mapped("o_orderstatus", RIVERS), F.lit(" River")).alias("nm_rvr"),
        F.col("o_orderkey").cast("string").alias("id_site"),
        F.timestamp_add("SECOND", (F.col("o_orderkey") * 37) % 86400, day).alias("tm_end"),
        (_tenth_miles() / 2).alias("rmi_start_bel"),
        (_tenth_miles() / 2 - 1).alias("rmi_end_bel"),
        F.floor(F.col("o_totalprice") / 100).cast("long").alias("amt_effort_sec"),
    )


def report_fish(spark: SparkSession, folder: str) -> DataFrame:
    return fish(spark, folder).select(
        F.col("SiteID").cast("string").alias("id_site"),
        F.col("SpeciesCode").alias("cd_spp"),
        F.concat(F.lit("name of "), F.col("SpeciesCode")).alias("cn_spp"),
        F.col("FishCount").alias("n_fish"),
        F.col("TotalLength_mm").alias("tot_length"),
    )


def report_count(spark: SparkSession, folder: str) -> DataFrame:
    return catch(spark, folder).where("SpeciesCode IS NOT NULL").select(
        F.col("SiteID").cast("string").alias("id_site"),
        F.col("SpeciesCode").alias("cd_spp"),
        F.concat(F.lit("name of "), F.col("SpeciesCode")).alias("cn_spp"),
        F.col("FishCount").alias("n_fish"),
    )


def daily_values(spark: SparkSession, folder: str) -> DataFrame:
    """Daily station values: the largest click (discharge) and view (temperature) per user and day."""
    events = table(spark, folder, "events").where(F.col("event_type").isin("click", "view"))
    code = F.when(F.col("event_type") == "click", "00060").otherwise("00010")
    return events.groupBy(
        F.col("user_id").cast("string").alias("staid"), code.alias("parameter"), F.to_date("ts").alias("dates")
    ).agg(F.max("value").alias("val"))


def report_water(spark: SparkSession, folder: str) -> DataFrame:
    """One series per river, as in the report extract."""
    events = table(spark, folder, "events").where(F.col("event_type").isin("click", "view"))
    river = mapped("_station", REPORT_STATIONS)
    keyed = events.withColumn("_station", F.col("user_id") % 3)
    click, view = F.col("event_type") == "click", F.col("event_type") == "view"
    return keyed.groupBy(
        F.col("_station").cast("string").alias("staid"), F.to_date("ts").alias("date"), river.alias("cd_rvr")
    ).agg(
        F.max(F.when(click, F.floor(F.col("value") * 100))).cast("double").alias("discharge"),
        F.max(F.when(view, F.round(F.col("value").cast("decimal(18,6)"), 1).cast("double"))).alias("temp"),
    )


def stages(spark: SparkSession) -> DataFrame:
    """Length ranges of the life stages; a parameter table of the queries."""
    rows = [(code, name, low, high, name.title(), None, codes) for code, name, low, high, codes in STAGE_LIMITS]
    return spark.createDataFrame(
        rows,
        "LifeStageCode string, LifeStageAbbr string, MinTotalLength_mm long, MaxTotalLength_mm long, "
        "LifeStageName string, LifeStageDescription string, AssociatedSpeciesCodes string",
    )


def species_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Species found among the parts, with their life-stage codes."""
    codes = F.when(F.col("species").isin("SM", "WE"), "ls_1").when(F.col("species") == "NP", "ls_2")
    found = species_of_parts(spark, folder).where("species IS NOT NULL").select("species").distinct()
    return found.select(
        F.col("species").alias("SpeciesCode"),
        F.concat(F.lit("name of "), F.col("species")).alias("CommonName"),
        codes.alias("LifeStageCode"),
    )


def check_site(spark: SparkSession, folder: str) -> DataFrame:
    """Staged sites for the quality checks."""
    mile = _tenth_miles()
    start = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate").cast("timestamp"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("s_index"),
        F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("site_id"),
        mapped_mod("o_custkey", 7, REACHES).alias("reach"),
        F.col("o_orderpriority").alias("pass"),
        start.alias("startdatetime"),
        F.timestamp_add("SECOND", F.col("o_orderkey") % 7200, start).alias("enddatetime"),
        mile.alias("start_rmi"),
        (mile - (F.col("o_custkey") % 8) + 1).alias("end_rmi"),
        F.floor(F.col("o_totalprice") / 100).cast("long").alias("el_sec"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("crew"),
        F.col("o_orderkey").alias("key_a"),
    )


def mapped_mod(column: str, modulus: int, codes: dict) -> Column:
    chain = F
    for key, value in codes.items():
        chain = chain.when(F.col(column) % modulus == key, value)
    return chain


def check_fish(spark: SparkSession, folder: str) -> DataFrame:
    """Staged fish for the quality checks; the last line of a site has lost its index."""
    lines = table(spark, folder, "lineitem").join(species_of_parts(spark, folder), "l_partkey")
    return lines.select(
        F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("s_index"),
        F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("site_id"),
        F.col("l_orderkey").alias("key_a"),
        mapped_mod("l_suppkey", 7, REACHES).alias("reach"),
        (F.col("l_partkey") % 350).cast("double").alias("rmi"),
        "species",
        F.floor(F.col("l_extendedprice") / 60).cast("long").alias("tot_length"),
        (F.col("l_quantity") * 100).cast("long").alias("weight"),
        mapped("l_returnflag", DISPOSITIONS).alias("disp"),
    )


def hauls(spark: SparkSession, folder: str) -> DataFrame:
    """One haul per order: the customer is the site, the nation its reach."""
    orders = table(spark, folder, "orders")
    places = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("reach"))
    return orders.join(places, "o_custkey").select(
        F.col("o_custkey").alias("site_id"),
        F.col("o_orderkey").alias("haul_id"),
        "reach",
        (F.floor("o_totalprice").cast("long") % 40 + 1).alias("haul_area"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).cast("long").alias("prim_sec"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(2).cast("long").alias("haul_num"),
    )


def haul_counts(spark: SparkSession, folder: str) -> DataFrame:
    return fish(spark, folder).select(
        F.col("SiteID").alias("haul_id"), F.col("SpeciesCode").alias("species"), F.col("FishCount").alias("fish_count")
    )


def antenna(spark: SparkSession, folder: str) -> DataFrame:
    """Flat tag detections, one per event, with their deployment (user and day)."""
    number = F.get_json_object("props", "$.k").cast("long")
    return table(spark, folder, "events").select(
        F.lit("123d").alias("StudyCode"),
        mapped_mod("user_id", 3, REPORT_STATIONS).alias("RiverCode"),
        F.col("user_id").cast("string").alias("SiteName"),
        F.to_date("ts").cast("timestamp").alias("DeploymentTimeStamp_UTC"),
        F.col("user_id").cast("double").alias("AntennaLocation_X"),
        F.lit(0.0).alias("AntennaLocation_Y"),
        F.lit(32612).cast("long").alias("AntennaLocationEPSGCode"),
        F.col("ts").cast("timestamp").alias("DetectionTimeStamp_UTC"),
        F.format_string("3D9.%02d", number).alias("PitTagHex"),
        F.col("event_id"),
    )


def tag_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Species per tag, from the parts whose number ends alike; half of the tags are unknown."""
    parts = species_of_parts(spark, folder).groupBy((F.col("l_partkey") * 2 % 100).alias("_n")).agg(F.min("species").alias("SpeciesCode"))
    return parts.select(F.format_string("3D9%02d", "_n").alias("PitTagString"), "SpeciesCode")


# ----- the same frames as SQL ------------------------------------------------------------
_MILE = "CAST(CAST(floor(o_totalprice) AS BIGINT) % 3450 AS DOUBLE) / CAST(10 AS DOUBLE)"
_START = "(o_orderdate + to_seconds(o_orderkey % 86400))"
_EFFORT = "CAST(floor(o_totalprice / 100) AS BIGINT)"
_SPECIES = f"CASE WHEN p_size <> 1 THEN {_case('p_type', SPECIES)} END"

SQL = {
    "sites": f"""SELECT o_orderkey AS "SiteID", {_case('o_orderpriority', STUDIES, 'o_orderpriority')} AS "StudyCode",
        {_case('o_orderstatus', RIVERS)} AS "RiverCode", {_MILE} AS mile, {_START} AS ts, {_EFFORT} AS effort
        FROM orders""",
    "fish": f"""SELECT l_orderkey AS "SiteID", {_SPECIES} AS "SpeciesCode", CAST(l_quantity AS BIGINT) AS "FishCount",
        CASE WHEN l_linenumber <> 7 THEN CAST(floor(l_extendedprice / 100) AS BIGINT) END AS "TotalLength_mm",
        CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part, l_suppkey AS supplier, l_shipdate AS seen
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "catch": """SELECT "SiteID", "SpeciesCode", CAST(sum("FishCount") AS BIGINT) AS "FishCount" FROM fish GROUP BY 1, 2""",
    "report_site": f"""SELECT '123d' AS cd_study, {_case('o_orderstatus', RIVERS)} AS cd_rvr,
        {_case('o_orderstatus', RIVERS)} || ' River' AS nm_rvr, CAST(o_orderkey AS VARCHAR) AS id_site,
        TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 40 AS INTEGER)) + to_seconds((o_orderkey * 37) % 86400) AS tm_end,
        {_MILE} / 2 AS rmi_start_bel, {_MILE} / 2 - 1 AS rmi_end_bel, {_EFFORT} AS amt_effort_sec FROM orders""",
    "report_fish": """SELECT CAST("SiteID" AS VARCHAR) AS id_site, "SpeciesCode" AS cd_spp,
        'name of ' || "SpeciesCode" AS cn_spp, "FishCount" AS n_fish, "TotalLength_mm" AS tot_length FROM fish""",
    "report_count": """SELECT CAST("SiteID" AS VARCHAR) AS id_site, "SpeciesCode" AS cd_spp,
        'name of ' || "SpeciesCode" AS cn_spp, "FishCount" AS n_fish FROM catch WHERE "SpeciesCode" IS NOT NULL""",
    "daily_values": """SELECT CAST(user_id AS VARCHAR) AS staid,
        CASE WHEN event_type = 'click' THEN '00060' ELSE '00010' END AS parameter, CAST(ts AS DATE) AS dates,
        max(value) AS val FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2, 3""",
    "report_water": f"""SELECT CAST(user_id % 3 AS VARCHAR) AS staid, CAST(ts AS DATE) AS date,
        {_case('user_id % 3', REPORT_STATIONS)} AS cd_rvr,
        CAST(max(CASE WHEN event_type = 'click' THEN floor(value * 100) END) AS DOUBLE) AS discharge,
        max(CASE WHEN event_type = 'view' THEN CAST(round(CAST(value AS DECIMAL(18,6)), 1) AS DOUBLE) END) AS temp
        FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2, 3""",
    "stages": "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', '{n}', {lo}, {hi}, '{s}')" for c, n, lo, hi, s in STAGE_LIMITS)
    + ") AS v(code, stage, low, high, codes)",
    "species_dim": f"""SELECT DISTINCT {_SPECIES} AS "SpeciesCode", 'name of ' || ({_SPECIES}) AS "CommonName",
        CASE WHEN ({_SPECIES}) IN ('SM', 'WE') THEN 'ls_1' WHEN ({_SPECIES}) = 'NP' THEN 'ls_2' END AS "LifeStageCode"
        FROM part WHERE p_size <> 1""",
    "check_site": f"""SELECT o_orderkey AS s_index, 'S' || CAST(o_orderkey AS VARCHAR) AS site_id,
        {_case('o_custkey % 7', REACHES)} AS reach, o_orderpriority AS pass, {_START} AS startdatetime,
        {_START} + to_seconds(o_orderkey % 7200) AS enddatetime, {_MILE} AS start_rmi,
        {_MILE} - (o_custkey % 8) + 1 AS end_rmi, {_EFFORT} AS el_sec, nullif(o_orderstatus, 'P') AS crew,
        o_orderkey AS key_a FROM orders""",
    "check_fish": f"""SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS s_index,
        'S' || CAST(l_orderkey AS VARCHAR) AS site_id, l_orderkey AS key_a, {_case('l_suppkey % 7', REACHES)} AS reach,
        CAST(l_partkey % 350 AS DOUBLE) AS rmi, {_SPECIES} AS species,
        CAST(floor(l_extendedprice / 60) AS BIGINT) AS tot_length, CAST(l_quantity * 100 AS BIGINT) AS weight,
        {_case('l_returnflag', DISPOSITIONS)} AS disp FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "hauls": """SELECT o_custkey AS site_id, o_orderkey AS haul_id, CAST(c_nationkey AS BIGINT) AS reach,
        CAST(floor(o_totalprice) AS BIGINT) % 40 + 1 AS haul_area,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS prim_sec,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 2 END AS haul_num
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "haul_counts": """SELECT "SiteID" AS haul_id, "SpeciesCode" AS species, "FishCount" AS fish_count FROM fish""",
    "antenna": f"""SELECT '123d' AS "StudyCode", {_case('user_id % 3', REPORT_STATIONS)} AS "RiverCode",
        CAST(user_id AS VARCHAR) AS "SiteName", CAST(ts AS DATE) AS deployed, ts AS seen,
        CAST(user_id AS DOUBLE) AS x, printf('3D9.%02d', CAST(json_extract_string(props, '$.k') AS BIGINT)) AS hex
        FROM events""",
    "tag_dim": f"""SELECT printf('3D9%02d', l * 2 % 100) AS tag, min(species) AS species
        FROM (SELECT p_partkey AS l, {_SPECIES} AS species FROM part) GROUP BY 1""",
}
_NEEDS = {"catch": ["fish"], "report_fish": ["fish"], "report_count": ["fish", "catch"], "haul_counts": ["fish"]}


def with_frames(names: list[str], body: str) -> str:
    """``body`` after the common table expressions it uses."""
    wanted: list[str] = []
    for name in names:
        for part in [*_NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    frames = ",\n".join(f"{name} AS ({SQL[name]})" for name in wanted)
    return f"WITH {frames}\n{body}" if not body.lstrip().startswith(",") else f"WITH {frames}{body}"
