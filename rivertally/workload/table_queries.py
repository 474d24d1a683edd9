"""Queries of the cleaning, join, ordering, reshaping, quality and view operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivertally import fixed_values as fixed
from rivertally.functions import cleaning as c
from rivertally.functions import geo, times
from rivertally.functions.numbers import area, round_to
from rivertally.operators import joins, ordered, quality, reshape, stats
from rivertally.plans import dimensions, reports, views
from rivertally.sources.tables import union_like
from rivertally.workload import standins as s
from rivertally.workload.rate_queries import nested_facts
from rivertally.workload.registry import query, rounded

_REACH_CHECK = "(" + " OR ".join(
    f"(reach = '{reach}' AND {{0}} BETWEEN {lo} AND {hi} AND {{1}} BETWEEN {lo} AND {hi})"
    for reach, (lo, hi) in fixed.REACH_LIMITS.items()
) + ")"
_NATIVE = ", ".join(f"'{x}'" for x in fixed.NATIVE_SPECIES)
_COMMON = ", ".join(f"'{x}'" for x in fixed.COMMON_SPECIES)


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'FLAG' WHEN NOT ({condition}) THEN '' END"


# ----- quality flags ---------------------------------------------------------------------
_QC_SITE = f"""SELECT s_index, site_id, reach, start_rmi, end_rmi, el_sec,
    {_flag('start_rmi - end_rmi > 5 OR start_rmi < end_rmi')} AS rmi_length_flg,
    CASE WHEN {_REACH_CHECK.format('start_rmi', 'end_rmi')} THEN '' ELSE 'FLAG' END AS rmi_flg,
    {_flag('date_diff(\'second\', startdatetime, enddatetime) < el_sec')} AS datetime_flg,
    {_flag('el_sec > 7200 OR el_sec < 1000')} AS el_sec_flg,
    {_flag('reach IS NULL OR crew IS NULL')} AS "NA_flg" FROM check_site"""
_SITE_FLAGS = ["rmi_length_flg", "rmi_flg", "datetime_flg", "el_sec_flg", "NA_flg"]


def _qc_site_rows(spark: SparkSession, folder: str) -> DataFrame:
    checked = quality.qc_site(s.check_site(spark, folder).drop("key_a"))
    return checked.select("s_index", "site_id", "reach", "start_rmi", "end_rmi", "el_sec", *_SITE_FLAGS)


@query(_QC_SITE, ["check_site"])
def qc_site(spark: SparkSession, folder: str) -> DataFrame:
    return _qc_site_rows(spark, folder)


@query(
    f", q AS ({_QC_SITE}) SELECT * FROM q WHERE " + " OR ".join(f"coalesce(\"{f}\" = 'FLAG', false)" for f in _SITE_FLAGS),
    ["check_site"],
)
def qc_site_flagged(spark: SparkSession, folder: str) -> DataFrame:
    return quality.only_flagged(_qc_site_rows(spark, folder))


@query(
    f"""
, j AS (SELECT coalesce(s.s_index, f.s_index) AS s_index, coalesce(s.site_id, f.site_id) AS site_id, coalesce(s.key_a, f.key_a) AS key_a,
        f.reach, rmi, species, tot_length, weight, disp
    FROM (SELECT s_index, site_id, key_a FROM check_site) s FULL JOIN check_fish f ON s.s_index = f.s_index AND s.site_id = f.site_id AND s.key_a = f.key_a)
SELECT *, {_flag('s_index IS NULL')} AS orphan_flg, CASE WHEN {_REACH_CHECK.format('rmi', 'rmi')} THEN '' ELSE 'FLAG' END AS rmi_flg,
    {_flag(f'species IS NULL OR species NOT IN ({_COMMON})')} AS species_flg,
    {_flag("(species IS NULL OR species NOT IN ('CC', 'GC', 'NP')) AND tot_length > 1000")} AS tot_length_flg,
    {_flag("(species IS NULL OR species NOT IN ('CC', 'GC', 'NP')) AND weight > 2800")} AS weight_flg,
    {_flag(f"(disp = 'DE' AND coalesce(species IN ({_NATIVE}), false)) OR (disp = 'RA' AND NOT coalesce(species IN ({_NATIVE}), false)) OR disp IS NULL")} AS disp_flg FROM j""",
    ["check_site", "check_fish"],
)
def qc_fish(spark: SparkSession, folder: str) -> DataFrame:
    return quality.qc_fish(s.check_fish(spark, folder), s.check_site(spark, folder))


def _tag_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Tags: one per line item, with numbers of several lengths and some missing values."""
    kind = F.when(F.col("l_linenumber") % 3 == 0, "134").when(F.col("l_linenumber") % 3 == 1, "400").otherwise("100")
    number = F.when(F.col("l_discount") != 0, F.concat(F.lit("3D9"), F.lpad(F.col("l_partkey").cast("string"), 6, "0"), F.repeat(F.lit("F"), (F.col("l_linenumber") * 5 / 3).cast("int"))))
    recap = F.when(F.col("l_tax") == 0, "NNF").when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "N", "N")
    return s.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("key_aa"),
        F.when(F.col("l_returnflag") == "A", "SM").otherwise("WE").alias("species"),
        kind.alias("pit_type"),
        number.alias("pit_num"),
        recap.alias("pit_recap"),
    )


_TAGS = """
tags AS (SELECT l_orderkey AS key_aa, CASE WHEN l_returnflag = 'A' THEN 'SM' ELSE 'WE' END AS species,
    CASE WHEN l_linenumber % 3 = 0 THEN '134' WHEN l_linenumber % 3 = 1 THEN '400' ELSE '100' END AS pit_type,
    CASE WHEN l_discount <> 0 THEN '3D9' || CASE WHEN length(CAST(l_partkey AS VARCHAR)) > 6 THEN left(CAST(l_partkey AS VARCHAR), 6) ELSE lpad(CAST(l_partkey AS VARCHAR), 6, '0') END
        || repeat('F', CAST(trunc(l_linenumber * 5 / CAST(3 AS DOUBLE)) AS INTEGER)) END AS pit_num,
    CASE WHEN l_tax = 0 THEN 'NNF' WHEN l_returnflag = 'A' THEN 'Y' WHEN l_returnflag = 'N' THEN 'N' END AS pit_recap FROM lineitem)"""


@query(
    f"""WITH {_TAGS}, f AS (SELECT o_orderkey AS f_index, o_orderkey AS key_aa, CASE WHEN o_orderstatus = 'F' THEN 'SM' ELSE 'WE' END AS species FROM orders)
SELECT f_index, t.*, {_flag('f_index IS NULL')} AS orphan_flg, {_flag("pit_recap = 'NNF'")} AS nnf_flg,
    {_flag('(pit_recap IS NULL) <> (pit_num IS NULL)')} AS pit_recap_flg,
    CASE WHEN pit_type = '134' AND length(pit_num) <> 14 THEN 'FLAG' WHEN pit_type = '400' AND length(pit_num) <> 9 THEN 'FLAG' END AS invalid_pitnum_flg
FROM tags t LEFT JOIN f ON f.key_aa = t.key_aa AND f.species = t.species"""
)
def qc_pit(spark: SparkSession, folder: str) -> DataFrame:
    fish = s.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("f_index"),
        F.col("o_orderkey").alias("key_aa"),
        F.when(F.col("o_orderstatus") == "F", "SM").otherwise("WE").alias("species"),
    )
    return quality.qc_pit(_tag_rows(spark, folder), fish)


@query(
    f"""WITH {_TAGS} SELECT key_aa AS fl_index, species, pit_num AS floy_num, pit_recap AS floy_recap,
    {_flag('pit_num IS NULL OR pit_recap IS NULL')} AS "NA_flg" FROM tags"""
)
def qc_floy(spark: SparkSession, folder: str) -> DataFrame:
    tags = _tag_rows(spark, folder).select(
        F.col("key_aa").alias("fl_index"), "species", F.col("pit_num").alias("floy_num"), F.col("pit_recap").alias("floy_recap")
    )
    return quality.qc_floy(tags)


@query(
    """SELECT l_orderkey AS id_haul, l_partkey AS cd_spp, c_name AS pass, c_mktsegment AS cd_rvr, CAST(c_nationkey AS BIGINT) AS cd_rch, c_acctbal AS rmi
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey"""
)
def qc_attach(spark: SparkSession, folder: str) -> DataFrame:
    """Fish rows with the place of their haul's site: customers are sites, orders are hauls."""
    site = s.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id_site"), F.col("c_name").alias("pass"), F.col("c_mktsegment").alias("cd_rvr"),
        F.col("c_nationkey").cast("long").alias("cd_rch"), F.col("c_acctbal").alias("rmi"),
    )
    haul = s.table(spark, folder, "orders").select(F.col("o_orderkey").alias("id_haul"), F.col("o_custkey").alias("id_site"))
    fish = s.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id_haul"), F.col("l_partkey").alias("cd_spp"))
    return quality.attach_site(site, haul, {"fish": fish})["fish"]


# ----- numbering and filling --------------------------------------------------------------
@query(
    """WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
new AS (SELECT o_orderkey, (SELECT max(o_orderkey) FROM old) + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS s_index,
    year(o_orderdate) AS y FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old))
SELECT o_orderkey, CAST(s_index AS BIGINT) AS s_index, printf('123d_%d_%03d', y, s_index) AS site_id FROM new"""
)
def site_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Sites that are not yet stored, numbered on from the last stored identifier."""
    orders = s.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    stored = orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", F.format_string("123d_1995_%03d", "o_orderkey").alias("site_id")
    )
    fresh = joins.without_keys(orders, stored, "o_orderkey")
    numbered = ordered.number_rows(
        fresh, ["o_orderdate", "o_orderkey"], "s_index", ordered.last_index(stored, "site_id"), unique=True
    )
    named = numbered.withColumn("study", F.lit("123d"))
    return named.select("o_orderkey", "s_index", c.sample_id("study", F.year("o_orderdate"), "s_index").alias("site_id"))


_HAUL_IDS = """SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_shipdate AS DATE) AS day,
    printf('%s.%02d', CAST(l_orderkey AS VARCHAR), row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_linenumber)) AS id_haul FROM lineitem"""


def _haul_ids(spark: SparkSession, folder: str, **limits: int) -> DataFrame:
    lines = s.table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", "l_partkey", "l_linenumber")
    numbered = ordered.number_within(lines, ["l_orderkey"], ["l_shipdate"], "_n", **limits)
    named = numbered.withColumn("_site", F.col("l_orderkey").cast("string"))
    return named.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), c.haul_id("_site", "_n").alias("id_haul")
    )


@query(_HAUL_IDS)
def haul_ids(spark: SparkSession, folder: str) -> DataFrame:
    return _haul_ids(spark, folder)


@query(_HAUL_IDS)
def haul_ids_spread(spark: SparkSession, folder: str) -> DataFrame:
    """The same numbering by the form for groups too large for one task."""
    return _haul_ids(spark, folder, hot_rows=0)


@query(
    """SELECT o_orderstatus, o_orderpriority, row_number() OVER (ORDER BY o_orderstatus, o_orderpriority) AS idx FROM orders"""
)
def number_with_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Numbering rows of which very many are equal."""
    orders = s.table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority")
    return ordered.number_rows(orders, ["o_orderstatus", "o_orderpriority"], "idx")


_FILL = """SELECT event_id, user_id, last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER
    (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM events"""


def _fill(spark: SparkSession, folder: str, **limits: int) -> DataFrame:
    events = s.table(spark, folder, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    return ordered.fill_down(events, ["user_id"], ["ts", "event_id"], ["value"], **limits).drop("ts")


@query(_FILL)
def forward_fill(spark: SparkSession, folder: str) -> DataFrame:
    return _fill(spark, folder)


@query(_FILL)
def forward_fill_spread(spark: SparkSession, folder: str) -> DataFrame:
    """The same fill by the form for groups too large for one task."""
    return _fill(spark, folder, hot_rows=0)


@query(
    """SELECT user_id, day, event_id, event_type FROM (SELECT *, CAST(ts AS DATE) AS day,
    row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1"""
)
def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    events = s.table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", F.to_date("ts").alias("day"))
    return ordered.first_per_key(events, ["user_id", "day"], ["ts", "event_id"]).select("user_id", "day", "event_id", "event_type")


@query(
    """WITH f AS (SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderdate), o_custkey) AS seq FROM orders GROUP BY o_custkey)
SELECT o_orderkey, o_custkey, seq FROM orders JOIN f USING (o_custkey)"""
)
def group_sequence(spark: SparkSession, folder: str) -> DataFrame:
    orders = s.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ordered.group_sequence(orders, "o_custkey", "o_orderdate", "seq").drop("o_orderdate")


# ----- joins -------------------------------------------------------------------------------
_PLACES = """WITH a AS (SELECT n_regionkey AS k, nullif(n_nationkey, 3) AS n, n_name FROM nation),
b AS (SELECT nullif(CAST(s_nationkey AS INTEGER), 3) AS n, s_suppkey, s_acctbal FROM supplier)"""


def _places(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    nation = s.table(spark, folder, "nation").select(
        F.col("n_regionkey").alias("k"), F.nullif(F.col("n_nationkey"), F.lit(3)).alias("n"), "n_name"
    )
    supplier = s.table(spark, folder, "supplier").select(
        F.nullif(F.col("s_nationkey").cast("int"), F.lit(3)).alias("n"), "s_suppkey", "s_acctbal"
    )
    return nation, supplier


@query(
    _PLACES + "SELECT k, coalesce(a.n, b.n) AS n, n_name, s_suppkey, s_acctbal FROM a FULL JOIN b ON a.n IS NOT DISTINCT FROM b.n"
)
def natural_full(spark: SparkSession, folder: str) -> DataFrame:
    """Full join on the shared column; a missing key matches a missing key."""
    return joins.natural_join(*_places(spark, folder), "full")


@query(
    _PLACES + "SELECT k, b.n, n_name, s_suppkey, s_acctbal FROM a RIGHT JOIN b ON a.n IS NOT DISTINCT FROM b.n"
)
def natural_right(spark: SparkSession, folder: str) -> DataFrame:
    return joins.natural_join(*_places(spark, folder), "right")


@query(_PLACES + "SELECT * FROM a WHERE EXISTS (SELECT 1 FROM b WHERE b.n IS NOT DISTINCT FROM a.n)")
def natural_semi(spark: SparkSession, folder: str) -> DataFrame:
    return joins.natural_join(*_places(spark, folder), "left_semi")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')")
def anti_new_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = s.table(spark, folder, "orders")
    staged = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return joins.without_keys(orders.select("o_orderkey", "o_custkey"), staged, "o_orderkey")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def members_of(spark: SparkSession, folder: str) -> DataFrame:
    ids = s.table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.members_of(s.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"), ids, "l_orderkey")


@query(
    """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
)
def lookup_river(spark: SparkSession, folder: str) -> DataFrame:
    """Two dimension lookups on differently named keys."""
    nation = s.table(spark, folder, "nation").select(F.col("n_nationkey").alias("cd_rch"), "n_name", "n_regionkey")
    region = s.table(spark, folder, "region").select(F.col("r_regionkey").alias("cd_rvr"), "r_name")
    placed = joins.lookup(s.table(spark, folder, "customer").select("c_custkey", "c_nationkey"), nation, {"c_nationkey": "cd_rch"})
    return joins.lookup(placed, region, {"n_regionkey": "cd_rvr"}).select("c_custkey", "n_name", "r_name")


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return s.table(spark, folder, "orders").select("o_custkey", "o_orderstatus").distinct()


# ----- nesting and reshaping -----------------------------------------------------------------
@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem")
def nest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lines = s.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    fields = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    nested = reshape.nest(lines, ["l_orderkey"], fields, "lines", ["l_shipdate", "l_linenumber"])
    return reshape.unnest(nested, "lines", ["l_orderkey"])


@query(
    """WITH n AS (SELECT l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_partkey) AS rn FROM lineitem)
SELECT l_suppkey, (rn - 1) // 100 AS "Part", count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts FROM n GROUP BY 1, 2"""
)
def nest_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Nesting with arrays of at most a hundred rows: large parents continue on further rows."""
    lines = s.table(spark, folder, "lineitem").select("l_suppkey", "l_shipdate", "l_partkey")
    nested = reshape.nest(lines, ["l_suppkey"], ["l_partkey"], "lines", ["l_shipdate", "l_partkey"], max_rows=100)
    summed = F.aggregate("lines", F.lit(0).cast("long"), lambda total, line: total + line["l_partkey"])
    return nested.select("l_suppkey", "Part", F.size("lines").cast("long").alias("n"), summed.alias("parts"))


@query(
    """SELECT user_id, day, min(value) FILTER (event_type = 'click') AS loc1_depth, min(k) FILTER (event_type = 'click') AS loc1_sub,
    min(value) FILTER (event_type = 'view') AS loc2_depth, min(k) FILTER (event_type = 'view') AS loc2_sub,
    min(value) FILTER (event_type = 'error') AS mx_depth, min(k) FILTER (event_type = 'error') AS mx_sub
FROM (SELECT user_id, CAST(ts AS DATE) AS day, event_type, value, json_extract_string(props, '$.k') AS k FROM events) GROUP BY 1, 2"""
)
def pivot_depth(spark: SparkSession, folder: str) -> DataFrame:
    places = {"click": "loc1", "view": "loc2", "error": "mx"}
    events = s.table(spark, folder, "events").select(
        "user_id",
        F.to_date("ts").alias("day"),
        s.mapped("event_type", places).alias("location"),
        F.col("value").alias("depth"),
        F.get_json_object("props", "$.k").alias("sub"),
    )
    return reshape.pivot_wide(events, ["user_id", "day"], "location", ["depth", "sub"], ["loc1", "loc2", "mx"])


@query(
    """, x AS (SELECT code, unnest(string_split(codes, ' ')) AS species FROM stages), m AS (SELECT species, (list(code ORDER BY try_cast(nullif(regexp_extract(code, '[0-9]+$'), '') AS BIGINT) NULLS LAST, code))[1] AS code FROM x GROUP BY 1)
SELECT d."SpeciesCode", "CommonName", m.code AS "LifeStageCode" FROM species_dim d LEFT JOIN m ON d."SpeciesCode" = m.species""",
    ["stages", "species_dim"],
)
def codes_to_lifestage(spark: SparkSession, folder: str) -> DataFrame:
    raw = s.stages(spark).withColumnsRenamed(dimensions.LIFESTAGE_NAMES)
    coded, _ = dimensions.rebuild_species(s.species_dim(spark, folder), raw)
    return coded


@query("SELECT user_id AS id, CASE WHEN event_type <> 'view' THEN value END AS value, CASE event_type WHEN 'click' THEN 'a' WHEN 'view' THEN 'b' ELSE 'c' END AS source FROM events")
def union_like_tables(spark: SparkSession, folder: str) -> DataFrame:
    events = s.table(spark, folder, "events")
    tables = {
        "site": events.where("event_type = 'click'").select(F.col("user_id").alias("id"), "value", F.lit("a").alias("source")),
        "site2": events.where("event_type = 'view'").select(F.col("user_id").alias("id"), F.lit("b").alias("source")),
        "old_site": events.where("event_type not in ('click', 'view')").select(F.lit("c").alias("source"), "value", F.col("user_id").alias("id")),
        "fish": events,
    }
    return union_like(tables, "site")


# ----- cleaning --------------------------------------------------------------------------------
@query(
    """SELECT l_orderkey, nullif(l_returnflag, 'N') AS flag, nullif(l_discount, 0) AS discount, CASE WHEN l_linestatus = 'O' THEN true WHEN l_linestatus = 'F' THEN false END AS open,
    CASE WHEN regexp_matches(note, '^EXP') THEN true WHEN regexp_matches(note, '^INT|NOT') THEN false END AS ripe,
    try_cast(string_split(rays, '/')[1] AS BIGINT) AS dorsal, try_cast(nullif(string_split(rays, '/')[2], '') AS BIGINT) AS anal,
    nullif(regexp_extract(secchi, '.*[Ss]ecchi.*'), '') AS secchi_note
FROM (SELECT *, CASE l_linenumber % 4 WHEN 0 THEN 'EXPRESSING' WHEN 1 THEN 'INTERMEDIATE' WHEN 2 THEN 'NOT RIPE' ELSE 'X' END AS note,
    CASE WHEN l_tax = 0 THEN NULL WHEN l_tax < 0.04 THEN CAST(l_linenumber AS VARCHAR) ELSE CAST(l_linenumber AS VARCHAR) || '/' || CAST(l_suppkey AS VARCHAR) || '/x' END AS rays,
    CASE WHEN l_suppkey % 2 = 0 THEN 'ok' || chr(10) || 'no secchi disk' ELSE 'fine' END AS secchi FROM lineitem)"""
)
def sentinel_clean(spark: SparkSession, folder: str) -> DataFrame:
    line = F.col("l_linenumber")
    rows = s.table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_returnflag").alias("flag"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_linestatus") == "O", "Y").when(F.col("l_linestatus") == "F", "N").alias("open"),
        F.when(line % 4 == 0, "EXPRESSING").when(line % 4 == 1, "INTERMEDIATE").when(line % 4 == 2, "NOT RIPE").otherwise("X").alias("rep_cond"),
        F.when(F.col("l_tax") == 0, None)
        .when(F.col("l_tax") < 0.04, line.cast("string"))
        .otherwise(F.concat_ws("/", line.cast("string"), F.col("l_suppkey").cast("string"), F.lit("x")))
        .alias("ray_ct"),
        F.when(F.col("l_suppkey") % 2 == 0, "ok\nno secchi disk").otherwise("fine").alias("notes"),
    )
    cleaned = c.null_zero(c.null_text(rows, "N", ["flag"]), ["discount"])
    return cleaned.select(
        "l_orderkey",
        "flag",
        "discount",
        c.yes_no("open").alias("open"),
        c.is_ripe().alias("ripe"),
        c.ray_count(1).alias("dorsal"),
        c.ray_count(2).alias("anal"),
        c.secchi_note("notes").alias("secchi_note"),
    )


@query(
    f"""SELECT site_id, reach, start_rmi + CASE WHEN reach IN ('DESO', 'ECHO') THEN 120 ELSE 0 END AS start_rmi,
    end_rmi + CASE WHEN reach IN ('DESO', 'ECHO') THEN 120 ELSE 0 END AS end_rmi, el_sec FROM check_site
    WHERE coalesce(crew IN ('F'), false) AND NOT coalesce(reach IN ('WW'), false)""",
    ["check_site"],
)
def river_mile_correction(spark: SparkSession, folder: str) -> DataFrame:
    rows = c.keep(s.check_site(spark, folder), c.is_in("crew", ["F"]), c.not_in("reach", ["WW"]))
    return c.correct_miles(rows.select("site_id", "reach", "start_rmi", "end_rmi", "el_sec"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'XX' ELSE o_orderstatus END AS river,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS price FROM orders
UNION ALL SELECT -s_suppkey, NULL, s_acctbal FROM supplier"""
)
def corrections(spark: SparkSession, folder: str) -> DataFrame:
    """Stated values overlaid by key, and imputed rows appended."""
    orders = s.table(spark, folder, "orders")
    river = orders.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'").select(
        "o_orderkey", F.lit("river").alias("column"), F.lit("XX").alias("value")
    )
    price = orders.where("o_orderpriority = '5-LOW' AND o_orderstatus = 'F'").select(
        "o_orderkey", F.lit("price").alias("column"), F.lit(None).cast("string").alias("value")
    )
    rows = orders.select("o_orderkey", F.col("o_orderstatus").alias("river"), F.col("o_totalprice").alias("price"))
    extra = s.table(spark, folder, "supplier").select((-F.col("s_suppkey")).alias("o_orderkey"), F.col("s_acctbal").alias("price"))
    return c.append_rows(c.apply_corrections(rows, river.unionByName(price), "o_orderkey"), extra)


@query(
    """SELECT event_id, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month, CAST(ts AS DATE) AS date,
    CAST((dayofyear(ts) - 1) // 7 + 1 AS BIGINT) AS week, CAST(ts - INTERVAL 7 HOUR AS DATE) AS local_date FROM events"""
)
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Date parts of a time, and its date in local time (winter: seven hours behind)."""
    events = s.table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("tm"))
    parts = times.date_parts(events, "tm").withColumn("local_date", F.to_date(times.to_local("tm")))
    return parts.drop("tm")


@query(
    """SELECT o_orderkey, CAST(o_orderdate + to_seconds(o_orderkey % 86400) AS TIMESTAMP) AS started,
    o_orderkey % 60 + 60 * (o_custkey % 100) AS el_sec FROM orders"""
)
def field_times(spark: SparkSession, folder: str) -> DataFrame:
    """Timestamps from date and time texts, and effort from minutes and seconds."""
    secs = F.col("o_orderkey") % 86400
    raw = s.table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("date"),
        F.format_string("%02d:%02d:%02d", F.floor(secs / 3600), F.floor(secs / 60) % 60, secs % 60).alias("starttime"),
        (F.col("o_orderkey") % 60).alias("effort_sec"),
        (F.col("o_custkey") % 100).alias("effort_min"),
    )
    return raw.select(
        "o_orderkey", times.wall_clock("date", "starttime").cast("timestamp_ntz").alias("started"), c.effort_seconds().alias("el_sec")
    )


@query("SELECT p_partkey, p_size * CAST(p_partkey AS BIGINT) AS swept FROM part")
def areas(spark: SparkSession, folder: str) -> DataFrame:
    return s.table(spark, folder, "part").select("p_partkey", area("p_size", "p_partkey").alias("swept"))


# ----- positions ----------------------------------------------------------------------------------
def _utm_sql() -> str:
    radius, alphas = geo._series()
    e = (fixed.WGS84_FLATTENING * (2 - fixed.WGS84_FLATTENING)) ** 0.5
    east = " + ".join(f"{a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(alphas, 1))
    north = " + ".join(f"{a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(alphas, 1))
    return f"""
, pos AS (SELECT "SiteID" AS site_id, line AS rmi, -113 + (part % 400) / CAST(100 AS DOUBLE) AS lon, 38 + (supplier % 300) / CAST(100 AS DOUBLE) AS lat FROM fish),
m AS (SELECT site_id, rmi, avg(lon) AS lon, avg(lat) AS lat, count(*) AS n FROM pos GROUP BY 1, 2),
t AS (SELECT *, sinh(atanh(sin(radians(lat))) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * sin(radians(lat)))) AS t, radians(lon + 111) AS lam FROM m),
x AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t)
SELECT site_id, rmi, n, {rounded(f'500000 + {0.9996 * radius!r}::DOUBLE * (eta + {east})', 2)} AS loc_x,
    {rounded(f'{0.9996 * radius!r}::DOUBLE * (xi + {north})', 2)} AS loc_y FROM x"""


@query(_utm_sql(), ["fish"])
def utm_centroid(spark: SparkSession, folder: str) -> DataFrame:
    """UTM position of every (site, mile), joined back to its fish and counted."""
    fish = s.fish(spark, folder).select(
        F.col("SiteID").alias("site_id"),
        F.col("line").alias("rmi"),
        (F.lit(-113) + (F.col("part") % 400) / F.lit(100.0)).alias("ilon"),
        (F.lit(38) + (F.col("supplier") % 300) / F.lit(100.0)).alias("ilat"),
    )
    placed = geo.attach_positions(fish, ["site_id", "rmi"])
    return placed.groupBy("site_id", "rmi", "loc_x", "loc_y").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"loc_x": round_to("loc_x", 2), "loc_y": round_to("loc_y", 2)}
    )


@query(
    """WITH p AS (SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS x, o_totalprice AS y, CASE o_orderstatus WHEN 'F' THEN 'GR' WHEN 'O' THEN 'CO' ELSE 'SJ' END AS cd_rvr,
    CAST(o_orderkey AS DOUBLE) / 10 AS rmi_nhd FROM orders), b AS (SELECT min(x) x0, max(x) x1, min(y) y0, max(y) y1 FROM p WHERE cd_rvr = 'GR' AND rmi_nhd BETWEEN 100 AND 129.5)
SELECT o_orderkey, x, y FROM p, b WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1"""
)
def reach_crop(spark: SparkSession, folder: str) -> DataFrame:
    points = s.table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("double").alias("x"),
        F.col("o_totalprice").alias("y"),
        s.mapped("o_orderstatus", s.RIVERS).alias("cd_rvr"),
        (F.col("o_orderkey").cast("double") / 10).alias("rmi_nhd"),
    )
    return geo.crop_to_reach(points, points, "GR", 100, 129.5).select("o_orderkey", "x", "y")


# ----- views --------------------------------------------------------------------------------------------
@query(
    """SELECT "StudyCode", CAST(year(deployed) AS BIGINT) AS "Year", "RiverCode", "SiteName", seen AS "DetectionTimeStamp_UTC", replace(hex, '.', '') AS "PitTagString",
    species AS "SpeciesCode", x AS "AntennaLocation_X", CAST(0 AS DOUBLE) AS "AntennaLocation_Y", CAST(32612 AS BIGINT) AS "AntennaLocationEPSGCode"
FROM antenna LEFT JOIN tag_dim ON replace(hex, '.', '') = tag""",
    ["antenna", "tag_dim"],
)
def antenna_join(spark: SparkSession, folder: str) -> DataFrame:
    """Detections nested per deployment, unnested and joined to their tags' species."""
    flat = s.antenna(spark, folder)
    place = [n for n in flat.columns if n not in ("DetectionTimeStamp_UTC", "PitTagHex", "event_id")]
    facts = reshape.nest(flat, place, ["DetectionTimeStamp_UTC", "PitTagHex"], "Detection", ["DetectionTimeStamp_UTC", "event_id"])
    out = views.antenna_analysis(facts, s.tag_dim(spark, folder))
    return out.withColumn("DetectionTimeStamp_UTC", F.col("DetectionTimeStamp_UTC").cast("timestamp_ntz"))


@query(
    """SELECT "SiteID", "StudyCode", "RiverCode", CAST(year(ts) AS BIGINT) AS "Year", "SpeciesCode", "FishCount", "TotalLength_mm", line, seen FROM sites JOIN fish USING ("SiteID")""",
    ["sites", "fish"],
)
def fish_view(spark: SparkSession, folder: str) -> DataFrame:
    return views.fish_view(nested_facts(spark, folder)).withColumn("seen", F.col("seen").cast("timestamp_ntz"))


def _extract(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    sites = s.sites(spark, folder).withColumns(
        {
            "Year": F.year("StartDateTime_UTC").cast("long"),
            "EndDateTime_UTC": F.col("StartDateTime_UTC"),
            "EndLocation_BelknapMiles": F.col("StartLocation_BelknapMiles"),
        }
    )
    fish = s.fish(spark, folder).join(sites.select("SiteID", "StudyCode", "Year"), "SiteID")
    missing = {"Weight_g": "long", "Sex": "string", "IsRipe": "boolean", "DispositionCode": "string", "EncounterEasting_UTM": "double", "EncounterNorthing_UTM": "double"}
    fish = c.with_missing(fish.withColumnRenamed("seen", "EncounterDateTime_UTC"), missing)
    rivers = sites.select("RiverCode").distinct().where("RiverCode <> 'SJ'").withColumn("RiverName", F.concat("RiverCode", F.lit(" River")))
    names = s.species_dim(spark, folder)
    return views.report_extract(sites, fish, s.catch(spark, folder), rivers, names, "123d", 1998)


@query(
    """SELECT "StudyCode" AS cd_study, "RiverCode" AS cd_rvr, CASE WHEN "RiverCode" <> 'SJ' THEN "RiverCode" || ' River' END AS nm_rvr, "SiteID" AS id_site,
    mile AS rmi_start_bel, effort AS amt_effort_sec FROM sites WHERE "StudyCode" = '123d' AND year(ts) = 1998""",
    ["sites"],
)
def report_extract_site(spark: SparkSession, folder: str) -> DataFrame:
    return _extract(spark, folder)["site"].drop("tm_end", "rmi_end_bel")


@query(
    """SELECT "SiteID" AS id_site, "SpeciesCode" AS cd_spp, 'name of ' || "SpeciesCode" AS cn_spp, "FishCount" AS n_fish, "TotalLength_mm" AS tot_length
FROM sites JOIN fish USING ("SiteID") WHERE "StudyCode" = '123d' AND year(ts) = 1998""",
    ["sites", "fish"],
)
def report_extract_fish(spark: SparkSession, folder: str) -> DataFrame:
    return _extract(spark, folder)["fish"].select("id_site", "cd_spp", "cn_spp", "n_fish", "tot_length")


@query(
    """SELECT "SiteID" AS id_site, "SpeciesCode" AS cd_spp, 'name of ' || "SpeciesCode" AS cn_spp, "FishCount" AS n_fish
FROM catch WHERE "SiteID" IN (SELECT "SiteID" FROM sites WHERE "StudyCode" = '123d' AND year(ts) = 1998)""",
    ["sites", "fish", "catch"],
)
def report_extract_count(spark: SparkSession, folder: str) -> DataFrame:
    return _extract(spark, folder)["count"]


@query(
    f"""SELECT event_type, {rounded('quantile_cont(value, 0.1)', 5)} AS p10, {rounded('median(value)', 5)} AS p50, {rounded('quantile_cont(value, 0.9)', 5)} AS p90 FROM events GROUP BY 1"""
)
def quantiles_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles from narrow brackets: most values are only counted."""
    q = stats.quantiles(s.table(spark, folder, "events"), ["event_type"], "value", [0.1, 0.5, 0.9])
    named = {"p10": F.col("q")[0], "p50": F.col("q")[1], "p90": F.col("q")[2]}
    return q.select("event_type", *[round_to(value, 5).alias(name) for name, value in named.items()])


@query(
    """WITH w AS (SELECT CASE user_id % 3 WHEN 0 THEN 'GR' WHEN 1 THEN 'CO' ELSE 'SJ' END AS cd_rvr, CAST(ts AS DATE) AS date, event_id, event_type, value FROM events)
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY cd_rvr, date ORDER BY event_type, event_id) AS rn FROM w) WHERE rn = 1"""
)
def daily_points(spark: SparkSession, folder: str) -> DataFrame:
    """One row per river and day."""
    rows = s.table(spark, folder, "events").select(
        s.mapped_mod("user_id", 3, s.REPORT_STATIONS).alias("cd_rvr"), F.to_date("ts").alias("date"), F.col("event_type").alias("cd_rch"), "event_id", "value"
    )
    return reports.daily_points(rows).withColumnRenamed("cd_rch", "event_type")
