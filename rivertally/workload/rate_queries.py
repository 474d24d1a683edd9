"""Queries of the rate and summary operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivertally import fixed_values as fixed
from rivertally.functions.cleaning import with_missing
from rivertally.functions.numbers import round_to
from rivertally.functions.times import week_of_year
from rivertally.operators import days, quality, rates, stats
from rivertally.operators.joins import union_all, with_lifestage
from rivertally.operators.reshape import Children, attach_children, complete
from rivertally.plans import hydrology, reports, season, views
from rivertally.session import durable, new_folder
from rivertally.workload import standins as s
from rivertally.workload.registry import hours_sql, per, query, rounded

_PHASE = """CASE WHEN study = '123a' AND river = 'GR' AND mile BETWEEN 132 AND 250 THEN '123a-DESO'
     WHEN study = '123a' AND river = 'GR' AND mile >= 250 THEN '123a-ECHO'
     WHEN study = '123d' AND river = 'GR' AND mile BETWEEN 130 AND 150 THEN '123d-GRAY' ELSE study END"""
_NATIVE = ", ".join(f"'{c}'" for c in fixed.NATIVE_SPECIES)


def _summary_sql(value: str) -> str:
    return f"""
, p AS (SELECT sites.*, year(ts) AS yr, CAST(ts AS DATE) AS day, {_PHASE} AS phase
        FROM (SELECT "SiteID", "StudyCode" AS study, "RiverCode" AS river, mile, ts, effort FROM sites) AS sites),
e AS (SELECT study, river, yr, phase, min(day) AS d0, max(day) AS d1, count(DISTINCT day) AS days,
        {hours_sql('sum(effort)', 1)} AS hrs, count(*) AS n FROM p GROUP BY 1, 2, 3, 4),
f AS (SELECT study, river, yr, phase, fish."SpeciesCode" AS species, CAST({value} AS BIGINT) AS caught
        FROM p JOIN fish USING ("SiteID") WHERE fish."SpeciesCode" IS NOT NULL GROUP BY 1, 2, 3, 4, 5)
SELECT coalesce(e.river, f.river) AS "RiverCode", coalesce(e.phase, f.phase) AS "StudyCode",
    coalesce(e.yr, f.yr) AS "Year", hrs AS "Effort_Hours", d0 AS "EffortStartDate", d1 AS "EffortEndDate",
    days AS "NumberDaysSampled", n AS "NumberSamples", species AS "SpeciesCode", caught AS "FishCount",
    {rounded(per('caught', 'hrs'), 2)} AS "FishPerHour"
FROM e FULL JOIN f ON e.study = f.study AND e.river = f.river AND e.yr = f.yr AND e.phase = f.phase"""


@query(_summary_sql("count(*)"), ["sites", "fish"])
def study_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rates.study_summary(s.sites(spark, folder), s.catch(spark, folder, rows=True))


def nested_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Sites with their fish as arrays, shaped like the electrofishing facts."""
    one = {"Part": F.lit(0).cast("long"), "Parts": F.lit(1).cast("long"), "FishNumber": F.col("line")}
    fish = s.fish(spark, folder).withColumns(one)
    fields = ["SpeciesCode", "FishCount", "TotalLength_mm", "line", "seen", *one]
    return attach_children(s.sites(spark, folder), {"FishData": Children(fish, fields, ["seen", "line"])}, "SiteID")


@query(_summary_sql("count(*)"), ["sites", "fish"])
def study_summary_nested(spark: SparkSession, folder: str) -> DataFrame:
    facts = durable(with_missing(nested_facts(spark, folder), dict.fromkeys(views.SITE_COLUMNS, "string")))
    return views.summary_from_facts(facts)


def _group_sql(group: str, names: str) -> str:
    return f"""
, placed AS (SELECT "SiteID", {group}, effort FROM sites),
levels AS (SELECT DISTINCT "SpeciesCode" AS species FROM fish WHERE "SpeciesCode" IS NOT NULL),
n AS (SELECT "SiteID", "SpeciesCode" AS species, count(*) AS n FROM fish GROUP BY 1, 2),
g AS (SELECT placed.*, levels.species, coalesce(n.n, 0) AS n FROM placed CROSS JOIN levels
      LEFT JOIN n ON n."SiteID" = placed."SiteID" AND n.species = levels.species)
SELECT {names}, species, CAST(sum(n) AS BIGINT) AS fish_ct, {hours_sql('sum(effort)', 1)} AS effort_hr,
    {rounded(per('sum(n)', hours_sql('sum(effort)', 1)), 2)} AS cpue FROM g GROUP BY {names}, species"""


def _staged(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    sites = s.sites(spark, folder).withColumnsRenamed(
        {"SiteID": "key_a", "RiverCode": "river", "Effort_Seconds": "el_sec", "StartDateTime_UTC": "startdatetime"}
    )
    fish = s.fish(spark, folder).select(F.col("SiteID").alias("key_a"), F.col("SpeciesCode").alias("species"))
    return sites, fish


@query(_group_sql('"RiverCode" AS river', "river"), ["sites", "fish"])
def cpue_river_species(spark: SparkSession, folder: str) -> DataFrame:
    sites, fish = _staged(spark, folder)
    return rates.cpue_by_group(sites, fish, "key_a", {"river": F.col("river")})


@query(
    _group_sql('CAST((dayofyear(ts) - 1) // 7 + 1 AS BIGINT) AS week, "RiverCode" AS river', "week, river"),
    ["sites", "fish"],
)
def cpue_week(spark: SparkSession, folder: str) -> DataFrame:
    sites, fish = _staged(spark, folder)
    weeks = {"week": week_of_year(F.to_date("startdatetime")), "river": F.col("river")}
    return rates.cpue_by_group(sites, fish, "key_a", weeks)


@query(
    f"""
, placed AS (SELECT "SiteID", "RiverCode" AS river, effort FROM sites),
counted AS (SELECT river, "SpeciesCode" AS species, count(*) AS n FROM placed JOIN fish USING ("SiteID") GROUP BY 1, 2)
SELECT river, species, n FROM counted""",
    ["sites", "fish"],
)
def species_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Fish per river and species."""
    sites, fish = _staged(spark, folder)
    # Fish are counted per site first; the sites then add their river.
    counted = rates.tally(fish, ["key_a", "species"], into="n")
    joined = counted.join(sites.select("key_a", "river"), "key_a")
    return joined.groupBy("river", "species").agg(F.sum("n").alias("n"))


# ----- report rates ---------------------------------------------------------------------
_REACHED = """
, reached AS (SELECT s.*, CASE WHEN cd_rvr = 'CO' THEN 'LCO' WHEN cd_rvr = 'GR' AND rmi_start_bel BETWEEN 100 AND 129.5 THEN 'LGR'
        WHEN cd_rvr = 'GR' AND rmi_start_bel > 129.5 THEN 'DESO' END AS cd_rch,
    CASE WHEN cd_rvr = 'CO' THEN 'Lower Colorado River' WHEN cd_rvr = 'GR' AND rmi_start_bel BETWEEN 100 AND 129.5 THEN 'Tusher'
        WHEN cd_rvr = 'GR' AND rmi_start_bel > 129.5 THEN 'Lower Gray Canyon' END AS nm_rch, CAST(tm_end AS DATE) AS date
    FROM report_site s),
site AS (SELECT r.*, discharge, temp FROM reached r LEFT JOIN report_water w ON r.cd_rvr = w.cd_rvr AND r.date = w.date)"""
_REPORT = ["report_site", "report_water"]


def _report_sites(spark: SparkSession, folder: str) -> DataFrame:
    return reports.report_sites(s.report_site(spark, folder), s.report_water(spark, folder))


@query(
    _REACHED
    + f""", x AS (SELECT s.cd_rvr, s.cd_rch, c.cd_spp, s.date, discharge, temp, sum(amt_effort_sec) AS sec, coalesce(sum(n_fish), 0) AS n
    FROM site s LEFT JOIN report_count c ON s.id_site = c.id_site GROUP BY 1, 2, 3, 4, 5, 6)
SELECT cd_rvr, cd_rch, cd_spp, date, discharge, temp, CAST(n AS BIGINT) AS n_fish, {rounded('CAST(sec AS DOUBLE) / 3600.0::DOUBLE', 4)} AS tot_effort,
    {rounded(per('n', 'CAST(sec AS DOUBLE) / 3600.0::DOUBLE'), 4)} AS cpue_dt FROM x""",
    [*_REPORT, "report_count"],
)
def cpue_date_reach(spark: SparkSession, folder: str) -> DataFrame:
    out = rates.cpue_by_date(_report_sites(spark, folder), s.report_count(spark, folder))
    return out.withColumns({"tot_effort": round_to("tot_effort", 4), "cpue_dt": round_to("cpue_dt", 4)})


_REACH_RATES = (
    _REACHED
    + f""", x AS (SELECT cd_rch, nm_rch, cn_spp, cd_spp, CAST(sum(n_fish) AS BIGINT) AS fish_ct, {hours_sql('sum(amt_effort_sec)', 2)} AS tot_effort
    FROM site s LEFT JOIN report_count c ON s.id_site = c.id_site GROUP BY 1, 2, 3, 4),
rates AS (SELECT *, {rounded(per('fish_ct', 'tot_effort'), 2)} AS cpue FROM x WHERE fish_ct > 0)"""
)


@query(_REACH_RATES + "SELECT * FROM rates", [*_REPORT, "report_count"])
def cpue_reach_nonzero(spark: SparkSession, folder: str) -> DataFrame:
    return rates.cpue_by_reach(_report_sites(spark, folder), s.report_count(spark, folder))


@query(_REACH_RATES + f"SELECT * FROM rates WHERE cd_spp IN ({_NATIVE})", [*_REPORT, "report_count"])
def cpue_reach_native(spark: SparkSession, folder: str) -> DataFrame:
    return reports.native_split(cpue_reach_nonzero(spark, folder))["native"]


@query(
    _REACH_RATES + f"SELECT * FROM rates WHERE cd_spp NOT IN ({_NATIVE}, 'UI')", [*_REPORT, "report_count"]
)
def cpue_reach_nonnative(spark: SparkSession, folder: str) -> DataFrame:
    return reports.native_split(cpue_reach_nonzero(spark, folder))["nonnative"]


_STAGED = """
, stage_fish AS (SELECT f.*, st.stage AS ls FROM report_fish f LEFT JOIN species_dim d ON f.cd_spp = d."SpeciesCode"
    LEFT JOIN stages st ON st.code = d."LifeStageCode" AND f.tot_length BETWEEN st.low AND st.high)"""
_STAGE_RATES = (
    _STAGED
    + f""", x AS (SELECT s.id_site, cd_rvr, nm_rvr, cd_spp, cn_spp, amt_effort_sec, ls, sum(n_fish) AS n_fish
    FROM report_site s JOIN stage_fish f ON s.id_site = f.id_site
    WHERE cd_spp IN ('SM', 'NP', 'WE') AND tot_length IS NOT NULL AND ls IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7),
g AS (SELECT * FROM (SELECT DISTINCT id_site, cd_rvr, nm_rvr, cd_spp, cn_spp, amt_effort_sec FROM x) CROSS JOIN (SELECT DISTINCT ls FROM x)),
rates AS (SELECT g.*, CAST(coalesce(n_fish, 0) AS BIGINT) AS n_fish,
    {per('coalesce(n_fish, 0) * 3600', 'g.amt_effort_sec')} AS cpue
    FROM g LEFT JOIN x ON g.id_site = x.id_site AND g.cd_spp = x.cd_spp AND g.ls = x.ls)"""
)
_STAGE_FRAMES = ["report_site", "report_fish", "species_dim", "stages"]


def _stage_rates(spark: SparkSession, folder: str) -> DataFrame:
    staged = with_lifestage(
        s.report_fish(spark, folder), s.species_dim(spark, folder), s.stages(spark), "cd_spp", "tot_length"
    ).where("ls IS NOT NULL")
    return rates.cpue_by_lifestage(s.report_site(spark, folder), staged, ["cd_rvr", "nm_rvr"])


@query(
    # Rounded as whole numbers, not as doubles.
    _STAGE_RATES
    + """SELECT * EXCLUDE (cpue), CASE WHEN amt_effort_sec <> 0 THEN CAST((2 * n_fish * 36000000 + amt_effort_sec) // (2 * amt_effort_sec) AS DOUBLE) / 10000 END AS cpue FROM rates""",
    _STAGE_FRAMES,
)
def cpue_lifestage(spark: SparkSession, folder: str) -> DataFrame:
    return _stage_rates(spark, folder).withColumn("cpue", round_to("cpue", 4))


@query(
    _STAGE_RATES
    + f""", l AS (SELECT cd_rvr, cd_spp, ls, log10(cpue) AS v FROM rates WHERE cpue > 0),
q AS (SELECT cd_rvr, cd_spp, ls, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM l GROUP BY 1, 2, 3),
j AS (SELECT l.*, q1, q2, q3, v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM l JOIN q USING (cd_rvr, cd_spp, ls))
SELECT cd_rvr, cd_spp, ls, {rounded('pow(10, min(v) FILTER (inside))', 3)} AS lower, {rounded('pow(10, min(q1))', 3)} AS q1,
    {rounded('pow(10, min(q2))', 3)} AS median, {rounded('pow(10, min(q3))', 3)} AS q3,
    {rounded('pow(10, max(v) FILTER (inside))', 3)} AS upper, count(*) FILTER (NOT inside) AS outliers FROM j GROUP BY 1, 2, 3""",
    _STAGE_FRAMES,
)
def box_stats(spark: SparkSession, folder: str) -> DataFrame:
    out = stats.box_stats(_stage_rates(spark, folder), ["cd_rvr", "cd_spp", "ls"], "cpue")
    return out.withColumns({c: round_to(c, 3) for c in ("lower", "q1", "median", "q3", "upper")})


@query(
    _STAGED + "SELECT cd_spp, ls, count(*) AS n, CAST(sum(n_fish) AS BIGINT) AS n_fish FROM stage_fish GROUP BY 1, 2",
    ["report_fish", "species_dim", "stages"],
)
def lifestage_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Range join of fish lengths to life stages, counted."""
    staged = with_lifestage(
        s.report_fish(spark, folder), s.species_dim(spark, folder), s.stages(spark), "cd_spp", "tot_length"
    )
    return staged.groupBy("cd_spp", "ls").agg(F.count(F.lit(1)).alias("n"), F.sum("n_fish").alias("n_fish"))


# ----- area rates -------------------------------------------------------------------------
@query(
    f"""
, j AS (SELECT h.site_id, h.haul_id, h.reach, h.haul_area, species, fish_count FROM hauls h LEFT JOIN haul_counts c ON h.haul_id = c.haul_id),
g AS (SELECT * FROM (SELECT DISTINCT site_id, haul_id, reach, haul_area FROM hauls)
      CROSS JOIN (SELECT DISTINCT species FROM j WHERE species IN ({_NATIVE}))),
f AS (SELECT g.*, coalesce(fish_count, 0) AS fish_count FROM g LEFT JOIN j ON g.haul_id = j.haul_id AND g.species = j.species)
SELECT site_id, reach, species, CAST(sum(fish_count) AS BIGINT) AS fish_count, CAST(sum(haul_area) AS BIGINT) AS haul_area,
    {rounded(per('sum(fish_count)', 'sum(haul_area)') + ' * 10', 2)} AS fp10ms FROM f GROUP BY 1, 2, 3""",
    ["hauls", "haul_counts"],
)
def area_cpue_native(spark: SparkSession, folder: str) -> DataFrame:
    return rates.area_cpue_native(s.hauls(spark, folder), s.haul_counts(spark, folder))


@query(
    f"""
, h AS (SELECT * FROM hauls WHERE prim_sec = 1 AND haul_num = 1),
j AS (SELECT h.site_id, h.reach, h.haul_area, species, fish_count FROM h LEFT JOIN haul_counts c ON h.haul_id = c.haul_id),
g AS (SELECT * FROM (SELECT DISTINCT site_id, reach, haul_area FROM j) CROSS JOIN (SELECT DISTINCT species FROM j WHERE species IS NULL OR species NOT IN ({_NATIVE}))),
f AS (SELECT g.*, coalesce(fish_count, 0) AS fish_count FROM g LEFT JOIN j ON g.site_id = j.site_id AND g.reach = j.reach
      AND g.haul_area = j.haul_area AND g.species IS NOT DISTINCT FROM j.species)
SELECT site_id, reach, haul_area, species, CAST(fish_count AS BIGINT) AS fish_count, {rounded(per('fish_count', 'haul_area') + ' * 10', 2)} AS fp10ms FROM f""",
    ["hauls", "haul_counts"],
)
def area_cpue_nonnative(spark: SparkSession, folder: str) -> DataFrame:
    return rates.area_cpue_nonnative(s.hauls(spark, folder), s.haul_counts(spark, folder))


@query(
    """
, c AS (SELECT site_id, CAST(sum(fish_count) AS BIGINT) AS n FROM hauls JOIN haul_counts USING (haul_id) WHERE species = 'CS' GROUP BY 1)
SELECT s.site_id, coalesce(c.n, 0) AS "CS" FROM (SELECT c_custkey AS site_id FROM customer) s LEFT JOIN c USING (site_id)""",
    ["hauls", "haul_counts"],
)
def target_catch_site(spark: SparkSession, folder: str) -> DataFrame:
    sites = s.table(spark, folder, "customer").select(F.col("c_custkey").alias("site_id"))
    counts = s.haul_counts(spark, folder).groupBy("haul_id", "species").agg(F.sum("fish_count").alias("fish_count"))
    catch = s.hauls(spark, folder).select("site_id", "haul_id").join(counts, "haul_id")
    return rates.target_catch(sites, catch, "CS")


@query(
    """
, j AS (SELECT s."SiteID", "RiverCode", c."SpeciesCode", c."FishCount" FROM sites s JOIN catch c USING ("SiteID")),
g AS (SELECT * FROM (SELECT DISTINCT "SiteID", "RiverCode" FROM j) CROSS JOIN (SELECT DISTINCT "SpeciesCode" FROM j))
SELECT g.*, coalesce("FishCount", 0) AS "FishCount" FROM g LEFT JOIN j ON g."SiteID" = j."SiteID"
    AND g."SpeciesCode" IS NOT DISTINCT FROM j."SpeciesCode" """,
    ["sites", "fish", "catch"],
)
def complete_zero_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Every observed site with every observed species, null among them."""
    joined = s.sites(spark, folder).select("SiteID", "RiverCode").join(s.catch(spark, folder), "SiteID")
    return complete(joined, ["SiteID", "RiverCode"], ["SpeciesCode"], {"FishCount": 0})


@query(
    """
, k AS (SELECT * FROM catch WHERE "SpeciesCode" IS NOT NULL)
SELECT g.*, coalesce("FishCount", 0) AS "FishCount" FROM
    (SELECT * FROM (SELECT "SiteID" FROM sites) CROSS JOIN (SELECT DISTINCT "SpeciesCode" FROM k)) g LEFT JOIN k USING ("SiteID", "SpeciesCode")""",
    ["sites", "fish", "catch"],
)
def fish_count_view(spark: SparkSession, folder: str) -> DataFrame:
    return views.fish_count_view(s.sites(spark, folder), s.catch(spark, folder))


# ----- effort, summaries and trends -------------------------------------------------------------
_EFFORT = f"""
, d AS (SELECT "RiverCode" AS river, CAST(ts AS DATE) AS date, sum(effort) AS sec FROM sites GROUP BY 1, 2),
r AS (SELECT river, min(date) AS min_date, max(date) AS max_date, {hours_sql('sum(sec)', 1)} AS total_effort_hr, count(*) AS sampling_days FROM d GROUP BY 1)"""


def _season(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Season tables from the states of four uploads, one of them added twice."""
    sites, fish = _staged(spark, folder)
    path = new_folder(spark, "season")
    for upload in (0, 1, 2, 3, 1):
        mine = F.col("key_a") % 4 == upload
        season.add_upload(season.season_state(sites.where(mine), fish.where(mine)), path, upload)
    return season.season_tables(season.current_state(spark, path))


@query(_group_sql('"RiverCode" AS river', "river"), ["sites", "fish"])
def season_river_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rates per river from the sums of the season's uploads."""
    return _season(spark, folder)["cpue_river"]


@query(
    _group_sql('CAST((dayofyear(ts) - 1) // 7 + 1 AS BIGINT) AS week, "RiverCode" AS river', "week, river") + " HAVING species IN ('SM', 'WE')",
    ["sites", "fish"],
)
def season_week_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Rates of the target species per week and river from the sums of the season's uploads."""
    return _season(spark, folder)["cpue_week_target"]


@query(
    _EFFORT + """, n AS (SELECT "RiverCode" AS river, "SpeciesCode" AS species, CAST(count(*) AS BIGINT) AS n FROM fish JOIN sites USING ("SiteID") GROUP BY 1, 2)
SELECT n.*, row_number() OVER (PARTITION BY river ORDER BY n DESC, species NULLS LAST) AS rank, min_date, max_date, total_effort_hr, sampling_days FROM n JOIN r USING (river)""",
    ["sites", "fish"],
)
def season_effort_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Effort and fish per river and species, with the place of each row in its river's list."""
    tables = _season(spark, folder)
    # A list of a few rows per river, in the order that the table has.
    order = Window.partitionBy("river").orderBy(F.col("n").desc_nulls_last(), F.col("species").asc_nulls_last())
    ranked = tables["counts"].withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.join(tables["effort"], "river")


@query(
    """SELECT "StudyCode", "RiverCode", CAST(year(ts) AS BIGINT) AS "Year", count(DISTINCT CAST(ts AS DATE)) AS days FROM sites
GROUP BY GROUPING SETS (("StudyCode", "RiverCode", year(ts)), ("StudyCode", "RiverCode"), ("StudyCode"), ())""",
    ["sites"],
)
def sampling_days(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct sampling days at four levels, from the merged day states of three batches."""
    sites = s.sites(spark, folder).withColumn("Year", F.year("StartDateTime_UTC").cast("long"))
    keys = ["StudyCode", "RiverCode", "Year"]
    batches = [days.day_bitmaps(sites.where(F.col("SiteID") % 3 == i), keys, F.to_date("StartDateTime_UTC")) for i in range(3)]
    state = durable(days.merge_days(union_all(*batches), keys))
    return union_all(*[days.count_days_of(state, keys[:n]) for n in range(3, -1, -1)])


@query(_EFFORT + "SELECT * FROM r", ["sites"])
def effort_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rates.effort_by_river(_staged(spark, folder)[0])


@query(
    _EFFORT
    + """SELECT min(min_date) AS min_date, max(max_date) AS max_date, CAST(sum(CAST(total_effort_hr AS DECIMAL(18,1))) AS DOUBLE) AS total_effort_hr,
    CAST(sum(sampling_days) AS BIGINT) AS sampling_days FROM r""",
    ["sites"],
)
def effort_overall(spark: SparkSession, folder: str) -> DataFrame:
    return rates.effort_overall(rates.effort_by_river(_staged(spark, folder)[0]))


_SAMPLING = (
    _REACHED
    + f""", x AS (SELECT cd_rvr, nm_rvr, nm_rch, cd_rch, max(rmi_start_bel) AS rmi_start_bel_max, min(rmi_start_bel) AS rmi_start_bel_min,
    max(rmi_end_bel) AS rmi_end_bel_max, min(rmi_end_bel) AS rmi_end_bel_min, max(date) AS date_max, min(date) AS date_min,
    max(discharge) AS discharge_max, min(discharge) AS discharge_min, max(temp) AS temp_max, min(temp) AS temp_min,
    {hours_sql('sum(amt_effort_sec)', 1)} AS effort_hr, count(DISTINCT date) AS sampl_days FROM site GROUP BY 1, 2, 3, 4)"""
)


@query(_SAMPLING + "SELECT * FROM x", _REPORT)
def sampling_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sampling_summary(_report_sites(spark, folder))


@query(
    _SAMPLING
    + """SELECT cd_rvr, nm_rvr, nm_rch, cd_rch, printf('%.1f', round(CAST(rmi_start_bel_max AS DECIMAL(38,6)), 1)) AS rmi_start_bel_max,
    printf('%.1f', round(CAST(rmi_start_bel_min AS DECIMAL(38,6)), 1)) AS rmi_start_bel_min, printf('%.1f', round(CAST(rmi_end_bel_max AS DECIMAL(38,6)), 1)) AS rmi_end_bel_max,
    printf('%.1f', round(CAST(rmi_end_bel_min AS DECIMAL(38,6)), 1)) AS rmi_end_bel_min,
    strftime(date_max, '%d %B %Y') AS date_max, strftime(date_min, '%d %B %Y') AS date_min, effort_hr, sampl_days,
    regexp_replace(CAST(temp_min AS VARCHAR), '\\.0$', '') || ' - ' || regexp_replace(CAST(temp_max AS VARCHAR), '\\.0$', '') AS temp_rng,
    format('{:,}', CAST(discharge_min AS BIGINT)) || ' - ' || format('{:,}', CAST(discharge_max AS BIGINT)) AS dis_rng FROM x""",
    _REPORT,
)
def sampling_summary_text(spark: SparkSession, folder: str) -> DataFrame:
    return reports.format_summary(reports.sampling_summary(_report_sites(spark, folder)))


@query(
    """
, m AS (SELECT cd_rvr, max(discharge) AS a, min(discharge) AS b, median(discharge) AS c, count(*) AS n FROM report_water GROUP BY 1)
SELECT m.cd_rvr, a AS discharge_max, b AS discharge_min, c AS discharge_median, n AS discharge_n,
    (SELECT min(date) FROM report_water w WHERE w.cd_rvr = m.cd_rvr AND discharge = a) AS dt_max_flow,
    (SELECT min(date) FROM report_water w WHERE w.cd_rvr = m.cd_rvr AND discharge = b) AS dt_min_flow FROM m""",
    ["report_water"],
)
def hydrology_summary(spark: SparkSession, folder: str) -> DataFrame:
    return hydrology.water_summary(s.report_water(spark, folder), display=False)


@query(
    """SELECT coalesce(d.staid, t.staid) AS staid, coalesce(d.dates, t.dates) AS date, d.val AS discharge, t.val AS temp
FROM (SELECT * FROM daily_values WHERE parameter = '00060') d FULL JOIN (SELECT * FROM daily_values WHERE parameter = '00010') t
    ON d.staid = t.staid AND d.dates = t.dates""",
    ["daily_values"],
)
def hydrology_full(spark: SparkSession, folder: str) -> DataFrame:
    return hydrology.daily_series(s.daily_values(spark, folder))


@query(
    """
, spent AS (SELECT cd_rvr, cd_rch, nm_rch, date, CAST(sum(amt_effort_sec) AS BIGINT) AS amt_effort_sec FROM site GROUP BY 1, 2, 3, 4)
SELECT w.staid, w.date, w.cd_rvr, discharge, temp, cd_rch, nm_rch, amt_effort_sec, w.cd_rvr || ' River' AS nm_rvr
FROM report_water w LEFT JOIN spent s ON w.date = s.date AND w.cd_rvr = s.cd_rvr WHERE w.date < DATE '2024-10-01'""".replace(
        ", spent", _REACHED + ", spent", 1
    ),
    _REPORT,
)
def sampled_water(spark: SparkSession, folder: str) -> DataFrame:
    site = s.report_site(spark, folder)
    rivers = site.select("cd_rvr", "nm_rvr").distinct()
    return reports.sampled_water(_report_sites(spark, folder), s.report_water(spark, folder), rivers, 2024)


_LENGTHS = """ FROM fish GROUP BY 1"""


@query(
    f"""SELECT "SpeciesCode", min("TotalLength_mm") AS min, quantile_cont("TotalLength_mm", 0.25) AS q1, quantile_cont("TotalLength_mm", 0.5) AS median,
    {rounded('CAST(sum("TotalLength_mm") AS DOUBLE) / count("TotalLength_mm")', 4)} AS mean, quantile_cont("TotalLength_mm", 0.75) AS q3,
    max("TotalLength_mm") AS max, count(*) FILTER ("TotalLength_mm" IS NULL) AS n_missing {_LENGTHS}""",
    ["fish"],
)
def length_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = stats.length_summary(s.fish(spark, folder), ["SpeciesCode"], "TotalLength_mm")
    return out.withColumn("mean", round_to("mean", 4))


@query(
    """SELECT "SpeciesCode", CAST(ceil("TotalLength_mm" / CAST(25 AS DOUBLE) - CAST(0.5 AS DOUBLE)) AS BIGINT) * CAST(25 AS DOUBLE) AS bin_center, count(*) AS n
FROM fish WHERE "TotalLength_mm" IS NOT NULL GROUP BY 1, 2""",
    ["fish"],
)
def length_hist(spark: SparkSession, folder: str) -> DataFrame:
    return stats.histogram(s.fish(spark, folder), ["SpeciesCode"], "TotalLength_mm", 25)


@query(
    """
, w AS (SELECT (max("TotalLength_mm") - min("TotalLength_mm")) / CAST(29 AS DOUBLE) AS w FROM fish),
b AS (SELECT "SpeciesCode", CAST(ceil("TotalLength_mm" / w - CAST(0.5 AS DOUBLE)) AS BIGINT) AS b FROM fish, w WHERE "TotalLength_mm" IS NOT NULL)
SELECT "SpeciesCode", round(b * (SELECT w FROM w), 4) AS bin_center, count(*) AS n FROM b GROUP BY 1, 2""",
    ["fish"],
)
def length_hist_default(spark: SparkSession, folder: str) -> DataFrame:
    """Thirty bins over the range of all lengths, shared by the species."""
    fish = s.fish(spark, folder)
    width = stats.bin_width(fish, "TotalLength_mm")
    out = stats.histogram(fish, ["SpeciesCode"], "TotalLength_mm", width)
    return out.withColumn("bin_center", F.round("bin_center", 4))


@query(
    """SELECT CAST(supplier AS DOUBLE) AS loc_x, CAST(line AS DOUBLE) AS loc_y, "SpeciesCode" AS species, count(*) AS n
FROM fish WHERE supplier <> 0 GROUP BY 1, 2, 3""",
    ["fish"],
)
def location_tally(spark: SparkSession, folder: str) -> DataFrame:
    fish = s.fish(spark, folder).select(
        F.nullif(F.col("supplier"), F.lit(0)).cast("double").alias("loc_x"),
        F.col("line").cast("double").alias("loc_y"),
        F.col("SpeciesCode").alias("species"),
    )
    return rates.location_tally(fish)


@query(
    f"""
, c AS (SELECT "SiteID", "FishCount" AS n FROM catch WHERE "SpeciesCode" = 'WE')
SELECT year(ts) AS yr, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_fish, {hours_sql('sum(effort)', 2)} AS tot_effort,
    {rounded(per('coalesce(sum(n), 0) * 3600', 'sum(effort)'), 2)} AS cpue
FROM sites LEFT JOIN c USING ("SiteID") WHERE "RiverCode" = 'GR' GROUP BY 1""",
    ["sites", "fish", "catch"],
)
def trend_by_year(spark: SparkSession, folder: str) -> DataFrame:
    sites = s.sites(spark, folder).where("RiverCode = 'GR'").withColumn("Year", F.year("StartDateTime_UTC").cast("long"))
    return rates.trend_by_year(sites, s.catch(spark, folder), "WE")


@query(
    f"""
, c AS (SELECT site_id, count(*) AS ct FROM check_fish WHERE species = 'SM' GROUP BY 1)
SELECT pass, reach, count(*) AS n_site, {hours_sql('sum(el_sec)', 2)} AS effort_hr, CAST(coalesce(sum(ct), 0) AS BIGINT) AS catch,
    {rounded(per('coalesce(sum(ct), 0)', hours_sql('sum(el_sec)', 2)), 2)} AS cpue, 'SM' AS species
FROM check_site LEFT JOIN c USING (site_id) GROUP BY 1, 2""",
    ["check_site", "check_fish"],
)
def qc_stats(spark: SparkSession, folder: str) -> DataFrame:
    return quality.qc_stats(s.check_site(spark, folder), s.check_fish(spark, folder), "SM")
