"""Catch-per-unit-effort rates.

Catch is counted per (site, species) before it meets the sites, so a site with very many fish
costs one row per species in the join. Rates over groups of sites never build the zero-filled
site-by-species table: a group's effort is the same for every species, so effort is summed once per
group and only the small group-by-species table is completed with zeros.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivertally import fixed_values as fixed
from rivertally.functions.cleaning import is_in, not_in, study_phase
from rivertally.functions.numbers import hours, ratio, round_to, total
from rivertally.operators.joins import null_safe_join
from rivertally.operators.reshape import fill_levels, level_grid
from rivertally.session import durable


def tally(fish: DataFrame, keys: Sequence[str], count: str | None = None, into: str = "n_fish", na_rm: bool = True) -> DataFrame:
    """Catch per key: rows, or the sum of a count column."""
    value = F.count(F.lit(1)) if count is None else total(count, na_rm)
    return fish.groupBy(*keys).agg(value.cast("long").alias(into))


# ----- study summary ------------------------------------------------------------------
def study_summary(sites: DataFrame, catch: DataFrame, site_keys: bool = True) -> DataFrame:
    """Effort and catch per study phase, river, year and species, with fish per hour.

    ``sites``: SiteID, StudyCode, RiverCode, StartLocation_BelknapMiles, StartDateTime_UTC,
    Effort_Seconds. ``catch``: SiteID, SpeciesCode, FishCount, one row per site and species.
    Groups with effort only, or with catch only, keep a row. With ``site_keys`` false the keys of
    catch-only groups are left null, as the published view has them.
    """
    placed = sites.select(
        "SiteID",
        "StudyCode",
        "RiverCode",
        F.year("StartDateTime_UTC").cast("long").alias("Year"),
        F.to_date("StartDateTime_UTC").alias("_day"),
        "Effort_Seconds",
        study_phase().alias("_phase"),
    )
    group = ["StudyCode", "RiverCode", "Year", "_phase"]
    effort = placed.groupBy(*group).agg(
        F.min("_day").alias("EffortStartDate"),
        F.max("_day").alias("EffortEndDate"),
        F.count_distinct("_day").alias("NumberDaysSampled"),
        round_to(hours(F.sum("Effort_Seconds")), 1).alias("Effort_Hours"),
        F.count(F.lit(1)).alias("NumberSamples"),
    )
    caught = (
        placed.select("SiteID", *group)
        .join(catch.where(F.col("SpeciesCode").isNotNull()), "SiteID")
        .groupBy(*group, "SpeciesCode")
        .agg(F.sum("FishCount").alias("FishCount"))
    )
    renamed = caught.withColumnsRenamed({c: f"_f_{c}" for c in group})
    match = [F.col(c) == F.col(f"_f_{c}") for c in group]
    joined = effort.join(renamed, match, "full")

    def key(name: str) -> Column:
        return F.coalesce(F.col(name), F.col(f"_f_{name}")) if site_keys else F.col(name)

    return joined.select(
        key("RiverCode").alias("RiverCode"),
        key("_phase").alias("StudyCode"),
        key("Year").alias("Year"),
        "Effort_Hours",
        "EffortStartDate",
        "EffortEndDate",
        "NumberDaysSampled",
        "NumberSamples",
        "SpeciesCode",
        "FishCount",
        round_to(ratio("FishCount", "Effort_Hours"), 2).alias("FishPerHour"),
    )


# ----- zero-filled rates over groups of sites --------------------------------------------
def cpue_by_group(sites: DataFrame, fish: DataFrame, key: str, group: Mapping[str, Column | str], effort: str = "el_sec", species: str = "species") -> DataFrame:
    """Catch, hours and fish per hour for every group of sites and every species seen anywhere.

    ``group`` maps each output group column to an expression over the sites. Hours are rounded to
    one decimal and the rate is computed from the rounded hours.
    """
    names = list(group)
    shaped = sites.select(key, *[F.expr(e).alias(n) if isinstance(e, str) else e.alias(n) for n, e in group.items()], effort)
    # Copies of a site row count its effort once and its fish as often as it is listed.
    parents = shaped.groupBy(key, *names, effort).agg(F.count(F.lit(1)).alias("_times"))
    catch = (
        null_safe_join(parents, tally(fish, [key, species], into="_n"), [key], "inner")
        .where(F.col(species).isNotNull())
        .groupBy(*names, species)
        .agg(F.sum(F.col("_n") * F.col("_times")).alias("fish_ct"))
    )
    hours_of = parents.groupBy(*names).agg(round_to(hours(total(effort, na_rm=False)), 1).alias("effort_hr"))
    # Small by now, and read twice: for the species seen, and for their catch.
    return zero_filled_rates(hours_of, durable(catch), names, species)


def zero_filled_rates(hours_of: DataFrame, catch: DataFrame, names: Sequence[str], species: str = "species") -> DataFrame:
    """Rates of every group and every species seen, from the groups' ``effort_hr`` and the ``fish_ct`` of the pairs that have any."""
    grid = level_grid(hours_of, catch.select(species).distinct())
    filled = null_safe_join(grid, catch, [*names, species], "left")
    return filled.select(
        *names,
        species,
        F.coalesce("fish_ct", F.lit(0)).alias("fish_ct"),
        "effort_hr",
        round_to(ratio(F.coalesce("fish_ct", F.lit(0)), "effort_hr"), 2).alias("cpue"),
    )


# ----- rates over joined site and count rows ------------------------------------------------
def site_counts(sites: DataFrame, counts: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Sites with their counts, one row per site and species; ``_rows`` tells how many it stands for."""
    small = counts.groupBy(key, *labels).agg(
        F.sum("n_fish").alias("n_fish"), F.count_if(F.col("n_fish").isNull()).alias("_nulls"), F.count(F.lit(1)).alias("_rows")
    )
    joined = null_safe_join(sites, small, [key], "left")
    return joined.withColumns(
        {"_nulls": F.coalesce("_nulls", F.lit(1)), "_rows": F.coalesce("_rows", F.lit(1))}
    )


def cpue_by_date(sites: DataFrame, counts: DataFrame, river: str = "cd_rvr", reach: str = "cd_rch", species: str = "cd_spp") -> DataFrame:
    """Unrounded rate per river, reach, species, date, discharge and temperature."""
    joined = site_counts(sites, counts, "id_site", [species])
    seconds = F.sum(F.col("amt_effort_sec") * F.col("_rows"))
    grouped = joined.groupBy(river, reach, species, F.to_date("tm_end").alias("date"), "discharge", "temp").agg(
        hours(F.coalesce(seconds, F.lit(0))).alias("tot_effort"),
        F.coalesce(F.sum("n_fish"), F.lit(0)).alias("n_fish"),
    )
    return grouped.withColumn("cpue_dt", ratio("n_fish", "tot_effort"))


def cpue_by_reach(sites: DataFrame, counts: DataFrame, name: str = "cn_spp", code: str = "cd_spp") -> DataFrame:
    """Catch, hours and rate per reach and species; species without catch drop.

    A missing count makes its species' catch missing, and a missing catch drops too.
    """
    joined = site_counts(sites, counts, "id_site", [name, code])
    seconds = F.when(
        F.count_if(F.col("amt_effort_sec").isNull()) == 0, F.sum(F.col("amt_effort_sec") * F.col("_rows"))
    )
    grouped = joined.groupBy("cd_rch", "nm_rch", name, code).agg(
        F.when(F.sum("_nulls") == 0, F.sum("n_fish")).alias("fish_ct"),
        round_to(hours(seconds), 2).alias("tot_effort"),
    )
    return grouped.withColumn("cpue", round_to(ratio("fish_ct", "tot_effort"), 2)).where("fish_ct > 0")


def cpue_by_lifestage(sites: DataFrame, fish_staged: DataFrame, labels: Sequence[str], species: Sequence[str] = fixed.LIFESTAGE_SPECIES, multiply: bool = False) -> DataFrame:
    """Rate per site, species and life stage, zero-filled over the stages seen.

    ``sites``: id_site, ``labels``, amt_effort_sec. ``fish_staged``: id_site, cd_spp, cn_spp,
    tot_length, n_fish, ls. The rate divides by hours; ``multiply`` gives the product instead.
    """
    wanted = fish_staged.where(F.col("cd_spp").isin(list(species)) & F.col("tot_length").isNotNull())
    counted = wanted.groupBy("id_site", "cd_spp", "cn_spp", "ls").agg(
        F.sum("n_fish").alias("n_fish"), F.count_if(F.col("n_fish").isNull()).alias("_nulls")
    )
    joined = null_safe_join(sites.select("id_site", *labels, "amt_effort_sec"), counted, ["id_site"], "inner")
    parents = ["id_site", *labels, "cd_spp", "cn_spp", "amt_effort_sec"]
    summed = joined.groupBy(*parents, "ls").agg(
        F.when(F.sum("_nulls") == 0, F.sum("n_fish")).alias("n_fish")
    )
    filled = fill_levels(durable(summed), parents, "ls", {"n_fish": 0})
    # One division, so that a rate that lies on a rounding tie is exactly that.
    rate = hours("amt_effort_sec") * F.col("n_fish") if multiply else ratio(F.col("n_fish") * 3600, "amt_effort_sec")
    return filled.withColumn("cpue", rate)


# ----- rates per area -----------------------------------------------------------------------
def area_cpue_native(hauls: DataFrame, counts: DataFrame, native: Sequence[str] = fixed.NATIVE_SPECIES) -> DataFrame:
    """Fish per 10 m² per site, reach and native species, zero-filled over hauls.

    ``hauls``: site_id, haul_id, reach, haul_area. ``counts``: haul_id, species, fish_count. A
    species' area is the site's whole haul area; where a haul lists a species more than once, its
    area counts that often, which is added to the site's area afterwards.
    """
    site = ["site_id", "reach"]
    tuples = hauls.groupBy("site_id", "haul_id", "reach", "haul_area").agg(F.count(F.lit(1)).alias("_times"))
    small = counts.where(F.col("species").isin(list(native))).groupBy("haul_id", "species").agg(
        F.sum("fish_count").alias("_fish"), F.count(F.lit(1)).alias("_rows")
    )
    # Warehouse-style join: a missing haul id matches nothing.
    caught = (
        tuples.join(small, "haul_id")
        .groupBy(*site, "species")
        .agg(
            F.sum(F.col("_fish") * F.col("_times")).alias("fish_count"),
            F.sum(F.col("haul_area") * (F.col("_rows") * F.col("_times") - 1)).alias("_again"),
        )
    )
    areas = tuples.groupBy(*site).agg(F.coalesce(F.sum("haul_area"), F.lit(0)).alias("_area"))
    filled = fill_levels(durable(caught), site, "species", {"fish_count": 0, "_again": 0}, parents=areas)
    area = F.col("_area") + F.col("_again")
    return filled.select(
        *site,
        "species",
        "fish_count",
        area.alias("haul_area"),
        round_to(ratio("fish_count", area) * 10, 2).alias("fp10ms"),
    )


def area_cpue_nonnative(hauls: DataFrame, counts: DataFrame, native: Sequence[str] = fixed.NATIVE_SPECIES) -> DataFrame:
    """Fish per 10 m² of the first haul in each primary habitat, for species that are not native.

    One row per haul and counted entry, plus zero rows for the species a haul lacks. Entries
    without a species stay: they are not in the native list.
    """
    first = hauls.where((F.col("prim_sec") == 1) & (F.col("haul_num") == 1))
    joined = first.join(counts, "haul_id", "left").select(
        "site_id", "reach", "haul_area", "species", "fish_count"
    )
    # Parents come from all first hauls, also those with native fish only.
    other = joined.where(not_in("species", native))
    tuples = first.select("site_id", "reach", "haul_area").distinct()
    grid = level_grid(tuples, other.select("species").distinct())
    on = ["site_id", "reach", "haul_area", "species"]
    absent = null_safe_join(grid, other.select(*on).distinct(), on, "left_anti")
    filled = other.unionByName(absent, allowMissingColumns=True).fillna(0, ["fish_count"])
    return filled.withColumn("fp10ms", round_to(ratio("fish_count", "haul_area") * 10, 2))


def target_catch(sites: DataFrame, catch: DataFrame, target: str, key: str = "site_id", species: str = "species", count: str = "fish_count") -> DataFrame:
    """Sites with their catch of one species, 0 where there is none; named after the species."""
    one = catch.where(F.col(species) == target).groupBy(key).agg(total(count).alias(target))
    return null_safe_join(sites, one, [key], "left").fillna(0, [target])


# ----- effort and trends -----------------------------------------------------------------------
def effort_by_river(sites: DataFrame, river: str = "river", stamp: str = "startdatetime", effort: str = "el_sec") -> DataFrame:
    """Sampling period, hours and days per river."""
    daily = sites.groupBy(river, F.to_date(stamp).alias("date")).agg(total(effort, na_rm=False).alias("_sec"))
    return daily.groupBy(river).agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        round_to(hours(total("_sec", na_rm=False)), 1).alias("total_effort_hr"),
        F.count(F.lit(1)).alias("sampling_days"),
    )


def effort_overall(by_river: DataFrame) -> DataFrame:
    """Totals over rivers, of hours that were already rounded per river."""
    return by_river.agg(
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
        F.sum(F.col("total_effort_hr").cast("decimal(18,1)")).cast("double").alias("total_effort_hr"),
        F.sum("sampling_days").alias("sampling_days"),
    )


def trend_by_year(sites: DataFrame, catch: DataFrame, species: str, key: str = "SiteID", year: str = "Year", effort: str = "Effort_Seconds") -> DataFrame:
    """Catch, hours and rate of one species per year, over all given sites."""
    one = catch.where(F.col("SpeciesCode") == species).groupBy(key).agg(F.sum("FishCount").alias("_n"))
    joined = sites.join(one, key, "left")
    return joined.groupBy(F.col(year).alias("yr")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_fish"),
        round_to(hours(F.sum(effort)), 2).alias("tot_effort"),
        round_to(ratio(F.coalesce(F.sum("_n"), F.lit(0)) * 3600, F.sum(effort)), 2).alias("cpue"),
    )


def location_tally(fish: DataFrame, x: str = "loc_x", y: str = "loc_y", species: str = "species") -> DataFrame:
    """Number of fish per position and species; fish without a position are left out."""
    return fish.where(F.col(x).isNotNull()).groupBy(x, y, species).agg(F.count(F.lit(1)).alias("n"))


def target_only(rates: DataFrame, targets: Sequence[str], species: str = "species") -> DataFrame:
    return rates.where(is_in(species, targets))
