"""Annual report tables and the in-season update."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivertally import fixed_values as fixed
from rivertally.functions.cleaning import before_season_end, is_in, not_in, report_reach
from rivertally.functions.numbers import hours, ratio, round_to, total
from rivertally.functions.times import (
    display_count,
    display_date,
    display_decimal,
    display_range,
    to_local,
    week_of_year,
)
from rivertally.operators.joins import null_safe_join, with_lifestage
from rivertally.operators.ordered import first_per_key
from rivertally.operators.rates import (
    cpue_by_group,
    cpue_by_lifestage,
    effort_by_river,
    effort_overall,
    site_counts,
    target_only,
)
from rivertally.operators.stats import across, bin_center, box_stats, count_days
from rivertally.plans.hydrology import water_summary
from rivertally.session import durable


# ----- sites ---------------------------------------------------------------------------
def report_sites(site: DataFrame, water: DataFrame, date_zone: str = "UTC") -> DataFrame:
    """Report sites with reach, date, week and the day's discharge and temperature."""
    code, name = report_reach()
    seen = F.col("tm_end") if date_zone == "UTC" else to_local("tm_end", date_zone)
    shaped = site.withColumns(
        {"cd_rch": code, "nm_rch": name, "date": F.to_date(seen), "week": week_of_year(seen)}
    )
    return null_safe_join(shaped, water.drop("file_study", "file_year"), ["cd_rvr", "date"], "left")


def sampling_summary(sites: DataFrame) -> DataFrame:
    """Miles, dates, flow and temperature ranges, hours and days per reach."""
    measured = ["rmi_start_bel", "rmi_end_bel", "date", "discharge", "temp"]
    return sites.groupBy("cd_rvr", "nm_rvr", "nm_rch", "cd_rch").agg(
        *across(measured, ["max", "min"]),
        round_to(hours(total("amt_effort_sec")), 1).alias("effort_hr"),
        count_days(F.to_date("tm_end")).alias("sampl_days"),
    )


def format_summary(summary: DataFrame) -> DataFrame:
    """The sampling summary as display text, in order of the first sampling date."""
    def tenths(name: str) -> Column:
        return display_decimal(name).alias(name)

    return summary.orderBy(F.col("date_min").asc_nulls_last()).select(
        "cd_rvr",
        "nm_rvr",
        "nm_rch",
        "cd_rch",
        *[tenths(n) for n in ("rmi_start_bel_max", "rmi_start_bel_min", "rmi_end_bel_max", "rmi_end_bel_min")],
        display_date("date_max").alias("date_max"),
        display_date("date_min").alias("date_min"),
        "effort_hr",
        "sampl_days",
        display_range("temp_min", "temp_max").alias("temp_rng"),
        display_range(display_count("discharge_min"), display_count("discharge_max")).alias("dis_rng"),
    )


def format_water(summary: DataFrame) -> DataFrame:
    numbers = ["discharge_max", "discharge_min", "discharge_median", "discharge_n"]
    return summary.withColumns({n: display_count(n) for n in numbers})


def sampled_water(sites: DataFrame, water: DataFrame, rivers: DataFrame, year: int) -> DataFrame:
    """Daily water up to the season's end, with the effort spent that day in each reach."""
    spent = sites.groupBy("cd_rvr", "cd_rch", "nm_rch", "date").agg(total("amt_effort_sec").alias("amt_effort_sec"))
    joined = null_safe_join(water, spent, ["date", "cd_rvr"], "left")
    return null_safe_join(joined, rivers, ["cd_rvr"], "left").where(before_season_end("date", year))


def daily_points(water: DataFrame) -> DataFrame:
    """One row per river and day, for the flow figure."""
    return first_per_key(water, ["cd_rvr", "date"], ["cd_rch"])


# ----- report tables --------------------------------------------------------------------------
def native_split(rates: DataFrame, native: Sequence[str] = fixed.NATIVE_SPECIES) -> dict[str, DataFrame]:
    """Native and other species, each by falling rate; unidentified fish are in neither."""
    order = [F.col("cpue").desc_nulls_last(), F.col("cd_spp").asc_nulls_last()]
    return {
        "native": rates.where(is_in("cd_spp", native)).orderBy(*order),
        "nonnative": rates.where(not_in("cd_spp", [*native, fixed.UNIDENTIFIED_SPECIES])).orderBy(*order),
    }


def reach_lengths(fish: DataFrame, sites: DataFrame) -> DataFrame:
    places = sites.select("id_site", "cd_rch", "nm_rch", "cd_rvr", "nm_rvr")
    return null_safe_join(fish, places, ["id_site"], "left")


def study_totals(rates: DataFrame, summary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hours over all reaches, and catch per species over all reaches."""
    spent = summary.agg(F.sum(F.col("effort_hr").cast("decimal(18,1)")).cast("double").alias("effort_hr"))
    return spent, rates.groupBy("cd_spp").agg(F.sum("fish_ct").alias("fish_ct"))


def report_bases(tables: Mapping[str, DataFrame], date_zone: str = "UTC") -> dict[str, DataFrame]:
    """Three aggregates from which every table of the report is rolled up; each extract is read once, and each aggregate written once.

    ``site``: sites with reach, day and water. ``catch``: catch and effort per reach, species, day and water. ``fish``: fish per site, species and
    length. Sums keep beside them how many values were missing, since a missing one makes some sums missing.
    """
    sites = durable(report_sites(tables["site"], tables["water"], date_zone))
    per_site = durable(
        tables["fish"].groupBy("id_site", "cd_spp", "cn_spp", "tot_length").agg(
            F.sum("n_fish").alias("n_fish"), F.count_if(F.col("n_fish").isNull()).alias("no_count"), F.count(F.lit(1)).alias("rows")
        )
    )
    joined = site_counts(sites, tables["count"], "id_site", ["cn_spp", "cd_spp"])
    places = ["cd_rvr", "cd_rch", "nm_rch", "cn_spp", "cd_spp", F.to_date("tm_end").alias("date"), "discharge", "temp"]
    catch = joined.groupBy(*places).agg(
        F.sum("n_fish").alias("n_fish"),
        F.sum("_nulls").alias("no_count"),
        F.sum(F.col("amt_effort_sec") * F.col("_rows")).alias("seconds"),
        F.count_if(F.col("amt_effort_sec").isNull()).alias("no_effort"),
    )
    return {"site": sites, "catch": durable(catch), "fish": per_site}


def date_rates(catch: DataFrame) -> DataFrame:
    """``rates.cpue_by_date`` from the base aggregate."""
    grouped = catch.groupBy("cd_rvr", "cd_rch", "cd_spp", "date", "discharge", "temp").agg(
        hours(F.coalesce(F.sum("seconds"), F.lit(0))).alias("tot_effort"), F.coalesce(F.sum("n_fish"), F.lit(0)).alias("n_fish")
    )
    return grouped.withColumn("cpue_dt", ratio("n_fish", "tot_effort"))


def reach_rates(catch: DataFrame) -> DataFrame:
    """``rates.cpue_by_reach`` from the base aggregate."""
    grouped = catch.groupBy("cd_rch", "nm_rch", "cn_spp", "cd_spp").agg(
        F.when(F.sum("no_count") == 0, F.sum("n_fish")).alias("fish_ct"),
        round_to(hours(F.when(F.sum("no_effort") == 0, F.sum("seconds"))), 2).alias("tot_effort"),
    )
    return grouped.withColumn("cpue", round_to(ratio("fish_ct", "tot_effort"), 2)).where("fish_ct > 0")


def length_tables(fish: DataFrame, sites: DataFrame, width: float = 25) -> tuple[DataFrame, DataFrame]:
    """Length summary and histogram per reach and species. Lengths are whole millimetres, so a group has few of them."""
    lengths = durable(reach_lengths(fish, sites).groupBy("cd_rch", "cd_spp", "tot_length").agg(F.sum("rows").alias("rows")))
    known = F.col("tot_length").isNotNull()
    weighted = F.sum(F.when(known, F.col("tot_length") * F.col("rows")))
    summary = lengths.groupBy("cd_rch", "cd_spp").agg(
        F.min("tot_length").alias("min"),
        F.percentile("tot_length", [0.25, 0.5, 0.75], F.col("rows")).alias("_q"),
        ratio(weighted, F.sum(F.when(known, F.col("rows")))).alias("mean"),
        F.max("tot_length").alias("max"),
        F.coalesce(F.sum(F.when(~known, F.col("rows"))), F.lit(0)).alias("n_missing"),
    )
    quartiles = {name: F.col("_q")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))}
    summary = summary.select("cd_rch", "cd_spp", "min", quartiles["q1"], quartiles["median"], "mean", quartiles["q3"], "max", "n_missing")
    center = bin_center("tot_length", width)
    bins = lengths.where(known).groupBy("cd_rch", "cd_spp", center.alias("bin_center")).agg(F.sum("rows").alias("n"))
    return summary, bins


def annual_report_tables(tables: Mapping[str, DataFrame], d_species: DataFrame, d_lifestage: DataFrame, year: int, native: Sequence[str] = fixed.NATIVE_SPECIES, date_zone: str = "UTC", multiply: bool = False) -> dict[str, DataFrame]:
    """Every computed table of the annual report from its four extracts."""
    bases = report_bases(tables, date_zone)
    sites = bases["site"]
    rates = durable(reach_rates(bases["catch"]))
    split = native_split(rates, native)
    summary = sampling_summary(sites)
    total_hours, species_totals = study_totals(rates, summary)
    staged = with_lifestage(bases["fish"], d_species, d_lifestage, species="cd_spp", length="tot_length").where("ls IS NOT NULL")
    # A sum with a missing count is missing.
    staged = staged.withColumn("n_fish", F.when(F.col("no_count") == 0, F.col("n_fish")))
    stage_rates = cpue_by_lifestage(sites, staged, ["cd_rvr", "nm_rvr"], multiply=multiply)
    length_summary, length_histogram = length_tables(bases["fish"], sites)
    rivers = sites.select("cd_rvr", "nm_rvr").distinct()
    water = sampled_water(sites, tables["water"], rivers, year)
    return {
        "sampling": format_summary(summary),
        "water": format_water(water_summary(tables["water"])),
        "flow_points": daily_points(water),
        "cpue_date": date_rates(bases["catch"]),
        "cpue_reach": rates,
        "cpue_reach_native": split["native"],
        "cpue_reach_nonnative": split["nonnative"],
        "cpue_lifestage": stage_rates,
        "lifestage_box": box_stats(stage_rates, ["cd_rvr", "cd_spp", "ls"], "cpue"),
        "length_summary": length_summary,
        "length_histogram": length_histogram,
        "total_hours": total_hours,
        "species_totals": species_totals,
    }


# ----- season update -------------------------------------------------------------------------------
def species_counts(fish: DataFrame, river: str = "river", species: str = "species") -> DataFrame:
    """Fish per river and species, most frequent first within the river."""
    counts = fish.groupBy(river, species).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col(river).asc_nulls_last(), F.col("n").desc_nulls_last(), F.col(species).asc_nulls_last())


def season_update(site: DataFrame, fish: DataFrame, targets: Sequence[str] = ("SM", "WE")) -> dict[str, DataFrame]:
    """Effort, rates by river and by week, and counts, from staged sites and fish."""
    effort = effort_by_river(site)
    by_river = cpue_by_group(site, fish, "key_a", {"river": F.col("river")})
    weeks = {"week": week_of_year(F.to_date("startdatetime")), "river": F.col("river")}
    by_week = cpue_by_group(site, fish, "key_a", weeks)
    counts = species_counts(null_safe_join(fish.drop("river"), site.select("key_a", "river"), ["key_a"], "left"))
    return {
        "effort": effort,
        "effort_overall": effort_overall(effort),
        "cpue_river": by_river,
        "river_summary": null_safe_join(effort, by_river.drop("effort_hr"), ["river"], "left"),
        "cpue_week": by_week,
        "cpue_target": target_only(by_river, targets),
        "cpue_week_target": target_only(by_week, targets),
        "counts": counts,
    }
