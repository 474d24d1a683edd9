"""Seining data products: site, native and non-native area rates, fish and water tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivertally import fixed_values as fixed
from rivertally.functions.numbers import area, total
from rivertally.operators.joins import null_safe_join
from rivertally.operators.rates import area_cpue_native, area_cpue_nonnative, target_catch
from rivertally.plans.hydrology import StationRow, waterdata
from rivertally.sources.tables import write_product


def year_hauls(site: DataFrame, haul: DataFrame, year: int, all_years: bool = False) -> DataFrame:
    """Hauls with their site's reach and their swept area.

    Hauls of other years are left out; ``all_years`` keeps them, without a reach.
    """
    placed = site.where(F.col("year") == year).select("site_id", "reach")
    joined = haul.join(placed, "site_id", "left" if all_years else "inner")
    return joined.withColumn("haul_area", area("haul_length", "haul_width"))


def seine_products(tables: Mapping[str, DataFrame], year: int, water_values: DataFrame | None = None, native: Sequence[str] = fixed.NATIVE_SPECIES, target: str = fixed.DEFAULT_TARGET, stations: Sequence[StationRow] = fixed.STATIONS, all_years: bool = False) -> dict[str, DataFrame]:
    """All product tables of one year.

    ``tables``: site, haul, in_count and fish of the relational store; ``prim_sec`` may be a
    column of the site or of the haul table.
    """
    site, haul, counts = tables["site"], tables["haul"], tables["in_count"]
    hauls = year_hauls(site, haul, year, all_years)
    if "prim_sec" not in hauls.columns:
        hauls = hauls.join(site.select("site_id", "prim_sec"), "site_id", "left")
    swept = hauls.groupBy("site_id", "reach").agg(total("haul_area").alias("haul_area"))
    this_year = site.where(F.col("year") == year)
    own = hauls.join(this_year.select("site_id"), "site_id", "left_semi") if all_years else hauls
    catch = own.select("site_id", "haul_id").join(
        counts.where(F.col("species") == target).groupBy("haul_id", "species").agg(F.sum("fish_count").alias("fish_count")),
        "haul_id",
    )
    sites = null_safe_join(
        this_year.withColumn("hab_area", area("hab_length", "hab_width")), swept, ["site_id", "reach"], "left"
    )
    lengths = tables["fish"].join(own.select("haul_id", "site_id", "reach"), "haul_id", "left")
    out = {
        "site": target_catch(sites, catch, target),
        "cpue_nf": area_cpue_native(hauls, counts, native),
        "cpue_nnf": area_cpue_nonnative(hauls, counts, native),
        "fish": lengths.select("site_id", "reach", "species", "tot_length"),
    }
    if water_values is not None:
        out["waterdata"] = waterdata(water_values, stations).withColumn("dataset_created", F.current_timestamp())
    return out


def write_products(products: Mapping[str, DataFrame], folder: str, prefix: str) -> None:
    for name, df in products.items():
        write_product(df, f"{folder}/{prefix}_{name}.csv")
