"""Quality flags. Rows are kept; each rule adds a ``*_flg`` column holding FLAG or empty text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivertally import fixed_values as fixed
from rivertally.functions.cleaning import columns_between, is_in, not_in
from rivertally.functions.numbers import hours, ratio, round_to, total
from rivertally.operators.joins import growing, natural_join, null_safe_join
from rivertally.operators.rates import tally


def flag(condition: Column) -> Column:
    """FLAG, empty, or missing where the condition cannot be decided."""
    return F.when(condition, fixed.FLAG).when(~condition, "")


def _any_null(df: DataFrame, first: str, last: str) -> Column:
    return flag(reduce(Column.__or__, [F.col(c).isNull() for c in columns_between(df, first, last)]))


def outside_reach(miles: Sequence[str], reach: str = "reach", limits: Mapping[str, tuple[float, float]] = fixed.REACH_LIMITS) -> Column:
    """FLAG unless every mile lies inside its reach; unknown reaches and missing miles are flagged."""
    chain = F
    for code, (low, high) in limits.items():
        inside = reduce(Column.__and__, [F.col(m).between(low, high) for m in miles])
        chain = chain.when((F.col(reach) == code) & inside, "")
    return chain.otherwise(fixed.FLAG)


def qc_site(site: DataFrame, limits: Mapping[str, tuple[float, float]] = fixed.REACH_LIMITS) -> DataFrame:
    elapsed = F.unix_micros("enddatetime") - F.unix_micros("startdatetime")
    return site.withColumns(
        {
            "rmi_length_flg": flag(
                (F.col("start_rmi") - F.col("end_rmi") > fixed.MAX_SITE_MILES) | (F.col("start_rmi") < F.col("end_rmi"))
            ),
            "rmi_flg": outside_reach(["start_rmi", "end_rmi"], limits=limits),
            "datetime_flg": flag(elapsed < F.col("el_sec") * 1_000_000),
            "el_sec_flg": flag(
                (F.col("el_sec") > fixed.MAX_EFFORT_SECONDS) | (F.col("el_sec") < fixed.MIN_EFFORT_SECONDS)
            ),
            "NA_flg": _any_null(site, "s_index", "crew"),
        }
    )


def qc_fish(fish: DataFrame, site: DataFrame, native: Sequence[str] = fixed.NATIVE_SPECIES, limits: Mapping[str, tuple[float, float]] = fixed.REACH_LIMITS) -> DataFrame:
    """Fish and sites side by side (sites without fish included), with flags."""
    joined = natural_join(site.select("s_index", "site_id", "key_a"), fish, "full")
    ordinary = not_in("species", fixed.LARGE_BODIED_SPECIES)
    is_native = is_in("species", native)
    wrong = (
        ((F.col("disp") == "DE") & is_native) | ((F.col("disp") == "RA") & ~is_native) | F.col("disp").isNull()
    )
    return joined.withColumns(
        {
            "orphan_flg": flag(F.col("s_index").isNull()),
            "rmi_flg": outside_reach(["rmi"], limits=limits),
            "species_flg": flag(not_in("species", fixed.COMMON_SPECIES)),
            "tot_length_flg": flag(ordinary & (F.col("tot_length") > fixed.MAX_LENGTH_MM)),
            "weight_flg": flag(ordinary & (F.col("weight") > fixed.MAX_WEIGHT_G)),
            "disp_flg": flag(wrong),
        }
    )


def qc_pit(pit: DataFrame, fish: DataFrame) -> DataFrame:
    """Tags with their fish, and flags. A valid number gives a missing flag, not an empty one."""
    joined = natural_join(growing(fish.select("f_index", "key_aa", "species")), pit, "right")
    chain = F
    for kind, digits in fixed.PIT_NUMBER_LENGTHS.items():
        wrong = (F.col("pit_type").cast("string") == kind) & (F.length("pit_num") != digits)
        chain = chain.when(wrong, fixed.FLAG)
    return joined.withColumns(
        {
            "orphan_flg": flag(F.col("f_index").isNull()),
            "nnf_flg": flag(F.col("pit_recap") == "NNF"),
            "pit_recap_flg": flag(F.col("pit_recap").isNull() != F.col("pit_num").isNull()),
            "invalid_pitnum_flg": chain,
        }
    )


def qc_floy(floy: DataFrame) -> DataFrame:
    return floy.withColumn("NA_flg", _any_null(floy, "fl_index", "floy_recap"))


def qc_stats(site: DataFrame, fish: DataFrame, target: str) -> DataFrame:
    """Sites, hours, catch and rate of the target species per pass and reach."""
    counted = tally(fish.where(F.col("species") == target), ["site_id"], into="ct")
    joined = null_safe_join(site, counted, ["site_id"], "left")
    grouped = joined.groupBy("pass", "reach").agg(
        F.count(F.lit(1)).alias("n_site"),
        round_to(hours(total("el_sec", na_rm=False)), 2).alias("effort_hr"),
        total("ct").alias("catch"),
    )
    return grouped.withColumns(
        {"cpue": round_to(ratio("catch", "effort_hr"), 2), "species": F.lit(target)}
    )


def only_flagged(df: DataFrame) -> DataFrame:
    """Rows with at least one flag."""
    flags = [F.coalesce(F.col(c) == fixed.FLAG, F.lit(False)) for c in df.columns if c.endswith("_flg")]
    return df.where(reduce(Column.__or__, flags, F.lit(False)))


def attach_site(site: DataFrame, haul: DataFrame, others: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Seine check tables: pass, river, reach and mile next to every haul, fish and vial row."""
    place = ["pass", "cd_rvr", "cd_rch", "rmi"]
    hauls = null_safe_join(haul, growing(site.select("id_site", *place)), ["id_site"], "left")
    by_haul = growing(hauls.select("id_haul", *place))
    return {"haul": hauls} | {
        name: null_safe_join(frame, by_haul, ["id_haul"], "left") for name, frame in others.items()
    }
