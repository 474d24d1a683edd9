"""Seining: raw tables to checked staging tables, and staging tables to facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivertally import fixed_values as fixed
from rivertally import schemas
from rivertally.functions import cleaning as c
from rivertally.functions.numbers import total
from rivertally.functions.times import parse_date, wall_clock
from rivertally.operators.joins import growing, lookup, null_safe_join, union_all, without_keys
from rivertally.operators.ordered import HOT_ROWS, bucket_bound, group_bound, last_index, number_rows, number_within
from rivertally.operators.quality import attach_site
from rivertally.operators.reshape import MAX_WEIGHT, Children, attach_children, pivot_wide, weight_of
from rivertally.session import durable
from rivertally.sources.tables import conform, union_like
from rivertally.sources.validation import load_checked

Tables = Mapping[str, DataFrame]

# --- Fixed values: depth measurements -------------------------------------------------
DEPTH_LOCATIONS = ["loc1", "loc2", "mx"]
DEPTH_MEASURES = ["depth", "sub_1", "sub_2"]
DEPTH_FIELDS = {
    "loc1_depth": "DepthAtLocation1_mm",
    "loc1_sub_1": "PrimarySubstrateAtLocation1",
    "loc1_sub_2": "SecondarySubstrateAtLocation1",
    "loc2_depth": "DepthAtLocation2_mm",
    "loc2_sub_1": "PrimarySubstrateAtLocation2",
    "loc2_sub_2": "SecondarySubstrateAtLocation2",
    "mx_depth": "MaximumDepth_mm",
    "mx_sub_1": "PrimarySubstrateAtMaximumDepth",
    "mx_sub_2": "SecondarySubstrateAtMaximumDepth",
}
OPTIONAL_SITE_COLUMNS = {
    "mc_temp": "double", "mc_secchi": "long", "hab_1": "string", "hab_2": "string", "hab_length": "long",
    "hab_width": "long", "hab_mx_dep": "long", "hab_temp": "double", "hab_secchi": "long", "algae": "string",
}


# ----- identifiers ------------------------------------------------------------------------
def haul_times(site: DataFrame, haul: DataFrame) -> DataFrame:
    """Start time of every haul: the site's date and the haul's clock time."""
    days = site.select("key_a", "date")
    joined = null_safe_join(haul.select("key_a", "key_aa", "starttime"), growing(days), ["key_a"], "inner")
    return joined.select("key_a", "key_aa", wall_clock("date", "starttime").alias("ts"))


def sample_keys(site: DataFrame, times: DataFrame, ties: int) -> DataFrame:
    """Site and haul ids per haul: hauls are numbered by time, overall and inside their site."""
    hauls = number_rows(times, ["ts", "key_aa"], "h_idx", ties=ties)
    known = null_safe_join(site.select("id_site", "key_a", "s_idx"), growing(hauls), ["key_a"], "left")
    numbered = number_within(known, ["id_site"], ["ts", "key_aa"], "_haul")
    # Few columns, and joined to every other table: written once.
    return durable(numbered.withColumn("id_haul", c.haul_id("id_site", "_haul")).drop("_haul"))


def place_sites(site: DataFrame, times: DataFrame, reach_river: DataFrame, study: str, start: int) -> DataFrame:
    """Sites with hauls, numbered by their first haul."""
    firsts = times.groupBy("key_a").agg(F.min("ts").alias("_first"))
    order = number_rows(firsts, ["_first", "key_a"], "s_idx", start, unique=True).drop("_first")
    dated = null_safe_join(site, growing(order), ["key_a"], "inner").withColumns(
        {"study": F.lit(study), "date": parse_date("date")}
    )
    dated = dated.withColumn("year", F.year("date").cast("long"))
    named = dated.withColumn("id_site", c.sample_id("study", "year", "s_idx"))
    placed = lookup(named, reach_river, {"reach": "cd_rch"}).withColumnRenamed("reach", "cd_rch")
    placed = c.with_missing(placed, OPTIONAL_SITE_COLUMNS)
    first = ["id_site", "study", "year", "pass", "cd_rvr", "cd_rch", "date", "rmi"]
    measured = c.columns_like(placed, "mc_|hab_")
    return placed.select(*first, *measured, "algae", "ilat", "ilon", "crew", "site_notes", "s_idx", "key_a")


# ----- staging --------------------------------------------------------------------------------
def stage_seine(raw: Tables, reach_river: DataFrame, study: str, stored_site: DataFrame | None = None, depths: bool = False, locations: Sequence[str] = DEPTH_LOCATIONS) -> dict[str, DataFrame]:
    """Check tables of a seining batch: site, haul, fish (with counts) and vial.

    ``depths`` is for studies that measure depth at several places of a haul: the depth table is
    pivoted onto the hauls, and hauls without a mean depth stay.
    """
    tables = {name: c.lower_names(df) for name, df in raw.items()}
    known = None if stored_site is None else stored_site.select("key_a").distinct()
    start = 0 if stored_site is None else last_index(stored_site, "id_site")

    def incoming(kind: str) -> DataFrame | None:
        df = union_like(tables, kind)
        if df is None:
            return None
        df = c.null_text(df)
        return df if known is None else without_keys(df, known, "key_a")

    site, haul = incoming("site"), incoming("haul")
    if site is None or haul is None:
        raise ValueError("a batch needs its site and haul tables")
    site = c.null_zero(site)
    times = haul_times(site, haul)
    site = place_sites(site, times, reach_river, study, start)
    keys = growing(sample_keys(site, times, group_bound(haul, ["key_aa"])))
    on = ["key_a", "key_aa"]

    measured = (F.col("haul_width") > 0) & (F.col("haul_lengt") > 0)
    if not depths:
        measured = measured & (F.col("avg_dep") > 0)
    hauls = null_safe_join(c.with_missing(haul, {"avg_dep": "double"}), keys, on, "left").where(measured)
    hauls = hauls.select(
        "id_haul",
        "id_site",
        F.col("gear").alias("cd_gear"),
        F.col("ts").alias("haul_datetime"),
        F.col("haul_lengt").alias("haul_length"),
        "haul_width",
        F.col("avg_dep").alias("haul_avg_depth"),
        F.col("substrate").alias("cd_sub"),
        "rs",
        "ss",
        "fh",
        "haul_notes",
        "s_idx",
        "h_idx",
        *on,
    )
    depth = incoming("depth") if depths else None
    if depth is not None:
        hauls = null_safe_join(hauls, growing(pivot_wide(depth, on, "location", DEPTH_MEASURES, locations)), on, "left")

    count = incoming("count")
    fish = incoming("fish")
    parts = []
    if fish is not None:
        fish = null_safe_join(c.null_zero(fish, ["tot_length", "weight"]), keys, on, "left")
        parts.append(
            fish.select(
                "id_haul",
                "id_site",
                F.col("species").alias("cd_spp"),
                F.lit(1).cast("long").alias("n_fish"),
                "tot_length",
                "weight",
                F.col("disp").alias("cd_disp"),
                "photo_num",
                "fish_notes",
                *on,
                "key_aaa",
                "s_idx",
            )
        )
    if count is not None:
        kept = count.where(F.col("species").isNotNull())
        summed = kept.groupBy(*on, "species", "disp").agg(total("fish_count", na_rm=False).alias("n_fish"))
        parts.append(
            null_safe_join(summed, keys, on, "left").select(
                "id_site",
                "id_haul",
                F.col("species").alias("cd_spp"),
                F.col("n_fish").cast("long").alias("n_fish"),
                F.col("disp").alias("cd_disp"),
                *on,
                "s_idx",
            )
        )
    others = {}
    if parts:
        others["fish"] = union_all(*parts)
    vial = incoming("vial")
    if vial is not None:
        held = null_safe_join(vial.where("vial_num IS NOT NULL"), keys, on, "left")
        others["vial"] = held.select(
            "id_haul", "id_site", "vial_num", "vial_type", "photo_num", "vial_notes", *on, "key_aac", "s_idx"
        )
    return {"site": site} | attach_site(site, hauls, others)


# ----- facts ------------------------------------------------------------------------------------
def seine_facts(staged: Tables, max_weight: int | None = None) -> DataFrame:
    """Nested facts from proofed staging tables: fish in hauls, hauls and water in sites.

    A haul with very many fish has several elements with one ``HaulID``.
    """
    tables = {name: c.drop_matching(df, fixed.HELPER_COLUMNS) for name, df in staged.items()}
    source = tables["site"]
    # Groups up to this size aren't counted one by one: far less than a part holds, or any that a window takes if parts are small.
    enough = MAX_WEIGHT // 8 if max_weight is None else HOT_ROWS
    water = source.select(
        F.col("id_site").alias("SiteID"),
        F.col("mc_temp").alias("WaterTemperatureMain_C"),
        F.col("mc_secchi").alias("SecchiDepthMain_mm"),
        F.col("hab_temp").alias("WaterTemperatureHabitat_C"),
        F.col("hab_secchi").alias("SecchiDepthHabitat_mm"),
        F.col("hab_secchi").isNull().alias("IsSecchiMaxDepth"),
        c.secchi_note("site_notes").alias("WaterQualityNotes"),
    )
    children = {"WaterQuality": Children(water, water.columns[1:], water.columns[1:], most=bucket_bound(water, ["SiteID"], enough))}

    in_hauls = {}
    if "fish" in tables:
        fish = c.kinds_to_text(tables["fish"], T.BooleanType)
        fish = fish.select(
            F.col("id_haul").alias("HaulID"),
            F.col("cd_spp").alias("SpeciesCode"),
            F.col("n_fish").alias("FishCount"),
            F.col("tot_length").alias("TotalLength_mm"),
            F.col("weight").alias("Weight_g"),
            F.col("cd_disp").alias("DispositionCode"),
            F.col("photo_num").cast("string").alias("PhotoURLorID"),
            F.col("fish_notes").alias("FishEncounterNotes"),
        )
        in_hauls["FishData"] = Children(fish, fish.columns[1:], ["SpeciesCode", "TotalLength_mm"], most=bucket_bound(fish, ["HaulID"], enough))
    if "vial" in tables:
        vial = tables["vial"].select(
            F.col("id_haul").alias("HaulID"),
            F.col("vial_num").cast("string").alias("VialString"),
            F.col("vial_type").alias("VialTypeCode"),
            F.col("vial_notes").alias("VialNotes"),
        )
        in_hauls["HaulVial"] = Children(vial, vial.columns[1:], ["VialString"], most=bucket_bound(vial, ["HaulID"], enough))

    hauls = tables["haul"]
    depth = [F.col(name).alias(field) for name, field in DEPTH_FIELDS.items() if name in hauls.columns]
    hauls = hauls.select(
        F.col("id_site").alias("SiteID"),
        F.col("id_haul").alias("HaulID"),
        F.col("haul_datetime").cast("timestamp_ntz").alias("HaulDateTime_Local"),
        F.col("cd_gear").alias("GearCode"),
        F.col("haul_length").alias("HaulLength_m"),
        F.col("haul_width").alias("HaulWidth_m"),
        F.col("haul_avg_depth").alias("HaulMeanDepth_mm"),
        F.col("cd_sub").alias("PrimarySubstrate"),
        F.col("rs").alias("HasRedShiner"),
        F.col("ss").alias("HasSandShiner"),
        F.col("fh").alias("HasFatHead"),
        F.col("haul_notes").alias("HaulNotes"),
        *depth,
    )
    hauls = attach_children(c.yes_no_columns(hauls), in_hauls, "HaulID", max_weight)
    fields = [n for n in hauls.columns if n != "SiteID"]
    weighed = hauls.withColumn("_weight", weight_of(*in_hauls))
    # A part of a haul holds a fish or a vial at least, so the weight is no more than twice the rows.
    inside = [tables["haul"], *[tables[kind] for kind in ("fish", "vial") if kind in tables]]
    most = sum(bucket_bound(df, ["id_site"], enough) for df in inside) if all("id_site" in df.columns for df in inside) else None
    children["HaulData"] = Children(weighed, fields, ["HaulID", "Part"], "_weight", most, None if most is None else 2 * most)

    site = source.select(
        F.col("id_site").alias("SiteID"),
        F.col("study").alias("StudyCode"),
        F.col("cd_rvr").alias("RiverCode"),
        F.col("pass").cast("string").alias("PassIdentifier"),
        F.col("rmi").alias("SiteLocation_BelknapMiles"),
        F.to_date("date").alias("SiteDate_Local"),
        F.col("hab_1").alias("PrimaryHabitatCode"),
        F.col("hab_2").alias("SecondaryHabitatCode"),
        F.col("hab_length").alias("SiteLength_m"),
        F.col("hab_width").alias("SiteWidth_m"),
        F.col("hab_mx_dep").alias("SiteMaxDepth_mm"),
        c.yes_no("algae").alias("IsAlgaePresent"),
        F.col("ilon").alias("SiteLongitude_DD"),
        F.col("ilat").alias("SiteLatitude_DD"),
        F.lit(fixed.EPSG_WGS84).cast("long").alias("SiteEPSGCode"),
        F.col("crew").alias("CrewNames"),
        F.col("site_notes").alias("SiteNotes"),
    )
    return conform(attach_children(site, children, "SiteID", max_weight), schemas.F_SEINE)


def load_seine(staged: Tables, path: str, rejects: str | None = None, max_weight: int | None = None, skip_repeats: bool = False) -> DataFrame:
    """Nest and append, unless a site of the batch is already stored; returns the rows that lack a required value.

    Those rows go, with the names of what they lack, to ``rejects`` (beside the facts, if not named) and not to the facts.
    """
    facts = seine_facts(staged, max_weight).withColumn("Year", F.year("SiteDate_Local").cast("long"))
    return load_checked(facts, schemas.F_SEINE, path, rejects, skip_repeats=skip_repeats)
