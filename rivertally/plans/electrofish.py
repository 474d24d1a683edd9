"""Electrofishing: raw tables to checked staging tables, and staging tables to facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivertally import fixed_values as fixed
from rivertally import schemas
from rivertally.functions import cleaning as c
from rivertally.functions.geo import attach_positions, mean_positions, projected
from rivertally.functions.times import on_day_of, wall_clock
from rivertally.operators import quality as qc
from rivertally.operators.joins import growing, lookup, natural_join, null_safe_join, without_keys
from rivertally.operators.ordered import HOT_ROWS, bucket_bound, fill_down, group_bound, last_index, number_rows
from rivertally.operators.reshape import MAX_WEIGHT, Children, attach_children, weight_of
from rivertally.session import durable
from rivertally.sources.store import Loaded, append_all
from rivertally.sources.tables import conform, stamp_upload, union_like
from rivertally.sources.validation import load_checked

Tables = Mapping[str, DataFrame]


# ----- cleaning of each kind ------------------------------------------------------------
def clean_site(raw: DataFrame, reach_river: DataFrame, study: str, known: DataFrame | None, start: int = 0) -> DataFrame:
    """Sites with times, effort, river, corrected miles and sample ids in order of their end."""
    site = c.null_text(raw)
    if known is not None:
        site = without_keys(site, known, "key_a")
    site = site.withColumns(
        {
            "startdatetime": wall_clock("date", "starttime"),
            "enddatetime": wall_clock("date", "endtime"),
            "el_sec": c.effort_seconds(),
            "project": F.lit(study),
        }
    ).withColumn("year", F.year("startdatetime").cast("long"))
    site = number_rows(site, ["enddatetime", "key_a"], "s_index", start, ties=group_bound(raw, ["key_a"]))
    site = site.drop("river").withColumn("site_id", c.sample_id("project", "year", "s_index"))
    site = c.with_missing(lookup(site, reach_river, {"reach": "cd_rch"}), {"pass": "string", "cd_rvr": "string"})
    names = [
        "s_index", "site_id", "project", "year", "cd_rvr", "reach", "pass", "startdatetime", "enddatetime",
        "start_rmi", "end_rmi", "shoreline", "el_sec", "boat", "crew", "site_notes", "key_a",
    ]
    return c.correct_miles(site.select(*names).withColumnRenamed("cd_rvr", "river"))


def clean_water(raw: DataFrame) -> DataFrame:
    return c.null_text(c.null_zero(raw, ["cond_amb", "cond_spec", "rvr_temp", "secchi"])).withColumnRenamed(
        "h2o_notes", "water_notes"
    )


def clean_fish(raw: DataFrame, native: Sequence[str] = fixed.NATIVE_SPECIES) -> DataFrame:
    fish = c.null_text(c.null_zero(raw, ["ilat", "ilon", "tot_length", "st_length", "weight"]))
    fish = c.null_text(fish, fixed.NO_RAYS_TEXT, ["ray_ct"])
    return fish.withColumns(
        {"tubercles": c.native_only("tubercles", native=native), "rep_cond": F.upper("rep_cond")}
    )


def place_fish(fish: DataFrame, samples: DataFrame, landed: DataFrame | None = None) -> DataFrame:
    """Fish with their site, time and mile, positions as UTM, numbered in time order.

    A site's fish lie together after the join, so its mean positions need no shuffle of their own; fish without a site share theirs with each other and
    get them in the end. Numbering writes its rows once, and the tables built on the fish start there; UTM positions are
    worked out from the written means. ``landed`` holds all the keys of ``fish`` and is cheaper to measure.
    """
    measured = fish if landed is None else landed
    placed = null_safe_join(fish, samples, ["key_a"], "left").withColumn("datetime", on_day_of("t_stamp", "time"))
    placed = c.correct_miles(placed.drop("time", "t_stamp"))
    ties = group_bound(measured, ["key_aa"])
    if group_bound(measured, ["key_a"]) > HOT_ROWS:
        # A site too large for one task: positions by an aggregate and a join that can be split.
        return number_rows(attach_positions(placed, ["site_id", "rmi"]), ["datetime", "key_aa"], "f_index", ties=ties)
    # The join's own keys, so that its layout holds.
    laid = placed.withColumns({"_key": F.coalesce(F.col("key_a").cast("string"), F.lit("")), "_none": F.col("key_a").isNull()})
    meant = mean_positions(laid, ["_key", "_none", "site_id", "rmi"], F.col("site_id").isNotNull()).drop("_key", "_none")
    positions = ["ilon", "ilat"]
    numbered = number_rows(meant.select(*[n for n in meant.columns if n not in positions], *positions), ["datetime", "key_aa"], "f_index", ties=ties)
    astray = numbered.where("site_id IS NULL")
    if astray.limit(1).take(1):
        shared = astray.groupBy("site_id", "rmi").agg(*[F.avg(n).alias(n) for n in positions])
        numbered = numbered.where("site_id IS NOT NULL").unionByName(null_safe_join(astray.drop(*positions), shared, ["site_id", "rmi"], "left"))
    return projected(numbered)


def place_tags(tags: DataFrame, samples: DataFrame, fish: DataFrame, index: str, key: str, landed: DataFrame | None = None) -> DataFrame:
    """Tags or vials with their site and species, numbered in the fish's time order."""
    placed = null_safe_join(tags, samples.select("key_a", "site_id", "s_index"), ["key_a"], "left")
    placed = null_safe_join(placed, growing(fish.select("key_aa", "datetime", "species")), ["key_aa"], "left")
    return number_rows(placed, ["datetime", key], index, ties=group_bound(tags if landed is None else landed, [key])).drop("datetime")


# ----- staging -----------------------------------------------------------------------------
def stage_electrofish(raw: Tables, reach_river: DataFrame, study: str, target: str, stored_site: DataFrame | None = None, native: Sequence[str] = fixed.NATIVE_SPECIES) -> dict[str, DataFrame]:
    """Check tables of a field batch: cleaned, indexed, joined and flagged.

    Rows whose site is already staged are left out, and numbering goes on after the last one.
    """
    tables = {name: c.lower_names(df) for name, df in raw.items()}
    known = None if stored_site is None else stored_site.select("key_a").distinct()
    start = 0 if stored_site is None else last_index(stored_site, "site_id")

    def new(df: DataFrame) -> DataFrame:
        """Cleaned rows whose site isn't stored; they lie by site then, as the next join wants them."""
        return df if known is None else without_keys(df, known, "key_a")

    out: dict[str, DataFrame] = {}
    raw_site = union_like(tables, "site")
    if raw_site is None:
        raise ValueError("a batch needs its site table")
    # Every other table is placed by the sites: worked out once.
    site = durable(clean_site(raw_site, reach_river, study, known, start))
    samples = growing(site.select("key_a", "site_id", "s_index", F.col("enddatetime").alias("t_stamp"), "reach"))
    out["site"] = qc.qc_site(site)

    water = union_like(tables, "water")
    if water is not None:
        out["water_qual"] = null_safe_join(
            new(clean_water(water)), samples.select("key_a", "site_id", "s_index"), ["key_a"], "left"
        ).select(
            "key_ab", "s_index", "site_id", "cond_amb", "cond_spec", "rvr_temp", "secchi", "water_notes", "key_a"
        )

    landed = union_like(tables, "fish")
    if landed is None:
        return out
    fish = place_fish(new(clean_fish(landed, native)), samples, landed)
    out["fish"] = qc.qc_fish(fish, site, native)
    out["stats"] = qc.qc_stats(site, fish, target)

    landed = union_like(tables, "pittag")
    if landed is not None:
        pit = new(c.null_text(landed.where("pit_num IS NOT NULL")))
        pit = place_tags(pit, samples, fish, "p_index", "key_aaa", landed).withColumn("pit_num", F.upper("pit_num"))
        names = ["p_index", "s_index", "key_aaa", "key_aa", "site_id", "species", "pit_type", "pit_num", "pit_recap", "pit_notes", "key_a"]
        out["pittag"] = qc.qc_pit(pit.select(*names), fish)
    landed = union_like(tables, "floytag")
    if landed is not None:
        floy = new(c.null_text(landed.where("floy_num IS NOT NULL"))).drop("floy_id")
        names = ["fl_index", "s_index", "key_aab", "key_aa", "site_id", "species", "floy_color", "floy_num", "floy_recap", "floy_notes"]
        out["floytag"] = qc.qc_floy(place_tags(floy, samples, fish, "fl_index", "key_aab", landed).select(*names))
    landed = union_like(tables, "vial")
    if landed is not None:
        names = ["v_index", "s_index", "key_aac", "key_aa", "site_id", "species", "vial_num", "vial_type", "vial_notes"]
        out["vial"] = place_tags(new(c.null_text(landed)), samples, fish, "v_index", "key_aac", landed).select(*names)
    return out


# ----- facts ----------------------------------------------------------------------------------
def nesting_bound(max_weight: int | None) -> int:
    """Groups up to this size aren't counted one by one: far less than a part holds, or any that a window takes if parts are small."""
    return MAX_WEIGHT // 8 if max_weight is None else HOT_ROWS


def tag_children(staged: Tables, key: str = "key_aa", max_weight: int | None = None) -> dict[str, Children]:
    """Pit tags, floy tags and vials of the fish."""
    found = {}
    if "pittag" in staged:
        found["PitTag"] = staged["pittag"].select(
            key,
            F.col("pit_num").alias("PitTagString"),
            c.yes_no("pit_recap").alias("IsPitTagRecapture"),
            F.col("pit_type").cast("string").alias("PitTagType"),
            F.col("pit_notes").alias("Notes"),
        )
    if "floytag" in staged:
        found["FloyTag"] = staged["floytag"].select(
            key,
            F.col("floy_num").alias("FloyTagString"),
            F.col("floy_color").alias("FloyTagColorCode"),
            c.yes_no("floy_recap").alias("IsFloyTagRecapture"),
            F.col("floy_notes").alias("Notes"),
        )
    if "vial" in staged:
        found["Vial"] = staged["vial"].select(
            key,
            F.col("vial_num").alias("VialString"),
            F.col("vial_type").alias("VialTypeCode"),
            F.col("vial_notes").alias("Notes"),
        )
    return {name: Children(rows, rows.columns[1:], rows.columns[1:2], most=bucket_bound(rows, [key], nesting_bound(max_weight))) for name, rows in found.items()}


def _most_elements(max_weight: int | None, *tables: DataFrame) -> int | None:
    """A bound on the rows of one site in all these tables; None if one of them doesn't name the site."""
    if not all("site_id" in df.columns for df in tables):
        return None
    return sum(bucket_bound(df, ["site_id"], nesting_bound(max_weight)) for df in tables)


def electrofish_facts(staged: Tables, native: Sequence[str] = fixed.NATIVE_SPECIES, max_weight: int | None = None) -> DataFrame:
    """Nested facts from proofed staging tables: tags in fish, fish and water in sites.

    ``FishNumber`` tells the fish of a batch apart; a fish with very many tags has several elements with one number. What a required column
    lacks is left missing; see ``load_electrofish``.
    """
    fish_number = "f_index"
    tables = {
        name: c.drop_matching(df.withColumn("_number", F.col(fish_number)) if name == "fish" else df, fixed.FLAG_OR_INDEX_COLUMNS)
        for name, df in staged.items()
    }
    site = tables["site"].select(
        F.col("site_id").alias("SiteID"),
        F.col("project").alias("StudyCode"),
        F.col("river").alias("RiverCode"),
        F.col("pass").cast("string").alias("PassIdentifier"),
        F.col("start_rmi").alias("StartLocation_BelknapMiles"),
        F.col("end_rmi").alias("EndLocation_BelknapMiles"),
        F.col("startdatetime").alias("StartDateTime_UTC"),
        F.col("enddatetime").alias("EndDateTime_UTC"),
        F.col("shoreline").alias("Shoreline"),
        F.col("el_sec").alias("Effort_Seconds"),
        F.col("boat").alias("BoatName"),
        F.col("crew").alias("CrewNames"),
        F.col("site_notes").alias("Notes"),
    )
    children = {}
    if "water_qual" in tables:
        water = tables["water_qual"].select(
            F.col("site_id").alias("SiteID"),
            F.col("cond_amb").alias("AmbientConductivityMain_uS"),
            F.col("cond_spec").alias("SpecificConductivityMain_uS"),
            F.col("rvr_temp").alias("WaterTemperatureMain_C"),
            F.col("secchi").alias("SecchiDepthMain_mm"),
            F.col("water_notes").alias("Notes"),
        )
        children["WaterQuality"] = Children(water, water.columns[1:], water.columns[1:], most=bucket_bound(water, ["SiteID"], nesting_bound(max_weight)))
    if "fish" in tables:
        fish = tables["fish"].where("key_aa IS NOT NULL")
        fish = c.with_missing(fish, {"st_length": "long"})
        tags = tag_children(tables, max_weight=max_weight)
        # A part of a fish holds a tag at least, so there are no more elements than fish and tags, and no more weight than twice that.
        most = _most_elements(max_weight, fish, *[tables[kind] for kind in ("pittag", "floytag", "vial") if kind in tables])
        fish = attach_children(fish, tags, "key_aa", max_weight)
        fish = fish.select(
            F.col("site_id").alias("SiteID"),
            F.col("datetime").alias("EncounterDateTime_UTC"),
            F.col("rmi").alias("EncounterLocation_BelknapMiles"),
            F.col("species").alias("SpeciesCode"),
            F.lit(1).cast("long").alias("FishCount"),
            F.col("tot_length").alias("TotalLength_mm"),
            F.col("st_length").alias("StandardLength_mm"),
            F.col("weight").alias("Weight_g"),
            F.col("sex").alias("Sex"),
            c.is_ripe().alias("IsRipe"),
            c.is_tuberculate(native=native).alias("IsTuberculate"),
            c.ray_count(1).alias("DorsalRayCount"),
            c.ray_count(2).alias("AnalRayCount"),
            F.col("disp").alias("DispositionCode"),
            F.col("loc_x").alias("EncounterEasting_UTM"),
            F.col("loc_y").alias("EncounterNorthing_UTM"),
            F.col("epsg").alias("EncounterEPSGCode"),
            F.col("fish_notes").alias("Notes"),
            *tags,
            F.col("_number").cast("long").alias("FishNumber"),
            "Part",
            "Parts",
        )
        fields = [n for n in fish.columns if n != "SiteID"]
        weighed = fish.withColumn("_weight", weight_of(*tags))
        children["FishData"] = Children(weighed, fields, ["EncounterDateTime_UTC", "FishNumber", "Part"], "_weight", most, None if most is None else 2 * most)
    return conform(attach_children(site, children, "SiteID", max_weight), schemas.F_ELECTROFISH)


def load_electrofish(staged: Tables, path: str, rejects: str | None = None, native: Sequence[str] = fixed.NATIVE_SPECIES, max_weight: int | None = None, skip_repeats: bool = False) -> DataFrame:
    """Nest and append, unless a site of the batch is already stored; returns the rows that lack a required value.

    Those rows go, with the names of what they lack, to ``rejects`` (beside the facts, if not named) and not to the facts.
    """
    facts = electrofish_facts(staged, native, max_weight).withColumn("Year", F.year("StartDateTime_UTC").cast("long"))
    return load_checked(facts, schemas.F_ELECTROFISH, path, rejects, skip_repeats=skip_repeats)


# ----- flat load and vial extract -------------------------------------------------------------
def finalise_for_load(staged: Tables, stored_site: DataFrame | None) -> dict[str, DataFrame]:
    """Flat tables for the relational store: helpers dropped, times as text, batch number stamped."""
    out = {
        name: c.drop_matching(c.kinds_to_text(df, T.TimestampType, T.TimestampNTZType), fixed.HELPER_COLUMNS)
        for name, df in staged.items()
    }
    if "site" in out:
        out["site"] = stamp_upload(out["site"].withColumnRenamed("project", "project_code"), stored_site)
    if "fish" in out:
        # A fish is told by its id column; site rows without fish have none.
        real = staged["fish"].where("key_aa IS NOT NULL")
        text = c.kinds_to_text(real, T.TimestampType, T.TimestampNTZType)
        out["fish"] = c.drop_matching(text, fixed.HELPER_COLUMNS).drop("reach")
    if "pittag" in out:
        out["pittag"] = c.cast_columns(out["pittag"], {"pit_type": "string"}).drop("species", "site_id")
    if "floytag" in out:
        out["floytag"] = out["floytag"].drop("species", "site_id")
    if "meta" in out:
        out["meta"] = out["meta"].distinct()
    return out


def load_flat(staged: Tables, root: str) -> Loaded:
    """Append the flat tables under the next upload number; the same tables again, in any order of rows, change nothing."""
    flat = finalise_for_load(staged, None)
    return append_all({name: df.drop("upload_id") for name, df in flat.items()}, root)


def vial_extract(site: DataFrame, fish: DataFrame, vials: DataFrame, tags: DataFrame | None = None, fixes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Fish with vials, and the sites they came from.

    Positions that a fish lacks are taken from the fish before it at the same site. ``fixes``
    overlays corrected fish values by ``f_index``.
    """
    columns = [
        "site_id", "river", "reach", "rmi", "datetime", "species", "tot_length", "weight", "sex", "rep_cond",
        "disp", "fish_notes", "loc_x", "loc_y", "epsg", "vial_num", "vial_type", "vial_notes",
    ]
    if fixes is None:
        # What the result doesn't show isn't moved about.
        fish = fish.select(*[n for n in fish.columns if n in {"s_index", "f_index", "key_a", "key_aa", *columns} - {"site_id", "reach", "river"}])
    placed = fill_down(fish, ["s_index"], ["datetime", "f_index"], ["loc_x", "loc_y"])
    if tags is not None:
        placed = null_safe_join(placed, tags.select("key_a", "key_aa", "pit_num", "pit_recap"), ["key_a", "key_aa"], "left")
    held = null_safe_join(
        placed, vials.select("key_a", "key_aa", "vial_num", "vial_type", "vial_notes"), ["key_a", "key_aa"], "inner"
    ).where("species IS NOT NULL")
    if fixes is not None:
        held = c.apply_corrections(held, fixes, "f_index")
    labelled = null_safe_join(
        held.drop("river", "reach", "site_id"), site.select("key_a", "site_id", "river", "reach"), ["key_a"], "left"
    )
    rows = labelled.select(*columns)
    return {"fish": rows, "site": natural_join(site, rows.select("site_id"), "left_semi")}
