"""The in-season update from state that grows by batches.

A batch of staged sites and fish becomes a small table of sums: effort per river and day, effort and catch per river and per week and
river, and fish per river and species. All of it adds up, so the tables of the season come from the sums of all batches, and a new batch is the
only thing that is read when it arrives. The state of an upload is a folder of its own: adding an upload again replaces it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivertally.functions.numbers import hours, round_to
from rivertally.functions.times import week_of_year
from rivertally.operators.joins import null_safe_join
from rivertally.operators.rates import effort_overall, tally, target_only, zero_filled_rates
from rivertally.session import durable
from rivertally.sources import store

STATE_KEYS = ["measure", "river", "week", "date", "species"]


def season_state(site: DataFrame, fish: DataFrame, key: str = "key_a") -> DataFrame:
    """``STATE_KEYS``, ``amount``, ``missing`` and ``rows`` of one batch; a fish belongs to a site of its own batch.

    Missing values are counted, since one of them makes a sum missing. Copies of a site row count its effort per day as often as it is listed, and its
    effort in rates once.
    """
    day = F.to_date("startdatetime")
    placed = site.select(key, "river", day.alias("date"), week_of_year(day).alias("week"), F.col("el_sec").cast("long").alias("el_sec"))
    none = {"week": F.lit(None).cast("long"), "date": F.lit(None).cast("date"), "species": F.lit(None).cast("string")}

    def sums(measure: str, rows: DataFrame, names: Sequence[str], amount: Column, missing: Column | None = None) -> DataFrame:
        made = rows.groupBy(*names).agg(
            F.coalesce(F.sum(amount), F.lit(0)).cast("long").alias("amount"),
            (F.lit(0) if missing is None else F.count_if(missing)).cast("long").alias("missing"),
            F.count(F.lit(1)).alias("rows"),
        )
        made = made.withColumns({n: v for n, v in none.items() if n not in names})
        return made.select(F.lit(measure).alias("measure"), *STATE_KEYS[1:], "amount", "missing", "rows")

    no_effort = F.col("el_sec").isNull()
    caught = tally(fish, [key, "species"], into="_n")
    parts = [sums("effort_day", placed, ["river", "date"], F.col("el_sec"), no_effort)]
    for grain, names in (("river", ["river"]), ("week", ["week", "river"])):
        parents = placed.groupBy(key, *names, "el_sec").agg(F.count(F.lit(1)).alias("_times"))
        parts.append(sums(f"effort_{grain}", parents, names, F.col("el_sec"), no_effort))
        found = null_safe_join(parents, caught, [key], "inner").where(F.col("species").isNotNull())
        parts.append(sums(f"catch_{grain}", found, [*names, "species"], F.col("_n") * F.col("_times")))
    rivers = site.groupBy(key, "river").agg(F.count(F.lit(1)).alias("_times"))
    every = null_safe_join(caught, rivers, [key], "left")
    parts.append(sums("count", every, ["river", "species"], F.col("_n") * F.coalesce("_times", F.lit(1))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def merge_states(state: DataFrame) -> DataFrame:
    """The sums of all states that were put together."""
    return state.groupBy(*STATE_KEYS).agg(*[F.sum(c).alias(c) for c in ("amount", "missing", "rows")])


def add_upload(state: DataFrame, path: str, upload: int) -> None:
    """Store the state of an upload, in place of what it had before."""
    spark = state.sparkSession
    folder = store.write_incoming(state.coalesce(1), path, [])  # sums: a few rows per river, day and species
    store.delete(spark, f"{path}/upload={upload}")
    store.move(spark, folder, f"{path}/upload={upload}")


def current_state(spark: SparkSession, path: str) -> DataFrame:
    return merge_states(spark.read.parquet(path))


def season_tables(state: DataFrame, targets: Sequence[str] = ("SM", "WE")) -> dict[str, DataFrame]:
    """The tables of ``reports.season_update``, from merged state."""
    state = durable(state)

    def of(measure: str) -> DataFrame:
        return state.where(F.col("measure") == measure)

    def known(value: Column) -> Column:
        return F.when(F.sum("missing") == 0, F.coalesce(value, F.lit(0)))

    effort = of("effort_day").groupBy("river").agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        round_to(hours(known(F.sum("amount"))), 1).alias("total_effort_hr"),
        F.count(F.lit(1)).alias("sampling_days"),
    )

    def rates(grain: str, names: Sequence[str]) -> DataFrame:
        spent = of(f"effort_{grain}").groupBy(*names).agg(round_to(hours(known(F.sum("amount"))), 1).alias("effort_hr"))
        return zero_filled_rates(spent, of(f"catch_{grain}").select(*names, "species", F.col("amount").alias("fish_ct")), names)

    by_river, by_week = rates("river", ["river"]), rates("week", ["week", "river"])
    counts = of("count").select("river", "species", F.col("amount").alias("n"))
    return {
        "effort": effort,
        "effort_overall": effort_overall(effort),
        "cpue_river": by_river,
        "river_summary": null_safe_join(effort, by_river.drop("effort_hr"), ["river"], "left"),
        "cpue_week": by_week,
        "cpue_target": target_only(by_river, targets),
        "cpue_week_target": target_only(by_week, targets),
        "counts": counts.orderBy(F.col("river").asc_nulls_last(), F.col("n").desc_nulls_last(), F.col("species").asc_nulls_last()),
    }
