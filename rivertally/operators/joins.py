"""Joins with the survey's key rules.

In-memory survey tables match a missing key with a missing key; warehouse views do not. A side is
hinted to be broadcast only after its rows were counted (``if_small``). Otherwise the choice is
Spark's, by ``spark.sql.autoBroadcastJoinThreshold``, and hot keys are split at run time. Spark takes the compressed size of files for that of
their rows, which may be a hundred times as large; a side that grows with the data is therefore marked by ``growing``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SMALL_ROWS = 50_000


def if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def growing(df: DataFrame) -> DataFrame:
    """``df`` with a hint that a join with it shuffles both sides: its rows never pass through the driver, however small their files are."""
    return df.hint("merge")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match. Key columns appear once, first for a full join."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    rest = [c for c in renamed.columns if c not in {f"_r_{k}" for k in on}]
    if how in ("right", "full"):
        keys = {c: F.coalesce(F.col(c), F.col(f"_r_{c}")).alias(c) for c in on}
        return joined.select(*[keys.get(c, F.col(c)) for c in left.columns], *rest)
    return joined.select(*left.columns, *rest)


def natural_keys(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]


HEAVY_KEYS = 100
SALTS = 32


def heavy_keys(df: DataFrame, keys: Sequence[str], part: float = 1 / 200) -> list[int]:
    """Hashes of the keys that hold more than ``part`` of the rows, by a mergeable sketch; at most ``HEAVY_KEYS``."""
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(HEAVY_KEYS), F.lit(10 * HEAVY_KEYS))
    found, rows = df.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [entry["item"] for entry in found or [] if entry["count"] > max(1, part * rows)]


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join on ``keys``, null-safe, in one shuffle, also where ``left`` has keys with very many rows.

    Rows of a hot key of ``left`` are dealt to ``SALTS`` parts, by what they hold (so a task that runs again deals the same way, and
    exact copies stay together), and the rows of ``right`` with such a key are copied to all of them. A copy
    that meets no row in its part is dropped: the key is there on the left, so the row is matched in another part.

    A ``left`` that has the keys only, each once, adds nothing to the rows of ``right``: only keys are shuffled, to find those that ``right`` lacks.
    """
    if set(left.columns) == set(keys) and not left.groupBy(*keys).count().where("count > 1").limit(1).take(1):
        alone = null_safe_join(left, right.select(*keys).distinct(), keys, "left_anti")
        return union_all(alone, right).select(*left.columns, *[c for c in right.columns if c not in keys])
    hot = heavy_keys(left, keys)
    order = left.columns + [c for c in right.columns if c not in keys]
    if not hot:
        return null_safe_join(left, right, keys, "full").select(*order)
    is_hot = F.xxhash64(*keys).isin(hot)
    own = [f.name for f in left.schema.fields if f.dataType.typeName() != "map"]
    dealt = left.withColumns({"_salt": F.when(is_hot, F.pmod(F.xxhash64(*own), F.lit(SALTS))).otherwise(0), "_here": F.lit(True)})
    copies = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    copied = right.withColumns({"_copied": is_hot, "_salt": F.explode(copies)})
    joined = null_safe_join(dealt, copied, [*keys, "_salt"], "full")
    return joined.where(F.col("_here").isNotNull() | ~F.coalesce("_copied", F.lit(False))).select(*order)


def natural_join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on all shared columns; nulls match.

    Spark splits hot keys of one-sided joins at run time; a full join deals them out itself.
    """
    keys = natural_keys(left, right)
    if how == "full":
        return full_join(left, right, keys)
    if how == "right":
        order = left.columns + [c for c in right.columns if c not in keys]
        return null_safe_join(right, left, keys, "left").select(*order)
    if how == "left_semi":
        return null_safe_join(left, right.select(*keys).distinct(), keys, how)
    return null_safe_join(left, right, keys, how)


def lookup(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str = "left") -> DataFrame:
    """Join on differently named keys (left name: right name); the right names are dropped."""
    renamed = right.withColumnsRenamed({r: f"_r_{r}" for r in keys.values()})
    condition = reduce(Column.__and__, [F.col(l).eqNullSafe(F.col(f"_r_{r}")) for l, r in keys.items()])
    return left.join(renamed, condition, how).drop(*[f"_r_{r}" for r in keys.values()])


def without_keys(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``known``. A null key is unknown unless ``known`` holds a null."""
    return null_safe_join(df, known.select(key).distinct(), [key], "left_anti")


def members_of(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in another result."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def stage_intervals(species_dim: DataFrame, stages: DataFrame) -> DataFrame:
    """``_species``, ``_bounds`` and ``_stages``: the length ranges of a species, cut into disjoint pieces.

    ``_bounds`` are all ends of ranges, sorted. Piece 2 i is the i-th bound itself (counted from 0), piece 2 i + 1 what lies between it and the next one;
    ``_stages`` lists the stages of each piece, sorted, one for each range that covers it.
    """
    ranges = species_dim.join(stages, "LifeStageCode").where("MinTotalLength_mm <= MaxTotalLength_mm")
    each = F.struct(F.col("MinTotalLength_mm").cast("double").alias("a"), F.col("MaxTotalLength_mm").cast("double").alias("b"), F.col("LifeStageAbbr").alias("s"))
    held = ranges.groupBy(F.col("SpeciesCode").alias("_species")).agg(F.collect_list(each).alias("_ranges"))
    bounds = F.array_sort(F.array_distinct(F.concat(F.col("_ranges")["a"], F.col("_ranges")["b"])))
    held = held.withColumn("_bounds", bounds)

    def covering(low: Column, high: Column) -> Column:
        return F.array_sort(F.filter("_ranges", lambda r: (r["a"] <= low) & (r["b"] >= high))["s"])

    pieces = F.transform(
        F.sequence(F.lit(0), F.size("_bounds") - 1),
        lambda i: F.array(covering(F.get("_bounds", i), F.get("_bounds", i)), covering(F.get("_bounds", i), F.get("_bounds", i + 1))),
    )
    return held.select("_species", "_bounds", F.flatten(pieces).alias("_stages"))


def _piece(bounds: str, value: Column, steps: int) -> Column:
    """The piece that ``value`` lies in, by bisection; -1 below all bounds."""
    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        right = (state["low"] < state["high"]) & (F.get(bounds, middle) <= value)
        return F.struct(
            F.when(right, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(right | (state["low"] >= state["high"]), state["high"]).otherwise(middle).alias("high"),
        )

    at = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve, lambda state: state["low"]) - 1
    return F.when(at < 0, -1).when(F.get(bounds, at) == value, 2 * at).otherwise(2 * at + 1)


def with_lifestage(fish: DataFrame, species_dim: DataFrame, stages: DataFrame, species: str = "SpeciesCode", length: str = "TotalLength_mm", into: str = "ls") -> DataFrame:
    """Life stage of each fish, from its species' length ranges; one row for each range that holds it, one without a stage if none does.

    A fish meets one row per species, with the ranges cut into pieces, and finds its piece by bisection: no row is
    multiplied by all ranges of its species.
    """
    pieces = stage_intervals(species_dim, stages)
    most = pieces.agg(F.max(F.size("_bounds"))).first()[0] or 1
    joined = fish.join(if_small(pieces), F.col(species) == F.col("_species"), "left")
    piece = _piece("_bounds", F.col(length).cast("double"), most.bit_length() + 1)
    found = joined.withColumn("_found", F.when(F.col(length).isNotNull() & F.col("_bounds").isNotNull() & (piece >= 0), F.get("_stages", piece)))
    return found.drop("_species", "_bounds", "_stages").withColumn(into, F.explode_outer("_found")).drop("_found")


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
