"""Grouped summaries, exact quantiles, histograms and box statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivertally.operators.joins import if_small, null_safe_join
from rivertally.session import durable

FUNCTIONS = {
    "max": F.max,
    "min": F.min,
    "mean": F.avg,
    "sum": F.sum,
    "n": lambda _: F.count(F.lit(1)),
}


def across(columns: Sequence[str], functions: Sequence[str]) -> list[Column]:
    """Every function of every column, named ``{column}_{function}``."""
    return [FUNCTIONS[f](F.col(c)).alias(f"{c}_{f}") for c in columns for f in functions]


def count_days(day: Column, count_missing: bool = False) -> Column:
    """Number of distinct days; a missing day counts as one more if asked."""
    days = F.count_distinct(day)
    return days + F.max(day.isNull().cast("int")) if count_missing else days


def day_of_extreme(day: str, value: str, largest: bool = True) -> Column:
    """Day of the largest (smallest) value, the earliest on ties, missing values ignored."""
    number = F.unix_date(F.col(day))
    if largest:
        best = F.max(F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), (-number).alias("d"))))
        return F.date_from_unix_date(-best["d"])
    best = F.min(F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), number.alias("d"))))
    return F.date_from_unix_date(best["d"])


ACCURACY = 10_000  # of the sketch that brackets a quantile: ranks are at most one in so many rows off


# ----- quantiles ----------------------------------------------------------------------------
def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], into: str = "q", accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles with linear interpolation, as an array per key; missing values are ignored.

    Two passes over the values, of any number per key. A mergeable sketch brackets each quantile between two values that
    are surely below and above it. Then values are counted (combined map-side): each one inside a bracket by itself, all those between two brackets
    together, with the smallest and the largest of them. That leaves some values in ``accuracy`` of a group, from which the wanted ranks
    are read.
    """
    asked = list(probs)
    values = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_value"))
    ends = [min(max(p + side * 2 / accuracy, 0.0), 1.0) for p in asked for side in (-1, 1)]
    sketch = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_total"), F.array_sort(F.percentile_approx("_value", ends, accuracy)).alias("_ends")
    )
    # A few numbers per key, read three times.
    sketch = durable(sketch)
    bracketed = null_safe_join(values, if_small(sketch.select(*keys, "_ends")), keys, "left") if keys else values.withColumn("_ends", sketch.select("_ends").scalar())
    inside = F.lit(False)
    ordered = sorted(range(len(asked)), key=lambda i: asked[i])
    merged: list[list[int]] = []
    for i in ordered:  # brackets in order; those whose ends overlap become one
        low, high = ends[2 * i], ends[2 * i + 1]
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    places = sorted(ends)
    spans = [(places.index(low), len(places) - 1 - places[::-1].index(high)) for low, high in merged]
    gap = F.lit(0)
    for n, (low, high) in enumerate(spans):
        inside = inside | F.col("_value").between(F.col("_ends")[low], F.col("_ends")[high])
        gap = F.when(F.col("_value") > F.col("_ends")[high], n + 1).otherwise(gap)
    slotted = bracketed.select(*keys, "_value", F.when(inside, F.col("_value")).alias("_own"), F.when(~inside, gap).alias("_gap"))
    counted = slotted.groupBy(*keys, "_own", "_gap").agg(
        F.count(F.lit(1)).alias("_count"), F.min("_value").alias("_least"), F.max("_value").alias("_most")
    )
    window = Window.partitionBy(*keys).orderBy("_least").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("_before", F.coalesce(F.sum("_count").over(window), F.lit(0)))
    placed = null_safe_join(ranked, sketch.select(*keys, "_total"), keys, "left") if keys else ranked.withColumn("_total", sketch.select("_total").scalar())

    def at(rank: Column) -> Column:
        """The value of a rank: that of its slot, or an end of the slot if it stands there."""
        here = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_count"))
        first, last = rank == F.col("_before"), rank == F.col("_before") + F.col("_count") - 1
        known = F.when(F.col("_gap").isNull() | first, F.col("_least")).when(last, F.col("_most"))
        return F.max(F.when(here, F.coalesce(known, F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"))))

    spots = [(F.col("_total") - 1) * F.lit(float(p)) for p in asked]
    picked = placed.groupBy(*keys).agg(
        *[c for i, spot in enumerate(spots) for c in (at(F.floor(spot)).alias(f"_low{i}"), at(F.ceil(spot)).alias(f"_high{i}"), F.first(spot - F.floor(spot)).alias(f"_share{i}"))]
    )

    def step(i: int) -> Column:
        # The weighting of the built-in percentile, so that both agree to the last digit.
        low, high, share = F.col(f"_low{i}"), F.col(f"_high{i}"), F.col(f"_share{i}")
        return F.when(share == 0, low).otherwise((1 - share) * low + share * high)

    return picked.select(*keys, F.array(*[step(i) for i in range(len(asked))]).alias(into))


def length_summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Minimum, quartiles, mean, maximum and number of missing values per key."""
    plain = df.groupBy(*keys).agg(
        F.min(value).alias("min"),
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
        F.count_if(F.col(value).isNull()).alias("n_missing"),
    )
    q = quantiles(df, keys, value, [0.25, 0.5, 0.75])
    joined = null_safe_join(plain, q, keys, "left")
    return joined.select(
        *keys,
        "min",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        "mean",
        F.col("q")[2].alias("q3"),
        "max",
        "n_missing",
    )


# ----- histograms -------------------------------------------------------------------------------
def bin_center(value: str, width: float) -> Column:
    """Centre of the bin of a value: bins are centred on multiples of ``width`` and closed on the right."""
    return F.ceil(F.col(value) / F.lit(float(width)) - 0.5).cast("long") * F.lit(float(width))


def histogram(df: DataFrame, keys: Sequence[str], value: str, width: float, fill_gaps: bool = False) -> DataFrame:
    """Counts in bins centred on multiples of ``width`` and closed on the right."""
    number = F.ceil(F.col(value) / F.lit(float(width)) - 0.5).cast("long")
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, number.alias("_bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if fill_gaps:
        ends = counts.groupBy(*keys).agg(F.min("_bin").alias("_a"), F.max("_bin").alias("_b"))
        every = ends.select(*keys, F.explode(F.sequence("_a", "_b")).alias("_bin"))
        counts = null_safe_join(every, counts, [*keys, "_bin"], "left").fillna(0, ["n"])
    return counts.select(*keys, (F.col("_bin") * float(width)).alias("bin_center"), "n")


def bin_width(df: DataFrame, value: str, bins: int = 30) -> float:
    """Bin width that spans the whole range with the given number of bins."""
    low, high = df.agg(F.min(value), F.max(value)).first()
    return (high - low) / (bins - 1) if low is not None and high > low else 1.0


# ----- box statistics -----------------------------------------------------------------------------
def box_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Box-plot statistics on a log10 axis, reported on the value's own scale.

    Values that are not positive have no place on the axis and drop before the statistics.
    """
    # Read three times: worked out once.
    logs = durable(df.where(F.col(value) > 0).select(*keys, F.log10(value).alias("_log")))
    q = quantiles(logs, keys, "_log", [0.25, 0.5, 0.75]).select(
        *keys, F.col("q")[0].alias("_q1"), F.col("q")[1].alias("_q2"), F.col("q")[2].alias("_q3")
    )
    q = if_small(durable(q))
    reach = 1.5 * (F.col("_q3") - F.col("_q1"))
    inside = F.col("_log").between(F.col("_q1") - reach, F.col("_q3") + reach)
    stats = null_safe_join(logs, q, keys, "left").groupBy(*keys).agg(
        F.min(F.when(inside, F.col("_log"))).alias("_low"),
        F.first("_q1").alias("_q1"),
        F.first("_q2").alias("_q2"),
        F.first("_q3").alias("_q3"),
        F.max(F.when(inside, F.col("_log"))).alias("_high"),
        F.count_if(~inside).alias("outliers"),
    )
    back: Mapping[str, str] = {"lower": "_low", "q1": "_q1", "median": "_q2", "q3": "_q3", "upper": "_high"}
    return stats.select(*keys, *[F.pow(F.lit(10.0), F.col(c)).alias(n) for n, c in back.items()], "outliers")
