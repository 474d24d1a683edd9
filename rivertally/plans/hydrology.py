"""Daily discharge and temperature series per gauging station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivertally import fixed_values as fixed
from rivertally.functions.times import display_date
from rivertally.operators.joins import null_safe_join
from rivertally.operators.reshape import Children, attach_children
from rivertally.operators.stats import across, day_of_extreme, quantiles

StationRow = tuple[str, str, str, str]


def daily_series(values: DataFrame) -> DataFrame:
    """Discharge and temperature side by side.

    ``values``: staid, parameter, dates, val. A day with only one of the two is kept.
    """
    wanted = {"discharge": fixed.DISCHARGE_PARAMETER, "temp": fixed.TEMPERATURE_PARAMETER}
    listed = values.where(F.col("parameter").isin(list(wanted.values())))
    # One aggregate; where a day has several values of both, each meets each, as in a join.
    each = [F.collect_list(F.when(F.col("parameter") == code, F.struct(F.col("val").alias("v")))).alias(name) for name, code in wanted.items()]
    days = listed.groupBy("staid", F.col("dates").alias("date")).agg(*each)
    none = F.array(F.struct(F.lit(None).cast(values.schema["val"].dataType).alias("v")))
    for name in wanted:
        days = days.withColumn(name, F.explode(F.when(F.size(name) > 0, F.col(name)).otherwise(none))).withColumn(name, F.col(name)["v"])
    return days


def waterdata(values: DataFrame, stations: Sequence[StationRow] = fixed.STATIONS, name: str = "sta_name", river: str = "rvr_code", reach: str | None = "rch_code") -> DataFrame:
    """The stations' daily series with station, river and reach labels.

    All stations are read and joined in one pass; a station that is not listed drops.
    """
    spark = values.sparkSession
    labels = ["staid", name, river, reach or "_reach"]
    table = spark.createDataFrame(list(stations), ", ".join(f"{c} string" for c in labels))
    listed = values.where(F.col("staid").isin([s[0] for s in stations]))
    # The station list is the caller's own short literal.
    tagged = daily_series(listed).join(F.broadcast(table), "staid")
    return tagged if reach else tagged.drop("_reach")


def station_facts(series: DataFrame, stations: DataFrame, max_weight: int | None = None) -> DataFrame:
    """Nested hydrology facts from flat series; ``stations`` holds the station columns.

    A station with a very long series has several rows, numbered in ``Part``; ``merge_parts`` puts them together.
    """
    flat = series.select(
        F.col("staid").alias("StationID"),
        F.col("date").cast("timestamp_ntz").alias("ObservationDateTime_Local"),
        F.col("discharge").cast("long").alias("Discharge_CFS"),
        F.col("temp").cast("double").alias("WaterTemperature_C"),
    )
    fields = ["ObservationDateTime_Local", "Discharge_CFS", "WaterTemperature_C"]
    return attach_children(stations, {"WaterData": Children(flat, fields, ["ObservationDateTime_Local"])}, "StationID", max_weight)


def water_summary(water: DataFrame, river: str = "cd_rvr", display: bool = True) -> DataFrame:
    """Largest, smallest, median and number of daily discharges, and the days of the extremes."""
    plain = water.groupBy(river).agg(
        *across(["discharge"], ["max", "min", "n"]),
        day_of_extreme("date", "discharge").alias("dt_max_flow"),
        day_of_extreme("date", "discharge", largest=False).alias("dt_min_flow"),
    )
    medians = quantiles(water, [river], "discharge", [0.5]).select(river, F.col("q")[0].alias("discharge_median"))
    joined = null_safe_join(plain, medians, [river], "left")
    days = [display_date(c).alias(c) if display else F.col(c) for c in ("dt_max_flow", "dt_min_flow")]
    return joined.select(river, "discharge_max", "discharge_min", "discharge_median", "discharge_n", *days)
