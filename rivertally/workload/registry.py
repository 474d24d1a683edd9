"""Registered queries and the SQL that each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rivertally.session import configure
from rivertally.workload.standins import with_frames

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, frames: list[str] | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its checking SQL over the named frames."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(configure(spark), folder)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = with_frames(frames, sql) if frames else sql
        return function

    return register


def rounded(value: str, digits: int) -> str:
    """SQL for half-up rounding on the decimal text of a double."""
    return f"CAST(round(CAST(({value}) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def hours_sql(seconds: str, digits: int) -> str:
    return rounded(f"CAST({seconds} AS DOUBLE) / 3600.0::DOUBLE", digits)


def per(numerator: str, denominator: str) -> str:
    return f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0)"
