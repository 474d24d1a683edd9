"""Date and time column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivertally.fixed_values import DISPLAY_DATE, LOCAL_ZONE
from rivertally.functions.numbers import col

# --- Fixed values: accepted date and time texts ------------------------------------
DATE_TEXTS = ["M/d/yyyy", "M-d-yyyy"]
TIME_TEXTS = ["H:mm:ss", "H:mm"]


def parse_date(text: Column | str) -> Column:
    """Month-first date text to a date; missing if it cannot be read."""
    text = col(text)
    return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in DATE_TEXTS])


def wall_clock(date: Column | str, time: Column | str) -> Column:
    """Date text and time text to a timestamp that keeps the wall clock, labelled UTC.

    Needs a session whose zone is UTC. Missing if either part is missing or unreadable.
    """
    joined = F.concat(col(date), F.lit(" "), col(time))
    return F.coalesce(
        *[F.try_to_timestamp(joined, F.lit(f"{d} {t}")) for d in DATE_TEXTS for t in TIME_TEXTS]
    )


def on_day_of(stamp: Column | str, time: Column | str) -> Column:
    """The given clock time on the day of another timestamp."""
    joined = F.concat(F.date_format(col(stamp), "yyyy-MM-dd"), F.lit(" "), col(time))
    return F.coalesce(*[F.try_to_timestamp(joined, F.lit(f"yyyy-MM-dd {t}")) for t in TIME_TEXTS])


def week_of_year(day: Column | str) -> Column:
    """Weeks of seven days counted from 1 January (not ISO weeks)."""
    return F.floor((F.dayofyear(col(day)) - 1) / 7).cast("long") + 1


def to_local(stamp: Column | str, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(col(stamp), zone)


def shift_to_local(df: DataFrame, prefix: str = "tm_", zone: str = LOCAL_ZONE) -> DataFrame:
    """Shift every column whose name starts with ``prefix`` from UTC to local wall clock."""
    names = [c for c in df.columns if c.startswith(prefix)]
    return df.withColumns({c: to_local(c, zone) for c in names})


def date_parts(df: DataFrame, stamp: str, zone: str = "UTC") -> DataFrame:
    """Add ``year``, ``month``, ``date`` and ``week`` of a timestamp column, as seen in ``zone``."""
    seen = F.col(stamp) if zone == "UTC" else to_local(stamp, zone)
    return df.withColumns(
        {
            "year": F.year(seen).cast("long"),
            "month": F.month(seen).cast("long"),
            "date": F.to_date(seen),
            "week": week_of_year(seen),
        }
    )


def display_date(day: Column | str) -> Column:
    return F.date_format(col(day), DISPLAY_DATE)


def display_range(low: Column | str, high: Column | str) -> Column:
    def text(value: Column | str) -> Column:
        return F.regexp_replace(col(value).cast("string"), r"\.0$", "")

    return F.concat(text(low), F.lit(" - "), text(high))


def display_count(value: Column | str) -> Column:
    """Whole number with thousands marks."""
    return F.format_number(col(value), 0)


def display_decimal(value: Column | str, digits: int = 1) -> Column:
    """Fixed number of decimals, without thousands marks."""
    return F.round(col(value).cast("double"), digits).cast(f"decimal(38,{digits})").cast("string")
