"""Cleaning and derivation steps for raw collection tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivertally import fixed_values as fixed
from rivertally.functions.numbers import col


# ----- columns by name ---------------------------------------------------------------
def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    start, stop = df.columns.index(first), df.columns.index(last)
    return df.columns[start : stop + 1]


def columns_of(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def drop_matching(df: DataFrame, pattern: str = fixed.HELPER_COLUMNS) -> DataFrame:
    return df.drop(*columns_like(df, pattern))


def rename_select(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep and rename; ``names`` maps each new name to its source column, in output order."""
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def kinds_to_text(df: DataFrame, *kinds: type[T.DataType]) -> DataFrame:
    """Cast every column of the given types (logical, timestamp, …) to text."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns_of(df, *kinds)})


def with_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns (name: type) that the frame lacks, as nulls."""
    return df.withColumns(
        {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    )


# ----- sentinels -----------------------------------------------------------------------
def null_text(df: DataFrame, text: str = fixed.MISSING_TEXT, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn a sentinel text into null, in the named or in all text columns."""
    names = columns_of(df, T.StringType) if columns is None else [c for c in columns if c in df.columns]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(text)) for c in names})


def null_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn 0 into null, in the named or in all numeric columns."""
    names = columns_of(df, T.NumericType) if columns is None else [c for c in columns if c in df.columns]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0)) for c in names})


# ----- null-aware predicates --------------------------------------------------------------
def is_in(value: Column | str, choices: Iterable) -> Column:
    """Membership that is never null: a missing value is not in the list."""
    return F.coalesce(col(value).isin(list(choices)), F.lit(False))


def not_in(value: Column | str, choices: Iterable) -> Column:
    return ~is_in(value, choices)


def keep(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet every condition; one that is null counts as not met."""
    for condition in conditions:
        df = df.where(condition)
    return df


def before_season_end(day: Column | str, year: int) -> Column:
    month, first = fixed.REPORT_SEASON_END
    return col(day) < F.make_date(F.lit(year), F.lit(month), F.lit(first))


# ----- derived values -----------------------------------------------------------------------
def effort_seconds(seconds: str = "effort_sec", minutes: str = "effort_min") -> Column:
    return F.col(seconds) + F.col(minutes) * 60


def correct_miles(df: DataFrame, reach: str = "reach", offsets: Mapping[str, float] = fixed.MILE_OFFSETS, suffix: str = "rmi") -> DataFrame:
    """Shift every ``*rmi`` column by its reach's offset; other reaches keep their values."""
    names = [c for c in df.columns if c.endswith(suffix)]

    def shifted(name: str) -> Column:
        value = F.col(name)
        chain = F
        for code, miles in offsets.items():
            chain = chain.when(F.col(reach) == code, value + miles)
        return chain.otherwise(value)

    return df.withColumns({c: shifted(c) for c in names}) if offsets else df


def classify(rules: Sequence[tuple[Column, object]], otherwise: Column | None = None) -> Column:
    """First matching rule wins; missing (or ``otherwise``) if none does."""
    chain = F
    for condition, value in rules:
        chain = chain.when(condition, value if isinstance(value, Column) else F.lit(value))
    return chain.otherwise(otherwise) if otherwise is not None else chain


def study_phase(study: str = "StudyCode", river: str = "RiverCode", mile: str = "StartLocation_BelknapMiles") -> Column:
    rules = []
    for code, rv, low, high, phase in fixed.STUDY_PHASES:
        inside = (F.col(mile) >= low) if high is None else F.col(mile).between(low, high)
        rules.append(((F.col(study) == code) & (F.col(river) == rv) & inside, phase))
    return classify(rules, otherwise=F.col(study))


def report_reach(river: str = "cd_rvr", mile: str = "rmi_start_bel") -> tuple[Column, Column]:
    """Reach code and reach name of a report site."""
    low, high = fixed.TUSHER_MILES
    colorado, green = F.col(river) == "CO", F.col(river) == "GR"
    rules = [
        (colorado, fixed.LOWER_COLORADO),
        (green & F.col(mile).between(low, high), fixed.TUSHER),
        (green & (F.col(mile) > high), fixed.LOWER_GRAY),
    ]
    code = classify([(rule, reach[0]) for rule, reach in rules])
    name = classify([(rule, reach[1]) for rule, reach in rules])
    return code, name


def sample_id(study: str, year: Column | str, index: str) -> Column:
    """``study_year_007``; longer numbers keep all digits. Missing if any part is."""
    parts = [col(study), col(year), col(index)]
    text = F.format_string("%s_%d_%03d", parts[0], parts[1].cast("long"), parts[2].cast("long"))
    return F.when(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull(), text)


def haul_id(site: str, index: str) -> Column:
    text = F.format_string("%s.%02d", F.col(site), F.col(index).cast("long"))
    return F.when(F.col(site).isNotNull() & F.col(index).isNotNull(), text)


def trailing_number(identifier: Column | str) -> Column:
    return F.regexp_substr(col(identifier), F.lit("[0-9]+$")).try_cast("long")


def yes_no(value: Column | str) -> Column:
    return F.when(col(value) == "Y", True).when(col(value) == "N", False)


def yes_no_columns(df: DataFrame, pattern: str = "^Has") -> DataFrame:
    return df.withColumns({c: yes_no(c) for c in columns_like(df, pattern)})


def is_ripe(condition: str = "rep_cond") -> Column:
    return F.when(F.col(condition).rlike(fixed.RIPE_TEXT), True).when(
        F.col(condition).rlike(fixed.NOT_RIPE_TEXT), False
    )


def is_tuberculate(species: str = "species", tubercles: str = "tubercles", native: Sequence[str] = fixed.NATIVE_SPECIES) -> Column:
    return F.when(is_in(species, native), yes_no(tubercles))


def native_only(value: str, species: str = "species", native: Sequence[str] = fixed.NATIVE_SPECIES) -> Column:
    return F.when(is_in(species, native), F.col(value))


def ray_count(index: int, text: str = "ray_ct") -> Column:
    """Dorsal (1) or anal (2) count of ``9/10``; missing pieces are null, extra ones ignored."""
    return F.try_element_at(F.split(F.col(text), "/"), F.lit(index)).try_cast("long")


def secchi_note(notes: str) -> Column:
    return F.regexp_substr(F.col(notes), F.lit(fixed.SECCHI_NOTE))


def plain_tag(tag: Column | str) -> Column:
    """Tag text without dots."""
    return F.replace(col(tag), F.lit("."))


def target_species(study: str) -> str:
    prefixed = study.startswith(fixed.RAZORBACK_STUDY_PREFIX)
    return fixed.RAZORBACK_TARGET if prefixed else fixed.DEFAULT_TARGET


# ----- corrections ----------------------------------------------------------------------------
def apply_corrections(df: DataFrame, fixes: DataFrame, key: str) -> DataFrame:
    """Overlay corrected values by key.

    ``fixes`` holds one row per (key, column): ``key``, ``column``, ``value`` as text. Only the
    named columns of the named keys change, and a value may be null.
    """
    types = dict(df.dtypes)
    wide = fixes.groupBy(F.col(key).alias("_fix_key")).agg(
        F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("_fixes")
    )
    joined = df.join(wide, F.col(key).eqNullSafe(F.col("_fix_key")), "left")

    def corrected(name: str) -> Column:
        stated = F.map_contains_key("_fixes", F.lit(name))
        return F.when(F.coalesce(stated, F.lit(False)), F.col("_fixes")[name].cast(types[name])).otherwise(
            F.col(name)
        )

    return joined.select(*[F.col(c) if c == key else corrected(c).alias(c) for c in df.columns])


def append_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    return df.unionByName(rows, allowMissingColumns=True)
