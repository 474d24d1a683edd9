"""Nesting, unnesting, completing and pivoting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivertally.operators.joins import growing, null_safe_join
from rivertally.operators.ordered import sum_before

MAX_WEIGHT = 50_000  # rows, at all levels, that the arrays of one row should hold
MAX_LEVELS = 10_000
BLOCK_CELLS = 4_000_000  # cells of a grid that one join key makes


# ----- nest / unnest --------------------------------------------------------------------
class Children(NamedTuple):
    """Child rows to be nested: the fields of an element, and the order of the elements.

    ``weight`` names a column with the number of rows that an element stands for, itself and all below it; 1 if there is none.
    ``most`` is a bound on the elements of a parent, for kinds that are costly to measure, and ``heaviest`` one on their weights together.
    """

    rows: DataFrame
    fields: Sequence[str]
    order: Sequence[str]
    weight: str | None = None
    most: int | None = None
    heaviest: int | None = None


PARENT = ["_hash", "_key", "_none"]


def _parent_key(key: str) -> dict[str, Column]:
    """A key as columns that are never null, so that windows, aggregates and plain joins on them share one shuffle.

    The hash comes first: keys that begin alike are told apart by it, where a sort would compare them whole.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return {"_hash": F.xxhash64(text), "_key": text, "_none": F.col(key).isNull()}


def nest_weighted(children: Mapping[str, Children], key: str, max_weight: int | None = None, part: str = "Part", parts: str = "Parts") -> DataFrame:
    """One row per key and part, with all kinds of children as ordered arrays.

    The kinds of a key follow each other, and so do the elements of a kind; a running sum of their weights
    tells the part that an element falls into. So the arrays of a row hold about ``max_weight`` rows at most, at all levels together (one
    element more, at worst), whatever a key has in all. Part 0 is always there; ``parts`` is the number of a key's rows. An array
    that has nothing in a part is empty there. The layout depends on the rows only, not on how they were worked out.
    ``PARENT`` is the key as ``attach_children`` joins it. Where the bounds show that no key fills a part, nothing is summed.
    """
    bound = MAX_WEIGHT if max_weight is None else max_weight
    kinds = list(children.items())
    every = None
    for i, (_, kind) in enumerate(kinds):
        rank = F.struct(*[p for c in kind.order for p in (F.col(c).isNull(), F.col(c))])
        item = F.struct(*kind.fields)
        weight = F.lit(1) if kind.weight is None else F.col(kind.weight)
        rows = kind.rows.select(F.col(key), F.lit(i).alias("_kind"), rank.alias(f"_rank{i}"), item.alias(f"_item{i}"), weight.cast("long").alias("_weight"))
        every = rows if every is None else every.unionByName(rows, allowMissingColumns=True)
    order = ["_kind", *[f"_{what}{i}" for i in range(len(kinds)) for what in ("rank", "item")]]
    keyed = every.withColumns(_parent_key(key))
    known = [kind.most for _, kind in kinds]
    heaviest = [kind.most if kind.weight is None else kind.heaviest for _, kind in kinds]
    whole = None not in heaviest and sum(heaviest) <= bound
    if whole:
        # Dealt out before they are gathered: lists grow where they stay.
        cut = keyed.repartition(*PARENT).withColumn(part, F.lit(0).cast("long"))
    else:
        summed = sum_before(keyed, PARENT, order, "_weight", "_before", None if None in known else sum(known))
        cut = summed.withColumn(part, F.floor(F.col("_before") / bound).cast("long"))
    found = cut.groupBy(*PARENT, key, part).agg(
        *[F.sort_array(F.collect_list(F.when(F.col("_kind") == i, F.struct(f"_rank{i}", f"_item{i}")))).alias(name) for i, (name, _) in enumerate(kinds)]
    )
    items = {name: F.col(name)[f"_item{i}"] for i, (name, _) in enumerate(kinds)}
    number = F.lit(1) if whole else F.count(F.lit(1)).over(Window.partitionBy(*PARENT))
    return found.withColumns(items).withColumn(parts, number.cast("long"))


def attach_children(parents: DataFrame, children: Mapping[str, Children], key: str, max_weight: int | None = None, part: str = "Part", parts: str = "Parts") -> DataFrame:
    """Parents with their children nested; one that has too many comes on several rows, numbered in ``part``."""
    first = {part: F.lit(0).cast("long"), parts: F.lit(1).cast("long")}
    if not children:
        return parents.withColumns(first)
    # The children are laid out by their parent already, and stay where they are.
    nested = nest_weighted(children, key, max_weight, part, parts).drop(key)
    joined = parents.withColumns(_parent_key(key)).join(growing(nested), PARENT, "left").drop(*PARENT)
    return joined.withColumns({name: F.coalesce(F.col(name), value) for name, value in first.items()})


def weight_of(*arrays: str) -> Column:
    """Weight of a row: itself and what its arrays hold."""
    return sum((F.coalesce(F.size(a), F.lit(0)) for a in arrays), F.lit(1)).cast("long")


def merge_parts(df: DataFrame, keys: Sequence[str], arrays: Sequence[str], part: str = "Part", parts: str = "Parts") -> DataFrame:
    """The reverse of nesting in parts: one row per key, with its whole arrays; ``part`` and ``parts`` go.

    Only rows of keys that have several parts are shuffled. Keys match if they are both missing. All parts of a key must be there.
    """
    others = [c for c in df.columns if c not in (*keys, *arrays, part, parts)]
    kept = [c for c in df.columns if c not in (part, parts)]
    rows = F.sort_array(F.collect_list(F.struct(part, *[F.coalesce(a, F.array().cast(df.schema[a].dataType)).alias(a) for a in arrays])))
    merged = df.where(F.col(parts) > 1).groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(rows.alias("_parts"), F.min_by(F.struct(F.lit(1).alias("_one"), *others), part).alias("_row"))
    whole = merged.select(*keys, *[F.flatten(F.col("_parts")[a]).alias(a) for a in arrays], *[F.col("_row")[c].alias(c) for c in others])
    return df.where(F.col(parts) == 1).select(*kept).unionByName(whole.select(*kept))


def nest(df: DataFrame, keys: Sequence[str], fields: Sequence[str], into: str, order: Sequence[str], part: str = "Part", max_rows: int = MAX_WEIGHT) -> DataFrame:
    """One row per key with its child rows as an ordered array of structs.

    A key with more than ``max_rows`` children gets several rows, ``part`` 0, 1, …, each with the
    next stretch of the children: no group is ever gathered whole by one task, and nothing is
    dropped. Ordinary keys have part 0 only.
    """
    kept = df.select(*dict.fromkeys([*keys, *order, *fields])).withColumn("_one", F.lit(1).cast("long"))
    cut = sum_before(kept, keys, order, "_one", "_before").withColumn(part, F.floor(F.col("_before") / max_rows).cast("long"))
    rank = [p for c in order for p in (F.col(c).isNull(), F.col(c))]
    item = F.struct(F.struct(*rank).alias("_rank"), F.struct(*fields).alias("_item"))
    grouped = cut.groupBy(*keys, part).agg(F.array_sort(F.collect_list(item)).alias(into))
    return grouped.withColumn(into, F.transform(into, lambda pair: pair["_item"]))


def unnest(df: DataFrame, column: str, keep: Sequence[str], outer: bool = False) -> DataFrame:
    """One row per array element; parents with an empty array drop unless ``outer``."""
    rows = F.inline_outer(column) if outer else F.inline(column)
    return df.select(*keep, rows)


# ----- complete -------------------------------------------------------------------------
def _fetch_levels(levels: DataFrame, max_levels: int) -> DataFrame | None:
    """All levels as one row with one array, or None if there are more than ``max_levels``.

    At most ``max_levels`` + 1 rows reach the driver.
    """
    fetched = levels.limit(max_levels + 1).collect()
    if len(fetched) > max_levels:
        return None
    schema = T.StructType([T.StructField("_levels", T.ArrayType(levels.schema))])
    return levels.sparkSession.createDataFrame([([tuple(row) for row in fetched],)], schema)


def level_grid(parents: DataFrame, levels: DataFrame, max_levels: int = MAX_LEVELS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """Every parent row with every level row.

    Up to ``max_levels`` levels (species, life stages) travel as one array that each parent row
    explodes, with no shuffle of the parents. Beyond that the grid is cut into blocks of about ``block_cells`` cells, by the
    counts of both sides: each block is one key of an equality join, and makes each of its cells once.
    """
    names = levels.columns
    every = _fetch_levels(levels, max_levels)
    if every is not None:
        held = parents.withColumn("_levels", every.scalar())
        return held.select(*parents.columns, F.inline("_levels"))
    # Square blocks: each parent goes to as many of them as there are stretches of levels, and each level likewise.
    side = max(1, int(block_cells**0.5))
    down, across = (max(1, -(-frame.count() // side)) for frame in (parents, levels))

    def dealt(frame: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        # By what a row holds, so that a task that is run again deals the same way.
        place = F.pmod(F.xxhash64(*frame.columns), F.lit(parts))
        return frame.withColumns({own: place, other: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))})

    left = dealt(parents, "_p", down, "_l", across)
    right = dealt(levels, "_l", across, "_p", down)
    return left.join(right, ["_p", "_l"]).select(*parents.columns, *names)


def fill_levels(counts: DataFrame, keys: Sequence[str], level: str, fill: Mapping[str, object], parents: DataFrame | None = None, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Every key with every level seen, from counts that hold one row per key and level.

    Each key's counts are put into one map (no more entries than there are levels), and the level
    array is read off against it. So what is shuffled are the counts, never the far larger table of
    all pairs. Keys come from ``counts``, or from ``parents``, which may carry further columns.
    Measures in ``fill`` replace missing values, in absent pairs and elsewhere.
    """
    types = dict(counts.dtypes)
    every = _fetch_levels(counts.select(level).distinct(), max_levels)
    if every is None:
        base = counts.select(*keys).distinct() if parents is None else parents
        grid = level_grid(base, counts.select(level).distinct(), max_levels)
        filled = null_safe_join(grid, counts.select(*keys, level, *fill), [*keys, level], "left")
        return filled.withColumns({m: F.coalesce(F.col(m), F.lit(v).cast(types[m])) for m, v in fill.items()})
    entry = F.struct(F.struct(level).alias("key"), F.struct(*fill).alias("value"))
    packed = counts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_counts"))
    held = packed if parents is None else null_safe_join(parents, packed, keys, "left")
    held = held.withColumn("_levels", every.scalar())

    def pair(one: Column) -> Column:
        found = F.try_element_at("_counts", one)
        measures = [F.coalesce(found[m], F.lit(v).cast(types[m])).alias(m) for m, v in fill.items()]
        return F.struct(one[level].alias(level), *measures)

    kept = [c for c in held.columns if c not in ("_counts", "_levels")]
    return held.select(*kept, F.inline(F.transform("_levels", pair)))


def complete(df: DataFrame, parents: Sequence[str], levels: Sequence[str], fill: Mapping[str, object], keep_level: Column | None = None, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Add a row for every (observed parent tuple, observed level) that is absent.

    Null is a level like any other. Measures in ``fill`` are filled in added rows and where they
    were null before; other measures of added rows are null. ``keep_level`` is a condition on the
    level columns, applied to the result (before the grid is built, which is the same thing).

    The observed rows pass through as they are; only absent pairs are built and appended, so a
    pair with very many rows is never joined.
    """
    if keep_level is None:
        seen, rows = df, df
    else:
        rows = seen = df.where(keep_level)
    tuples = df.select(*parents).distinct()
    grid = level_grid(tuples, seen.select(*levels).distinct(), max_levels)
    on = [*parents, *levels]
    absent = null_safe_join(grid, rows.select(*on).distinct(), on, "left_anti")
    filled = rows.unionByName(absent, allowMissingColumns=True)
    types = dict(df.dtypes)
    return filled.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value).cast(types[c])) for c, value in fill.items()}
    )


# ----- pivot / split ----------------------------------------------------------------------
def pivot_wide(df: DataFrame, keys: Sequence[str], names_from: str, measures: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One column per (value of ``names_from``, measure), named ``{value}_{measure}``."""
    picks = {
        f"{value}_{measure}": F.min(F.when(F.col(names_from) == value, F.col(measure)))
        for value in values
        for measure in measures
    }
    return df.groupBy(*keys).agg(*[pick.alias(name) for name, pick in picks.items()])


def split_codes(df: DataFrame, codes: str, into: str) -> DataFrame:
    """One row per space-separated code."""
    return df.withColumn(into, F.explode(F.split(F.trim(codes), " +"))).where(F.col(into) != "")
