"""Numbering, filling and running totals in a stated order.

A window over one group runs in one task. That is the right plan while every group is of ordinary
size, and impossible when one group holds a large share of a large table. So each operator first
measures its largest group, and above ``HOT_ROWS`` uses a distributed form: rows are range-sorted
by (group, order) into balanced slices, each slice is worked on alone, and what earlier slices of
the same group contribute (a handful of rows per slice) is joined back.

Equal rows cannot be spread by a range sort, so the distributed form first collapses exact copies
into one row with a count, and expands them again at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivertally.session import durable

HOT_ROWS = 5_000_000
#: Groups that the sketch of ``group_bound`` tracks, and the part of the rows that a group which it doesn't list may have: the sketch errs
#: by 3.5 / 8192 of the rows, and lists all groups of twice that.
TRACKED, UNLISTED = 5_000, 1 / 1_000
#: Buckets of ``bucket_bound``.
BUCKETS = 1 << 16
_SLICE_BITS = 33  # monotonically_increasing_id(): partition above, row position below


def _nulls_last(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _total_order(df: DataFrame, order: Sequence[str]) -> list[str]:
    """The order columns, then all others as tie-breaks (as far as they can be compared)."""
    rest = [f.name for f in df.schema.fields if f.name not in order and f.dataType.typeName() != "map"]
    return [*order, *rest]


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group. Counts are combined map-side; one row reaches the driver."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.max("_n")).first()[0] or 0


def group_bound(df: DataFrame, keys: Sequence[str], enough: int = HOT_ROWS) -> int:
    """At least the rows of the largest group: what a sketch says, if that is no more than ``enough``, else the exact number.

    The sketch is merged from task to task, so no row is shuffled.
    """
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(1), F.lit(TRACKED))
    found, rows = df.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    listed = max((entry["count"] for entry in found or []), default=0)
    bound = min(rows, max(listed, int(rows * UNLISTED) + 1))
    return bound if bound <= enough else largest_group(df, keys)


def bucket_bound(df: DataFrame, keys: Sequence[str], enough: int = HOT_ROWS) -> int:
    """At least the rows of the largest group: the largest of ``BUCKETS`` buckets that hold whole groups, if that is no more than ``enough``, else the exact number.

    Tighter than the sketch of ``group_bound`` on large tables. A task sends a count per bucket at most.
    """
    buckets = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    bound = buckets.agg(F.max("_n")).first()[0] or 0
    return bound if bound <= enough else largest_group(df, keys)


# ----- copies ------------------------------------------------------------------------
def collapse_copies(df: DataFrame, count: str = "_copies") -> DataFrame:
    """Exact copies become one row with a count, combined before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count))


def expand_copies(df: DataFrame, most: int, count: str = "_copies", index: str | None = None, block: int = 10_000) -> DataFrame:
    """One row per copy again, numbered 1..count in ``index`` if named.

    ``most`` is the largest count. Counts beyond ``block`` are cut into blocks that are shuffled
    apart before they are written out, so no task writes all copies of a row.
    """
    position = index or "_copy"
    first = F.lit(1).cast("long")
    if most == 1:
        out = df.withColumn(position, first)
    else:
        small = df.where(F.col(count) <= block) if most > block else df
        out = small.withColumn(position, F.explode(F.sequence(first, F.col(count))))
    if most > block:
        last = F.floor((F.col(count) - 1) / block).cast("long")
        cut = df.where(F.col(count) > block).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        start = F.col("_block") * block + 1
        end = F.least(start + block - 1, F.col(count))
        apart = cut.repartition(*cut.columns).withColumn(position, F.explode(F.sequence(start, end)))
        out = out.unionByName(apart.drop("_block"))
    out = out.drop(count)
    return out if index else out.drop(position)


# ----- slices ------------------------------------------------------------------------
def _lay_out(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-sort into slices and fix the layout; adds ``_slice`` and ``_pos`` (0-based).

    Slice bounds are sampled, so the laid-out rows are written once: all later reads, and tasks
    repeated after an executor loss, see the same slices.
    """
    sort = _nulls_last(order)
    laid = durable(
        df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id())
    )
    return laid.withColumns(
        {
            "_slice": F.shiftright("_at", _SLICE_BITS),
            "_pos": F.col("_at").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1)),
        }
    ).drop("_at")


def _earlier_slices(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


def _with_carry(laid: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach what earlier slices carry in.

    A slice continues at most one group of the slice before it, so ``carry`` has at most one row
    per slice and is safe to broadcast.
    """
    renamed = carry.withColumnsRenamed({c: f"_c_{c}" for c in [*keys, "_slice"]})
    condition = F.col("_slice") == F.col("_c__slice")
    for c in keys:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    return laid.join(F.broadcast(renamed), condition, "left").drop(*[f"_c_{c}" for c in [*keys, "_slice"]])


def _carry_sums(laid: DataFrame, keys: Sequence[str], weight: str, into: str) -> DataFrame:
    here = Window.partitionBy("_slice", *keys).orderBy("_pos")
    local = laid.withColumn("_local", F.sum(weight).over(here) - F.col(weight))
    sums = laid.groupBy(*keys, "_slice").agg(F.sum(weight).alias("_sum"))
    carry = sums.withColumn("_carried", F.sum("_sum").over(_earlier_slices(keys))).where(
        F.col("_carried").isNotNull()
    )
    joined = _with_carry(local, carry.drop("_sum"), keys)
    return joined.withColumn(into, F.col("_local") + F.coalesce("_carried", F.lit(0))).drop(
        "_local", "_carried", "_slice", "_pos"
    )


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str, into: str) -> DataFrame:
    """Sum of ``weight`` over the rows of the group that come earlier, for groups of any size.

    ``keys`` and ``order`` together must be unique.
    """
    return _carry_sums(_lay_out(df, [*keys, *order]), keys, weight, into)


def _number_spread(df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str) -> DataFrame:
    """Numbers per group for groups, or runs of equal rows, of any size."""
    laid = _lay_out(collapse_copies(df), [*keys, *order])
    most = laid.agg(F.max("_copies")).first()[0] or 1
    counted = _carry_sums(laid, keys, "_copies", "_base")
    expanded = expand_copies(counted, most, index="_copy")
    return expanded.withColumn(into, F.col("_base") + F.col("_copy")).drop("_base", "_copy")


def sum_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str, into: str, most: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sum of ``weight`` over the rows of the group that come earlier, in a total order; 0 for the first.

    Exact copies stand side by side. ``weight`` is never missing. ``most`` is a bound on the rows of a group, if one is known; groups are
    measured if there is none below ``hot_rows``.
    """
    ordered = [c for c in _total_order(df, order) if c not in keys]
    if (most is not None and most <= hot_rows) or group_bound(df, keys, hot_rows) <= hot_rows:
        window = Window.partitionBy(*keys).orderBy(*_nulls_last(ordered)).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(into, F.coalesce(F.sum(weight).over(window), F.lit(0)).cast("long"))
    laid = _lay_out(collapse_copies(df).withColumn("_all", F.col(weight) * F.col("_copies")), [*keys, *ordered])
    most = laid.agg(F.max("_copies")).first()[0] or 1
    summed = _carry_sums(laid, keys, "_all", "_base")
    expanded = expand_copies(summed.drop("_all"), most, index="_copy")
    return expanded.withColumn(into, (F.col("_base") + (F.col("_copy") - 1) * F.col(weight)).cast("long")).drop("_base", "_copy")


# ----- numbering ---------------------------------------------------------------------
def number_rows(df: DataFrame, order: Sequence[str], into: str, start: int = 0, unique: bool = False, ties: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number all rows start+1, start+2, … in order, nulls last.

    One range shuffle in all. Rows that tie on the order columns are told apart by the others;
    where very many tie, exact copies are collapsed first. Ties are measured, unless ``ties`` gives
    a bound that is known already or ``unique`` says that the order columns are a key.
    """
    if not unique and (group_bound(df, order, hot_rows) if ties is None else ties) > hot_rows:
        spread = _number_spread(df, [], _total_order(df, order), into)
        return spread.withColumn(into, F.col(into) + F.lit(start))
    laid = _lay_out(df, order if unique else _total_order(df, order))
    sizes = laid.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: bounded by the number of shuffle partitions.
    before = sizes.select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = laid.join(F.broadcast(before), "_slice")
    return joined.withColumn(into, F.col("_before") + F.col("_pos") + 1 + F.lit(start)).drop(
        "_slice", "_pos", "_before"
    )


def number_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], into: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number the rows of each group 1, 2, … in order, nulls last."""
    ordered = [c for c in _total_order(df, order) if c not in keys]
    if group_bound(df, keys, hot_rows) <= hot_rows:
        window = Window.partitionBy(*keys).orderBy(*_nulls_last(ordered))
        return df.withColumn(into, F.row_number().over(window).cast("long"))
    return _number_spread(df, keys, ordered, into)


def fill_down(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Fill missing values with the last earlier value of the group."""
    ordered = [c for c in _total_order(df, order) if c not in keys]
    unbounded, current = Window.unboundedPreceding, Window.currentRow
    if group_bound(df, keys, hot_rows) <= hot_rows:
        window = Window.partitionBy(*keys).orderBy(*_nulls_last(ordered)).rowsBetween(unbounded, current)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})
    laid = _lay_out(collapse_copies(df), [*keys, *ordered])
    most = laid.agg(F.max("_copies")).first()[0] or 1
    here = Window.partitionBy("_slice", *keys).orderBy("_pos").rowsBetween(unbounded, current)
    local = laid.withColumns({c: F.last(c, ignorenulls=True).over(here) for c in columns})
    lasts = laid.groupBy(*keys, "_slice").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))).alias(f"_last_{c}") for c in columns]
    )
    earlier = _earlier_slices(keys)
    carry = lasts.select(
        *keys,
        "_slice",
        F.count(F.lit(1)).over(earlier).alias("_seen"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_in_{c}") for c in columns],
    ).where(F.col("_seen") > 0)
    joined = _with_carry(local, carry.drop("_seen"), keys)
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_in_{c}")) for c in columns})
    plain = filled.drop("_slice", "_pos", *[f"_in_{c}" for c in columns])
    return expand_copies(plain, most).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the stated order, nulls last.

    An aggregate, not a window: each task keeps one candidate per key before the shuffle.
    """
    ordered = [c for c in _total_order(df, order) if c not in keys]
    rank = F.struct(*[part for c in ordered for part in (F.col(c).isNull(), F.col(c))])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), rank).alias("_row"))
    return picked.select("_row.*")


def group_sequence(df: DataFrame, key: str, stamp: str, into: str, start: int = 0) -> DataFrame:
    """Number the groups by their earliest time and give each row its group's number."""
    firsts = df.groupBy(key).agg(F.min(stamp).alias("_first"))
    numbered = number_rows(firsts, ["_first", key], into, start=start, unique=True).drop("_first")
    return df.join(numbered.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def last_index(ids: DataFrame, column: str) -> int:
    """Largest trailing number among stored identifiers; 0 if there are none."""
    number = F.regexp_substr(F.col(column), F.lit("[0-9]+$")).try_cast("long")
    return ids.agg(F.max(number)).first()[0] or 0
