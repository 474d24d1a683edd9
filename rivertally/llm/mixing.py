"""Mixing sources to target weights by Pfair scheduling.

A source is cut into blocks of equal size. Block ``b`` of a source of weight ``w`` may be placed from slot
``floor(b / w)`` on and must be placed before slot ``ceil((b + 1) / w)``; each slot goes to the waiting block with
the earliest deadline. As the weights add up to one, all deadlines are met, and after any number of slots a
source has had its weighted share to within less than one block. A source that runs out leaves, and the others go on
at their relative weights.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction
from itertools import islice
from math import ceil, lcm
from numbers import Rational

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivertally.llm.common import given_id, known_id
from rivertally.llm.order import running_total
from rivertally.session import durable, new_folder

BLOCK_BYTES = 16 * 1024
PERIOD = 1000
#: Unless weights are given, sources weigh what they hold, but none more than this.
MOST_WEIGHT = 0.25
#: The lane of sources that given weights leave out.
POOL = "rest"
#: So many blocks of the run are held at once.
AT_ONCE = 1 << 17


def capped_shares(supply: Mapping[str, int], most: float = MOST_WEIGHT) -> dict[str, Fraction]:
    """Exact weights in proportion to the supply, none above ``most`` (or an even share, where that is larger)."""
    most = max(Fraction(most), Fraction(1, max(1, len(supply))))
    weights, fixed = {}, set()
    while len(fixed) < len(supply):
        free = sum(v for k, v in supply.items() if k not in fixed)
        rest = 1 - most * len(fixed)
        weights = {k: most if k in fixed else rest * v / free for k, v in supply.items()}
        over = {k for k, v in weights.items() if k not in fixed and v > most}
        if not over:
            break
        fixed |= over
    return weights


def shares(weights: Mapping[str, Rational | float], period: int) -> dict[str, int]:
    """Weights rounded to whole slots of a period (one per lane at least in all), largest remainders first. ``mix`` doesn't round."""
    period = max(period, len(weights))
    whole = sum(map(Fraction, weights.values()))
    exact = {k: Fraction(v) / whole * period for k, v in weights.items()}
    given = {k: int(v) for k, v in exact.items()}
    left = period - sum(given.values())
    for k in sorted(exact, key=lambda k: (int(exact[k]) - exact[k], k))[:left]:
        given[k] += 1
    return given


def placements(weights: Mapping[str, Rational], blocks: Mapping[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """The whole run, earliest deadline first: (lane, block, release, deadline, slot), a slot for each of the ``blocks``.

    While all lanes have blocks, each has its weighted share of the slots. A lane whose share is used up leaves, and the others
    go on at their relative weights. Windows are exact: a block may be placed from the slot in which the share of its
    lane reaches it until the share has passed it. Memory is that of the lanes, however many blocks there are.
    """
    exact = {k: Fraction(w) for k, w in weights.items()}
    scale = lcm(*(w.denominator for w in exact.values()))
    parts = {k: int(w * scale) for k, w in exact.items()}
    # A lane has left after blocks / parts units of time, in each of which all lanes that go on get their parts.
    leaving: dict[Fraction, list[str]] = {}
    for k in parts:
        leaving.setdefault(Fraction(blocks[k], parts[k]), []).append(k)
    ends = sorted(leaving)
    done, going, phases = 0, sum(parts.values()), []
    for end in ends:
        phases.append((done, going))
        done += sum(blocks[k] for k in leaving[end])
        going -= sum(parts[k] for k in leaving[end])
    phase = dict.fromkeys(parts, 0)

    def reached(k: str, b: int) -> tuple[int, int]:
        """First and last slot edge around the moment in which lane ``k`` has had ``b`` blocks."""
        end = ends[phase[k]]
        if b * end.denominator > end.numerator * parts[k]:
            phase[k] = bisect_left(ends, Fraction(b, parts[k]), phase[k])
        before, at = phases[phase[k]]
        whole, over = divmod(at * b, parts[k])
        return before + whole, before + whole + (over > 0)

    coming = [(0, k, 0) for k in sorted(parts)]
    ready: list[tuple[int, str, int, int, int]] = []
    for slot in range(done):
        while coming and coming[0][0] <= slot:
            release, k, b = heapq.heappop(coming)
            following, deadline = reached(k, b + 1)
            heapq.heappush(ready, (deadline, k, b, release, following))
        deadline, k, b, release, following = heapq.heappop(ready)
        yield k, b, release, deadline, slot
        if b + 1 < blocks[k]:
            heapq.heappush(coming, (following, k, b + 1))


def schedule(given: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """The run of lanes that have as many blocks as their weight says, so that all end together."""
    return list(placements(given, given))


def blocks_in_mix(weights: Mapping[str, Rational], held: Mapping[str, int], block_bytes: int) -> dict[str, int]:
    """Blocks of each lane that are in the mix: all of them, except for the lane that would be left alone at the end.

    That one stops with the last of the others: what it holds above its weight beside them is left over. One lane alone is whole.
    """
    blocks = {k: max(1, -(-v // block_bytes)) for k, v in held.items()}
    if len(held) < 2:
        return blocks
    ends = {k: Fraction(max(1, v)) / Fraction(weights[k]) for k, v in held.items()}
    longest = max(ends, key=lambda k: (ends[k], k))
    stop = max(v for k, v in ends.items() if k != longest) * Fraction(weights[longest])
    blocks[longest] = min(blocks[longest], max(1, ceil(stop / block_bytes)))
    return blocks


def _written(spark: SparkSession, placed: Iterable[tuple[str, int, int, int, int]]) -> DataFrame:
    """The run as a table, written in pieces as it comes."""
    path, schema = new_folder(spark, "schedule"), "lane string, block long, release long, deadline long, slot long"
    spark.createDataFrame([], schema).write.parquet(path)
    names = ["lane", "block", "release", "deadline", "slot"]
    placed = iter(placed)
    while piece := list(islice(placed, AT_ONCE)):
        table = pa.table([pa.array(c) for c in zip(*piece, strict=True)], names)
        spark.createDataFrame(table).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_bytes: int = BLOCK_BYTES, period: int = PERIOD) -> DataFrame:
    """``did``, ``th``, ``source``, ``lane``, ``block``, ``release``, ``deadline``, ``slot``, ``place``, ``in_mix`` per row.

    A source's rows stand in order of identifier and text hash; ``place`` is the number of bytes before a row in its
    lane and ``block`` the block in which it begins. Sorting by slot and place gives the mixed stream. A source that runs out
    leaves, and the others go on at their relative weights. ``in_mix`` is false for what the one source that lasts longest
    holds above its weight beside the others (see ``blocks_in_mix``); those rows follow after the mix.

    A missing text is empty, a missing source is a source of its own, repeated rows each take their place, and
    an empty table gives an empty result. Given ``weights`` name sources; sources that they leave out are not in the mix.
    Weights are kept exactly and every source is a lane of its own; ``period`` has no effect any more.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        known_id("doc_id").alias("did"), F.xxhash64(text).alias("th"), docs["source"].alias("source"), F.octet_length(text).cast("long").alias("size")
    )
    rows = durable(rows)
    held = rows.groupBy("source").agg(F.sum("size").alias("size"))
    own = F.coalesce(F.concat(F.lit("="), "source"), F.lit("none"))
    if weights is not None:
        own = F.when(F.col("source").isin(*weights), own).otherwise(POOL)
    lanes = held.select("source", own.alias("lane"), "size")
    # One row for each source.
    supply = {r[0]: r[1] for r in lanes.groupBy("lane").agg(F.sum("size")).collect()}
    if weights is None:
        given = capped_shares({k: max(1, v) for k, v in supply.items()})
    else:
        given = {f"={k}": Fraction(v) for k, v in weights.items() if v > 0 and f"={k}" in supply}
    inside = blocks_in_mix(given, {k: supply[k] for k in given}, block_bytes)
    run = _written(docs.sparkSession, placements(given, inside) if given else [])
    length = sum(inside.values())
    known = [(k, inside[k], max(1, -(-supply[k] // block_bytes))) for k in given]
    bounds = docs.sparkSession.createDataFrame(known, "lane string, inside long, blocks long")

    lane_of = lanes.select(F.col("source").alias("__source"), "lane")
    in_lane = rows.join(lane_of, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    # Empty texts at the very end of a lane belong to its last block.
    block = F.least(F.expr(f"place div {block_bytes}"), F.col("blocks") - 1)
    placed = running_total(in_lane, ["lane"], ["did", "th"], "size", "place").join(bounds, "lane", "left").withColumn("block", block)
    # What is left over follows block by block.
    late = F.when(F.col("block") >= F.col("inside"), F.col("block") - F.col("inside") + length)
    return placed.join(run, ["lane", "block"], "left").select(
        "did",
        "th",
        "source",
        "lane",
        "block",
        F.coalesce("release", late).alias("release"),
        F.coalesce("deadline", late + 1).alias("deadline"),
        F.coalesce("slot", late).alias("slot"),
        "place",
        F.col("slot").isNotNull().alias("in_mix"),
    )


def mixing_report(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its place in the mix; see ``mix``."""
    return mix(docs).select(given_id("did").alias("doc_id"), "source", "lane", "block", "release", "deadline", "slot", "place", "in_mix")


def mixed(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs``, with its columns, in the order of the mix.

    Without ``weights`` every row stays, and what one source holds above its weight beside the others comes last. Given ``weights`` leave
    that out, and the sources that they don't name. Rows that repeat each other stand together.
    """
    placed = mix(docs, weights)
    placed = placed if weights is None else placed.where("in_mix")
    places = placed.groupBy("did", "th").agg(F.min(F.struct("slot", "place")).alias("at"))
    keyed = docs.select(known_id("doc_id").alias("did"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("th"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    return keyed.join(places, ["did", "th"]).orderBy("at").select("row.*")
