"""Running totals over a total order, without one task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivertally.llm.common import known_id
from rivertally.session import durable


def running_total(df: DataFrame, groups: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same group that come before.

    Rows are range-sorted by group and order into slices of even size, so one group may fill many slices. A
    slice is totalled alone, and what the slices before it hold for the group (one row per slice and group)
    is added. Rows that are equal in group and order are placed by where they are read, so that copies of one row
    spread over slices too. ``df`` should be narrow: it is written once.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    keys = [*groups, *order, "__tie"]
    cut = durable(tied.repartitionByRange(slices, *keys).withColumn("__slice", F.spark_partition_id()))
    inside = Window.partitionBy("__slice", *groups).orderBy(*order, "__tie").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        cut.groupBy("__slice", *groups)
        .agg(F.sum(value).alias("__sum"))
        .withColumn("__base", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
        .drop("__sum")
    )
    placed = cut.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    total = placed.join(sums, ["__slice", *groups]).withColumn(name, F.col("__base") + F.col("__inside"))
    return total.select(*df.columns, name)


def row_keys(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``rk``, ``did`` and ``text`` (as bytes, empty where missing): one long per document that tells it from all others.

    It is the identifier itself (see ``known_id``) where identifiers don't repeat. Else documents are numbered in order
    of identifier and text hash, so that rows of one identifier stay apart; rows equal in both are one document.
    With ``carry`` the whole row comes along as the struct ``row``.
    """
    more = [F.struct(*(docs[c] for c in docs.columns)).alias("row")] if carry else []
    rows = docs.select(known_id("doc_id").alias("did"), F.coalesce(docs["text"], F.lit("")).alias("text"), *more)
    kept = ["did", F.col("text").cast("binary").alias("text"), *(["row"] if carry else [])]
    repeats = rows.groupBy("did").count().where("count > 1").limit(1)
    if not repeats.take(1):
        return rows.select(F.col("did").alias("rk"), *kept)
    named = rows.withColumn("th", F.xxhash64("text"))
    distinct = named.select("did", "th").distinct().withColumn("one", F.lit(1).cast("long"))
    numbered = durable(running_total(distinct, [], ["did", "th"], "one", "rk").select("did", "th", "rk"))
    return named.join(numbered, ["did", "th"]).select("rk", *kept)
