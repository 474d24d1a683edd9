"""Stores that grow by whole batches, with an index of their keys and a ledger of their loads.

A batch is worked out and written once, into a hidden folder of the store. From there its fingerprint, its keys and its index are read, and one rename
makes all of it visible: ``batch=7`` holds the rows (by year), ``_keys`` the index of its keys and ``_ledger`` one row about the load. A batch
that is refused, or was loaded before, is deleted from the hidden folder and leaves nothing. One writer at a time, as with any
numbering.

Index: the keys of a batch and year are hashed to the bits of a space that is at least ``BITS_PER_KEY`` times as large as their number, kept as bitmaps of 32,768 bits. An
incoming key whose bit isn't set is new. Fact files are read only for the batches and years in which some bit is set, to compare
the keys themselves.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivertally.session import setting
from rivertally.sources.tables import read_if_present

BITMAP_BITS = 32_768  # of the built-in bitmap functions
BITS_PER_KEY = 16
#: Lists are gathered in sorted order: hash tables of lists give up after 128 keys in a task, twice in each aggregate, and sort then.
HASHED_LISTS = "spark.sql.execution.useObjectHashAggregateExec"
MOST_LISTED = 1_000  # batches and years that are named in a filter


class DuplicateKeys(ValueError):
    """An incoming batch holds keys that the store already has."""


class Loaded(NamedTuple):
    batch: int | None  #: number of the batch in the store; None for an empty one
    new: bool  #: False if the same rows were loaded before


# ----- files ----------------------------------------------------------------------------------------------
def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; its new parent is made, and nothing may be there yet."""
    files, place = _place(spark, path)
    _, target = _place(spark, to)
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(place, target):
        raise FileExistsError(f"{to} can't be written")


# ----- fingerprints and ledger ---------------------------------------------------------------------------------------
def fingerprint(df: DataFrame) -> tuple[int, int, int]:
    """Number of rows and sums of two hashes of them: the same for the same rows in any order and layout.

    Columns count by name, whatever their order; nulls, empty texts and empty arrays differ.
    """
    text = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    one, two = (F.xxhash64(F.lit(salt), text).cast("decimal(20,0)") for salt in ("a", "b"))
    n, a, b = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(one), F.lit(0)), F.coalesce(F.sum(two), F.lit(0))).first()
    return n, int(a), int(b)


def ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """``batch``, ``rows``, ``hash_a``, ``hash_b`` and ``loaded_at`` of every load; None for an empty store."""
    return read_if_present(spark, f"{path}/batch=*/_ledger")


# ----- keys ------------------------------------------------------------------------------------------------------------
def _bit(key: str, space: Column) -> Column:
    """Place of a key in a space of so many bits, from 1 as the bitmap functions count."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), space) + 1


def key_index(df: DataFrame, batch: int, key: str, partition: str | None) -> DataFrame:
    """Bitmaps of the key hashes of a batch, by partition value (as text)."""
    value = F.lit("") if partition is None else F.coalesce(F.col(partition).cast("string"), F.lit(""))
    keys = df.select(F.col(key), value.alias("part")).distinct()
    # A power of two per partition value; one row for each of them.
    sizes = keys.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    bitmaps = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.col("_n") * BITS_PER_KEY / F.lit(float(BITMAP_BITS)), F.lit(1.0)))))
    spaced = keys.join(sizes.select("part", (bitmaps * BITMAP_BITS).cast("long").alias("space")), "part")
    placed = spaced.withColumn("_bit", _bit(key, F.col("space")))
    made = placed.groupBy("part", "space", F.bitmap_bucket_number("_bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("bits")
    )
    return made.select(F.lit(batch).cast("long").alias("batch"), "part", "space", "bucket", "bits")


def _is_set(bits: str, position: str) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(F.col(position) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    # Eight values, no shift by a column needed.
    return byte.bitwiseAND(F.pow(F.lit(2), F.col(position) % 8).cast("int")) > 0


def possible_hits(index: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming keys whose bit is set somewhere: ``key``, ``batch`` and ``part``."""
    # Powers of two: a few, however large the store.
    spaces = [F.lit(r.space) for r in index.select("space").distinct().collect()]
    if not spaces:
        return index.select(F.lit(None).cast(incoming.schema[key].dataType).alias(key), "batch", "part").limit(0)
    placed = incoming.select(key).distinct().withColumn("space", F.explode(F.array(*spaces))).withColumn("_bit", _bit(key, F.col("space")))
    placed = placed.withColumns({"bucket": F.bitmap_bucket_number("_bit"), "_position": F.bitmap_bit_position("_bit")})
    return placed.join(index, ["space", "bucket"]).where(_is_set("bits", "_position")).select(key, "batch", "part")


def clashes(spark: SparkSession, path: str, incoming: DataFrame, key: str, partition: str | None) -> DataFrame | None:
    """Incoming keys that the store holds; None if the index alone shows that there is none."""
    index = read_if_present(spark, f"{path}/batch=*/_keys")
    if index is None:
        return None
    hits = possible_hits(index, incoming, key)
    places = hits.select("batch", "part").distinct().limit(MOST_LISTED + 1).collect()
    if not places:
        return None
    stored = spark.read.parquet(path)
    value = F.lit("") if partition is None else F.coalesce(F.col(partition).cast("string"), F.lit(""))
    if len(places) <= MOST_LISTED:
        # Conditions on partition columns, so no other folder is opened.
        stored = stored.where(F.col("batch").isin(sorted({p.batch for p in places})))
        if partition is not None:
            stored = stored.where(value.isin(sorted({p.part for p in places})))
    keys = hits.select(F.col(key).alias("_key")).distinct()
    return stored.select(key).join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_semi").distinct()


# ----- appending -----------------------------------------------------------------------------------------------------------
def write_incoming(df: DataFrame, path: str, partitions: Sequence[str]) -> str:
    """Write a batch into a hidden folder of the store; returns the folder."""
    folder = f"{path}/_incoming/{uuid.uuid4().hex}"
    with setting(df.sparkSession, HASHED_LISTS, "false"):
        if partitions:
            # Even files: small partition values are put together, large ones split.
            df.hint("rebalance", *partitions).write.partitionBy(*partitions).parquet(folder)
        else:
            df.write.parquet(folder)
    return folder


def publish(spark: SparkSession, rows: DataFrame, folder: str, path: str, key: str, partition: str | None, mark: tuple[int, int, int], skip_repeats: bool) -> Loaded:
    """Make what lies in ``folder`` (read as ``rows``) the store's next batch, unless it was loaded before or holds stored keys."""
    loads = ledger(spark, path)
    number = 1
    if loads is not None:
        n, a, b = (F.lit(str(x)).cast("decimal(38,0)") for x in mark)
        same = (F.col("rows") == n) & (F.col("hash_a") == a) & (F.col("hash_b") == b)
        last, before = loads.agg(F.max("batch"), F.min(F.when(same, F.col("batch")))).first()
        if before is not None and skip_repeats:
            return Loaded(before, False)
        if before is not None:
            raise DuplicateKeys(f"{path} already holds this batch as number {before}; nothing was written")
        number = last + 1
        clash = clashes(spark, path, rows, key, partition)
        if clash is not None and clash.limit(1).take(1):
            raise DuplicateKeys(f"{path} already holds {key} values of this batch; nothing was written")
    key_index(rows, number, key, partition).write.parquet(f"{folder}/_keys")
    row = spark.range(1).select(
        F.lit(number).cast("long").alias("batch"),
        *[F.lit(str(x)).cast("decimal(38,0)").alias(name) for x, name in zip(mark, ("rows", "hash_a", "hash_b"), strict=True)],
        F.current_timestamp().alias("loaded_at"),
    )
    row.coalesce(1).write.parquet(f"{folder}/_ledger")
    move(spark, folder, f"{path}/batch={number}")
    return Loaded(number, True)


def append_guarded(df: DataFrame, path: str, key: str = "SiteID", partition: str | None = "Year", skip_repeats: bool = False) -> Loaded:
    """Append a batch, or refuse all of it if any of its keys is already stored.

    With ``skip_repeats`` the very same rows, in any order, are not an error: the batch is in the store already, and nothing changes.
    """
    spark = df.sparkSession
    folder = write_incoming(df, path, [] if partition is None else [partition])
    try:
        rows = spark.read.schema(df.schema).parquet(folder)
        mark = fingerprint(rows)
        return publish(spark, rows, folder, path, key, partition, mark, skip_repeats) if mark[0] else Loaded(None, False)
    finally:
        delete(spark, folder)


# ----- uploads of several tables --------------------------------------------------------------------------------------------------
def uploads(spark: SparkSession, root: str) -> DataFrame | None:
    """The ledger of ``append_all``: ``upload_id``, ``table``, ``rows``, ``hash_a``, ``hash_b``."""
    return read_if_present(spark, f"{root}/_uploads")


def append_all(tables: Mapping[str, DataFrame], root: str) -> Loaded:
    """Append every table that has rows, all under the next upload number; an upload that was made before changes nothing.

    A table is written once, and its fingerprint read from there. The rows of the ledger are written last, and ``read_uploaded`` reads only what they
    list, so an upload that broke off is not seen.
    """
    spark = next(iter(tables.values())).sparkSession
    folders = {name: write_incoming(df, f"{root}/{name}", []) for name, df in tables.items()}
    try:
        marks = {name: fingerprint(spark.read.schema(tables[name].schema).parquet(folder)) for name, folder in folders.items()}
        marks = {name: mark for name, mark in marks.items() if mark[0]}
        rows = [(name, *map(str, mark)) for name, mark in marks.items()]
        new = spark.createDataFrame(rows, "table string, rows string, hash_a string, hash_b string")
        new = new.select("table", *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("rows", "hash_a", "hash_b")])
        known, number = uploads(spark, root), 1
        if not rows:
            return Loaded(None, False)
        if known is not None:
            number = known.agg(F.max("upload_id")).first()[0] + 1
            same = known.join(new.withColumn("_same", F.lit(1)), ["table", "rows", "hash_a", "hash_b"], "left")
            found = same.groupBy("upload_id").agg(F.count("_same").alias("n"), F.count(F.lit(1)).alias("all"))
            before = found.where((F.col("n") == len(rows)) & (F.col("all") == len(rows))).agg(F.min("upload_id")).first()[0]
            if before is not None:
                return Loaded(before, False)
        for name in marks:
            place = f"{root}/{name}/upload_id={number}"
            delete(spark, place)  # of an upload that broke off before it was in the ledger
            move(spark, folders[name], place)
        new.withColumn("upload_id", F.lit(number).cast("long")).coalesce(1).write.mode("append").parquet(f"{root}/_uploads")
        return Loaded(number, True)
    finally:
        for folder in folders.values():
            delete(spark, folder)


def read_uploaded(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows of a table, with their ``upload_id``, of the uploads that the ledger lists."""
    listed = uploads(spark, root).where(F.col("table") == name).select("upload_id").distinct()
    rows = spark.read.parquet(f"{root}/{name}")
    return rows.withColumn("upload_id", F.col("upload_id").cast("long")).join(listed, "upload_id", "left_semi")
