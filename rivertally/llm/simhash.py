"""Near-duplicates by SimHash fingerprints, found through blocks of bits that close pairs share."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivertally.llm.common import given_id, known_id
from rivertally.llm.graph import components
from rivertally.session import durable

SHINGLE = 4
SEED = 42
DISTANCE = 4
BITS = 64

#: ASCII capitals to small letters; every other byte stays.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_AT_ONCE = 1 << 15


def fingerprint(text: bytes) -> int:
    """The fingerprint of one text, as an unsigned number; 0 without words."""
    words = text.translate(_LOWER).split()  # splits bytes at the six ASCII blanks
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    count = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, _AT_ONCE):  # a bounded number of hashes is unpacked at a time
        stop = min(start + _AT_ONCE, count)
        shingles = map(b" ".join, zip(*(words[start + i : stop + i] for i in range(size)), strict=True))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, stop - start)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(x.as_buffer().to_pybytes()) for x in batch["text"]), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch["did"], batch["th"], pa.array(found.view(np.int64))], ["did", "th", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``did`` (``known_id``), ``th`` (hash of the text, tells rows of one identifier apart) and ``fp`` of every row."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(known_id("doc_id").alias("did"), F.xxhash64(text).alias("th"), text.cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, "did long, th long, fp long")


def block_count(distinct: int) -> int:
    """Blocks to cut a fingerprint into: keys of the blocks left after DISTANCE differ grow with the table.

    At least ``blocks - DISTANCE`` blocks of a close pair agree. Six blocks give keys of 21 bits, eight keys of
    32 bits. The choice changes the work only: every count finds every close pair.
    """
    return next((n for n in (6, 7) if distinct >> (BITS * (n - DISTANCE) // n) < 64), 8)


def _masks(blocks: int) -> list[int]:
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - DISTANCE)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _close(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y)) <= DISTANCE


def close_groups(prints: DataFrame) -> DataFrame:
    """``node`` and ``root``: the fingerprints that links of up to DISTANCE bits join to a smaller one, and the smallest of those.

    ``prints`` has one row per distinct fingerprint, ``fp``. Each print goes to one bucket per choice of blocks. First every
    member is compared with its bucket's smallest print, which joins the bulk of a dense group with one row per
    member. Then members of a bucket are compared with each other, but a link comes out only where the two are
    not joined yet, and in the first bucket they share.
    """
    masks = [_signed(m) for m in _masks(block_count(prints.count()))]
    keys = F.explode(F.array(*(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks))))

    def spread(rows: DataFrame) -> DataFrame:
        return rows.select("*", keys.alias("k")).select(*rows.columns, "k.choice", "k.key")

    member = spread(prints.select("fp"))
    first = member.groupBy("choice", "key").agg(F.min("fp").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    near = member.join(first, ["choice", "key"]).where((F.col("fp") != F.col("first")) & _close(F.col("fp"), F.col("first")))
    by_first = components(near.select("fp", "first"), "fp", "first")
    joined = durable(prints.join(by_first, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("part")))
    x = spread(joined)
    y = x.select("choice", "key", F.col("fp").alias("fp2"), F.col("part").alias("part2"))
    differ = F.col("fp").bitwiseXOR(F.col("fp2"))
    shared = reduce(lambda rest, im: F.when(differ.bitwiseAND(F.lit(im[1])) == 0, im[0]).otherwise(rest), reversed(list(enumerate(masks))), F.lit(-1))
    apart = (
        x.join(y, ["choice", "key"])
        .where((F.col("part") < F.col("part2")) & (F.bit_count(differ) <= DISTANCE) & (shared == F.col("choice")))
        .select(F.col("part").alias("a"), F.col("part2").alias("b"))
    )
    return components(by_first.select(F.col("node").alias("a"), F.col("root").alias("b")).union(apart), "a", "b")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """``did``, ``th``, ``fp``, ``root`` (smallest print of the group) and ``component`` (smallest identifier reachable) of every row.

    A missing or empty text has fingerprint 0 and is linked like any other. Repeated rows come back as often as
    they come. A missing ``doc_id`` counts as smaller than all others.
    """
    rows = durable(fingerprints(docs))
    prints = durable(rows.groupBy("fp").agg(F.min("did").alias("rep")))
    rooted = durable(
        prints.join(close_groups(prints), F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    )
    least = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    named = rooted.join(least, "root").select("fp", "root", "component")
    return rows.join(named, "fp").select("did", "th", "fp", "root", "component")


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """One row of each group, with the columns of ``docs``: the row whose identifier is the group's smallest.

    Rows that repeat both identifier and text count as one.
    """
    groups = simhash_groups(docs)
    stays = groups.where("did = component").groupBy("root", "component").agg(F.min("th").alias("th"))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({"__did": known_id("doc_id"), "__th": F.xxhash64(text)})
    kept = keyed.join(stays.select(F.col("component").alias("__did"), F.col("th").alias("__th")), ["__did", "__th"], "left_semi")
    return kept.dropDuplicates(["__did", "__th"]).select(*(F.col(f"`{c}`") for c in docs.columns))


def simhash_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row."""
    return simhash_groups(docs).select(
        given_id("did").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), given_id("component").alias("component_id")
    )
