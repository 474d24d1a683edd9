"""Removal of long word sequences that occur before, on a sparse De Bruijn graph.

The text is a walk over word k-mers, the edges of a De Bruijn graph. Of all k-mers in a window the one with the
smallest hash is its anchor (the leftmost one on ties), which depends on the window's words only. The edges
between two changes of anchor form one path without branches inside the document: windows that share an
anchor are compacted into one segment, named by a hash of all its words.

1. Segments meet by anchor. An anchor that occurs once settles all its windows: none of them is repeated.
2. Segments that are equal settle each other at once: all but the first in order of source coordinates are repeats. This
   is where long passages and copies go, with one row for up to fifteen windows.
3. Where different segments share an anchor the path branches, and the coordinates of the first of each are
   looked up in the text: its single windows are compared by hash, and all but the first are repeats.

Windows are compared by two 64-bit hashes (of the window and of its anchor).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivertally.llm.common import given_id
from rivertally.llm.order import row_keys

WINDOW = 20
ANCHOR = 6
#: Windows that can share an anchor, and the base of the numbers that hold a start and a length.
SPREAD = WINDOW - ANCHOR + 1
BASE = SPREAD + 1

_ODD = [int(x) | 1 for x in np.random.default_rng(20).integers(1 << 62, 1 << 63, 16, dtype=np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_ODD[0])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_ODD[1])
    return x ^ (x >> np.uint64(32))


def _sequence_hash(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, by doubling: a run is a head and a tail of known hashes."""
    known, length, out, done, level = h, 1, None, 0, 2
    while True:
        if size & length:
            out, done = (known, length) if out is None else (known[: len(known) - done] * np.uint64(_ODD[level]) + out[length:], done + length)
            out = out[: len(h) - done + 1]
        if 2 * length > size:
            return _mix(out)
        known = known[: len(known) - length] * np.uint64(_ODD[level + 1]) + known[length:]
        length, level = 2 * length, level + 2


def _leftmost_least(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the smallest of every ``size`` values in a row, the leftmost one on ties."""
    best, at, length = values, np.arange(len(values)), 1
    while length < size:
        step = min(length, size - length)
        left, right = slice(None, len(best) - step), slice(step, None)
        lower = best[right] < best[left]
        best, at = np.where(lower, best[right], best[left]), np.where(lower, at[right], at[left])
        length += step
    return at


class Windows:
    """All windows of one document: their hash, their anchor's hash, and which are the first of their kind in it."""

    def __init__(self, words: list[bytes]):
        h = _mix(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        grams = _sequence_hash(h, ANCHOR)
        self.hash = _sequence_hash(h, WINDOW)
        self.at = _leftmost_least(grams, SPREAD)
        self.anchor = grams[self.at]
        self.first = np.zeros(len(self.hash), bool)
        self.first[np.unique(self.hash, return_index=True)[1]] = True

    def segments(self) -> tuple[np.ndarray, ...]:
        """Anchor, name, start, length and kind (first in the document or not) of the segments."""
        n = len(self.hash)
        new = np.ones(n, bool)
        new[1:] = (self.at[1:] != self.at[:-1]) | (self.first[1:] != self.first[:-1])
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, n))
        # The first and the last window overlap, so that they hold all words of the segment.
        name = _mix(self.hash[start] * np.uint64(_ODD[14]) + _mix(self.hash[start + length - 1]) + length.astype(np.uint64))
        return self.anchor[start], name, start, length, self.first[start]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``anchor``, ``name``, ``rk``, ``at`` of the segments; ``at`` is negative for windows that repeat within the document."""
    names = ["anchor", "name", "rk", "at"]

    def batch_of(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names)

    for batch in batches:
        parts, held = [], 0
        for rk, text, copy in zip(batch["rk"], batch["text"], batch["copy"], strict=True):
            words = text.as_buffer().to_pybytes().split()
            if copy.as_py() or len(words) < WINDOW:
                continue
            anchor, name, start, length, first = Windows(words).segments()
            at = start.astype(np.int64) * BASE + length
            own = np.full(len(at), rk.as_py(), np.int64)
            # What repeats within the document is settled; a name of its own keeps it from meeting anything.
            anchor = np.where(first, anchor, _mix(own.astype(np.uint64) * np.uint64(_ODD[13]) + at.astype(np.uint64)))
            parts.append((anchor, name, own, np.where(first, at, -at)))
            held += len(at)
            if held >= 1 << 17:
                yield batch_of(parts)
                parts, held = [], 0
        if parts:
            yield batch_of(parts)


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The single windows of the segments that are named in ``marks``."""
    for batch in batches:
        for rk, text, marks in zip(batch["rk"], batch["text"], batch["marks"], strict=True):
            marked = np.asarray(marks.values, np.int64)
            marked = marked[marked & 1 == 0] >> 1
            if not len(marked):
                continue
            w = Windows(text.as_buffer().to_pybytes().split())
            start, length = marked // BASE, marked % BASE
            every = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
            columns = [w.anchor[every].view(np.int64), w.hash[every].view(np.int64), np.full(len(every), rk.as_py(), np.int64), every]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "hash", "rk", "start"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that stay."""
    for batch in batches:
        out: list[tuple[int, int, bytes]] = []
        for text, copy, marks, starts in zip(batch["text"], batch["copy"], batch["marks"], batch["starts"], strict=True):
            words = text.as_buffer().to_pybytes().split()
            n = len(words)
            if copy.as_py() and n >= WINDOW:
                out.append((n, n, b""))
                continue
            edge = np.zeros(n + 1, np.int64)
            if marks.is_valid:
                gone = np.asarray(marks.values, np.int64)
                gone = gone[gone & 1 == 1] >> 1
                start, length = gone // BASE, gone % BASE
                np.add.at(edge, start, 1)
                np.add.at(edge, start + length + WINDOW - 1, -1)
            if starts.is_valid:
                single = np.asarray(starts.values, np.int64)
                np.add.at(edge, single, 1)
                np.add.at(edge, single + WINDOW, -1)
            stays = np.cumsum(edge[:-1]) == 0
            removed = n - int(stays.sum())
            out.append((n, removed, b" ".join(compress(words, stays.tolist()) if removed else words)))
        n_words, n_removed, kept = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch["did"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
            ["did", "n_words", "n_removed", "kept"],
        )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (bytes: the words that stay, joined by one space) of every row.

    A word goes if a window of WINDOW words that covers it also starts earlier: in a smaller document or earlier in the same
    one. Windows are judged on the input. A missing or short text keeps all its words. A missing ``doc_id`` is
    smaller than all others; rows of one identifier with different texts are documents of their own, in order
    of the text's hash, and rows that repeat both are one document, returned as often as it comes.
    """
    rows = row_keys(docs)
    # Whole copies: every window of a later one has been seen, so they take no part in what follows.
    named = rows.select("rk", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2"))
    firsts = named.groupBy("h1", "h2").agg(F.min("rk").alias("first"))
    copies = named.join(firsts, ["h1", "h2"]).where("rk <> first").select("rk").distinct().withColumn("copy", F.lit(True))
    flagged = rows.join(copies, "rk", "left").withColumn("copy", F.coalesce("copy", F.lit(False)))

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = flagged.select("rk", "text", "copy").mapInArrow(_segments, "anchor long, name long, rk long, at long").repartition(parts, "anchor")
    equal = Window.partitionBy("anchor", "name").orderBy("rk", "at")
    around = Window.partitionBy("anchor")
    judged = met.select(
        "rk",
        "at",
        F.rank().over(equal).alias("turn"),
        F.min("name").over(around).alias("low"),
        F.max("name").over(around).alias("high"),
    )
    gone = (F.col("turn") > 1) | (F.col("at") < 0)
    # One number per segment: odd if it goes, even if its windows are to be compared.
    mark = F.when(gone, F.abs("at") * 2 + 1).when(F.col("low") != F.col("high"), F.col("at") * 2)
    marks = judged.select("rk", mark.alias("mark")).where("mark is not null").groupBy("rk").agg(F.collect_list("mark").alias("marks"))

    to_compare = marks.where(F.exists("marks", lambda m: m % 2 == 0))
    singles = rows.join(to_compare, "rk").select("rk", "text", "marks").mapInArrow(_single_windows, "anchor long, hash long, rk long, start long")
    turn = F.rank().over(Window.partitionBy("anchor", "hash").orderBy("rk", "start"))
    later = singles.withColumn("turn", turn).where("turn > 1").groupBy("rk").agg(F.collect_list("start").alias("starts"))

    everything = flagged.join(marks, "rk", "left").join(later, "rk", "left").select("did", "text", "copy", "marks", "starts")
    return everything.mapInArrow(_kept, "did long, n_words long, n_removed long, kept binary").select(
        given_id("did").alias("doc_id"), "n_words", "n_removed", "kept"
    )


def substring_report(docs: DataFrame) -> DataFrame:
    """``drop_repeats`` with the SHA-256 digest of what stays in place of the words."""
    return drop_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
