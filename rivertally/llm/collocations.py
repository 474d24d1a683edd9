"""Collocations: phrases of two and three words that occur together more often than their parts would by chance.

Words are numbered by a 64-bit hash of language and word, which is checked to be one to one (else another seed is taken), so all counts below are
exact. The texts are a weighted graph: its nodes are pairs of neighbouring words, and an edge from (x, y) to (y, z) is
the three-word gram x y z, weighted with its occurrences. At a piece's end the gram is filled up with an end mark, so the
weights of the edges that leave a node, the end's among them, sum up to the pair's own count, and those of all edges that begin with a word to the
word's count.

1. A pass over the texts sums the flow of every word, and names pairs that hold a thousandth of the text.
2. A second one sums edges in each task and packs them, by node, into blocks that are dealt to partitions; edges of a pair found above are dealt by their
   third word too, so no partition holds a whole hot node. Spark sorts each partition, and a stream over it sums edges and node flows.
3. Edges that occur often enough are compacted: where a node has one such edge in and one out, the two become
   one path, by pointer doubling over joins. Words and node flows are looked up once for a path's place, not for each of the grams that share it.

A missing text has no words; a missing language is ``und``. Every row counts, also those that repeat another row or identifier. A very long text is cut into words as a
whole; its memory is a few times its size. Ties in the ranking are settled by count and phrase, so the result is the same at any
partitioning. Empty tables give no rows. Other columns of the table don't matter.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivertally.llm.byte_words import byte_class, cut_words, slices
from rivertally.session import durable

LEAST = 10  # occurrences of a candidate
INSIDE = 50  # a phrase goes if a longer one around it has this percentage of its occurrences
TOP = 2000
CHUNK = 2 << 20  # bytes of text whose edges are summed at once
RUN = 500_000  # edges that are summed at once before they are sorted
STRETCH = 1024  # edges of a path that lie in one row
HOT = 1000  # a pair with more than this part of the text is dealt out by its third word too
HOT_PARTS = 64
BATCH_BYTES = 4 << 20  # bytes of a batch that a task gets, however many blocks it has; one block at least
BUCKETS = 64  # the ranking of a language is begun in so many parts

# Ends of pieces, and what lies between words.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
ENDS = byte_class(PIECE_ENDS)
IN_WORD = ~byte_class(PIECE_ENDS + b"\x20\x09")

BYTES_A_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
END = 0  # in place of a word behind a piece's end
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ----- texts to grams -----------------------------------------------------------------------------------------------------
def _numbered(texts: pa.Array, langs: pa.Array, seed: int) -> tuple[list[tuple[str, bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """The chunk's (language, word) pairs, their hashes, each token's pair, and whether the next token lies in the same piece."""
    words = cut_words(texts, IN_WORD)
    coded, lang = words.values.dictionary_encode(), langs.fill_null("und").dictionary_encode()
    names = coded.dictionary.to_pylist()
    size = max(len(names), 1)
    both, token = np.unique(lang.indices.to_numpy().astype(np.int64)[words.rows] * size + coded.indices.to_numpy(), return_inverse=True)
    kinds = lang.dictionary.to_pylist()
    pairs = [(kinds[i // size], names[i % size]) for i in both.tolist()]
    heads = {k: struct.pack("<I", len(k.encode())) + k.encode() for k in kinds}
    made = (xxhash.xxh64_intdigest(heads[k] + w, seed) for k, w in pairs)
    hashes = np.fromiter(made, np.uint64, len(pairs)).astype(np.int64)
    hashes[hashes == END] = 1
    ends = np.cumsum(ENDS[words.data], dtype=np.int64)
    piece = ends[words.starts] if len(words.starts) else np.zeros(0, np.int64)
    same = (piece[1:] == piece[:-1]) & (words.rows[1:] == words.rows[:-1])
    return pairs, hashes, token, same


def _grams(token: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Second and third word of the gram at every token, counted from 1; 0 behind a piece's end."""
    y, z = np.zeros(len(token), np.int64), np.zeros(len(token), np.int64)
    y[:-1][same] = token[1:][same] + 1
    both = same[:-1] & same[1:]
    z[:-2][both] = token[2:][both] + 1
    return y, z


def _chunks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple]:
    for batch in batches:
        for at, texts in slices(batch.column(0), CHUNK):
            made = _numbered(texts, batch.column(1).slice(at, len(texts)), seed)
            if len(made[2]):
                yield made


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["text"].alias("text"), docs["lang"].cast("string").alias("lang"))


def word_flows(docs: DataFrame, seed: int) -> DataFrame:
    """``h``, ``lang``, ``word`` and ``n`` of every word; rows with ``h2`` are hot pairs, of which ``n`` is what single chunks hold much of."""

    def flows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs, hashes, token, same in _chunks(batches, seed):
            y, _ = _grams(token, same)
            size = len(pairs) + 1
            couples, times = np.unique((token * size + y)[y > 0], return_counts=True)
            much = times * HOT >= len(token)
            couples, times = couples[much], times[much]
            lang, word = zip(*pairs, strict=True)
            none = [None] * len(couples)
            columns = [
                np.concatenate([hashes, hashes[couples // size]]),
                pa.array([*([None] * len(pairs)), *hashes[couples % size - 1].tolist()], pa.int64()),
                pa.array([*lang, *none], pa.string()),
                pa.array([*word, *none], pa.binary()).cast(pa.string()),
                np.concatenate([np.bincount(token, minlength=len(pairs)), times]),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "h2", "lang", "word", "n"])

    found = _texts(docs).mapInArrow(flows, "h long, h2 long, lang string, word string, n long")
    return durable(found.groupBy("h", "h2", "lang", "word").agg(F.sum("n").alias("n")))


def known_words(docs: DataFrame) -> tuple[DataFrame, np.ndarray, int]:
    """Words with their flows, the hot pairs (at most 2 * ``HOT`` of them), and the seed under which no two words share a hash."""
    seed = 0
    while True:
        found = word_flows(docs, seed)
        words = found.where("h2 IS NULL").drop("h2")
        if not words.groupBy("h").count().where("count > 1").take(1):
            break
        seed += 1
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # A pair with a part of 1 / HOT or more in a chunk counts there; one with twice that of the text passes.
    hot = found.where("h2 IS NOT NULL").where(F.col("n") * (2 * HOT) > total).select("h", "h2").collect()
    return words, np.array([tuple(r) for r in hot], np.int64).reshape(-1, 2), seed


# ----- edges and node flows ----------------------------------------------------------------------------------------------------
def _mixed(*values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values[0]), np.uint64)
    for v in values:
        out = (out ^ v.astype(np.uint64)) * _ODD
        out ^= out >> np.uint64(29)
    return out


def _is_hot(x: np.ndarray, y: np.ndarray, hot: np.ndarray) -> np.ndarray:
    found = np.zeros(len(x), bool)
    if len(hot):
        maybe = np.flatnonzero(np.isin(x, hot[:, 0]))
        known = set(map(tuple, hot.tolist()))
        found[maybe] = [pair in known for pair in zip(x[maybe].tolist(), y[maybe].tolist(), strict=True)]
    return found


def _packed(docs: DataFrame, hot: np.ndarray, seed: int, parts: int) -> DataFrame:
    """Edges of each chunk, packed by the partition they are to be summed in: the words' hashes, and numbers among them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs, hashes, token, same in _chunks(batches, seed):
            size = len(pairs) + 1
            y, z = _grams(token, same)
            couples, couple = np.unique(token * size + y, return_inverse=True)
            grams, times = np.unique(couple * size + z, return_counts=True)
            x, y, z = couples[grams // size] // size + 1, couples[grams // size] % size, grams % size
            named = np.concatenate([np.zeros(1, np.int64), hashes])
            split = np.where(_is_hot(named[x], named[y], hot), named[z] % HOT_PARTS, 0)
            part = (_mixed(named[x], named[y], split) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = []
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if a < b:
                    own = order[a:b]
                    used, place = np.unique(np.concatenate([x[own], y[own], z[own]]), return_inverse=True)
                    rows.append((i, named[used].tobytes(), place.astype(np.uint32).tobytes(), times[own].astype(np.uint32).tobytes()))
                if rows and (len(rows) == 256 or i == parts - 1):
                    columns = zip(*rows, strict=True)
                    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "names", "grams", "times"])
                    rows = []

    return _texts(docs).mapInArrow(pack, "part int, names binary, grams binary, times binary")


_EDGE = "x long, y long, z long, n long"


def _summed(x: np.ndarray, y: np.ndarray, z: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Sorted edges with equal ones added up."""
    fresh = np.ones(len(x), bool)
    fresh[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])
    at = np.flatnonzero(fresh)
    return [x[at], y[at], z[at], np.add.reduceat(n, at)] if len(at) else [x, y, z, n]


def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["x", "y", "z", "n"])


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Batches for Python of about ``size`` bytes in what is run inside: by rows alone, a batch of blocks would grow with the partition."""
    before = spark.conf.get(BYTES_A_BATCH, None)
    spark.conf.set(BYTES_A_BATCH, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BYTES_A_BATCH)
        else:
            spark.conf.set(BYTES_A_BATCH, before)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count = [], 0

    def run() -> pa.RecordBatch:
        x, y, z, n = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((z, y, x))
        return _batch(_summed(x[order], y[order], z[order], n[order]))

    for batch in batches:
        for block in zip(*batch.columns[1:], strict=True):
            # Blocks are read where they lie.
            names, grams, times = (np.frombuffer(value.as_buffer(), kind) for value, kind in zip(block, (np.int64, np.uint32, np.uint32), strict=True))
            x, y, z = names[grams].reshape(3, -1)
            held.append((x, y, z, times.astype(np.int64)))
            count += len(x)
            if count >= RUN:
                yield run()
                held, count = [], 0
    if held:
        yield run()


def frequent(docs: DataFrame, hot: np.ndarray, seed: int, least: int = LEAST) -> DataFrame:
    """Edges (``x``, ``y``, ``z``, ``n``) with ``least`` occurrences, and flows of nodes: ``z`` is ``END`` there. A hot node's flow is spread over rows."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [np.zeros(0, np.int64)] * 4
        edge, node = none, none

        def passed(edges: list[np.ndarray], last: bool) -> pa.RecordBatch:
            """Edges that are whole, and the nodes that they complete; the last node may go on."""
            nonlocal node
            x, y, z, n = edges
            flow = [np.concatenate(p) for p in zip(node, [x, y, np.zeros(len(x), np.int64), n], strict=True)]
            flow = _summed(*flow)
            end = len(flow[0]) - (0 if last else 1)
            node = [c[max(end, 0) :] for c in flow]
            flow = [c[: max(end, 0)] for c in flow]
            often = (n >= least) & (z != END)
            counted = (flow[1] != END) & ((flow[3] >= least) | _is_hot(flow[0], flow[1], hot))
            return _batch([np.concatenate([a[often], b[counted]]) for a, b in zip(edges, flow, strict=True)])

        for batch in batches:
            if batch.num_rows:
                edges = _summed(*(np.concatenate([a, c.to_numpy()]) for a, c in zip(edge, batch.columns, strict=True)))
                edge = [c[-1:] for c in edges]
                yield passed([c[:-1] for c in edges], False)
        yield passed(edge, True)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = _packed(docs, hot, seed, parts).repartitionById(parts, F.col("part"))
    with batches_of(docs.sparkSession, BATCH_BYTES):
        return durable(packed.mapInArrow(_unpack, _EDGE).sortWithinPartitions("x", "y", "z").mapInArrow(sums, _EDGE))


# ----- unary paths --------------------------------------------------------------------------------------------------------------
def _ranked(links: DataFrame) -> DataFrame:
    """``e``, ``ptr`` (head of its path) and ``dist`` (steps from there) for every edge ``b`` that follows an edge ``a``.

    Each round doubles how far an edge sees, and is a written table. Edges that still see no head when they see farther than there are
    edges lie on cycles; such a cycle is opened before its smallest edge.
    """
    state = durable(links.select(F.col("b").alias("e"), F.col("a").alias("ptr"), F.lit(1).cast("long").alias("dist"), F.least("a", "b").alias("low"), F.lit(True).alias("open")))
    size, reach = state.count(), 1
    while size:
        on = state.select(F.col("e").alias("ptr"), F.col("ptr").alias("_ptr"), F.col("dist").alias("_dist"), F.col("low").alias("_low"))
        far = state.join(on, "ptr", "left")
        state = durable(
            far.select(
                "e",
                F.coalesce("_ptr", "ptr").alias("ptr"),
                (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist"),
                F.least("low", "_low").alias("low"),
                F.col("_ptr").isNotNull().alias("open"),
            )
        )
        if not state.where("open").take(1):
            break
        # Edges that saw ``reach`` steps far and went on even so.
        if reach >= size:
            rounds = state.where("open").select(F.col("e").alias("b"), "low")
            opened = links.join(rounds, "b").where("b <> low").select("a", "b")
            return state.where("NOT open").select("e", "ptr", "dist").unionByName(_ranked(opened))
        reach *= 2
    return state.select("e", "ptr", "dist")


def compacted(edges: DataFrame) -> DataFrame:
    """Paths of edges through nodes with one edge in and one out: ``path``, ``stretch``, ``words`` (hashes) and ``counts`` (of the grams in them).

    Each edge lies in one path; a path of more than ``STRETCH`` edges has several rows. ``edges`` are distinct.
    """
    told = durable(edges.select("x", "y", "z", "n", F.monotonically_increasing_id().alias("e")))
    leave = told.groupBy("x", "y").agg(F.count(F.lit(1)).alias("k"), F.min("e").alias("b")).where("k = 1").drop("k")
    enter = told.groupBy(F.col("y").alias("x"), F.col("z").alias("y")).agg(F.count(F.lit(1)).alias("k"), F.min("e").alias("a")).where("k = 1").drop("k")
    links = durable(enter.join(leave, ["x", "y"]).where("a <> b").select("a", "b"))
    placed = told.join(_ranked(links), "e", "left").select(
        F.coalesce("ptr", "e").alias("path"), F.coalesce("dist", F.lit(0)).alias("pos"), "x", "y", "z", "n"
    )
    steps = F.array_sort(F.collect_list(F.struct("pos", "x", "y", "z", "n")))
    grouped = placed.groupBy("path", F.floor(F.col("pos") / STRETCH).alias("stretch")).agg(steps.alias("steps"))
    return durable(
        grouped.select(
            "path", "stretch", F.concat(F.array(F.col("steps")[0]["x"], F.col("steps")[0]["y"]), F.col("steps")["z"]).alias("words"), F.col("steps")["n"].alias("counts")
        )
    )


# ----- phrases --------------------------------------------------------------------------------------------------------------------
def _looked_up(paths: DataFrame, items: Column, table: DataFrame, keys: list[str], values: list[str], into: str) -> DataFrame:
    """``path``, ``stretch`` and the array ``into``: what ``table`` holds for each of the path's ``items``, in their order."""
    each = paths.select("path", "stretch", F.posexplode(items).alias("pos", "item"))
    each = each.select("path", "stretch", "pos", *([F.col("item").alias(keys[0])] if len(keys) == 1 else ["item.*"]))
    found = each.join(table, keys)
    rows = F.array_sort(F.collect_list(F.struct("pos", *values)))
    return found.groupBy("path", "stretch").agg(rows.alias(into))


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 a a / (l r)), exactly: decimals hold products up to 10^38."""
    wide = "decimal(20,0)"
    top = a.cast(wide) * a.cast(wide) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, l.cast(wide) * r.cast(wide))


def candidates(docs: DataFrame, least: int = LEAST, inside: int = INSIDE) -> tuple[DataFrame, DataFrame]:
    """All phrases that stay (``lang``, ``phrase``, ``a``, ``l``, ``r``, ``score``), and the number of words of each language (``lang``, ``n``)."""
    words, hot, seed = known_words(docs)
    heavy = frequent(docs, hot, seed, least)
    often = words.where(F.col("n") >= least).select("h", "lang", "word", F.col("n").alias("f"))
    nodes = durable(heavy.where(F.col("z") == END).groupBy("x", "y").agg(F.sum("n").alias("f")).where(F.col("f") >= least))
    edges = heavy.where(F.col("z") != END)
    paths = compacted(edges)

    pairs = F.zip_with(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    named = _looked_up(paths, F.col("words"), often, ["h"], ["word", "f", "lang"], "w")
    flows = _looked_up(paths, pairs, nodes, ["x", "y"], ["f"], "p")
    whole = paths.select("path", "stretch", "counts").join(named, ["path", "stretch"]).join(flows, ["path", "stretch"])
    each = whole.select("w", "p", F.posexplode("counts").alias("i", "a"))
    i = F.col("i")

    def word(k: int) -> Column:
        return F.col("w")[i + k]

    threes = each.select(
        F.col("w")[0]["lang"].alias("lang"),
        F.concat_ws(" ", word(0)["word"], word(1)["word"], word(2)["word"]).alias("phrase"),
        "a",
        word(0)["f"].alias("l1"),
        F.col("p")[i + 1]["f"].alias("r1"),
        F.col("p")[i]["f"].alias("l2"),
        word(2)["f"].alias("r2"),
    ).withColumns({"s1": _score(F.col("a"), F.col("l1"), F.col("r1")), "s2": _score(F.col("a"), F.col("l2"), F.col("r2"))})
    first = F.col("s1") <= F.col("s2")

    def lower(one: str, two: str) -> Column:
        return F.when(first, F.col(one)).otherwise(F.col(two))

    threes = threes.select("lang", "phrase", "a", lower("l1", "l2").alias("l"), lower("r1", "r2").alias("r"), lower("s1", "s2").alias("score"))

    around = edges.select("x", "y", "n").unionByName(edges.select(F.col("y").alias("x"), F.col("z").alias("y"), "n")).groupBy("x", "y").agg(F.max("n").alias("around"))
    free = nodes.join(around, ["x", "y"], "left").where(F.col("around").isNull() | (100 * F.col("around") < inside * F.col("f")))
    left = often.select(F.col("h").alias("x"), "lang", F.col("word").alias("w1"), F.col("f").alias("l"))
    right = often.select(F.col("h").alias("y"), F.col("word").alias("w2"), F.col("f").alias("r"))
    twos = free.join(left, "x").join(right, "y").select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), "l", "r")
    twos = twos.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    return threes.unionByName(twos), words.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of every language: ``lang``, ``rank``, ``phrase``, ``a`` (occurrences), ``l``, ``r`` (of its parts), ``n`` (words of the language), ``score``."""
    found, sizes = candidates(docs, least, inside)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # No task ranks a whole language: first the best of each part of it.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))).orderBy(*order)
    best = found.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= top).drop("_r")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
