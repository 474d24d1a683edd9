"""Near-duplicate vectors: spherical k-means cells, cosine products in blocks within a cell, one row kept per group.

A vector is compared within the cell of its nearest centre. A close pair may lie on both sides of the border
between two cells; as the two are at most ``REACH`` apart, one of them is within half of it of the border. So
a vector also visits every cell whose border is that near, and no close pair is missed, whatever the centres are. The
fit of the centres only decides how much work is done.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FloatType

from rivertally.llm.common import given_id, known_id
from rivertally.llm.graph import components
from rivertally.session import durable

COSINE = 0.95
#: Vectors that the centres are fitted on (about), at most so many centres, and rounds of fitting.
SAMPLE = 32_768
MOST_CELLS = 4_096
ROUNDS = 8
#: Owners or visitors of a cell that are compared in one piece; larger cells are compared piece by piece.
BLOCK = 2_048
_SLACK = 1e-9


def usable(embedding: Column) -> Column:
    """True for vectors with a direction: present, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _directions(vectors: pa.Array, dim: int) -> np.ndarray:
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centres(x: np.ndarray, cells: int, seed: int = 1) -> np.ndarray:
    """Spherical k-means on the sample ``x`` of directions."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(ROUNDS):
        nearest = np.concatenate([(x[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        order = np.argsort(nearest, kind="stable")
        found, start = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(x[order], start, axis=0)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres[found] = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres[found])
    return centres


def _assigned(batches: Iterator[pa.RecordBatch], centres: dict[int, np.ndarray], reach: float) -> Iterator[pa.RecordBatch]:
    """A row for a vector's own cell, with the cells that it visits, and a row for each visit."""
    gaps = {d: np.maximum(np.sqrt(np.maximum(0, 2 - 2 * c @ c.T)), 1e-12) for d, c in centres.items()}
    names = ["dim", "cell", "home", "rep", "copies", "vec", "visits"]
    for batch in batches:
        dims = batch["dim"].to_numpy()
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            for start in range(0, part.num_rows, 1024):
                some = part.slice(start, 1024)
                n = some.num_rows
                x = _directions(some["vec"], dim)
                if dim in centres:
                    near = x @ centres[dim].T
                    home = near.argmax(axis=1)
                    away = (near[np.arange(n), home][:, None] - near) / gaps[dim][home]
                    visit = away <= reach / 2 + _SLACK
                    visit[np.arange(n), home] = False
                else:
                    home, visit = np.zeros(n, np.int64), np.zeros((n, 1), bool)
                row, cell = np.nonzero(visit)
                offsets = np.concatenate([[0], np.cumsum(visit.sum(axis=1))]).astype(np.int32)
                visits = pa.ListArray.from_arrays(pa.array(offsets), pa.array(cell.astype(np.int32)))
                take = np.concatenate([np.arange(n), row])
                both = some.take(pa.array(take))
                no_visits = pa.ListArray.from_arrays(pa.array(np.zeros(len(row) + 1, np.int32)), pa.array([], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [
                        both["dim"],
                        pa.array(np.concatenate([home, cell]).astype(np.int32)),
                        pa.array(home[take].astype(np.int32)),
                        both["rep"],
                        both["copies"],
                        both["vec"],
                        pa.concat_arrays([visits, no_visits]),
                    ],
                    names,
                )


def _linked(key: tuple, rows: pa.Table, least: float) -> pa.Table:
    """Links between a piece of a cell's owners and a piece of its owners or visitors: summed per vector, with a group label.

    Two visitors meet at home or elsewhere, so they are not compared here. A visitor from a smaller cell
    is left to that cell by those owners that visit it. Links are few among the products, so they are kept as pairs.
    """
    _, cell, p, q = (k.as_py() for k in key)
    rows = rows.combine_chunks()
    rep, copies, home, piece = (rows[c].to_numpy() for c in ("rep", "copies", "home", "piece"))
    a, b = np.flatnonzero(piece == p), np.flatnonzero(piece == q)
    if not len(a) or not len(b):
        return pa.table({"rep": rep[:0], "links": np.zeros(0, np.int64), "label": rep[:0]})
    x = _directions(rows["vec"].combine_chunks(), key[0].as_py())
    other = x[b].T
    found = [np.nonzero(x[a[i : i + 512]] @ other >= least) for i in range(0, len(a), 512)]
    one = a[np.concatenate([r + 512 * i for i, (r, _) in enumerate(found)])]
    two = b[np.concatenate([c for _, c in found])]
    if p == q:
        keep = one != two
    else:
        visits = rows["visits"].combine_chunks()
        visitor = np.repeat(np.arange(len(rep)), visits.value_lengths().to_numpy(zero_copy_only=False))
        leaves = (visitor << 32) + visits.flatten().to_numpy(zero_copy_only=False)
        keep = (home[two] >= cell) | ~np.isin((one << 32) + home[two], leaves)
    one, two = one[keep], two[keep]
    counts = np.bincount(one, copies[two], len(rep))
    if p != q:
        counts += np.bincount(two, copies[one], len(rep))
    label, before = rep.copy(), None
    while before is None or (label != before).any():
        before = label.copy()
        np.minimum.at(label, one, label[two])
        np.minimum.at(label, two, label[one])
    met = np.flatnonzero(counts)
    return pa.table({"rep": rep[met], "links": counts[met].astype(np.int64), "label": label[met]})


def _vectors(embedding: Column, kind: DataType) -> Column:
    """The vectors as doubles, or as they are where they are floats, which take half the room and become the same doubles."""
    return embedding if kind == ArrayType(FloatType(), kind.containsNull if isinstance(kind, ArrayType) else True) else embedding.cast("array<double>")


def _grouped(vectors: DataFrame, least: float) -> DataFrame:
    """``vid``, ``vec`` (null without a direction), ``n_links`` and ``component`` (null where no identifier is known) of every row."""
    named = vectors.select(known_id("vec_id").alias("vid"), _vectors(F.col("embedding"), vectors.schema["embedding"].dataType).alias("vec"))
    rows = durable(named.select("vid", F.when(usable(F.col("vec")), F.col("vec")).alias("vec")))
    # Distinct vectors are compared, under numbers of their own that hold once they are written.
    distinct = durable(
        rows.where("vec is not null")
        .groupBy("vec")
        .agg(F.min(given_id("vid")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("rep"), "first", "copies", "vec", F.size("vec").alias("dim"))
    )
    n = distinct.count()
    every = max(1, n // SAMPLE)
    sample = distinct.where(F.pmod(F.xxhash64("rep"), F.lit(every)) == 0).select("dim", "vec").toArrow()
    sizes = np.asarray(sample["dim"])
    cells = int(min(MOST_CELLS, max(1, round(n**0.5))))
    centres = {}
    for dim in np.unique(sizes):
        x = _directions(sample.filter(pa.array(sizes == dim))["vec"].combine_chunks(), dim)
        centres[int(dim)] = fit_centres(x, max(1, cells * len(x) // len(sizes)))
    reach = float(np.sqrt(2 - 2 * least))

    kind = distinct.schema["vec"].dataType.simpleString()
    members = f"dim int, cell int, home int, rep long, copies long, vec {kind}, visits array<int>"
    assigned = durable(distinct.mapInArrow(partial(_assigned, centres=centres, reach=reach), members))
    # One row per cell: at most MOST_CELLS for each number of components. Owners are in pieces 0 to o - 1, visitors in the v pieces after them.
    # A piece of owners meets itself, the later pieces of owners and all pieces of visitors.
    owns = F.col("home") == F.col("cell")
    pieces = assigned.groupBy("dim", "cell").agg(*(F.ceil(F.count_if(who) / BLOCK).cast("int").alias(c) for c, who in (("o", owns), ("v", ~owns))))
    part = F.xxhash64("rep")
    piece = F.when(owns, F.pmod(part, F.greatest("o", F.lit(1)))).otherwise(F.col("o") + F.pmod(part, F.greatest("v", F.lit(1)))).cast("int")
    placed = assigned.join(pieces.where("o > 0"), ["dim", "cell"]).withColumn("piece", piece)
    last = F.when(owns, F.col("o") + F.col("v")).otherwise(F.col("o")) - 1
    pairs = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(F.least(k, "piece").alias("p"), F.greatest(k, "piece").alias("q")))
    dealt = placed.withColumn("pair", F.explode(pairs)).select("dim", "cell", F.col("pair.p").alias("p"), F.col("pair.q").alias("q"), "home", "rep", "copies", "vec", "visits", "piece")
    met = durable(dealt.groupBy("dim", "cell", "p", "q").applyInArrow(partial_with_key(_linked, least), "rep long, links long, label long"))

    groups = components(met.select("rep", "label"), "rep", "label")
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    found = durable(
        distinct.join(links, "rep", "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select("vec", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    )
    smallest = found.groupBy("root").agg(F.min("first").alias("component"))
    return rows.join(found.join(smallest, "root").select("vec", "n_links", "component", F.lit(True).alias("met")), "vec", "left")


def embedding_groups(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``: one row for each row of ``vectors``.

    Two vectors are linked if their cosine, in double precision, is at least ``least``; they must have the same number of
    components. Vectors without a direction link with nothing. Every row is a vector of its own, also where rows share an identifier, have
    none, or repeat each other: equal vectors are linked, and compared with others once. ``component_id`` is the smallest
    known identifier that a vector reaches, null if it reaches none.
    """
    out = _grouped(vectors, least).select(
        given_id("vid").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("met"), F.col("component")).otherwise(given_id("vid")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def partial_with_key(function, least: float):
    """The two-argument form that ``applyInArrow`` tells from the one-argument form by its signature."""

    def with_key(key: tuple, rows: pa.Table) -> pa.Table:
        return function(key, rows, least)

    return with_key


def representatives(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """The rows of ``vectors`` that stay: those that bear the smallest identifier of their group. Rows that repeat such a row stay with it."""
    grouped = _grouped(vectors, least).where(~F.coalesce("met", F.lit(False)) | (F.col("vid") == F.col("component")))
    kept = grouped.select(F.col("vid").alias("__vid"), F.col("vec").alias("__vec")).distinct()
    vec = _vectors(vectors["embedding"], vectors.schema["embedding"].dataType)
    own = F.when(usable(vec), vec)
    return vectors.join(kept, (known_id(vectors["vec_id"]) == kept["__vid"]) & own.eqNullSafe(kept["__vec"]), "left_semi")
