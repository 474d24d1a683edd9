"""Ranked lexical search: all documents scored for each item of a query set, by dense tiles.

Items are taken in groups of bounded text, so that the vocabulary that a task holds is bounded; a group is a pass over the
documents, and most query sets are one group. A pass has three steps:

1. Each document becomes its number of terms and the counts of the group's terms. Document frequencies are summed from that.
2. Each task multiplies tiles: the weights of some items over the terms that these items hold (their compact vocabulary, cut so that
   partial sums stay below 2^53) times the impacts of a block of documents over the same terms, in float64. All factors are
   whole numbers, so every partial sum is exact, in whatever order the library adds; tiles are added as 64-bit integers. Of each
   block, a document enters an item's list if its score is no less than the list's last one, and ties are put in order of identifier.
3. The tasks' lists (50 rows per item and task) are ranked together.

A missing text, or one without a term, is no document of the collection and in no list; an item without terms has no rows. Rows that repeat an item are items
of their own; rows that repeat a document are documents of their own, side by side in the lists. A missing ``doc_id`` comes before every other
in ties. Empty tables give no rows. Other columns of the tables don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivertally.llm.byte_words import byte_class, cut_words, slices
from rivertally.llm.common import given_id, known_id
from rivertally.llm.order import running_total
from rivertally.session import durable

TOP = 50
GROUP_BYTES = 4 << 20  # items' text, and 256 for each item, that tasks hold at once (or one item, if that is longer)
ITEMS = 256  # items of a tile
TERMS = 2048  # terms of a tile
DOCUMENTS = 1024  # documents of a tile
EXACT = 2**53

# A term is a run of ASCII letters and digits and of characters outside ASCII.
IN_TERM = byte_class(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))

MOST_IMPACT = 1_000_000  # of one term in one document; see ``impacts``


# ----- items ----------------------------------------------------------------------------------------------------------------
def grouped_items(items: DataFrame, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """``ik`` (a number for each row), ``item_id``, ``text`` and ``group`` of the items, and the number of groups."""
    text = F.coalesce(items["text"], F.lit(""))
    rows = items.select(items["item_id"].alias("item_id"), text.alias("text"), F.monotonically_increasing_id().alias("ik"))
    rows = durable(rows)  # the numbers hold from here on
    cost = rows.select("ik", (F.octet_length("text") + 256).cast("long").alias("cost"))
    group = F.floor(F.col("before") / group_bytes)
    placed = running_total(cost, [], ["ik"], "cost", "before").select("ik", group.alias("group"))
    grouped = durable(rows.join(placed, "ik"))
    last = grouped.agg(F.max("group")).first()[0]
    return grouped, 0 if last is None else last + 1


def _vocabulary(texts: pa.Array) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct terms of all texts, and the numbers of each text's terms."""
    words = cut_words(texts, IN_TERM)
    coded = words.values.dictionary_encode()
    codes = coded.indices.to_numpy()
    cuts = np.searchsorted(words.rows, np.arange(len(texts) + 1))
    return coded.dictionary, [np.unique(codes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


# ----- documents -------------------------------------------------------------------------------------------------------------
def counted(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """``did``, ``n`` (terms in all), ``terms`` and ``counts`` (those in the vocabulary) of every document that has terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(len(vocabulary), 1)
        for batch in batches:
            for at, texts in slices(batch.column(1)):
                words = cut_words(texts, IN_TERM)
                n = np.bincount(words.rows, minlength=len(texts))
                coded = words.values.dictionary_encode()
                number = pc.index_in(coded.dictionary, value_set=vocabulary).fill_null(-1).to_numpy()
                term = number[coded.indices.to_numpy()] if len(number) else np.zeros(0, np.int64)
                known = term >= 0
                pairs, times = np.unique(words.rows[known] * size + term[known], return_counts=True)
                ends = np.searchsorted(pairs // size, np.arange(len(texts) + 1)).astype(np.int32)
                made = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array((pairs % size).astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int32))),
                    ],
                    ["did", "n", "terms", "counts"],
                )
                yield made.filter(pa.array(n > 0))

    rows = docs.select(known_id(docs["doc_id"]).alias("did"), docs["text"].alias("text"))
    return durable(rows.mapInArrow(count, "did long, n long, terms array<int>, counts array<int>"))


def weights(documents: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Number of documents, of their terms, and the weight of each vocabulary term (0 where no document holds it)."""
    n_docs, n_terms = documents.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = documents.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * n_docs + 2)).cast("double") / (2 * F.col("df") + 1)))
    # One row for each term of the group.
    found = held.select("term", weight.cast("long").alias("w")).toArrow()
    out = np.zeros(size, np.int64)
    out[found.column("term").to_numpy()] = found.column("w").to_numpy()
    return n_docs, n_terms, out


def impacts(counts: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Of each term count in a document of ``n`` terms; less than ``MOST_IMPACT``."""
    m = 100 - 50 + 50 * n * n_docs // n_terms
    return 1_000_000_000 * counts // (1000 * counts + 20 * m)


# ----- tiles -------------------------------------------------------------------------------------------------------------------
class Tile:
    """Some items over their own vocabulary, cut into stretches of terms with their weights as matrices."""

    def __init__(self, first: int, held: list[np.ndarray], weight: np.ndarray, terms: int):
        self.first, self.size = first, len(held)
        vocabulary = np.unique(np.concatenate([*held, np.zeros(0, np.int64)])).astype(np.int64)
        vocabulary = vocabulary[weight[vocabulary] > 0]  # the rest adds nothing
        heaviest = int(weight[vocabulary].max()) if len(vocabulary) else 1
        step = max(1, min(terms, (EXACT - 1) // (heaviest * MOST_IMPACT)))
        self.parts = []
        for at in range(0, len(vocabulary), step):
            own = vocabulary[at : at + step]
            matrix = np.zeros((self.size, len(own)))
            for i, item in enumerate(held):
                present = np.isin(own, item, assume_unique=True)
                matrix[i, present] = weight[own[present]]
            self.parts.append((own, matrix))


class Lists:
    """The best documents so far of some items, ties in order of identifier."""

    def __init__(self, size: int, top: int):
        self.top = top
        self.scores = np.zeros((size, top), np.int64)
        self.ids = np.zeros((size, top), np.int64)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some documents (columns) for the items from ``first`` on."""
        last = np.maximum(self.scores[first : first + len(scores), -1:], 1)
        enough = scores >= last
        for i in np.flatnonzero(enough.any(axis=1)):
            row, new = first + i, enough[i]
            old = self.scores[row] > 0
            s = np.concatenate([self.scores[row][old], scores[i][new]])
            d = np.concatenate([self.ids[row][old], ids[new]])
            best = np.lexsort((d, -s))[: self.top]
            self.scores[row, : len(best)], self.ids[row, : len(best)] = s[best], d[best]


def best_of_tasks(documents: DataFrame, keys: np.ndarray, held: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """``ik``, ``did`` and ``score``: of each task, each item's best documents."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = [Tile(at, held[at : at + ITEMS], weight, TERMS) for at in range(0, len(held), ITEMS)]
        lists, local = Lists(len(held), top), np.full(len(weight), -1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS):
                block = batch.slice(at, DOCUMENTS)
                ids, n = block.column(0).to_numpy(), block.column(1).to_numpy()
                terms = block.column(2).flatten().to_numpy()
                sizes = pc.list_value_length(block.column(2)).to_numpy()
                where = np.repeat(np.arange(len(ids)), sizes)
                impact = impacts(block.column(3).flatten().to_numpy().astype(np.int64), n[where], n_docs, n_terms)
                for tile in tiles:
                    total = np.zeros((tile.size, len(ids)), np.int64)
                    for own, matrix in tile.parts:
                        local[own] = np.arange(len(own))
                        place = local[terms]
                        local[own] = -1
                        here = place >= 0
                        dense = np.zeros((len(own), len(ids)))
                        dense[place[here], where[here]] = impact[here]
                        total += (matrix @ dense).astype(np.int64)
                    lists.add(tile.first, total, ids)
        item, place = np.nonzero(lists.scores)
        columns = [keys[item], lists.ids[item, place], lists.scores[item, place]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["ik", "did", "score"])

    return documents.mapInArrow(score, "ik long, did long, score long")


# ----- search ---------------------------------------------------------------------------------------------------------------------
def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each item's ``top`` documents with a score above 0."""
    grouped, n_groups = grouped_items(items, group_bytes)
    found = grouped.select("ik", F.lit(0).cast("long").alias("did"), F.lit(0).cast("long").alias("score")).limit(0)
    for group in range(n_groups):
        held = grouped.where(F.col("group") == group).select("ik", "text").toArrow()
        texts = held.column("text").cast(pa.string()).combine_chunks()
        vocabulary, terms = _vocabulary(texts)
        documents = counted(docs, vocabulary)
        n_docs, n_terms, weight = weights(documents, len(vocabulary))
        best = best_of_tasks(documents, held.column("ik").to_numpy(), terms, weight, n_docs, n_terms, top)
        found = found.unionByName(durable(best))
    order = Window.partitionBy("ik").orderBy(F.col("score").desc(), "did")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = ranked.join(grouped.select("ik", "item_id"), "ik")
    return named.select("item_id", F.col("rank").cast("int").alias("rank"), given_id("did").alias("doc_id"), "score")
