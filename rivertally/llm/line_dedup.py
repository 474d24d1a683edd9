"""Removal of lines that resemble an earlier line: an exact set-similarity join over all lines.

A line is the set of its words. Sets are ordered by the words' rarity; two sets of Jaccard similarity t share a
word among the first ``n - ceil(t * n) + 1`` of each (prefix filter), and where and how long they are bounds what they
can share (positional and length filter). What passes is compared in full.

The join is laid out so that groups of copies cost rows in proportion to their size:

1. Equal sets meet under one hash, by an aggregate; all but the first are removed and take no further part.
2. Sets with the same smallest or largest few word hashes, which similar sets mostly have, are compared with the first such set. Lines
   that this settles look for no further partner, so that the members of a group of near copies aren't paired with each other.
3. Lines still in question are paired with all sets that share a prefix word with them, if those are few.
4. Under every other prefix word each of them is compared with the first line that has it, and only lines that
   are in question even then are paired with the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivertally.llm.common import WORD, given_id
from rivertally.llm.order import row_keys
from rivertally.session import durable

#: Jaccard similarity from which a line is removed, as a fraction.
SHARED, OF = 4, 5
#: Words are counted in so many buckets by hash (a power of two): the table of their frequencies is 8 bytes for each, whatever the
#: texts hold. Words of one bucket count as equally rare, and go by hash.
BUCKETS = 1 << 18
#: So many of the smallest word hashes of a set stand for it when the first of a group of near copies is looked for, and so many of the largest.
ENDS = 3
#: Lines under one word up to which all pairs are compared at once.
SMALL_GROUP = 1024


def _cut(text: Column) -> Column:
    """Words of a text, with empty ones where blanks follow each other."""
    for blank in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.split(text, " ")


def word_hashes(line: Column) -> Column:
    """Hashes of the distinct words of a line."""
    return F.array_distinct(F.transform(F.array_remove(_cut(line), ""), lambda w: F.xxhash64(w)))


def set_lines(rows: DataFrame) -> DataFrame:
    """``rk``, ``no`` and word hashes ``t`` of every line that has words."""
    lines = rows.select("rk", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return lines.where(F.col("line").rlike(WORD)).select("rk", "no", word_hashes(F.col("line")).alias("t"))


def word_levels(rows: DataFrame) -> DataFrame:
    """One row: for each bucket of word hashes, the high bits of the sort key of its words, more for frequent ones.

    All words of all texts are counted. Levels are half powers of two.
    """
    words = rows.select(F.explode(_cut(F.col("text"))).alias("word")).where("word != ''")
    counted = words.groupBy(F.expr(f"xxhash64(word) & {BUCKETS - 1}L").alias("bucket")).count()
    level = F.shiftleft(F.least(F.lit(63), 1 + F.floor(2 * F.log2("count"))).cast("long"), 57)
    every = rows.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket")).join(counted.select("bucket", level.alias("level")), "bucket", "left")
    ordered = every.agg(F.sort_array(F.collect_list(F.struct("bucket", F.coalesce("level", F.lit(0).cast("long")).alias("level")))).alias("all"))
    return ordered.select(F.col("all.level").alias("levels"))


def line_sets(rows: DataFrame, levels: DataFrame) -> DataFrame:
    """``rk``, ``no``, size ``n``, two hashes ``h`` and ``h2`` of the set, hashes of its ``ENDS`` ``least`` and ``most`` word hashes (of all, if it has fewer), 128 bits ``low`` and ``high`` and its ``prefix``, rarest words first, for every line that has words.

    Each word turns one of the bits, so two sets differ in at least as many words as their bits differ in.
    """
    by_hash = F.sort_array("t")
    ends = [F.xxhash64(F.slice(by_hash, start, ENDS)).alias(name) for name, start in (("least", F.lit(1)), ("most", F.greatest(F.size("t") - ENDS + 1, F.lit(1))))]
    ordered = (
        # The levels come in behind the step that uses the words several times: they stay a value then, and don't become a column.
        set_lines(rows)
        .select("rk", "no", *ends, "t")
        .withColumn("levels", levels.scalar())
        # That no level is null is said, as Spark then sorts plain longs.
        .select("rk", "no", "least", "most", F.expr(f"sort_array(transform(t, h -> coalesce(get(levels, cast(h & {BUCKETS - 1}L as int)), 0L) | shiftrightunsigned(h, 7)))").alias("keys"))
    )
    both, high = (F.expr(f"aggregate(keys, 0L, (a, k) -> a ^ shiftleft({bit}, cast(k & 63 as int)))") for bit in ("1L", "shiftright(k, 6) & 1L"))
    n = F.size("keys")
    length = n - F.ceil(n * SHARED / OF).cast("int") + 1
    hashes = [F.xxhash64("keys").alias("h"), F.xxhash64("keys", F.lit(1)).alias("h2")]
    return ordered.select("rk", "no", n.alias("n"), *hashes, "least", "most", both.bitwiseXOR(high).alias("low"), high.alias("high"), F.slice("keys", F.lit(1), length).alias("prefix"))


def _alike() -> Column:
    """Length filter and the bits for two sets (``n``, ``low``, ``high``, and the same with 2)."""
    n, n2 = F.col("n"), F.col("n2")
    apart = F.bit_count(F.col("low").bitwiseXOR(F.col("low2"))) + F.bit_count(F.col("high").bitwiseXOR(F.col("high2")))
    return (OF * F.least(n, n2) >= SHARED * F.greatest(n, n2)) & ((SHARED + OF) * apart <= (OF - SHARED) * (n + n2))


def _shares_enough() -> Column:
    """Positional filter for two sets that share the word at ``pos`` and ``pos2``."""
    return (SHARED + OF) * F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2")) >= SHARED * (F.col("n") + F.col("n2"))


def _before() -> Column:
    return (F.col("rk2") < F.col("rk")) | ((F.col("rk2") == F.col("rk")) & (F.col("no2") < F.col("no")))


def _pairs(x: DataFrame, y: DataFrame) -> DataFrame:
    """``rk``, ``no`` of lines of ``x`` with ``open`` set and ``rk2``, ``no2`` of earlier lines of ``y`` that share a prefix word and pass the filters."""
    z = y.select("key", *(F.col(c).alias(f"{c}2") for c in ("rk", "no", "n", "pos", "low", "high", "open")))
    # Said with a column of each side (``open`` is 0 or 1), so that it isn't moved below the shuffle that both may read.
    asks = (F.col("open") > 0) | (F.col("open2") < 0)
    return x.join(z, "key").where(asks & _before() & _alike() & _shares_enough()).select("rk", "no", "rk2", "no2")


def _near_firsts(sets: DataFrame) -> DataFrame:
    """``rk``, ``no`` of lines of ``sets`` and ``rk2``, ``no2`` of the first line with the same least or most word hashes, where the two pass the filters.

    There are two pairs for each line at most.
    """
    own = ["rk", "no", "n", "low", "high"]
    each = sets.select(*own, F.posexplode(F.array("least", "most")).alias("end", "word"))
    first = each.groupBy("end", "word").agg(F.min(F.struct(*own)).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    z = first.select("end", "word", *(F.col(f"first.{c}").alias(f"{c}2") for c in own))
    return each.join(z, ["end", "word"]).where(_before() & _alike()).select("rk", "no", "rk2", "no2").distinct()


def _verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rk``, ``no`` of the lines of ``pairs`` (``rk``, ``no``, ``rk2``, ``no2``) that are as similar as asked for to their partner."""
    wanted = pairs.select("rk", "no").union(pairs.select("rk2", "no2")).groupBy("rk").agg(F.collect_set("no").alias("wanted"))
    fetched = rows.join(wanted, "rk").select("rk", F.explode("wanted").alias("no"), F.split("text", "\n").alias("lines"))
    words = durable(fetched.select("rk", "no", word_hashes(F.get("lines", F.col("no"))).alias("t")))
    other = words.select(F.col("rk").alias("rk2"), F.col("no").alias("no2"), F.col("t").alias("t2"))
    shared = F.size(F.array_intersect("t", "t2"))
    enough = (SHARED + OF) * shared >= SHARED * (F.size("t") + F.size("t2"))
    return pairs.join(words, ["rk", "no"]).join(other, ["rk2", "no2"]).where(enough).select("rk", "no").distinct()


def repeated_lines(rows: DataFrame) -> DataFrame:
    """``rk``, ``no`` (from 0) of every line for which some earlier line has the similarity asked for.

    ``rows`` has ``rk`` and ``text``. Lines are judged on the input; earlier means a smaller ``rk``, or the same and a
    smaller ``no``. Lines without words match nothing.
    """
    sets = durable(line_sets(rows, durable(word_levels(rows))))
    repeated = durable(sets.groupBy("h", "h2").agg(F.min(F.struct("rk", "no")).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times"))
    marked = sets.join(repeated, ["h", "h2"], "left").withColumn("copy", F.coalesce(F.col("first") != F.struct("rk", "no"), F.lit(False)))
    copies = durable(marked.where("copy").select("rk", "no"))
    # From here on every set is there once, as its first line; sets of fewer than nine words together are as similar as asked for
    # only if they are equal.
    kept = ["rk", "no", "n", "low", "high"]
    firsts = durable(marked.where(f"not copy and n > {SHARED - 1}").select(*kept, "least", "most", "prefix"))
    near_first = durable(_verified(durable(_near_firsts(firsts)), rows))
    asking = firsts.join(near_first.withColumn("open", F.lit(0)), ["rk", "no"], "left").withColumn("open", F.coalesce("open", F.lit(1)))
    # That no column is null is said for the sake of the plan: neither use of the prefix rows then adds a filter of its own.
    for column in kept:
        asking = asking.where(F.col(column).isNotNull())
    prefix = asking.select(*kept, "open", F.posexplode("prefix").alias("pos", "key")).where("key is not null")
    many = durable(firsts.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(f"members > {SMALL_GROUP}").select("key"))
    # Dealt before the two sides' columns are named apart, and each with all columns: so they are one shuffle.
    small = prefix.join(many, "key", "left_anti").repartition("key")
    pairs = durable(_pairs(small, small))
    large = durable(prefix.join(many, "key").select("key", *kept, "open", "pos"))
    first = large.groupBy("key").agg(F.min(F.struct(*kept, "open", "pos")).alias("first")).select("key", "first.*")
    near = durable(pairs.union(_pairs(large, first)).distinct())
    settled = durable(_verified(near, rows))
    in_question = durable(large.where("open > 0").join(settled, ["rk", "no"], "left_anti"))
    still_open = durable(_pairs(in_question, large).distinct().join(near, ["rk", "no", "rk2", "no2"], "left_anti"))
    return copies.union(near_first).union(settled).union(_verified(still_open, rows)).distinct()


def without_repeated_lines(rows: DataFrame) -> DataFrame:
    """``rk``, ``text`` without its repeated lines, ``n_lines`` and ``n_removed`` of every row of ``rows``."""
    gone = repeated_lines(rows.select("rk", "text")).groupBy("rk").agg(F.collect_list("no").alias("gone"))
    lines = F.split("text", "\n")
    # The numbers are put where they belong, so that no line is looked up in a list.
    marked = rows.join(gone, "rk", "left").select("*", F.sort_array(F.coalesce("gone", F.array().cast("array<int>"))).alias("__gone"), lines.alias("__lines"))
    ends = F.concat(F.array(F.lit(-1)), F.col("__gone"), F.array(F.size("__lines")))
    runs = F.transform(ends, lambda e, i: F.when(i > 0, F.slice("__lines", F.get(ends, i - 1) + 2, F.greatest(e - F.get(ends, i - 1) - 1, F.lit(0)))).otherwise(F.array().cast("array<string>")))
    kept = marked.select("*", F.when(F.size("__gone") == 0, F.col("text")).otherwise(F.array_join(F.flatten(runs), "\n")).alias("__kept"))
    n_lines = F.when(F.col("text") == "", F.lit(0)).otherwise(F.size("__lines")).cast("long")
    return kept.select(*[c for c in rows.columns if c != "text"], F.col("__kept").alias("text"), n_lines.alias("n_lines"), F.size("__gone").cast("long").alias("n_removed"))


def line_dedup_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed`` and ``kept_sha256`` (of the text that stays) of every row of ``docs``.

    A missing or empty text has no lines. A missing ``doc_id`` comes before all others; rows of one identifier are
    told apart by their text, and rows that repeat both are one document, returned as often as it comes.
    """
    rows = row_keys(docs).withColumn("text", F.col("text").cast("string"))
    return without_repeated_lines(rows).select(given_id("did").alias("doc_id"), "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with repeated lines taken out of ``text`` (and ``n_chars`` set to what is left, if there is one).

    No row goes: a text all of whose lines are repeated becomes empty. Texts without a repeated line stay as they are, missing
    ones included.
    """
    rows = row_keys(docs, carry=True).withColumn("text", F.col("text").cast("string"))
    cut = without_repeated_lines(rows)
    new = {"text": F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        left = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") > 0, left).otherwise(F.col("row.n_chars"))
    return cut.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
