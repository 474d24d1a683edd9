"""Quality rules: a threshold table compiled into one projection.

Every rule names a measure and the range it must lie in. ``verdict`` turns the whole table into one column,
so that a new rule is a row of the table and no further pass over the text.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivertally.llm.common import WORD, total, words_of

# The most frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on are or this from at not have which "
    "de la le et les des en un du une que est pour qui dans sur pas au par "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "el y los se del las por con una su para al lo como"
).split()

SYMBOLS = "[#*$%&|<>]"


class Rule(NamedTuple):
    name: str
    measure: str
    least: float | None
    most: float | None


#: Ranges that prose keeps to. Bounds are included.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 20.0),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "stop_word_share", 0.02, None),
    Rule("repeated_lines", "repeated_line_share", None, 0.5),
)

#: Documents below the first bound or above the second fail whatever the table says.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

MEASURE = "__quality"


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with one more column, a struct named ``__quality`` of counts over the whole text.

    Every count is worked out inside the row, so there is no shuffle. Three-word windows are compared by a
    64-bit hash within one text: texts of a million words err with a chance below one in ten million.
    A missing or empty text has no words, no symbols and no lines.
    """
    columns = [docs[c] for c in docs.columns]
    text = F.coalesce(docs["text"], F.lit(""))
    # One projection per step: each reads the arrays that the step before it made, and makes them once.
    first = docs.select(
        *columns,
        words_of(text).alias("__words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("__lines"),
        F.size(F.regexp_extract_all(text, F.lit(SYMBOLS), F.lit(0))).cast("long").alias("__symbols"),
    )
    kept = [F.col(f"`{c}`") for c in docs.columns]
    words = F.col("__words")
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    second = first.select(*kept, "__words", "__lines", "__symbols", windows.alias("__windows"))
    by_hash = F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    third = second.select(*kept, "__words", "__lines", "__symbols", by_hash.alias("__sorted"))
    hashes = F.col("__sorted")
    again = F.filter(
        hashes,
        lambda e, j: (e["h"] == F.get(hashes, j - 1)["h"]) | (e["h"] == F.get(hashes, j + 1)["h"]),
    )
    starts = F.sort_array(F.transform(again, lambda e: e["i"]))
    fourth = third.select(*kept, "__words", "__lines", "__symbols", F.coalesce(starts, F.array().cast("array<int>")).alias("__starts"))
    # Windows overlap: each one covers the words up to the next start, at most three.
    covered = F.transform(
        "__starts", lambda s, j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), s - F.get(F.col("__starts"), j - 1))).cast("long")
    )
    n_lines = F.size("__lines").cast("long")
    counts = F.struct(
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"),
        n_lines.alias("n_lines"),
        (n_lines - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        total(covered).alias("n_repeat_words"),
        F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    # A filter on the counts stays above them: pushed down, it would hold every array expression many times over.
    return fourth.select(*kept, F.when(F.spark_partition_id() >= 0, counts).alias(MEASURE))


def _measures() -> dict[str, Column]:
    m = F.col(MEASURE)
    return {
        "mean_word_chars": F.try_divide(m["word_chars"], m["n_words"]),
        "symbols_per_word": F.try_divide(m["n_symbols"], m["n_words"]),
        "stop_word_share": F.try_divide(m["n_stop_words"], m["n_words"]),
        "repeated_line_share": F.try_divide(m["n_dup_lines"], m["n_lines"]),
    }


def base_failed() -> Column:
    m = F.col(MEASURE)
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"])


def broken_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a document breaks, in table order. An undefined measure breaks none."""
    measures = _measures()

    def breaks(rule: Rule) -> Column:
        value, wrong = measures[rule.measure], F.lit(False)
        if rule.least is not None:
            wrong = wrong | (value < rule.least)
        if rule.most is not None:
            wrong = wrong | (value > rule.most)
        return F.when(wrong, F.lit(rule.name))

    return F.filter(F.array(*(breaks(r) for r in rules)), lambda x: x.isNotNull())


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs`` with its counts and verdict.

    ``kept`` is false where ``base_failed`` is true or a rule of the table is broken; ``broken`` lists those
    rules. Rows with a missing ``doc_id`` or text are judged as well (no text: base failed). Repeated rows
    are judged each by itself, and other columns of ``docs`` are not read.
    """
    m = F.col(MEASURE)
    return measured(docs.select("doc_id", "text")).select(
        "doc_id",
        *(m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines")),
        base_failed().alias("base_failed"),
        (~base_failed() & (F.size(broken_rules(rules)) == 0)).alias("kept"),
        F.concat_ws(",", broken_rules(rules)).alias("broken"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    passed = measured(docs).where(~base_failed() & (F.size(broken_rules(rules)) == 0))
    return passed.select(*(F.col(f"`{c}`") for c in docs.columns))
