"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed and
# carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"

#: Stands for a missing identifier inside joins and orders; it sorts before every other one.
NO_ID = -(2**63)


def words_of(text: Column) -> Column:
    """All words of a text, in order; none for a missing text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def known_id(column: Column | str) -> Column:
    """The identifier as a long that is never null, so that plain equality joins keep missing ones."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("long"), F.lit(NO_ID))


def given_id(column: Column | str) -> Column:
    """The reverse of ``known_id``."""
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(NO_ID))


def text_rows(docs: DataFrame) -> DataFrame:
    """``did`` (see ``known_id``) and ``text`` (empty where missing), whatever else the table holds."""
    return docs.select(known_id("doc_id").alias("did"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def total(values: Column, of=lambda x: x) -> Column:
    """Sum of an array of longs, 0 if it is empty."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + of(x))
