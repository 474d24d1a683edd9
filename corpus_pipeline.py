"""From raw documents to packed training sequences, in five stages.

Each stage takes and returns a DataFrame and is written as a table before the next one reads it. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rivertally.llm import line_dedup, mixing, packing, quality_rules, simhash
from rivertally.session import configure, durable

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Documents of the mix that are laid along the packing curve together; the sequences follow the mix from one such stretch to the next.
STRETCH = 256


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    configure(spark)
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that resemble an earlier one."""
    configure(spark)
    return line_dedup.line_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    configure(spark)
    return simhash.simhash_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix; what one source holds beyond its weight beside the others comes last."""
    configure(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, which follow the order of the mix."""
    configure(spark)
    return packing.pack(docs, VOCABULARY, stretch=STRETCH)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-duplicates", near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL has no XXH64, Hilbert key or vocabulary; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
