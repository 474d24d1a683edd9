"""The registered queries of this subpackage and the SQL that they are checked with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from rivertally.llm import checking_sql, collocations, embeddings, licenses, line_dedup, mixing, packing, perplexity, quality_rules, ranked_search, simhash, substrings, token_counts, warc
from rivertally.session import configure

#: The vocabulary that the queries use; the operators take its path.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, table: str, operator: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    """Register ``operator`` over the whole of ``table`` in the folder that the query gets."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return operator(configure(spark).read.parquet(f"{folder}/{table}.parquet"))

    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    read = configure(spark).read
    return perplexity.quality_classifier(read.parquet(f"{folder}/documents.parquet"), read.parquet(f"{folder}/labels.parquet"))


def ranked(spark: SparkSession, folder: str) -> DataFrame:
    read = configure(spark).read
    return ranked_search.ranked_search(read.parquet(f"{folder}/documents.parquet"), read.parquet(f"{folder}/benchmark.parquet"))


register("op1_embedding_dedup", "embeddings", embeddings.embedding_groups)
register("op2_license_scan", "documents", licenses.licence_scan, checking_sql.LICENCE_SCAN)
QUERIES["op3_quality_classifier"] = quality_classifier
register("op4_token_counts", "documents", lambda docs: token_counts.token_counts(docs, VOCABULARY))
register("op5_packing", "documents", lambda docs: packing.pack(docs, VOCABULARY))
register("op6_quality_rules", "documents", quality_rules.quality_rules, checking_sql.QUALITY_RULES)
register("op7_simhash_dedup", "documents", simhash.simhash_report)
register("op8_line_dedup", "documents", line_dedup.line_dedup_report)
register("op9_substring_dedup", "documents", substrings.substring_report)
register("op10_mixing", "documents", mixing.mixing_report)
register("op11_collocations", "documents", collocations.collocations, checking_sql.COLLOCATIONS)
QUERIES["op12_ranked_search"] = ranked
ORACLES["op12_ranked_search"] = checking_sql.RANKED_SEARCH
register("op13_warc", "pages", warc.warc_report, checking_sql.WARC)
QUERIES["pipeline"] = corpus_pipeline.run
