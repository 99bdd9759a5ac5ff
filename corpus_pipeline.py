"""The training-data pipeline: quality rules to token files over the documents table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sectorgauge.llm import queries
from sectorgauge.llm.common import read_table
from sectorgauge.sources.stages import stage

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", queries.keep_good_documents),
    ("ngram_jaccard_join", queries.keep_one_of_each_group),
    ("benchmark_decontamination", queries.drop_benchmark_documents),
    ("source_mixing", queries.mix_documents),
    ("token_files", queries.tokenize_documents),
]

#: Neither the fitted rules nor the tokenizer can be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what its predecessor stored."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
