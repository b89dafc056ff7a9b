"""Operators for training-data pipelines, and the queries that apply them."""

from geoframe.llm import (bpe, chat, hard_negatives, line_dedup, ngram_join, packing,  # noqa: F401
                          phrases, quality, suffix_dedup, token_files, topk_search, toxicity,
                          vectors)
from geoframe.llm.common import REGISTRY, SQL


def queries():
    """Name -> function(spark, sf_dir) of every operator's query."""
    return dict(REGISTRY)


def oracle_sql():
    """Name -> DuckDB SQL, for the queries that SQL can express."""
    return dict(SQL)
