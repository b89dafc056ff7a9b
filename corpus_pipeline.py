"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join,
suffix-array dedup, packing.  Every stage takes (spark, docs, sf_dir); what it
returns is written as Parquet and read again as the next one's ``docs``.  Columns
beside those of ``documents`` go through all stages but the last, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm import line_dedup, ngram_join, packing, quality, suffix_dedup
from geoframe.llm.common import materialise, put_back, set_aside, table

PASSAGE = 51              # words of a repeated passage that goes


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def _with_text(docs: DataFrame, given: DataFrame) -> DataFrame:
    """The given columns, ``n_chars`` (if there) as the text now has it."""
    if "n_chars" in docs.columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(given.schema["n_chars"].dataType))
    return docs.select(*[f"`{c}`" for c in given.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing else is left."""
    docs, names = set_aside(docs, "_l_")
    done = line_dedup.dedup_lines(docs)
    empty = F.col("_l_places").isNotNull() & ~F.col("text").rlike(r"\S")
    return put_back(_with_text(done.where(~empty), docs), names)


def join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8) the first stays."""
    return ngram_join.keep_one(docs, n=5, percent=80)


def stretch_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of over 50 words (or 400 bytes) go, and documents of which
    nothing else is left.  Half a character at the end of a cut goes with it."""
    docs, names = set_aside(docs, "_s_")
    done = suffix_dedup.dedup_stretches(docs, length=2 * PASSAGE - 1, words=PASSAGE)
    done = done.withColumn("text", F.col("_s_text"))
    empty = (F.col("_s_spans") > 0) & ~F.col("text").rlike(r"\S")
    return put_back(_with_text(done.where(~empty), docs), names)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage), ("n-gram Jaccard join", join_stage),
          ("suffix-array dedup", stretch_stage), ("packing", packing_stage)]

#: Stages that work on bytes, tokens and near copies cannot be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        if i:
            docs = materialise(docs, "pipeline")
        docs = stage(spark, docs, sf_dir)
    return docs
