"""Columns of the caller that are named like inner ones, null and empty values,
repeated rows, long texts and empty tables, in the operators on documents."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoframe.llm import line_dedup, ngram_join, packing, quality, suffix_dedup, token_files
from geoframe.llm.common import put_back, set_aside
from tests.llm.conftest import DOCS

INNER = ["_l_id", "_l_of", "_L_Places_", "_s_row", "_s_found", "_s_size", "_n_id", "_n_of", "_q_words", "_Q_text",
         "_q_lang", "_q_one", "q_more", "given__l_id", "a b", "row", "key", "id", "of", "seq"]


def text(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def hard(spark, frame):
    """Documents with columns of inner names; null and empty texts, ids and languages,
    rows that repeat, a text of 1 MB without a blank."""
    rng = random.Random(5)
    line = "a line of some length that is in many texts"
    copy = "\n".join(text(rng, 9) for _ in range(12))
    texts = [(1, copy), (2, copy), (2, copy), (3, copy.replace("a", "e", 3)), (4, None), (5, ""), (None, copy),
             (6, line + "\n" + text(rng, 90)), (7, text(rng, 50) + "\n" + line), (8, "x" * 1_000_000), (9, " \n\t"),
             (10, copy)]
    rows = [(i, t, [None, "", "en"][k % 3], "s", None if t is None else len(t)) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    return docs, docs.select("*", *[F.lit(f"mine {c}").alias(c) for c in INNER])


def rows_of(df, columns):
    return sorted(map(repr, df.select(*[f"`{c}`" for c in columns]).collect()))


OPERATORS = {
    "lines": lambda d: line_dedup.dedup_lines(d).drop("_l_places"),
    "stretches": lambda d: suffix_dedup.dedup_stretches(d).withColumn("text", F.col("_s_text"))
    .drop("_s_bytes", "_s_spans", "_s_kept", "_s_text"),
    "join": ngram_join.keep_one,
    "good": quality.keep_good,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_named_like_inner_ones(hard, name):
    plain, docs = hard
    done = OPERATORS[name](docs)
    assert done.columns == docs.columns
    assert rows_of(done, plain.columns) == rows_of(OPERATORS[name](plain), plain.columns)
    for r in done.collect():
        assert [r[c] for c in INNER] == [f"mine {c}" for c in INNER]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(hard, name):
    assert OPERATORS[name](hard[1].limit(0)).count() == 0


def test_added_columns_take_the_place_of_given_ones(hard):
    plain, _ = hard
    same = plain.withColumn("_S_bytes", F.lit("mine")).withColumn("q_kept", F.lit("mine")) \
        .withColumn("_l_places", F.lit("mine"))
    assert dict(suffix_dedup.dedup_stretches(same).dtypes)["_s_bytes"] == "bigint"
    measured = quality.measure(same)
    assert dict(measured.dtypes)["q_kept"] == "boolean" and measured.columns.count("q_kept") == 1
    assert set(quality.keep_good(same).select("q_kept").distinct().toPandas()["q_kept"]) <= {"mine"}
    assert dict(line_dedup.dedup_lines(same).dtypes)["_l_places"] == "array<int>"


def test_columns_of_operators_that_have_inner_names(spark, hard):
    """The id and the text themselves may be named so."""
    plain, _ = hard
    renamed = plain.withColumnRenamed("doc_id", "_l_id").withColumnRenamed("text", "_l_text")
    got = line_dedup.dedup_lines(renamed, "_l_id", "_l_text")
    assert rows_of(got, ["_l_id", "_l_text"]) == [
        r.replace("doc_id=", "_l_id=").replace("text=", "_l_text=")
        for r in rows_of(line_dedup.dedup_lines(plain), ["doc_id", "text"])]


def test_null_and_empty_languages_are_two(spark):
    rng = random.Random(6)
    rows = [(i, text(rng, 400).upper() if lang is None else text(rng, 400), lang, "s", 1)
            for i, lang in enumerate([None] * 8 + [""] * 8)]
    docs = spark.createDataFrame(rows, DOCS)
    refs = {r["lang"]: r for r in quality.references(docs).collect()}
    assert set(refs) == {None, ""} and all(r["words"] for r in refs.values())
    assert refs[None]["class_share"][0] == 0.0 < refs[""]["class_share"][0]
    found = quality.measure(docs).collect()
    assert len(found) == 16 and all(r["q_class_divergence"] < 0.01 for r in found)


def test_long_texts_and_repeated_rows_in_tokens(spark, hard, byte_path, word_path, tmp_path):
    from geoframe.llm.common import scratch
    docs = hard[1]
    pieces = packing.pack(docs, byte_path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    copies = {r["doc_id"]: r["n"] for r in docs.groupBy("doc_id").count().withColumnRenamed("count", "n").collect()}
    assert {r["doc_id"] for r in pieces} == set(copies)
    assert next(r["n"] for r in pieces if r["doc_id"] == 2) == 2 * next(r["n"] for r in pieces if r["doc_id"] == 1)
    folder = scratch(spark, "test-cases")
    read = token_files.read_tokens(token_files.write_tokens(docs, word_path, folder, shard_ids=2_000), folder).collect()
    assert len(read) == docs.count() and sum(r["doc_id"] is None for r in read) == 1


def test_set_aside(spark):
    df = spark.range(1).select(F.lit(1).alias("_X_a"), F.lit(2).alias("given__X_a"), F.lit(3).alias("b"))
    held, names = set_aside(df, "_x_")
    assert held.columns == ["given_given__X_a", "given__X_a", "b"]
    assert put_back(held.withColumn("_x_a", F.lit(9)), names).first().asDict() == {"_X_a": 1, "given__X_a": 2, "b": 3}
    assert put_back(held.withColumn("_x_a", F.lit(9)), names, "_x_a").columns == ["given__X_a", "b", "_x_a"]
    assert isinstance(DOCS, T.StructType)
