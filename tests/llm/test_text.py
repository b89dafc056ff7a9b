"""Quality rules, chat formatting, toxicity and the suffix merge, by brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoframe.llm import REGISTRY, SQL, chat, merge_sort, quality, suffix_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = [False] * len(words)
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            hit[i:i + 5] = [True] * 5
    n = sum(hit)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            n, len(words) < 10 or 100 * n > 20 * len(words))


def test_base_rules(frame, documents):
    odd = [None, "", " \t\n", "a b c d", "a b c d e", "a b c d e a b c d e", "x " * 3000, " é #|<\n\n#|<\n",
           "one\x0btwo\x0cthree\rfour", "l\nl\nl\n"]
    given = documents + [(1000 + i, t) for i, t in enumerate(odd)]
    df = frame(given).withColumn("q_n_words", F.lit("clash"))
    got = {r["doc_id"]: r for r in quality.measure(df).collect()}
    for i, text in given:
        r = got[i]
        assert (r["q_n_words"], r["q_word_chars"], r["q_n_symbols"], r["q_n_dup_lines"], r["q_n_repeat_words"],
                r["q_base_failed"]) == base_rules(text), i
        assert not (r["q_base_failed"] and r["q_kept"])
    assert quality.measure(frame([])).count() == 0


def test_quality_against_labels(spark):
    """Junk goes, clean documents stay."""
    d = "/root/testdata/sf0.01"
    found = REGISTRY["op10_quality_divergence"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    rows = {r["quality"]: (r["n"], r["k"]) for r in found.where("NOT base_failed").groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).collect()}
    assert rows[1][1] >= 0.99 * rows[1][0] and rows[0][1] <= 0.2 * rows[0][0]


def test_quality_keeps_columns_and_needs_no_python(spark, frame, documents):
    df = frame(documents)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and 0 < kept.count() < len(documents)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_divergence(p, q):
    def half(a, b):
        return sum(0.5 * x * np.log2(2 * x / (x + y)) for x, y in zip(a, b) if x > 0)
    return half(p, q) + half(q, p)


def test_divergence(spark):
    rows = [([0.5, 0.5, 0.0], [0.2, 0.3, 0.5]), ([1.0, 0.0], [0.0, 1.0]), ([0.3, 0.7], [0.3, 0.7])]
    df = spark.createDataFrame(rows, "p array<double>, q array<double>")
    got = df.select("p", "q", quality._divergence(F.col("p"), F.col("q")).alias("d")).collect()
    for r in got:
        assert r["d"] == pytest.approx(brute_divergence(r["p"], r["q"]), abs=1e-12)


# --------------------------------------------------------------- chats

def turns_frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>user\nhi", "%3C|im_end|>", "100% <|", "<", "|im_start|>", "", None, "\n\n"]
    rows = [(i, k, role, text) for i, text in enumerate(nasty) for k, role in enumerate(("user", "assistant"))]
    rows += [(50, 0, "as%sis\n<|im_end|>", "x"), (50, 1, None, "y"), (51, None, "user", "a"), (51, 1, "user", "b"),
             (51, 1, "user", "b")]
    parsed = chat.parse_chats(chat.format_chats(turns_frame(spark, rows)))
    got = {r["conv_id"]: r for r in parsed.collect()}
    for c in {r[0] for r in rows}:
        want = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [(r[2] or "", r[3] or "") for r in want]
        assert got[c]["formatted"] == "".join(s["text"] for s in got[c]["segments"])
        learned = [s["text"] for s in got[c]["segments"] if s["loss"]]
        assert len(learned) == sum(r[2] == "assistant" for r in want)


@pytest.mark.parametrize("roles,bad", [
    (["user", "assistant"], None), (["system", "user", "assistant"], None), (["assistant"], 0),
    (["user", "user", "assistant"], 1), (["user", "assistant", "system"], 2), (["user"], 1),
    (["user", "assistant", "tool", "tool", "assistant"], None), (["user", "assistant", "user"], 3)])
def test_machine(spark, roles, bad):
    rows = [(1, i, r, "t") for i, r in enumerate(roles)]
    r = chat.format_chats(turns_frame(spark, rows)).first()
    assert r["first_bad_turn"] == bad and r["valid"] == (bad is None)


def test_no_chats(spark):
    assert chat.parse_chats(chat.format_chats(turns_frame(spark, []))).count() == 0


# ------------------------------------------------------------- toxicity

def test_non_negative_learning_finds_the_telling_words():
    rng = random.Random(2)
    feats = toxicity.Features()

    def text(bad):
        words = [f"w{rng.randint(0, 400)}" for _ in range(60)] + (["vile"] if bad else [])
        return feats(" ".join(words))
    positive = [text(True) for _ in range(150)]
    unlabelled = [text(i % 10 == 0) for i in range(900)]
    w, b = toxicity.train(positive, unlabelled, 0.1)
    scores = [(bad, b + float(w[x].sum())) for bad in (False, True) for x in (text(bad) for _ in range(200))]
    assert sum((s > 0) == bad for bad, s in scores) > 380
    again = toxicity.train(positive, unlabelled, 0.1)
    assert (again[0] == w).all() and again[1] == b


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    rows = (REGISTRY["op4_toxicity_nnpu"](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
            .where("held_out").select("doc_id", "score", "predicted", "toxic").collect())
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    good = sorted(r["score"] for r in rows if r["toxic"] == 0)
    bad = [r["score"] for r in rows if r["toxic"] == 1]
    area = sum(np.searchsorted(good, s) for s in bad) / (len(good) * len(bad))
    assert area > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_toxicity_without_labels(spark, frame):
    docs = frame([None, "", "some text"]).withColumn("score", F.lit(3))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert len(got) == 3 and all(r["score"] < 1e-9 for r in got)


# ------------------------------------------------------- suffixes, SQL

@pytest.mark.parametrize("seed", range(8))
def test_loser_tree(seed):
    rng = random.Random(seed)
    runs = []
    for _ in range(rng.randint(0, 9)):
        run = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 30)))
        coded = list(merge_sort.front_code(run, 3))
        assert [s for _, s in merge_sort.front_decode(coded)] == run
        runs.append([(n, s, None) for n, s in merge_sort.front_decode(coded)])
    out = list(merge_sort.merge(runs))
    assert [s for _, s, _ in out] == sorted(s for r in runs for _, s, _ in r)
    before = b""
    for n, s, _ in out:
        assert n == merge_sort.common_prefix(before, s)
        before = s


def test_comparisons_skip_known_prefixes(monkeypatch):
    starts = []
    real = merge_sort.common_prefix
    monkeypatch.setattr(merge_sort, "common_prefix", lambda a, b, start=0: starts.append(start) or real(a, b, start))
    runs = [[(0 if i == 0 else 99, b"p" * 100 + bytes([i, k]), None) for i in range(50)] for k in range(4)]
    assert len(list(merge_sort.merge(runs))) == 200
    assert sum(s >= 99 for s in starts) > 0.9 * len(starts)


def test_cut():
    assert suffix_dedup.stays(b"0123456789", [(2, 4), (4, 6), (8, 9)]) == ([b"01", b"67", b"9"], 2)
    assert suffix_dedup.stays(b"0123", [(0, 4), (1, 2)]) == ([b"", b""], 1)


@pytest.mark.parametrize("key", sorted(SQL))
def test_against_sql(spark, key):
    from tests.oracle import compare_frames, duck, type_mismatches
    d = "/root/testdata/sf0.01"
    found, rel = REGISTRY[key](spark, d), duck(d).sql(SQL[key])
    assert not type_mismatches(found.schema, rel)
    ok, message = compare_frames(found.toPandas(), rel.df())
    assert ok, message
