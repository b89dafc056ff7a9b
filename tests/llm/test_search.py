"""Exact top-k search, hard negatives and phrases against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("label", T.IntegerType()), T.StructField("cls", T.StringType()),
                        T.StructField("uid", T.StringType()), T.StructField("gf_part", T.IntegerType())])


@pytest.fixture(scope="module")
def vectors(spark):
    """(id, vector, label) -> a table with columns that clash with inner names."""
    from geoframe.session import ship_package
    ship_package(spark)
    return lambda rows: spark.createDataFrame([(*r, "c", "u", 1) for r in rows], VECTORS).repartition(3)


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def by_score(rows):
    """(score, id, ...) in order: null ids after all others."""
    return sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))


def brute_top(rows, step, k):
    rows = [(i, whole(v)) for i, v, *_ in rows]
    out = []
    for n, (i, v) in enumerate(rows):
        if v is None or i is None or i % step:
            continue
        found = by_score([(dot(v, w), j) for m, (j, w) in enumerate(rows)
                          if m != n and w is not None and len(w) == len(v)])[:k]
        out += [(i, r + 1, j, s) for r, (s, j) in enumerate(found)]
    return out


def brute_negatives(rows, step, positives=5, negatives=3, low=50, high=95):
    rows = [(i, whole(v), x) for i, v, x, *_ in rows if x is not None]
    out = []
    for n, (i, v, label) in enumerate(rows):
        if v is None or i is None or i % step:
            continue
        scored = by_score([(dot(v, w), j, x) for m, (j, w, x) in enumerate(rows)
                           if m != n and w is not None and len(w) == len(v)])
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and low * p <= 100 * s[0] <= high * p][:negatives]
            out += [(i, j, r + 1, s[1], p, s[0]) for r, s in enumerate(fits)]
    return out


def hard_rows(seed):
    """Random, near and equal vectors, nulls, other lengths, ties, equal ids."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(8)
    rows = [(i, (rng.standard_normal(8) / 3).tolist(), int(rng.integers(0, 3))) for i in range(150)]
    rows += [(200 + i, (centre + rng.standard_normal(8) / 50).tolist(), int(rng.integers(0, 3))) for i in range(60)]
    rows += [(300 + i, centre.tolist(), i % 2) for i in range(40)]              # copies
    rows += [(400 + i, [float(rng.integers(-1, 2)) for _ in range(8)], i % 3) for i in range(60)]   # ties
    rows += [(500, None, 1), (505, [], 1), (510, [], 2), (515, [1.0, None], 0), (520, [float("nan")] * 8, 0),
             (525, [float("inf")] * 8, 0), (530, [1.0, 2.0], 1), (535, [2.0, -1.0], None), (540, [0.0] * 8, 2),
             (545, [3.0], 0), (550, [2.0], 0), (555, [2.5], 1), (None, centre.tolist(), 1),
             (None, rng.standard_normal(8).tolist(), 0), (5, centre.tolist(), 0), (5, centre.tolist(), 0),
             (10, rng.standard_normal(8).tolist(), None), (15, [1e6] * 8, 1), (20, [-1e6] * 8, 2)]
    return rows


def rows_of(df, *names):
    return sorted([tuple(r[n] for n in names) for r in df.collect()], key=str)


@pytest.mark.parametrize("slices", [1, 2, 5, 11])
def test_top_k(vectors, slices):
    from geoframe.llm.topk_search import top_inner_products
    rows = hard_rows(slices)
    got = top_inner_products(vectors(rows), "vec_id", "embedding", F.col("vec_id") % 5 == 0, slices=slices)
    assert rows_of(got, "query_id", "rank", "id", "score") == sorted(brute_top(rows, 5, 5), key=str)


def test_top_k_in_several_blocks(vectors, monkeypatch):
    from geoframe.llm import int_vectors
    from geoframe.llm.topk_search import top_inner_products
    monkeypatch.setattr(int_vectors, "BLOCK_BYTES", 3000)
    rows = hard_rows(9)
    got = top_inner_products(vectors(rows), "vec_id", "embedding", F.col("vec_id") % 5 == 0, k=3)
    assert rows_of(got, "query_id", "rank", "id", "score") == sorted(brute_top(rows, 5, 3), key=str)


def test_large_components(vectors):
    from geoframe.llm.topk_search import top_inner_products
    rows = [(i, [float(2 ** 22 + 7 * i), float(2 ** 22 - i), -3.0], 0) for i in range(12)]
    got = top_inner_products(vectors(rows), "vec_id", "embedding", F.col("vec_id") % 5 == 0)
    assert rows_of(got, "query_id", "rank", "id", "score") == sorted(brute_top(rows, 5, 5), key=str)
    with pytest.raises(Exception, match="beyond 64 bits"):
        top_inner_products(vectors([(0, [1e18], 0), (1, [1e18], 0)]), "vec_id", "embedding",
                           F.col("vec_id") == 0).collect()


@pytest.mark.parametrize("tree", [20, 16_384])
def test_hard_negatives(vectors, tree):
    from geoframe.llm.hard_negatives import mine_negatives
    rows = hard_rows(tree)
    got = mine_negatives(vectors(rows), "vec_id", "embedding", F.col("label"), F.col("vec_id") % 5 == 0, tree=tree)
    assert rows_of(got, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") \
        == sorted(brute_negatives(rows, 5), key=str)


def test_empty_tables(vectors):
    from geoframe.llm.hard_negatives import mine_negatives
    from geoframe.llm.topk_search import top_inner_products
    for rows in ([], [(1, [1.0], 0)], [(0, [1.0], 0)]):
        df = vectors(rows)
        assert top_inner_products(df, "vec_id", "embedding", F.col("vec_id") == 0).collect() == []
        assert mine_negatives(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") == 0).collect() == []


def test_cover_tree():
    """Radii cover, levels separate, every row is in one leaf, and the descent finds
    what brute force does, also in parts of a tree."""
    from geoframe.llm import cover_tree as C
    from geoframe.llm.int_vectors import Factor
    rng = np.random.default_rng(3)
    ints = np.concatenate([rng.integers(-50, 50, (400, 6)), 40 + rng.integers(-3, 3, (600, 6)),
                           np.full((200, 6), 7)]).astype("int64")
    nodes, most = C.build(ints)
    x = np.column_stack([ints, np.sqrt(most - (ints.astype(float) ** 2).sum(axis=1))])
    below = {i: set() if n[3] is None else set(n[3].tolist()) for i, n in enumerate(nodes)}
    for i in reversed(range(1, len(nodes))):
        below[nodes[i][0]] |= below[i]
    assert below[0] == set(range(len(ints))) and sum(len(n[3]) for n in nodes if n[3] is not None) == len(ints)
    for i, (parent, centre, radius, _) in enumerate(nodes):
        assert parent < i and np.linalg.norm(x[list(below[i])] - x[centre], axis=1).max() <= radius
        kids = [n for n in nodes if n[0] == i]
        for a in kids:
            for b in kids:
                assert a is b or np.linalg.norm(x[a[1]] - x[b[1]]) > radius / C.BASE * 0.99
    labels = rng.integers(0, 3, len(ints))
    rows = [(i, n[0], n[2], ints[n[1]], None if n[3] is None else
             (n[3], labels[n[3]], n[3], Factor(ints[n[3]]))) for i, n in enumerate(nodes)]
    cut = len(rows) // 2
    for q in rng.integers(-50, 50, (20, 6)):
        scores = ints @ q
        for windows in ([(-np.inf, np.inf)], [(0, 400), (-900, -10)]):
            for parts in ([rows], [rows[:cut], rows[cut:]]):
                got = [C.Tree(p, most).search(Factor(q[None, :]), 1, False, windows, 4) for p in parts]
                for w, (lo, hi) in enumerate(windows):
                    want = sorted((-int(s), i, i) for i, s in enumerate(scores)
                                  if labels[i] != 1 and lo <= s <= hi)[:4]
                    assert sorted(r for g in got for r in g[w])[:4] == want


def test_registered_search_queries(spark):
    import duckdb

    from geoframe.llm import REGISTRY
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF}/embeddings.parquet'").fetchall()
    got = REGISTRY["op11_topk_threshold"](spark, SF)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == sorted(brute_top(rows, 50, 5), key=str)
    rows = [(i, v, x if x is None or i % 7 else (x + 1) % 10) for i, v, x in rows]
    got = REGISTRY["op12_negatives_cover_tree"](spark, SF)
    assert rows_of(got, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") \
        == sorted(brute_negatives(rows, 50), key=str)


# ---------------------------------------------------------------- phrases

def brute_phrases(docs, least, top, percent=50):
    """docs: (text, lang)."""
    f, n, lower = {}, Counter(), {c: c + 32 for c in range(65, 91)}
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= percent * a
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((score, a, " ".join(p), c[p[:k]], c[p[k:]]))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, x, y, n[lang], s) for i, (s, a, p, x, y) in enumerate(rows[:top])]
    return out


NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.fixture(scope="module")
def texts(spark):
    from geoframe.session import ship_package
    ship_package(spark)
    return lambda rows: spark.createDataFrame([(*r, "x", 3) for r in rows], "text string, lang string, h string, n int")


def test_phrases(texts, monkeypatch):
    from geoframe.llm import phrases as P
    rng = np.random.default_rng(5)
    words = ["a", "B", "cé", "É", "d e", "the", "of", "\U0001f600", "x1"]
    ends = [" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "!? ", "\r\n", ";\x0b", "\x0c"]
    docs = [("".join(str(rng.choice(words)) + str(rng.choice(ends)) for _ in range(rng.integers(0, 60))),
             [None, "en", "de", "", "und"][rng.integers(0, 5)]) for _ in range(120)]
    docs += [(None, "en"), ("", "en"), (" \t.,", "fr"), ("A b cé " * 400, "en"), ("a a a a a a a a a a a a", "zz"),
             ("of the x1", None)] + docs[:30]
    for shard in (40, 1 << 20):
        monkeypatch.setattr(P, "SHARD", shard)         # several shards a task, or one
        got = P.top_phrases(texts(docs).repartition(3), least=4, top=25)
        assert rows_of(got, *NAMES) == sorted(brute_phrases(docs, 4, 25), key=str)


def test_phrases_with_a_full_filter(texts, monkeypatch):
    """Clashes of bits and hashes let rare phrases through, the sums stay exact."""
    from geoframe.llm import bit_filter, phrases as P
    docs = [(f"w{i % 7} v{i % 5} u{i % 3} t{i}", "en") for i in range(200)]
    monkeypatch.setattr(P, "bit_filter", lambda keys, c: bit_filter.BitFilter(3, np.array([255], "u1")))
    assert rows_of(P.top_phrases(texts(docs)), *NAMES) == sorted(brute_phrases(docs, 10, 2000), key=str)


def test_phrases_of_an_empty_table(texts):
    from geoframe.llm.phrases import top_phrases
    assert top_phrases(texts([])).collect() == []
    assert top_phrases(texts([(None, None), ("", "en")])).collect() == []


def test_long_text_and_large_counts(texts):
    """A text of 3 MB is one shard; scores do not overflow 64 bits."""
    from geoframe.llm.phrases import top_phrases
    docs = [("left right " * 270_000, "en")]
    got = rows_of(top_phrases(texts(docs)), *NAMES)
    assert got == sorted(brute_phrases(docs, 10, 2000), key=str) and got


def test_extensions_are_counted(texts):
    from geoframe.llm.phrases import phrase_counts
    docs = [("x a b y. a b. z a b", "en")]
    got = {r["phrase"]: (r["n"], r["before"], r["after"]) for r in phrase_counts(texts(docs), least=3).collect()}
    assert got["a b"] == (3, 2, 1) and got["a"] == (3, 2, 3) and got[""][0] == 9


def test_registered_phrase_query(spark):
    import duckdb

    from geoframe.llm import REGISTRY
    docs = duckdb.sql(f"SELECT text, lang FROM '{SF}/documents.parquet'").fetchall()
    assert rows_of(REGISTRY["op13_phrase_index"](spark, SF), *NAMES) == sorted(brute_phrases(docs, 10, 2000), key=str)


def test_bidirectional_index():
    from geoframe.llm.fm_index import Bidirectional
    rng = np.random.default_rng(1)
    for _ in range(60):
        w = rng.integers(0, rng.integers(2, 8), rng.integers(1, 60))
        w[-1] = 0
        pieces = [p for p in "".join(chr(65 + x) for x in w).split("A")]

        def met(k):
            return Counter(p[i:i + k] for p in pieces for i in range(len(p) - k + 1) if k)
        index = Bidirectional(w, 3)
        for ways in range(4):
            p = index.single()
            for k in (2, 3):
                p = (index.left if ways >> (k - 2) & 1 else index.right)(p)
                names = ["".join(chr(65 + x) for x in row) for row in p.words]
                assert dict(zip(names, p.counts.tolist())) == dict(met(k))
                before = index.forward.extended(p.low, p.high)
                after = index.reverse.extended(p.low_r, p.high_r)
                longer = met(k + 1)
                for name, b, a in zip(names, before, after):
                    assert b == sum(n for q, n in longer.items() if q[1:] == name)
                    assert a == sum(n for q, n in longer.items() if q[:-1] == name)
        for name, n in met(3).items():
            low, high = 0, len(w)
            for x in reversed(name):
                low, high = index.forward.extend(ord(x) - 65, low, high)
            assert high - low == n


def test_spread_join(spark):
    from geoframe.llm.joins import spread_join
    rows = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 0), (3, 0), (None, 1), (1, 3)], "k int, v int")
    values = spark.createDataFrame([(1, "a", 7), (2, "b", 8), (None, "n", 9)], "k int, w string, gone int")
    got = spread_join(rows, values, ["k"], ["w"], share=10)
    assert got.columns == ["k", "v", "w"]
    assert sorted(map(tuple, got.collect())) == sorted([(1, i, "a") for i in range(500)] + [(2, 0, "b"), (1, 3, "a")])
