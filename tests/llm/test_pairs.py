"""Vectors, lines, n-grams, stretches and the pipeline, by brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geoframe.llm import line_dedup, linking, ngram_join, suffix_dedup, vectors
from geoframe.llm.common import components


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def groups(pairs, nodes):
    u = Union()
    for a, b in pairs:
        u.join(a, b)
    return {n: u.find(n) for n in nodes}


# -------------------------------------------------------- components

@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    pairs = {"chain": [(i, i + 1) for i in range(300)], "star": [(500, i) for i in range(300)], "none": [],
             "random": [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(220)]}[kind]
    rows = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in pairs] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(5)
    got = {r["node"]: r["component"] for r in components(df).collect()}
    pairs = [p for p in pairs if p[0] != p[1]]
    assert got == groups(pairs, {x for p in pairs for x in p})


def test_intersections(monkeypatch):
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype("uint64")) for _ in range(12)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    monkeypatch.setattr(linking, "CELLS", 50)
    got = linking.intersections(sets)
    np.fill_diagonal(got, 0)
    np.fill_diagonal(want := np.array(want), 0)
    assert (got == want).all()


def test_multiple_across_batches():
    import pyarrow as pa
    rng = random.Random(4)
    rows = sorted((rng.randint(0, 40), rng.randint(0, 3)) for _ in range(150))
    for size in (1, 2, 7, 150):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + size]], pa.int64()),
                                               pa.array([r[1] for r in rows[i:i + size]], pa.int64())],
                                              names=["key", "rid"]) for i in range(0, len(rows), size)]
        got = [(k, r) for b in linking.multiple(iter(batches))
               for k, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        rids = collections.defaultdict(set)
        for k, r in rows:
            rids[k].add(r)
        assert got == sorted((k, r) for k, s in rids.items() if len(s) > 1 for r in s)


# ----------------------------------------------------------- vectors

def test_vectors(spark, monkeypatch):
    from geoframe.session import ship_package
    ship_package(spark)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    rows = [(i, [float(x) for x in base[i % 40] + rng.standard_normal(16) * 0.06 * (i % 4)]) for i in range(240)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [(1100, [2 * x for x in rows[3][1]])]
    bad = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [float("inf")] * 16),
           (2005, [None] + [1.0] * 15), (2006, [1.0] * 8), (2006, [1.0] * 8), (2008, [1e-200] * 16), (2009, [1e200] * 16)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1))
    got = collections.Counter(tuple(r) for r in vectors.near_vectors(df).collect())
    good = [(i, np.array(v)) for i, v in rows] + [(2008, np.ones(16)), (2009, np.ones(16))]
    unit = np.stack([v / np.linalg.norm(v) for _, v in good])
    a, b = np.nonzero(np.triu(unit @ unit.T >= 0.95, 1))
    links = np.bincount(np.concatenate([a, b]), minlength=len(good))
    comp = groups([(good[x][0], good[y][0]) for x, y in zip(a, b)], [i for i, _ in good])
    want = collections.Counter((i, int(n), comp[i]) for (i, _), n in zip(good, links))
    want += collections.Counter({(i, 0, i): 1 for i in range(2000, 2006)}) + collections.Counter({(2006, 1, 2006): 2})
    assert got == want
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    x = vectors._unit(rng.standard_normal((400, 64)))
    off = rng.standard_normal((400, 64))
    off -= (off * x).sum(axis=1, keepdims=True) * x
    y = 0.9501 * x + np.sqrt(1 - 0.9501 ** 2) * vectors._unit(off)
    h = vectors.Hasher(64, vectors.THRESHOLD, vectors.TABLES, vectors.HASHES)
    assert (h(x) == h(y)).any(axis=1).mean() >= 0.98


# ------------------------------------------------------------- lines

LINE = "the quick brown fox jumps over the lazy dog number {} and then goes home to sleep until morning"


def line_texts():
    rng = random.Random(9)
    texts = [None, "", "\n\n", "short\nshort", "-" * 40 + "\n" + "-" * 40]
    texts += [LINE.format(i % 7) + "\nown line of document " + str(i * 7919) + " with words " + str(rng.random())
              for i in range(60)]
    texts += [LINE.format(3).upper() + "\n  " + LINE.format(3).replace(" ", "   ")] * 3
    return texts


def brute_lines(given):
    places = collections.defaultdict(set)
    for i, t in given:
        for k, x in enumerate((t or "").split("\n")):
            if (form := line_dedup.normal(x)) is not None:
                places[form].add((i, k))
    forms = sorted(places)
    sets = [{f[a:a + 8] for a in range(max(1, len(f) - 7))} for f in forms]
    pairs = [(x, y) for x in range(len(forms)) for y in range(x)
             if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])]
    comp, first = groups(pairs, range(len(forms))), {}
    for k, f in enumerate(forms):
        first[comp[k]] = min(first.get(comp[k], (1 << 60, 0)), min(places[f]))
    return {o for k, f in enumerate(forms) for o in places[f] if o != first[comp[k]]}


def test_lines(frame, documents):
    for texts in (line_texts(), [t for _, t in documents[:120]]):
        given = list(enumerate(texts))
        df = frame([*given, (None, LINE.format(3)), given[-1]]).withColumn("id", F.lit("x"))
        got = line_dedup.dedup_lines(df).collect()
        gone = brute_lines(given)
        assert len(got) == len(given) + 2
        for r in got:
            if r["doc_id"] is None:
                assert r["text"] == LINE.format(3)
                continue
            text = texts[r["doc_id"]]
            want = None if text is None else "\n".join(
                x for k, x in enumerate(text.split("\n")) if (r["doc_id"], k) not in gone)
            assert r["text"] == want and r["id"] == "x"
    assert line_dedup.dedup_lines(frame([])).count() == 0


def test_lines_of_single_blanks():
    assert not [c for c in map(chr, range(0x3001, 0x110000)) if c.isspace()]      # none is left out
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "B", "ß", "ΑΣ", "İ", "long word", "1", " ", " ", "\n", *extra])
                     for _ in range(rng.randint(0, 60))) for extra in ([], ["\t"], ["\u3000"], ["\x85", "  "])
             for _ in range(300)] + ["", " ", "\n", "x" * 30 + " ", " " + "y" * 30, "Σ" * 30 + "\n" + "ΑΣ" * 15]
    want = [(i, k, form) for i, t in enumerate(texts) for k, line in enumerate(t.split("\n"))
            if (form := line_dedup.normal(line)) is not None]
    assert list(line_dedup._lines(pa.array(texts))) == want
    assert 100 < sum(map(line_dedup.single_blanks, texts)) < len(texts) - 100


def test_few_lines_are_compared_as_many(monkeypatch):
    rng, found = random.Random(9), []
    groups_ = []
    for n in range(160):
        letters = "abc 你é" if n % 2 else "abc é"
        base = "".join(rng.choice(letters) for _ in range(rng.randint(5, 120)))
        groups_.append([(base[:k] + rng.choice("xyz") + base[k + 1:]).encode()
                        for k in (rng.randrange(len(base)) for _ in range(rng.randint(1, 6)))])
    for few in (0, line_dedup.FEW):
        monkeypatch.setattr(line_dedup, "FEW", few)
        found.append([[x.tolist() for x in line_dedup.similar_lines(g)] for g in groups_])
    assert found[0] == found[1] and any(a for a, _ in found[0])


def test_shingles_do_not_depend_on_the_batch():
    lines = ["ab", "abcdefgh你", "x" * 9, "abcdefgh你\U0001f600", "abcdefgh"]
    hashes, owner = line_dedup.shingles(lines)
    for i, line in enumerate(lines):
        own = hashes[owner == i]
        assert (line_dedup.shingles([line])[0] == own).all()
        assert len(own) == max(1, len(line) - line_dedup.SHINGLE + 1)
    assert len(line_dedup.shingles([])[0]) == 0
    assert len(np.unique(hashes)) == len({x[i:i + 8] for x in lines for i in range(max(1, len(x) - 7))})


def test_one_python_step_in_a_stage(spark, monkeypatch):
    """A worker for each core is enough: Python steps are parted by a shuffle or by files."""
    from geoframe.llm import common
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df
    write = common.materialise
    monkeypatch.setattr(common, "materialise", lambda df, name: write(noted(df, name), name))
    edges = spark.range(50).mapInArrow(lambda batches: (b.rename_columns(["a"]).append_column("b", b.column(0))
                                                        for b in batches), "a long, b long")
    common.components(edges.selectExpr("a", "b + 1 AS b"))
    assert any("MapInArrow" in p for p in plans)
    for plan in plans:
        steps = re.findall(r"MapInArrow|MapInPandas|Exchange", plan)
        assert not any(x.startswith("Map") and y.startswith("Map") for x, y in zip(steps, steps[1:])), plan


def test_line_recall():
    rng = random.Random(3)
    words = [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randint(0, 99)}" for _ in range(500)]
    a = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(300)]
    b = []
    for x in a:
        w = x.split()
        w[rng.randint(5, 34)] = "zzz"
        b.append(" ".join(w))
    assert (line_dedup.signatures(a) == line_dedup.signatures(b)).any(axis=1).mean() > 0.99


# ----------------------------------------------------------- n-grams

def word_sets(texts, n):
    out = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        out.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


@pytest.mark.parametrize("universe", [None, 0.0001, 1.0])
def test_ngrams(frame, documents, universe):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(80)]
    texts = [None, "", " \t ", "one", "ONE", "one two", "one\x0btwo", "Éa b c", "éa b c"]
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(80)] = rng.choice(words)
        texts.append(" ".join(w))
    texts += [t for _, t in documents[:60]]
    sets = word_sets(texts, 3)
    pairs = [(a, b) for a in range(len(sets)) for b in range(a)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    comp = groups(pairs, range(len(texts)))
    df = frame(texts).withColumn("key", F.lit(0)).withColumn("rid", F.lit(0))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in ngram_join.ngram_components(df, 3, 90, universe=universe).collect()}
    assert got == {i: (len(s), comp[i]) for i, s in enumerate(sets)}


def test_ngram_edges(frame):
    df = frame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (9, "other text")])
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "5", "9", "None"]
    assert ngram_join.ngram_components(frame([])).count() == 0


def test_held_by_across_batches(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(ngram_join, "BIG", 5)
    rng = random.Random(4)
    rows = sorted([(rng.randint(0, 30), rng.randint(0, 4)) for _ in range(90)] + [(12, r) for r in range(40)])
    rids = collections.defaultdict(set)
    for k, r in rows:
        rids[k].add(r)
    for size in (1, 3, 200):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + size]], pa.int64()),
                                               pa.array([r[1] for r in rows[i:i + size]], pa.int64())],
                                              names=["key", "rid"]) for i in range(0, len(rows), size)]
        got = {(k, r): n for b in ngram_join._held_by(iter(batches))
               for k, r, n in zip(*(c.to_pylist() for c in b.columns))}
        assert got == {(k, r): min(5, len(s)) for k, s in rids.items() if len(s) > 1 for r in s}


# --------------------------------------------------------- stretches

def brute_cut(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), runs, bytes(c for c, g in zip(d, gone) if not g)))
    return out


def whole(data, a, b):
    """Words of data[a:b] that lie in it whole."""
    found = re.finditer(rb"[^ \t\n\r\x0b\x0c]+", data)
    return sum(a <= m.start() and m.end() <= b for m in found)


def brute_passages(texts, words=51, most=400):
    """Per text, whether something goes and what stays of it: runs of bytes at which
    a stretch of 2 * words - 1 bytes starts that is there again go with these
    stretches, if they hold so many words, or ``most`` bytes."""
    data = [(t or "").encode() for t in texts]
    n = 2 * words - 1
    seen = collections.Counter(d[i:i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone, i = set(), 0
        while i < len(d) - n + 1:
            a = i
            while i < len(d) - n + 1 and seen[d[i:i + n]] > 1:
                i += 1
            end = i - 1 + n
            if i > a and (end - a >= most or whole(d, a, end) >= words):
                gone.update(range(a, end))
            i += 1
        pieces = [[]]
        for k, c in enumerate(d):
            if k in gone:
                pieces.append([])
            else:
                pieces[-1].append(c)
        out.append((bool(gone), "".join(bytes(p).decode("utf-8", "ignore") for p in pieces)))
    return out


def stretch_texts():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij é") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(150), text(120)
    texts = [None, "", "short", "a" * 399, "b" * 400, "c" * 401, "ab" * 400, "x" * 2000]
    texts += [text(60) + passage + text(50) for _ in range(8)]
    texts += [text(30) + other[:n] + text(30) for n in (398, 399, 400, 401, 402, 420, 450, 520, 600) for _ in (0, 1)]
    texts += [text(20) + other[a:a + n] + text(5) for a, n in ((0, 410), (7, 405), (3, 402), (100, 400), (101, 400))]
    near = text(400)
    for _ in range(10):
        k = rng.randrange(len(near))
        texts.append(near[:k] + "#" + near[k:])
    return texts + [text(200)] + [text(100) + passage + passage] * 2


def test_stretches(frame):
    texts = stretch_texts()
    want = brute_cut(texts, 400)
    df = frame(texts).withColumn("row", F.lit(1)).withColumn("key", F.lit(2))
    for r in suffix_dedup.dedup_stretches(df).collect():
        assert (r["_s_bytes"], r["_s_spans"], bytes(r["_s_kept"])) == want[r["doc_id"]], r["doc_id"]
    assert suffix_dedup.dedup_stretches(frame([])).count() == 0


@pytest.mark.parametrize("length", [32, 33, 100, 143])
def test_short_stretches(frame, length):
    rng = random.Random(length)
    text = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    passage, tail = text(length + 20), text(length)
    texts = [None, "x" * (length - 1), "y" * length, "z" * (length + 1), "ab" * length]
    texts += [text(80) + passage[:n] + text(40) for n in range(length - 2, length + 21) for _ in (0, 1)]
    texts += [text(60) + tail, tail + text(60), tail, passage, text(25) + passage + passage]
    want = brute_cut(texts, length)
    for r in suffix_dedup.dedup_stretches(frame(texts), length=length).collect():
        assert (r["_s_bytes"], r["_s_spans"], bytes(r["_s_kept"])) == want[r["doc_id"]], r["doc_id"]


@pytest.mark.parametrize("length", [-1, 0, 31])
def test_stretches_too_short(frame, length):
    with pytest.raises(ValueError, match="32 bytes"):
        suffix_dedup.dedup_stretches(frame(["text"]), length=length)


def test_long_text_in_segments(frame, monkeypatch):
    """Cut into segments with an overlap, chunks of a text are those of the whole."""
    rng = random.Random(2)
    text = "".join(rng.choice("abcd ") for _ in range(9000)).encode()
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1000)

    class Value:
        def as_py(self):
            return text.decode()

    class Batch:
        def column(self, i):
            import pyarrow as pa
            return pa.array([7]) if i == 0 else [Value()]

    starts = set()
    for rows, lo, hi, *_ in suffix_dedup._found([Batch()], 400):
        for a, b in zip(lo.tolist(), hi.tolist()):
            starts.update(range(a, b + 1))
    assert starts >= set(range(len(text) - 400 + 1)) and max(starts) == len(text) - 400


def value_batch(texts):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())],
                                      names=["row", "text"])


@pytest.mark.parametrize("repeats", [False, True])
def test_segments_give_the_chunks_of_the_whole(monkeypatch, repeats):
    """Every chunk comes out once, whatever the segments."""
    rng = random.Random(21)
    texts = ["".join(rng.choice("abcd ") for _ in range(n)) for n in (20_000, 7_531, 1_545, 1_544, 900, 3_000)]
    if repeats:
        texts += [texts[0][1_900:3_100] + texts[1], "ab" * 2_500]

    def chunks():
        return sorted(x for found in suffix_dedup._found([value_batch(texts)], 400)
                      for x in zip(*(c.tolist() for c in found)))
    whole = chunks()
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1000)
    assert chunks() == whole


def test_texts_of_several_segments(frame):
    """At the ends of segments only what is repeated goes."""
    rng, at = random.Random(22), suffix_dedup.SEGMENT
    text = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage, clean = text(700), text(2 * at + 5_000)
    a, b, c, d = text(at - 350), text(at + 9_000), text(2 * at - 20), text(3_000)
    texts = [clean, a + "1" + passage + "2" + b, c + "3" + passage + "4" + d]
    want = [(0, clean), (1, a + "12" + b), (1, c + "34" + d)]
    rows = suffix_dedup.dedup_stretches(frame(texts)).collect()
    assert sorted(r["doc_id"] for r in rows) == [0, 1, 2]
    for r in rows:
        assert (r["_s_spans"], bytes(r["_s_kept"]) == want[r["doc_id"]][1].encode()) == (want[r["doc_id"]][0], True)


def brute_covered(texts, words):
    """Per text: maximal runs and bytes of the passages of so many words that start anywhere else."""
    seen, found = {}, []
    for t in texts:
        data = (t or "").encode()
        at = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
        found.append([(at[i][0], at[i + words - 1][1]) for i in range(len(at) - words + 1)])
        for a, b in found[-1]:
            seen[data[a:b]] = seen.get(data[a:b], 0) + 1
    out = []
    for t, spans in zip(texts, found):
        data = (t or "").encode()
        covered, last, runs = set(), -1, 0
        for a, b in spans:
            if seen[data[a:b]] > 1:
                runs += a > last
                last = b
                covered.update(range(a, b))
        out.append((runs, len(covered)))
    return out


def passage_texts(words):
    rng = random.Random(words)
    word = lambda: "".join(rng.choices("abcdefghijé", k=rng.randint(1, 9)))
    text = lambda n: "".join(word() + rng.choice([" ", " ", " ", "\n", "  "]) for _ in range(n))
    passage, tail = text(words + 30).split(" "), text(words)
    texts = [None, "", "   ", "a " * (words - 1), "b " * words, "c " * (words + 1), "d" * 500, "d" * 500]
    for n in range(words - 2, words + 12):
        texts += [text(40) + " ".join(passage[:n]) + " " + text(20) for _ in (0, 1)]
    # the last word goes on, the first word began before, another blank in between
    exact = [word() for _ in range(words)]
    texts += [text(9) + " ".join(exact) + end + text(9) for end in ("x ", "y ")]
    texts += [text(9) + start + " ".join(exact) + " " + text(9) for start in ("x", "y")]
    texts += [" ".join(exact[:9]) + "\t" + " ".join(exact[9:])]
    whole = text(200)
    return texts + [tail, text(5) + tail, tail + text(30), whole, whole, whole[:700] + "#" + whole[700:]]


@pytest.mark.parametrize("words", [4, 5, 20, 51])
def test_passages_of_words(frame, words):
    texts = passage_texts(words)
    texts.append(" ".join(["w"] * 300))
    want, cut = brute_covered(texts, words), brute_cut(texts, 400)
    assert sum(n > 0 for n, _ in want) > 20
    for r in suffix_dedup.dedup_stretches(frame(texts), passage=words).collect():
        assert (r["_s_passages"], r["_s_covered"]) == want[r["doc_id"]], r["doc_id"]
        assert (r["_s_bytes"], r["_s_spans"], bytes(r["_s_kept"])) == cut[r["doc_id"]], r["doc_id"]


def test_passages_below_four_words(frame):
    with pytest.raises(ValueError, match="4 words"):
        suffix_dedup.dedup_stretches(frame(["text"]), passage=3)


@pytest.mark.parametrize("letters", ["abcd ", "abcdefgh" * 40 + " "])
def test_segments_give_the_passages_of_the_whole(monkeypatch, letters):
    """Words of any length, cut between them."""
    rng = random.Random(23)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (20_000, 7_531, 1_545, 1_544, 90_000)]
    texts += [" " * 3_000 + texts[0][1_900:9_100] + " " * 5_000 + texts[1] + " " * 2_500, "ab " * 2_500, " " * 9_000]

    def chunks():
        return sorted(x for found in suffix_dedup._found([value_batch(texts)], 400, 51)
                      for x in zip(*(c.tolist() for c in found)))
    whole = chunks()
    assert {k & 1 for *_, k, _ in whole} == {0, 1}
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1000)
    assert chunks() == whole


def test_op2_tells_passages_below_400_bytes(spark, tmp_path):
    """Passages of 51 words that are no stretch of 400 bytes stay and are counted."""
    rng = random.Random(24)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passage = text(51)
    texts = [text(80), f"{text(30)} {passage} {text(30)}", f"{text(10)} {passage} {text(40)}", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in suffix_dedup.op2(spark, str(tmp_path)).collect()}
    assert [(rows[i]["n_removed"], rows[i]["n_passages"], rows[i]["n_passage_bytes"]) for i in range(4)] \
        == [(0, 0, 0), (0, 1, 305), (0, 1, 305), (0, 0, 0)]


def test_repeated_rows_are_occurrences(frame):
    text = "".join(random.Random(1).choice("abcdef ") for _ in range(900))
    rows = suffix_dedup.dedup_stretches(frame([(4, text), (4, text)])).collect()
    assert [(r["_s_spans"], bytes(r["_s_kept"])) for r in rows] == [(1, b"")] * 2


def test_whole_words():
    data = b"one two  three\nfour"
    assert [suffix_dedup.whole_words(data, a, b) for a, b in
            ((0, 19), (0, 3), (0, 2), (1, 7), (3, 9), (4, 11), (5, 6), (8, 9), (15, 19))] == [4, 1, 0, 1, 1, 1, -1, 0, 1]
    assert suffix_dedup.stays(data, [(0, 3), (3, 5), (8, 19)], 2, 2) == ([b"one two ", b""], 1)
    assert suffix_dedup.stays(b"x" * 500, [(0, 300), (200, 400)], 2, 100) == ([b"", b"x" * 100], 1)
    assert suffix_dedup.stays(b"x" * 500, [(0, 300), (202, 402)], 2, 100) == ([b"x" * 500], 0)


# ---------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    """Every stage against brute force on what the stage before it kept."""
    import corpus_pipeline as C
    from geoframe.llm.common import materialise, table

    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents")
    columns, kept = docs.columns, {}
    for name, stage in C.STAGES[:-1]:
        docs = materialise(stage(spark, docs, d), "test-pipeline")
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    good, lines, joined, cut = kept.values()

    gone = brute_lines(sorted(good.items()))
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in good.items()}
    changed = {i for i, _ in gone}
    assert lines == {i: t for i, t in want.items() if i not in changed or t.strip()}

    ids = sorted(lines)
    sets = word_sets([lines[i] for i in ids], 5)
    comp = groups([(ids[a], ids[b]) for a in range(len(ids)) for b in range(a)
                   if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])], ids)
    assert joined == {i: lines[i] for i in ids if comp[i] == i}

    ids = sorted(joined)
    found = dict(zip(ids, brute_passages([joined[i] for i in ids])))
    assert cut == {i: t for i, (gone, t) in found.items() if not gone or t.strip()}

    pieces = C.STAGES[-1][1](spark, docs, d)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == set(cut)
    assert hashlib.sha256(repr(sorted(cut)).encode()).hexdigest()
    assert C.ORACLE_SQL is None


def test_pipeline_cuts_passages_of_over_50_words(spark, frame):
    import corpus_pipeline as C
    rng = random.Random(31)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = {n: text(n) for n in range(45, 63)}
    passages[1] = "x" * 405
    passages[51, "least"] = " ".join(rng.choices("abcdefgh", k=51))
    passages[50, "letters"] = " ".join(rng.choices("abcdefgh", k=50))
    assert sum(len(p) < 400 for n, p in passages.items() if n != 1) == len(passages) - 1
    gone = {n for n in passages if n == 1 or (n if isinstance(n, int) else n[0]) > 50}
    texts, want = [], []
    for n, p in passages.items():
        # the blanks around a passage differ, so that it is the whole repeat
        for a, b in (("\n", "\t"), ("\t", "\n")):
            x, y = text(40) + a, b + text(30)
            texts.append(x + p + y)
            want.append(x + y if n in gone else texts[-1])
    found = {r["doc_id"]: r["text"] for r in C.stretch_stage(spark, frame(texts), "").collect()}
    assert found == dict(enumerate(want))


def test_stretch_stage_against_brute_force(spark, frame, documents):
    import corpus_pipeline as C
    texts = [t for _, t in documents]
    want = {k: t if gone else texts[k] for k, (gone, t) in enumerate(brute_passages(texts)) if not gone or t.strip()}
    assert {r["doc_id"]: r["text"] for r in C.stretch_stage(spark, frame(texts), "").collect()} == want


def test_short_repeats_that_touch_stay(spark, frame):
    import corpus_pipeline as C
    rng = random.Random(41)
    text = lambda n: " ".join("".join(rng.choices("abcdefghijklm", k=5)) for _ in range(n))
    a, b, c = text(38), text(30), text(27)
    texts = [text(12) + " " + a + " " + b + " " + c + " " + text(13), text(20) + " " + a + "\n" + text(9),
             text(20) + "\n" + b + "\t" + text(9), text(20) + "\t" + c + "\n" + text(9)]
    found = {r["doc_id"]: r["text"] for r in C.stretch_stage(spark, frame(texts), "").collect()}
    assert found == dict(enumerate(texts))


def test_replacement_characters_stay(spark, frame):
    import corpus_pipeline as C
    rng = random.Random(42)
    text = lambda n: " ".join("".join(rng.choices("abcdefghijklm", k=5)) for _ in range(n))
    passage = "\u00e9" + text(60) + "\u00e9"
    texts = ["a\ufffdb " + text(9) + "\u00e8" + passage + "\u00e8" + text(9) + "\ufffd",
             text(9) + "\ufffd " + "\u0129" + passage + "\u0128" + text(9)]
    found = {r["doc_id"]: r["text"] for r in C.stretch_stage(spark, frame(texts), "").collect()}
    assert found == {k: t.replace(passage, "") for k, t in enumerate(texts)}


def test_rows_with_equal_ids_are_judged_by_their_own_text(frame):
    line, other = "a line that is there in two of the rows", "a first line that nobody else has got"
    done = line_dedup.dedup_lines(frame([(1, line + "\nx"), (5, line + "\ny"), (5, other + "\nz")]))
    assert sorted((r["doc_id"], r["text"]) for r in done.collect()) == [(1, line + "\nx"), (5, other + "\nz"), (5, "y")]
    words = [" ".join(f"{c}{i}" for i in range(40)) for c in "ab"]
    kept = ngram_join.keep_one(frame([(1, words[0]), (5, words[0]), (5, words[1]), (7, words[1])]))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, words[0]), (5, words[1])]


def test_only_lines_in_buckets_are_sent(spark, frame):
    """Lines that share no band with another are not shuffled."""
    rng = random.Random(31)
    lines = ["".join(rng.choices("abcdefghijklmnop ", k=60)) + "z" for _ in range(400)]
    texts = ["\n".join(lines), lines[0] + "y", lines[1] + "y"]
    seen = []
    plain = line_dedup._items

    def noted(shared):
        hits = sum(bool(shared.value(np.array([line_dedup.line_id(line_dedup.normal(x))]).view("uint64"))[0])
                   for x in lines)
        seen.append(hits)
        return plain(shared)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(line_dedup, "_items", noted)
        rows = line_dedup.dedup_lines(frame(texts)).collect()
    assert 2 <= seen[0] < 40
    assert {r["doc_id"]: r["_l_places"] for r in rows} == {0: None, 1: [0], 2: [0]}
