"""Fuzzy line dedup by MinHash.

Lines (cut at ``\\n``) are compared in a normal form: lower case, white space
collapsed.  A line's set are its distinct shingles of ``SHINGLE`` characters
(a shorter line: the whole line).  Its signature comes from ``PASSES`` hashes,
each dealt into ``BINS`` bins of which the minimum stays (an empty bin borrows
from the next one); ``ROWS`` bins make a band.  With 12 bands of 4 rows two
lines at similarity 0.8 share a band with probability 0.998, and closer ones
almost surely.  Lines that share a band are compared exactly by Jaccard
similarity of their sets, links are joined by a distributed union-find, and of
every component the first line (by document id, then place) stays.

Lines without a letter or digit (blank lines, rules) are never compared or
removed, nor are lines below ``MIN_CHARS`` characters: short headings and list
marks repeat by right.

Cases: null text is empty and comes back null; rows with equal id and text are
taken for one document and lose the same lines; rows without an id are left alone;
an empty table gives an empty result; texts of any length are cut line by line;
other columns are kept as they are, whatever their names, but for one that is
called ``_l_places``, as the added column is: it gives way.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.llm.bit_filter import bit_filter
from geoframe.llm.common import materialise, put_back, query, set_aside, table
from geoframe.llm.hashing import BASE, mix
from geoframe.llm.linking import intersections, similar_components

SHINGLE = 8
MIN_CHARS = 20
PASSES, BINS = 3, 16
BANDS, ROWS = 12, 4
PERCENT = 80
BATCH_CHARS = 1 << 17     # so that the arrays stay in the processor's cache
SEEN = 500_000            # lines that a task remembers, not to send them twice
FEW = 6                   # lines that are compared as sets of strings
_SPREAD_OUT = [*(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"), "  ", " \n", "\n "]
LETTERS = 1 << 12         # characters whose numbers are looked up
_LETTERS = mix(np.arange(1, LETTERS + 1, dtype="uint64"))
_MARK = np.uint64(0xFFFFFFFFFFFFFFFF)


def normal(line: str) -> str | None:
    """The form that is compared; None for lines that are left alone."""
    line = " ".join(line.lower().split())
    return line if len(line) >= MIN_CHARS and any(map(str.isalnum, line)) else None


def line_id(line: str) -> int:
    """One number for a normal form (64 bit)."""
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                          "little", signed=True)


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all lines, one after the other, and each one's line."""
    lines = [x.ljust(SHINGLE, "\0") for x in lines]
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    lengths = np.array([len(x) for x in lines], dtype="int64")
    if not len(lines):
        return np.zeros(0, "uint64"), np.zeros(0, "int64")
    # a polynomial of the characters' numbers, of 1, 2, 4 ... characters
    hashes = _LETTERS[codes] if codes.max() < LETTERS else np.where(
        codes < LETTERS, _LETTERS[np.minimum(codes, LETTERS - 1)], mix(codes + np.uint64(1)))
    span, factor = 1, int(BASE)
    while span < SHINGLE:
        more = hashes[span:] * np.uint64(factor)
        more += hashes[:-span]
        hashes = more
        span, factor = 2 * span, factor * factor % (1 << 64)
    inside = np.ones(len(hashes), bool)              # not across two lines
    inside[(np.cumsum(lengths)[:-1, None] - np.arange(1, SHINGLE)).ravel()] = False
    return mix(hashes[inside]), np.repeat(np.arange(len(lines)), lengths - SHINGLE + 1)


def signatures(lines: list[str]) -> np.ndarray:
    """Band hashes (lines x BANDS, int64)."""
    hashes, owner = shingles(lines)
    bins = np.full((len(lines), PASSES * BINS), _MARK)
    owner *= PASSES * BINS
    for p in range(PASSES):
        # a pass takes the bin and the order in it from bits of its own, which come first
        own = np.uint64(64 // PASSES * p)
        h = hashes << own | hashes >> (np.uint64(64) - own) if p else hashes
        cell = (h >> np.uint64(65 - BINS.bit_length())).view("int64") + owner
        np.minimum.at(bins.reshape(-1), cell + p * BINS, h)
        part = bins[:, p * BINS:(p + 1) * BINS]
        empty = part == _MARK
        source = part.copy()
        for step in range(1, BINS):
            if not empty.any():
                break
            near = np.roll(source, -step, axis=1)
            take = empty & (near != _MARK)
            part[take] = mix(near[take] + np.uint64(step))
            empty &= ~take
    rows = bins.reshape(len(lines), BANDS, ROWS)
    out = np.zeros((len(lines), BANDS), dtype="uint64")
    for r in range(ROWS):
        out = mix(out * np.uint64(5) + rows[:, :, r])
    return (out + np.arange(BANDS, dtype="uint64") * np.uint64(0x632BE59BD9B4E019)).view("int64")


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def _shared(lines: list[str]):
    """``(size of two sets' intersection, sets)`` of the shingles of a few lines: if all
    characters are bytes (Latin-1), a shingle is eight of them, read as one number."""
    try:
        data = [x.encode("latin-1") for x in lines]
    except UnicodeEncodeError:
        data = []
    if data and min(map(len, data)) >= SHINGLE == 8:
        sets = [_distinct(np.ndarray(len(x) - SHINGLE + 1, "<u8", x, strides=(1,))) for x in data]
        return lambda a, b: len(a) + len(b) - len(_distinct(np.concatenate([a, b]))), sets
    return (lambda a, b: len(a & b)), [
        {x[i:i + SHINGLE] for i in range(max(1, len(x) - SHINGLE + 1))} for x in lines]


def similar_lines(items):
    """Pairs of lines (UTF-8) whose Jaccard similarity is at least PERCENT / 100."""
    lines = [x.decode("utf-8", "surrogatepass") for x in items]
    if len(lines) <= FEW:
        shared, sets = _shared(lines)
        found = [(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j])
                 if 100 * min(len(a), len(b)) >= PERCENT * max(len(a), len(b))
                 and (100 + PERCENT) * shared(a, b) >= PERCENT * (len(a) + len(b))]
        found = np.array(sorted(found), dtype="int64").reshape(-1, 2)
        return found[:, 0], found[:, 1]
    hashes, owner = shingles(lines)
    cuts = np.searchsorted(owner, np.arange(1, len(items)))
    sets = [np.unique(s) for s in np.split(hashes, cuts)]
    size = np.array([len(s) for s in sets], dtype="int64")
    both = np.rint(intersections(sets)).astype("int64")
    union = size[:, None] + size[None, :] - both
    return np.nonzero(np.triu(100 * both >= PERCENT * union, 1))


def single_blanks(text: str) -> bool:
    """Whether all white space is single blanks inside lines and line ends, so that
    lines need no collapsing."""
    return not (text[:1] == " " or text[-1:] == " " or any(s in text for s in _SPREAD_OUT))


def _lines(texts):
    """(row, place, normal form) of the lines that are compared."""
    for i, text in enumerate(texts):
        text = text.as_py() or ""
        if single_blanks(text):
            for k, line in enumerate(text.lower().split("\n")):
                if len(line) >= MIN_CHARS and any(map(str.isalnum, line)):
                    yield i, k, line
            continue
        for k, line in enumerate(text.split("\n")):
            if (form := normal(line)) is not None:
                yield i, k, form


def _occurrences(batches):
    for batch in batches:
        ids, of = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        found = [(ids[i], of[i], k, line_id(x)) for i, k, x in _lines(batch.column(2))]
        kinds = zip(("id", "of", "place", "rid"), (pa.int64(), pa.int64(), pa.int32(), pa.int64()))
        yield pa.RecordBatch.from_pydict({n: pa.array([f[c] for f in found], t) for c, (n, t) in enumerate(kinds)})


def _new_lines(batches):
    """Lists of (rid, line) that this task has not sent, of bounded size."""
    seen: set[int] = set()
    held, size = [], 0
    for batch in batches:
        for _, _, line in _lines(batch.column(0)):
            if (rid := line_id(line)) in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(rid)
            held.append((rid, line))
            size += len(line)
            if size >= BATCH_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _bands(batches):
    for held in _new_lines(batches):
        keys = signatures([x for _, x in held])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), pa.array(np.repeat([r for r, _ in held], BANDS))], names=["key", "rid"])


def _items(shared):
    """The lines that may be in a bucket with others."""
    def run(batches):
        for held in _new_lines(batches):
            keep = shared.value(np.array([r for r, _ in held], dtype="int64").view("uint64")).tolist()
            held = [h for h, k in zip(held, keep) if k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in held], pa.int64()),
                 pa.array([x.encode("utf-8", "surrogatepass") for _, x in held], pa.binary())], names=["rid", "item"])
    return run


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines to remove: (id, of, places array<int>), one row per document; ``of`` is
    a hash of the text, which tells rows with equal ids apart."""
    base = docs.where(F.col(id_col).isNotNull() & F.col(text).isNotNull()) \
        .select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("of"), text)
    seen = materialise(base.mapInArrow(_occurrences, "id long, of long, place int, rid long"), "line-places")

    def items(needed):
        members = docs.sparkSession.sparkContext.broadcast(bit_filter(needed, "rid"))
        return base.select(text).mapInArrow(_items(members), "rid long, item binary")
    linked = similar_components(base.select(text).mapInArrow(_bands, "key long, rid long"), items,
                                similar_lines, "line")
    first = seen.groupBy("rid").agg(F.min(F.struct("id", "of", "place")).alias("lo"),
                                    F.max(F.struct("id", "of", "place")).alias("hi"))
    first = (first.join(linked.withColumnRenamed("node", "rid"), "rid", "left")
             .where("component IS NOT NULL OR lo < hi").withColumn("component", F.coalesce("component", "rid")))
    keeper = first.groupBy("component").agg(F.min("lo").alias("keeper"))
    of = materialise(first.join(keeper, "component").select("rid", "keeper"), "line-keepers")
    gone = seen.join(of, "rid").where(F.struct("id", "of", "place") != F.col("keeper"))
    return gone.groupBy("id", "of").agg(F.sort_array(F.collect_set("place")).alias("places"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines cut out of ``text``; all columns are kept
    and ``_l_places`` (array<int>, null if nothing went) is added."""
    docs, names = set_aside(docs, "_l_")
    id_col, text = names.get(id_col, id_col), names.get(text, text)
    gone = repeated_lines(docs, id_col, text).select(F.col("id").alias("_l_id"), F.col("of").alias("_l_of"),
                                                     F.col("places").alias("_l_places"))
    joined = docs.join(gone, (F.col(id_col).cast("long") == F.col("_l_id")) & (F.xxhash64(text) == F.col("_l_of")),
                       "left").drop("_l_id", "_l_of")
    lines = F.filter(F.split(text, "\\n"), lambda x, i: ~F.array_contains("_l_places", i))
    done = joined.withColumn(text, F.when(F.col("_l_places").isNull(), F.col(text))
                             .otherwise(F.array_join(lines, "\n")))
    return put_back(done, names, "_l_places")


@query("op9_line_minhash")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("given"))
    done = dedup_lines(docs)
    return done.select(
        "doc_id", F.size(F.split(F.coalesce("given", F.lit("")), "\\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("_l_places"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("_l_places", F.array().cast("array<int>")).alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
