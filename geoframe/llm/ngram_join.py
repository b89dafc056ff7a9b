"""N-gram Jaccard join by multiple-global-order filtering.

A text's set are its distinct word shingles (hashed to 64 bits).  If two sets
link, the first ``|x| - ceil(t |x|) + 1`` tokens of each, in any one global
order, share a token.  Candidates share such a prefix token under a first order
(found by a join on tokens) and also under a second one (checked on the spot);
what passes both filters is verified on whole sets.

The first order is rare-first: tokens whose hash lies in the lowest part of all
hashes (the ``universe``), by the number of sets that hold them, then all others by
hash.  A prefix takes ``1 - t`` of a set, so twice that share of the tokens is
enough to choose it from, and only these are counted and shuffled; a set that has
too few of them sends the tokens that follow as well.  A prefix token
that one set alone holds can meet nobody, which leaves most sets without any
candidate.  The second order is that of another hash.

Equal sets are one item, whatever the number of documents.  Cases: null text is
empty; a text without words has no shingles and links with nothing; one with
fewer words than a shingle has one, its whole sequence; rows with equal ids are
one document each but share a component id; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoframe.llm.common import materialise, put_back, query, set_aside, table
from geoframe.llm.hashing import batches_of, mix, word_hashes
from geoframe.llm.linking import intersections, similar_components

BIG = 100_000             # tokens held by more sets count as held by so many
BATCH_BYTES = 1 << 19
SEEN = 1_000_000          # sets that a task remembers, not to send them twice
TOKEN_BYTES = 5           # of a token's hash in an item; see ``pack``
_SALT = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[bytes], n: int):
    """Sorted distinct shingle hashes (uint64) of each text."""
    hashes, ends = word_hashes([t.lower() for t in texts])       # bytes: only A-Z
    at = 0
    for end in ends.tolist():
        words, at = hashes[at:end], end
        if not len(words):
            yield np.zeros(0, "uint64")
            continue
        k = min(n, len(words))
        s = np.zeros(len(words) - k + 1, dtype="uint64")
        for i in range(k):
            s = mix(s * np.uint64(3) + words[i:len(words) - k + 1 + i] + np.uint64(i + 1))
        yield np.unique(s + np.uint64(k))


def _sets(column, n: int):
    """Place and set of each text of an Arrow column."""
    texts = ((v.as_py() or "").encode("utf-8", "surrogatepass") for v in column)
    for part in batches_of(texts, BATCH_BYTES):
        for (i, _), s in zip(part, shingle_sets([t for _, t in part], n)):
            yield i, s


def set_id(s: np.ndarray) -> int:
    """One number for a whole set (64 bit)."""
    with np.errstate(over="ignore"):
        parts = mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype="uint64")
        return int(mix(np.array([parts + np.uint64(len(s))]))[0].astype("int64"))


def universe_limit(percent: int, universe: float | None = None) -> int:
    """Tokens below this are counted: by default twice a prefix's share."""
    share = 2 * (100 - percent) / 100 if universe is None else universe
    return min(int(share * (1 << 64)), (1 << 64) - 1)


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def second_order(s: np.ndarray) -> np.ndarray:
    return s[np.argsort(mix(s ^ _SALT), kind="stable")]


def pack(s: np.ndarray) -> bytes:
    """The leading 40 bits of every token: an item holds one set, and pairs are
    compared, so 2**40 values keep chance matches below one in a million pairs
    even for sets of a thousand."""
    high = (s >> np.uint64(32)).astype("<u4").tobytes()
    low = ((s >> np.uint64(24)) & np.uint64(0xFF)).astype("u1").tobytes()
    return high + low


def unpack(item: bytes) -> np.ndarray:
    n = len(item) // TOKEN_BYTES
    return ((np.frombuffer(item, "<u4", n).astype("uint64") << np.uint64(8))
            | np.frombuffer(item, "u1", n, 4 * n))


def _held_by(batches):
    """Rows (key, rid) sorted: those of keys with two rids or more, once, with
    the number of rids.  Rows of one key are kept until it ends, or is BIG."""
    keys = rids = np.zeros(0, "int64")
    big = None                                     # the key that has gone out as BIG

    def batch_of(keys, rids, counts):
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(rids), pa.array(counts.astype("int64"))],
                                          names=["key", "rid", "held"])

    def done(keys, rids):
        count = np.unique(keys, return_inverse=True, return_counts=True)
        held = count[2][count[1]] if len(keys) else keys
        some = held > 1
        return batch_of(keys[some], rids[some], np.minimum(held[some], BIG))

    for batch in batches:
        keys = np.concatenate([keys, np.asarray(batch.column(0))])
        rids = np.concatenate([rids, np.asarray(batch.column(1))])
        if big is not None:
            n = int(np.searchsorted(keys, big, side="right"))
            if n:
                yield batch_of(keys[:n], rids[:n], np.full(n, BIG))
            keys, rids = keys[n:], rids[n:]
        if not len(keys):
            continue
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (rids[1:] != rids[:-1])])
        keys, rids = keys[new], rids[new]
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        yield done(keys[:last], rids[:last])
        keys, rids = keys[last:], rids[last:]
        if len(keys) > BIG:
            big = keys[0]
            yield batch_of(keys, rids, np.full(len(keys), BIG))
            keys = rids = np.zeros(0, "int64")
    yield done(keys, rids)


def similar_sets(percent: int):
    """Pairs of items that share a second-order prefix token and whose Jaccard
    similarity is at least ``percent`` / 100."""
    def run(items):
        sets = [unpack(x) for x in items]
        size = np.array([len(s) for s in sets], dtype="int64")
        heads = [np.unique(s[:prefix_length(len(s), percent)]) for s in sets]
        few, many = np.minimum(size[:, None], size[None, :]), np.maximum(size[:, None], size[None, :])
        maybe = np.triu((intersections(heads) > 0) & (100 * few >= percent * many), 1)
        rows = np.nonzero(maybe.any(axis=0) | maybe.any(axis=1))[0]
        if not len(rows):
            return np.zeros(0, "int64"), np.zeros(0, "int64")
        both = np.rint(intersections([np.unique(sets[r]) for r in rows])).astype("int64")
        maybe = maybe[np.ix_(rows, rows)]
        union = size[rows][:, None] + size[rows][None, :] - both
        a, b = np.nonzero(maybe & (100 * both >= percent * union))
        return rows[a], rows[b]
    return run


def _components(docs: DataFrame, n: int, percent: int, id_col: str, text: str,
                universe: float | None) -> DataFrame:
    """One row per row of ``docs``: id, ``of`` (a hash of the text, which tells rows
    with equal ids apart), ``n_shingles`` and ``first``, the smallest (id, of) reachable
    (null for rows without shingles)."""
    bound = universe_limit(percent, universe)
    limit = np.uint64(bound)

    def sizes(batches):
        for batch in batches:
            found = [(len(s), set_id(s) if len(s) else None, int(np.searchsorted(s, limit)))
                     for _, s in _sets(batch.column(1), n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array([f[k] for f in found], pa.int64()) for k in range(3))],
                names=["id", "of", "n_shingles", "rid", "counted"])

    def prefixes(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, rids = [], []
            for _, s in _sets(batch.column(0), n):
                if not len(s) or (rid := set_id(s)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(rid)
                head = s[:max(int(np.searchsorted(s, limit)), prefix_length(len(s), percent))]
                keys.append(head.view("int64"))
                rids.append(np.full(len(head), rid, dtype="int64"))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(rids))],
                                                 names=["key", "rid"])

    def items(batches):
        seen: set[int] = set()
        for batch in batches:
            rids, packed = [], []
            for _, s in _sets(batch.column(0), n):
                if not len(s) or (rid := set_id(s)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(rid)
                rids.append(rid)
                packed.append(pack(second_order(s)))
            yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["rid", "item"])

    base = docs.select(F.col(id_col).cast("long").alias("id"), text, F.xxhash64(text).alias("of"))
    docs_sets = materialise(base.mapInArrow(sizes, "id long, of long, n_shingles long, rid long, counted long"),
                            "ngram-sets")
    # tokens that two sets or more hold; of the counted ones a set needs those
    # by which its prefix is longer than its tokens that nobody else holds
    shared = (docs.select(text).mapInArrow(prefixes, "key long, rid long")
              .repartition("key").sortWithinPartitions("key", "rid")
              .mapInArrow(_held_by, "key long, rid long, held long"))
    is_counted = F.shiftrightunsigned("key", 1) < F.lit(bound >> 1).cast("long")
    per_set = (docs_sets.where("rid IS NOT NULL").groupBy("rid")
               .agg(F.first("n_shingles").alias("size"), F.first("counted").alias("counted")))
    by_set = Window.partitionBy("rid")
    ranked = (shared.withColumn("of", is_counted)
              .withColumn("rank", F.row_number().over(by_set.orderBy(F.desc("of"), "held", "key")))
              .withColumn("known", F.sum(F.col("of").cast("int")).over(by_set)).join(per_set, "rid"))
    prefix = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    buckets = ranked.where(~F.col("of") | (F.col("rank") <= prefix - (F.col("counted") - F.col("known"))))
    linked = similar_components(buckets, docs.select(text).mapInArrow(items, "rid long, item binary"),
                                similar_sets(percent), "ngram")
    low = docs_sets.where("rid IS NOT NULL").groupBy("rid").agg(
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "of"))).alias("low"))
    found = low.join(linked.withColumnRenamed("node", "rid"), "rid", "left") \
        .withColumn("component", F.coalesce("component", "rid"))
    best = found.groupBy("component").agg(F.min("low").alias("first"))
    found = found.join(best, "component").select("rid", "first")
    return docs_sets.join(found, "rid", "left").select("id", "of", "n_shingles", "first")


def ngram_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text: str = "text", universe: float | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``
    (smallest id reachable by links of at least ``percent`` / 100)."""
    return _components(docs, n, percent, id_col, text, universe).select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("first.id", "id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
             text: str = "text") -> DataFrame:
    """The document with the smallest id of each component, all columns; rows
    without an id stay, and of rows with equal ids each is judged by its own text
    (equal rows stay together).  Other columns may have any names."""
    docs, names = set_aside(docs, "_n_")
    id_col, text = names.get(id_col, id_col), names.get(text, text)
    found = _components(docs, n, percent, id_col, text, None)
    gone = found.where(F.col("first").isNotNull() & (F.struct("id", "of") != F.col("first"))) \
        .select(F.col("id").alias("_n_id"), F.col("of").alias("_n_of")).distinct()
    return put_back(docs.join(gone, (F.col(id_col).cast("long") == F.col("_n_id"))
                              & (F.xxhash64(text) == F.col("_n_of")), "left_anti"), names)


@query("op8_ngram_multi_order")
def op8(spark, sf_dir):
    return ngram_components(table(spark, sf_dir, "documents"), n=3, percent=90)
