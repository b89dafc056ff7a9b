"""Near-duplicate vectors by p-stable hashing and exact cosines.

On the unit sphere a cosine of ``threshold`` is a Euclidean distance of
``c = sqrt(2 - 2 threshold)``.  Each of ``tables`` tables concatenates ``k``
hashes ``floor((a.x + b) / width)`` with Gaussian ``a``; with a width of 8 c two
vectors at distance c agree in one hash with probability 0.90, so with k = 16
and 24 tables a pair right at the threshold is met with probability 0.993, a
closer one almost surely, and far pairs rarely.

Equal vectors are folded into one class first.  Buckets larger than ``BLOCK``
are dealt into blocks and every pair of blocks is its own unit of work, so a
hot bucket is spread; no pair leaves its task - only sums of links and a
spanning forest do.  A pair is counted in the first table where it meets.

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are kept; vectors of different lengths never link; rows
with equal ids or vectors are rows of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.llm.common import components, materialise, query, table
from geoframe.llm.linking import forest

THRESHOLD = 0.95
TABLES = 24
HASHES = 16
WIDTH = 8.0            # in distances at the threshold
BLOCK = 512            # vectors of a bucket compared in one go
SEED = 20240607


def _valid(batch: pa.RecordBatch):
    """Ids, vectors as float64 arrays (None if they link with nothing)."""
    ids, col = batch.column(0).to_pylist(), batch.column(1)
    out = []
    for v in col.to_pylist():
        x = None
        if v and None not in v:
            x = np.asarray(v, dtype="float64")
            if not np.isfinite(x).all() or not x.any():
                x = None
        out.append(x)
    return ids, out


def _fingerprints(batches):
    for batch in batches:
        ids, vecs = _valid(batch)
        data = [None if v is None else v.astype("<f8").tobytes() for v in vecs]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()),
             pa.array([None if d is None else hashlib.blake2b(d, digest_size=16).digest() for d in data],
                      pa.binary()), pa.array(data, pa.binary())], names=["id", "key", "vec"])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)       # against under- and overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Hasher:
    """The tables' hashes for vectors of one length."""

    def __init__(self, dim: int, threshold: float, tables: int, k: int):
        rng = np.random.default_rng([SEED, dim])
        self.a = rng.standard_normal((dim, tables * k))
        self.width = WIDTH * np.sqrt(max(1e-6, 2 - 2 * threshold))
        self.b = rng.uniform(0, self.width, tables * k)
        self.mix = rng.integers(1, 1 << 62, (tables, k), dtype="int64").astype("uint64") | np.uint64(1)
        self.tables, self.k = tables, k

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        """Bucket numbers (rows x tables, int64)."""
        cells = np.floor((unit @ self.a + self.b) / self.width).astype("int64").astype("uint64")
        cells = cells.reshape(len(unit), self.tables, self.k)
        with np.errstate(over="ignore"):
            h = (cells * self.mix).sum(axis=2, dtype="uint64")
            h ^= h >> np.uint64(31)
            h *= np.uint64(0x9E3779B97F4A7C15)
        return h.view("int64")


def _buckets(threshold: float, tables: int, k: int):
    """mapInArrow: class rows (rep, n, vec) -> a row per table."""
    def run(batches):
        hashers: dict[int, Hasher] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                reps, counts = np.asarray(batch.column(0)), np.asarray(batch.column(1))
                vecs = batch.column(2).to_pylist()
                lengths = np.array([len(v) // 8 for v in vecs], dtype="int64")
                for dim in np.unique(lengths).tolist():
                    rows = np.nonzero(lengths == dim)[0]
                    x = np.frombuffer(b"".join(vecs[i] for i in rows), dtype="<f8").reshape(-1, dim)
                    if dim not in hashers:
                        hashers[dim] = Hasher(dim, threshold, tables, k)
                    sig = hashers[dim](_unit(x))
                    n, order = len(rows), np.repeat(np.arange(len(rows)), tables)
                    sigs = [s.tobytes() for s in sig]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.tile(np.arange(tables, dtype="int32"), n)), pa.array(sig.ravel()),
                        pa.array(np.full(n * tables, dim, dtype="int32")), pa.array(reps[rows][order]),
                        pa.array(counts[rows][order]), pa.array([vecs[rows[i]] for i in order], pa.binary()),
                        pa.array([sigs[i] for i in order], pa.binary())],
                        names=["t", "bucket", "dim", "rep", "n", "vec", "sig"])
    return run


def _compare(threshold: float):
    """mapInArrow over rows sorted by (t, bucket, dim, i, j): links of each
    bucket (or pair of blocks) as sums and spanning edges."""
    def group(key, rows):
        t, _, dim, i, j = key
        rep = np.array([r[0] for r in rows])
        order = np.argsort(rep, kind="stable")
        rows, rep = [rows[k] for k in order], rep[order]
        count = np.array([r[1] for r in rows])
        unit = _unit(np.frombuffer(b"".join(r[2] for r in rows), dtype="<f8").reshape(-1, dim))
        sig = np.frombuffer(b"".join(r[3] for r in rows), dtype="<i8").reshape(len(rows), -1)
        block = np.array([r[4] for r in rows])
        adds, edges_a, edges_b = np.zeros(len(rows), dtype="int64"), [], []
        for at in range(0, len(rows), BLOCK):
            part = slice(at, at + BLOCK)
            a, b = np.nonzero(unit[part] @ unit.T >= threshold)
            a += at
            keep = a < b
            if i != j:
                keep &= block[a] != block[b]
            a, b = a[keep], b[keep]
            for s in range(t):                       # met in an earlier table
                keep = sig[a, s] != sig[b, s]
                a, b = a[keep], b[keep]
            np.add.at(adds, a, count[b])
            np.add.at(adds, b, count[a])
            edges_a.append(a)
            edges_b.append(b)
        label = forest(len(rows), np.concatenate(edges_a), np.concatenate(edges_b))
        got = np.nonzero(adds)[0]
        return rep[got], adds[got], rep[label[got]]

    def run(batches):
        key, rows, out = None, [], []

        def flush():
            if len(rows) > 1:
                out.append(group(key, rows))

        def batch_of(parts):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[k] for p in parts]))
                                               for k in range(3)], names=["rep", "links", "low"])

        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in range(5)]))
            values = list(zip(*[batch.column(c).to_pylist() for c in range(5, 10)]))
            for k, v in zip(keys, values):
                if k != key:
                    flush()
                    key, rows = k, []
                rows.append(v)
            if sum(len(p[0]) for p in out) > 50_000:
                yield batch_of(out)
                out = []
        flush()
        if out:
            yield batch_of(out)
    return run


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding", threshold: float = THRESHOLD,
                 tables: int = TABLES, k: int = HASHES) -> DataFrame:
    """One row per row of ``df``: id, ``n_links`` (other vectors with a cosine
    of at least ``threshold``) and ``component_id`` (smallest id reachable)."""
    rows = materialise(df.select(F.col(id_col).cast("long").alias("id"), vec)
                       .mapInArrow(_fingerprints, "id long, key binary, vec binary"), "vectors")
    classes = materialise(rows.where("key IS NOT NULL").groupBy("key")
                          .agg(F.min("id").alias("rep_id"), F.count(F.lit(1)).alias("n"),
                               F.first("vec").alias("vec"))
                          .withColumn("rep", F.xxhash64("key")), "vector-classes")
    dealt = materialise(classes.select("rep", "n", "vec").mapInArrow(
        _buckets(threshold, tables, k),
        "t int, bucket long, dim int, rep long, n long, vec binary, sig binary").select(
            "t", "bucket", "dim", "rep", "n", "vec", "sig"), "vector-buckets")
    shared = materialise(dealt.groupBy("t", "bucket", "dim").agg(F.count(F.lit(1)).alias("size"))
                         .where("size > 1").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")),
                         "vector-shared")
    met = dealt.join(shared, ["t", "bucket", "dim"])
    own = F.pmod(F.xxhash64("rep", "t"), F.col("blocks")).cast("int")
    met = (met.withColumn("own", own)
           .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
           .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))
    keys = ["t", "bucket", "dim", "i", "j"]
    links = materialise(met.select(*keys, "rep", "n", "vec", "sig", "own")
                        .repartition(*keys).sortWithinPartitions(*keys)
                        .mapInArrow(_compare(threshold), "rep long, links long, low long"), "vector-links")
    comp = components(links.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    sums = links.groupBy("rep").agg(F.sum("links").alias("links"))
    of = (classes.select("key", "rep", "rep_id", "n").join(sums, "rep", "left")
          .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
          .withColumn("component", F.coalesce("component", "rep")))
    low = of.groupBy("component").agg(F.min("rep_id").alias("component_id"))
    of = of.join(low, "component").select(
        "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    return (rows.select("id", "key").join(of, "key", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id")))


@query("op6_vector_lsh")
def op6(spark, sf_dir):
    found = near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))
