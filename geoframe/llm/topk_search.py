"""Exact top-k by inner product: three phases with a uniform threshold.

The components of every vector are dealt into ``slices`` lists; an entry of a list
is a row's partial score for a query, and a row's score the sum over the lists.
Lists are written once, spread over tasks, and never move; queries go to the tasks
in blocks of bounded size, whatever their number.  For each block:

1. Every task gives the best ``GATHER * k`` partial scores of its part of a list; the
   best of each list are scored exactly.  The k-th score found, t, is a safe cutoff:
   the answer holds nothing below it.
2. The cutoffs go to all tasks.  A row with a score of t has a partial score of
   t / slices in some list (of negative numbers, too), so every task gives all
   entries from there on.  An entry that cannot reach t even if the rest of both
   vectors were parallel (Cauchy-Schwarz) is left out.
3. Entries of a row are summed, rows whose missing lists (below t / slices) cannot
   lift them to t go, and what remains is scored exactly.

Two lists are the default: random vectors of 64 components send 2 % of the rows in
phase 2 where four send 20 % and eight nearly all.

Equal vectors are one row of a list, and equal queries one query, see
``int_vectors.py``.

Cases: vectors that are null or hold null or non-finite components take no part,
neither as queries nor as candidates; vectors of different lengths are not compared;
empty vectors score 0 with each other; rows with equal ids are rows of their own (a
query only leaves out its own row) and equal query rows come out each; ties go to
the smaller id, null ids last, which are no queries; fewer candidates than k: all of
them; an empty table gives an empty result; other columns are not looked at; a
component or score beyond 64 bits raises.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoframe.llm.common import materialise, query, table
from geoframe.llm.int_vectors import Factor, best_members, folded, integer_rows, products, query_blocks, unpacked
from geoframe.llm.joins import spread_join

SLICES = 2
GATHER = 8                # times k: entries of a list that phase 1 scores
CELLS = 4_000_000         # scores that a task holds at a time
LOWEST = -(1 << 62)       # cutoff of a query with fewer than k candidates


def _slice(dim: int, slices: int, s: int) -> slice:
    return slice(dim * s // slices, dim * (s + 1) // slices)


def _lists(slices: int):
    """mapInArrow: classes (cls, dim, vec) -> entries (s, cls, dim, part, rest),
    ``rest`` being at least the length of the vector's other components."""
    def run(batches):
        for batch in batches:
            cls, dims, vecs = np.asarray(batch.column(0)), np.asarray(batch.column(1)), batch.column(2).to_pylist()
            for dim in np.unique(dims).tolist():
                rows = np.nonzero(dims == dim)[0]
                ints = unpacked([vecs[i] for i in rows], dim)
                squares = ints.astype("float64") ** 2
                for s in range(slices):
                    own = _slice(dim, slices, s)
                    rest = squares[:, :own.start].sum(axis=1) + squares[:, own.stop:].sum(axis=1)
                    part = np.ascontiguousarray(ints[:, own], dtype="<i8")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), s, "int32")), pa.array(cls[rows]),
                         pa.array(np.full(len(rows), dim, "int32")),
                         pa.array([p.tobytes() for p in part], pa.binary()),
                         pa.array(np.sqrt(rest) * (1 + 1e-9))], names=["s", "cls", "dim", "part", "rest"])
    return run


class Queries:
    """A block of queries: class ids in order, and by length of their vectors their
    places in it, whole vectors and, per list, parts and lengths of the rest."""

    def __init__(self, rows: pa.Table, slices: int):
        order = np.argsort(rows.column("cls").to_numpy())
        self.cls = rows.column("cls").to_numpy()[order]
        dims = rows.column("dim").to_numpy()[order]
        vecs = rows.column("vec").to_pylist()
        self.at, self.whole, self.parts, self.rest = {}, {}, {}, {}
        self.row = np.zeros(len(order), "int64")            # of a query in its matrix
        for dim in np.unique(dims).tolist():
            at = self.at[dim] = np.nonzero(dims == dim)[0]
            self.row[at] = np.arange(len(at))
            ints = self.whole[dim] = unpacked([vecs[order[i]] for i in at], dim)
            squares = ints.astype("float64") ** 2
            for s in range(slices):
                own = _slice(dim, slices, s)
                self.parts[dim, s] = ints[:, own]
                self.rest[dim, s] = np.sqrt(squares[:, :own.start].sum(axis=1) + squares[:, own.stop:].sum(axis=1))

    def place(self, cls: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cls, cls)


def _stretches(batches, queries: Queries):
    """(dim, s, cls, factor, rest) of the entries that some query meets, few enough
    to hold their scores."""
    for batch in batches:
        lists, cls, dims = (np.asarray(batch.column(k)) for k in range(3))
        parts, rest = batch.column(3).to_pylist(), np.asarray(batch.column(4))
        kind = dims.astype("int64") * (1 << 20) + lists
        for one in np.unique(kind).tolist():
            dim, s = one >> 20, one & ((1 << 20) - 1)
            if dim not in queries.at:
                continue
            rows = np.nonzero(kind == one)[0]
            step = max(1, CELLS // len(queries.at[dim]))
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                ints = np.frombuffer(b"".join([parts[i] for i in part]), "<i8").reshape(
                    len(part), queries.parts[dim, s].shape[1])
                yield dim, s, cls[part], Factor(ints), rest[part]


def _entries(q, cls, partial, s=None):
    cols = [pa.array(q), pa.array(cls), pa.array(partial)]
    names = ["q", "cls", "partial"]
    if s is not None:
        cols.append(pa.array(np.full(len(q), s, "int32")))
        names.append("s")
    return pa.RecordBatch.from_arrays(cols, names=names)


def _local_best(shared, k: int):
    """Phase 1: the best ``k`` entries of every list, per query."""
    def run(batches):
        queries: Queries = shared.value
        factors = {key: Factor(x) for key, x in queries.parts.items()}
        best: dict[tuple, tuple] = {}
        for dim, s, cls, part, _ in _stretches(batches, queries):
            scores = products(part, factors[dim, s]).astype("int64")
            names = np.broadcast_to(cls[:, None], scores.shape)
            if (dim, s) in best:
                scores = np.concatenate([best[dim, s][0], scores])
                names = np.concatenate([best[dim, s][1], names])
            if len(scores) > k:
                top = np.argpartition(scores, len(scores) - k, axis=0)[len(scores) - k:]
                scores, names = np.take_along_axis(scores, top, 0), np.take_along_axis(names, top, 0)
            best[dim, s] = scores, np.ascontiguousarray(names)
        for (dim, s), (scores, names) in best.items():
            yield _entries(np.tile(queries.cls[queries.at[dim]], len(scores)), names.ravel(), scores.ravel(), s)
    return run


def _exact(shared):
    """mapInArrow over (q, cls, dim, vec): the score of each pair."""
    def run(batches):
        queries: Queries = shared.value
        for batch in batches:
            q, cls, dims = (np.asarray(batch.column(k)) for k in range(3))
            vecs, score = batch.column(3).to_pylist(), np.zeros(batch.num_rows, "int64")
            for dim in np.unique(dims).tolist():
                rows = np.nonzero(dims == dim)[0]
                for at in range(0, len(rows), 8192):
                    part = rows[at:at + 8192]
                    x = unpacked([vecs[i] for i in part], dim)
                    y = queries.whole[dim][queries.row[queries.place(q[part])]]
                    a, b = Factor(x), Factor(y)
                    if a.bound(b) < 1 << 63:
                        score[part] = (x * y).sum(axis=1)
                    else:
                        exact = (x.astype(object) * y.astype(object)).sum(axis=1)
                        if exact.max() >= 1 << 63 or exact.min() < -(1 << 63):
                            raise OverflowError("an inner product beyond 64 bits")
                        score[part] = exact.astype("int64")
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(cls), pa.array(score)],
                                             names=["q", "cls", "score"])
    return run


def _above(shared, cutoffs, slices: int):
    """Phase 2: all entries that may belong to a score of the cutoff."""
    def run(batches):
        queries: Queries = shared.value
        factors = {key: Factor(x) for key, x in queries.parts.items()}
        for dim, s, cls, part, rest in _stretches(batches, queries):
            low = cutoffs.value[queries.at[dim]]
            partial = products(part, factors[dim, s])
            reach = low - queries.rest[dim, s] * rest[:, None] * (1 + 1e-9) - 1
            x, q = np.nonzero((partial >= -(-low // slices)) & (partial >= reach))
            if len(x):
                yield _entries(queries.cls[queries.at[dim]][q], cls[x], partial[x, q].astype("int64"))
    return run


def _may_reach(shared, cutoffs, slices: int):
    """mapInArrow over (q, cls, partial, lists): pairs whose sum, with all that the
    missing lists can add, reaches the cutoff."""
    def run(batches):
        queries: Queries = shared.value
        for batch in batches:
            partial, lists = np.asarray(batch.column(2)), np.asarray(batch.column(3))
            low = cutoffs.value[queries.place(np.asarray(batch.column(0)))]
            # as floats, with room for their rounding: lists may lack much of 64 bits
            most = partial + (slices - lists) * (-(-low // slices) - 1).astype("float64")
            keep = (low == LOWEST) | (most + np.abs(most) * 1e-9 + 1 >= low)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)),
                                              batch.column(1).filter(pa.array(keep))], names=["q", "cls"])
    return run


def _block(queries: pa.Table, lists: DataFrame, classes: DataFrame, k: int, slices: int) -> DataFrame:
    """(q, cls, score) of the classes from each query's cutoff on."""
    spark = lists.sparkSession
    held = Queries(queries, slices)
    shared = spark.sparkContext.broadcast(held)
    best = Window.partitionBy("q", "s").orderBy(F.desc("partial"), "cls")
    pairs = (lists.mapInArrow(_local_best(shared, GATHER * k), "q long, cls long, partial long, s int")
             .withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= GATHER * k)
             .select("q", "cls").distinct())
    vectors = classes.select("cls", "dim", "vec")

    def scored(pairs: DataFrame, name: str) -> DataFrame:
        return spread_join(materialise(pairs, name), vectors, ["cls"], ["dim", "vec"]) \
            .select("q", "cls", "dim", "vec").mapInArrow(_exact(shared), "q long, cls long, score long")

    by = Window.partitionBy("q").orderBy(F.desc("score"))
    cut = scored(pairs, "topk-local").withColumn("rn", F.row_number().over(by)).where(F.col("rn") == k) \
        .select("q", "score").toArrow()                     # a row per query of the block at the most
    low = np.full(len(held.cls), LOWEST, "int64")
    low[held.place(cut.column("q").to_numpy())] = cut.column("score").to_numpy()
    cutoffs = spark.sparkContext.broadcast(low)
    pairs = (lists.mapInArrow(_above(shared, cutoffs, slices), "q long, cls long, partial long")
             .groupBy("q", "cls").agg(F.sum("partial").alias("partial"), F.count(F.lit(1)).alias("lists"))
             .mapInArrow(_may_reach(shared, cutoffs, slices), "q long, cls long"))
    return materialise(scored(pairs, "topk-entries"), "topk-scores")


def top_inner_products(df: DataFrame, id_col: str, vec: str, is_query: Column, k: int = 5,
                       slices: int = SLICES) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows with the highest integer inner
    products with each row that ``is_query`` holds for, its own left out."""
    if k < 1 or slices < 1:
        raise ValueError("k and slices are 1 at least")
    rows = integer_rows(df, id_col, vec, "topk-rows", is_query=is_query)
    # the query's own row is among its best or not; so one more is looked for
    classes = folded(rows, ["dim", "vec"], k + 1, "topk-classes")
    asking = materialise(spread_join(rows.where("is_query").select("uid", "id", "dim", "vec"), classes,
                                     ["dim", "vec"], ["cls"]).select("uid", "id", "cls"), "topk-queries")
    lists = materialise(classes.select("cls", "dim", "vec").mapInArrow(
        _lists(slices), "s int, cls long, dim int, part binary, rest double"), "topk-lists")
    queries = materialise(classes.join(asking.select("cls").distinct(), "cls", "left_semi")
                          .select("cls", "dim", "vec"), "topk-vectors")
    found = None
    for block in query_blocks(queries):
        part = _block(block.toArrow(), lists, classes, k + 1, slices)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], "q long, cls long, score long")
    best = best_members(found, classes, ["q"], k + 1).withColumnRenamed("q", "cls")
    out = spread_join(asking, best, ["cls"], ["best"])
    own = F.filter("best", lambda b: b["uid"] != F.col("uid"))
    return out.select(F.col("id").alias("query_id"), F.posexplode(F.slice(own, 1, k)).alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.id").alias("id"), "b.score")


@query("op11_topk_threshold")
def op11(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    found = top_inner_products(vectors, "vec_id", "embedding", F.col("vec_id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")
