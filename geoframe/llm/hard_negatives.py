"""Hard negatives: rows of other labels that score nearly as well as a positive.

A score is the integer inner product (``int_vectors.py``).  An anchor's positives are
its first rows of the same label; a negative's score lies in a window of ``low`` to
``high`` percent of the positive's.  Both are found in cover trees (``cover_tree.py``)
of ``TREE`` vectors each, which are built once and written.  Anchors go to the tasks in
blocks of bounded size; every tree is searched best-first for each anchor, nodes
outside its windows are skipped, leaves are verified exactly, and what the trees give
(a few rows per anchor and window) is merged by Spark.

Equal vectors of a label are one leaf entry, and equal anchors of a label one query.

Cases: rows with a null label, a null vector, or null or non-finite components take
no part; vectors of different lengths are not compared; empty vectors score 0 with
each other; rows with equal ids are rows of their own, equal anchor rows come out
each, and an anchor only leaves out its own row; ties go to the smaller id, null ids
last; fewer positives or negatives than asked for: all of them; a positive with a
negative score has an empty window; an empty table gives an empty result; other
columns are not looked at; a component or score beyond 64 bits raises.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoframe.llm import cover_tree
from geoframe.llm.common import materialise, query, table
from geoframe.llm.int_vectors import Factor, best_members, folded, integer_rows, query_blocks, unpacked
from geoframe.llm.joins import spread_join

TREE = 16_384             # vectors of a tree
NO_ID = (1 << 63) - 1     # sorts null ids last; folded() has put them behind the others
NODES = ("tree long, dim int, most double, node int, parent int, radius double, centre binary, "
         "classes binary, labels binary, firsts binary, vecs binary")


def _trees(size: int):
    """mapInArrow: classes (cls, dim, label, first, vec) -> rows of nodes."""
    def run(batches):
        made = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def rows_of(dim, rows):
            nonlocal made
            made += 1
            cls, label, first = (np.array([r[k] for r in rows], "<i8") for k in range(3))
            ints = unpacked([r[3] for r in rows], dim).astype("<i8")
            nodes, most = cover_tree.build(ints)
            out = {n: [] for n in ("tree", "dim", "most", "node", "parent", "radius", "centre", "classes",
                                   "labels", "firsts", "vecs")}
            for i, (parent, centre, radius, own) in enumerate(nodes):
                leaf = [None] * 4 if own is None else [a[own].tobytes() for a in (cls, label, first, ints)]
                for name, value in zip(out, (made, dim, float(most), i, parent, radius,
                                             ints[centre].tobytes(), *leaf)):
                    out[name].append(value)
            kinds = dict.fromkeys(out, pa.binary()) | {"tree": pa.int64(), "dim": pa.int32(), "most": pa.float64(),
                                                       "node": pa.int32(), "parent": pa.int32(),
                                                       "radius": pa.float64()}
            return pa.RecordBatch.from_arrays([pa.array(v, kinds[n]) for n, v in out.items()], names=list(out))

        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for c, dim, label, first, vec in zip(*cols):
                own = held.setdefault(dim, [])
                own.append((c, label, NO_ID if first is None else first, vec))
                if len(own) >= size:
                    yield rows_of(dim, held.pop(dim))
        for dim, rows in held.items():
            yield rows_of(dim, rows)
    return run


class Anchors:
    """A block of anchors by length: class, label, vector and windows (named by the
    positive's score; None: one window that holds all)."""

    def __init__(self, rows: pa.Table, windows: dict[int, list[tuple]] | None):
        self.by_dim: dict[int, list] = {}
        for cls, dim, label, vec in zip(*[rows.column(c).to_pylist() for c in ("cls", "dim", "label", "vec")]):
            own = [(None, -np.inf, np.inf)] if windows is None else windows.get(cls)
            if own:
                self.by_dim.setdefault(dim, []).append((cls, label, unpacked([vec], dim), own))


def _forests(batches):
    """Runs of nodes of one tree, as they come."""
    held, key = [], None
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:3] != key and held:
                yield key, held
                held = []
            key = row[:3]
            held.append(row[3:])
    if held:
        yield key, held


def _searched(shared, same: bool, top: int):
    """mapInArrow over nodes: (q, positive_score, cls, score) of what each tree has."""
    def run(batches):
        anchors: Anchors = shared.value
        factors = {dim: [Factor(a[2]) for a in own] for dim, own in anchors.by_dim.items()}
        for (_, dim, most), rows in _forests(batches):
            nodes = []
            for node, parent, radius, centre, classes, labels, firsts, vecs in rows:
                leaf = None
                if classes is not None:
                    own = np.frombuffer(classes, "<i8")
                    leaf = (own, np.frombuffer(labels, "<i8"), np.frombuffer(firsts, "<i8"),
                            Factor(np.frombuffer(vecs, "<i8").reshape(len(own), dim)))
                nodes.append((node, parent, radius, np.frombuffer(centre, "<i8"), leaf))
            tree = cover_tree.Tree(nodes, most)
            out = []
            for (cls, label, _, windows), q in zip(anchors.by_dim.get(dim, ()), factors.get(dim, ())):
                found = tree.search(q, label, same, [w[1:] for w in windows], top)
                out += [(cls, w[0], c, -s) for w, got in zip(windows, found) for s, _, c in got]
            for at in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[k] for o in out[at:at + 50_000]], pa.int64()) for k in range(4)],
                    names=["q", "positive_score", "cls", "score"])
    return run


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores n with ``low * score <= 100 * n <= high * score``."""
    return -(-low * score // 100), high * score // 100


def mine_negatives(df: DataFrame, id_col: str, vec: str, label: Column, is_anchor: Column, positives: int = 5,
                   negatives: int = 3, low: int = 50, high: int = 95, tree: int = TREE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for
    each row that ``is_anchor`` holds for, each of its first ``positives`` other rows of
    the same label, and the first ``negatives`` rows of other labels in the window."""
    rows = integer_rows(df.where(label.isNotNull()), id_col, vec, "negatives-rows", is_anchor=is_anchor,
                        label=label.cast("long"))
    spark, keys = df.sparkSession, ["dim", "vec", "label"]
    classes = folded(rows, keys, max(positives + 1, negatives), "negatives-classes")
    asking = materialise(spread_join(rows.where("is_anchor").select("uid", "id", *keys), classes, keys, ["cls"])
                         .select("uid", "id", "cls"), "negatives-anchors")
    nodes = materialise(classes.select("cls", "dim", "label", F.col("members")[0]["id"].alias("first"), "vec")
                        .mapInArrow(_trees(tree), NODES), "negatives-trees")
    anchors = materialise(classes.join(asking.select("cls").distinct(), "cls", "left_semi")
                          .select("cls", *keys), "negatives-queries")

    def searched(block, windows, same, top, name):
        shared = spark.sparkContext.broadcast(Anchors(block, windows))
        return materialise(nodes.mapInArrow(_searched(shared, same, top),
                                            "q long, positive_score long, cls long, score long"), name)

    def merged(parts, columns, top):
        found = parts[0] if parts else spark.createDataFrame(
            [], "q long, positive_score long, cls long, score long")
        for part in parts[1:]:
            found = found.unionByName(part)
        return best_members(found, classes, columns, top).withColumnRenamed("q", "cls")

    blocks = query_blocks(anchors)
    best = merged([searched(b.toArrow(), None, True, positives + 1, "negatives-positives") for b in blocks],
                  ["q"], positives + 1)
    own = F.filter("best", lambda b: b["uid"] != F.col("uid"))
    pairs = materialise(
        spread_join(asking, best, ["cls"], ["best"])
        .select("cls", F.col("id").alias("anchor_id"), F.posexplode(F.slice(own, 1, positives)).alias("at", "p"))
        .select("cls", "anchor_id", "at", F.col("p.id").alias("positive_id"),
                F.col("p.score").alias("positive_score")), "negatives-pairs")

    found = []
    for b in blocks:
        asked = pairs.select("cls", "positive_score").distinct().join(b.select("cls"), "cls", "left_semi").toArrow()
        windows: dict[int, list[tuple]] = {}         # a few per anchor of the block
        for cls, score in zip(asked.column("cls").to_pylist(), asked.column("positive_score").to_pylist()):
            lo, hi = window(score, low, high)
            if lo <= hi:
                windows.setdefault(cls, []).append((score, lo, hi))
        found.append(searched(b.toArrow(), windows, False, negatives, "negatives-found"))
    best = merged(found, ["q", "positive_score"], negatives)
    out = spread_join(pairs, best, ["cls", "positive_score"], ["best"])
    return out.select("anchor_id", "positive_id", F.posexplode("best").alias("at", "b"), "positive_score").select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.id").alias("negative_id"),
        "positive_score", F.col("b.score").alias("negative_score"))


@query("op12_negatives_cover_tree")
def op12(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.col("vec_id") % 50 == 0)
