"""Helpers shared by the training-data operators: shared scratch tables,
table access and distributed connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.session import shared_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; makes the package importable on executors."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the session names."""
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.  This cuts the
    lineage: a lost executor re-reads the table instead of recomputing it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame, *prefixes: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns whose names begin like an operator's own (whatever
    their case) under names that no column has, and these names by the given ones."""
    taken = {c.lower() for c in docs.columns}
    names: dict[str, str] = {}
    for c in docs.columns:
        new = c
        if c.lower().startswith(prefixes):
            new = f"given_{c}"
            while new.lower() in taken:
                new = f"given_{new}"
            taken.add(new.lower())
        names[c] = new
    return docs.toDF(*names.values()) if any(k != v for k, v in names.items()) else docs, names


def put_back(df: DataFrame, names: dict[str, str], *added: str) -> DataFrame:
    """The given columns under their own names, then the added ones.  A given column
    of an added one's name gives way to it."""
    new = {c.lower() for c in added}
    own = [F.col(f"`{v}`").alias(k) for k, v in names.items() if k.lower() not in new]
    return df.select(*own, *added)


def _local_union(batches):
    """mapInArrow: union-find over one partition's edges; every node but the
    roots comes out once, linked to the smallest node of its local tree."""
    import numpy as np
    import pyarrow as pa
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (p := parent.get(root, root)) != root:
            root = p
        while (p := parent.get(x, x)) != root and p != x:
            parent[x] = root
            x = p
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                lo, hi = (ra, rb) if ra < rb else (rb, ra)
                parent[hi] = lo
    out = [(x, find(x)) for x in list(parent)]
    for i in range(0, len(out), 65536):
        part = np.array(out[i:i + 65536], dtype="int64").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph.

    ``edges`` has long columns ``a`` and ``b`` (nulls, self links, repeats and
    either direction allowed); the result has one row per node that has an
    edge: ``node`` and ``component`` (its smallest reachable node).

    First every partition contracts its own edges with union-find (what leaves
    a partition is at most one edge per node seen there), then rounds of
    large-star / small-star run on what is left until nothing changes.  Both
    steps only use ``min`` per node (partial aggregation) and a join, never a
    list per node, and each round is written to the shared folder, so neither
    a hub nor a long chain meets in one task.  The driver sees two numbers a
    round.
    """
    # edges that Python makes are written first: a stage with two Python steps takes two
    # workers for each core, and Spark keeps them, so that later steps run in all of them
    edges = materialise(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
                        .select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "cc-edges")
    cur = edges.mapInArrow(_local_union, "a long, b long")
    cur = materialise(cur.select(F.col("a").alias("v"), F.col("b").alias("u")).distinct(), "cc")
    seen = None
    while True:
        # large star: every larger neighbour points at the smallest neighbour
        both = cur.select("v", "u").unionAll(cur.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")) \
            .select("v", F.least("v", "m").alias("m"))
        large = (both.join(low, "v").where("u > v")
                 .select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").distinct())
        # small star: smaller neighbours and the node itself point at the smallest
        down = large.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u")).distinct()
        low = down.groupBy("v").agg(F.min("u").alias("m"))
        small = (down.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .unionAll(low.select("v", F.col("m").alias("u"))).where("v <> u").distinct())
        cur = materialise(small, "cc")
        state = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = cur.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return cur.select(F.col("v").alias("node"), F.col("u").alias("component")).unionAll(roots)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` as a query, with its SQL where it has one."""
    def wrap(fn):
        REGISTRY[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap
