"""Vectors of whole numbers: ``floor(256 * x)`` per component, exact products.

Rows whose vectors are null or hold null or non-finite components have no part.
Equal rows are folded into classes: whatever asks for the first ``top`` rows by
score, then id, needs the ``top`` smallest ids of a class only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoframe.llm.common import materialise
from geoframe.llm.joins import spread_join

SCALE = 256
BLOCK_BYTES = 32 << 20    # of the queries that are broadcast at a time
EXACT = 1 << 53           # below it sums of products are exact in float64


def _floored(col: pa.ListArray) -> list[bytes | None]:
    """Components as little-endian integers (32 bits if they fit, else 64)."""
    out: list[bytes | None] = []
    size = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(col)
    gap = flat.is_null().to_numpy(zero_copy_only=False)
    x = np.floor(pc.fill_null(flat, 0).cast(pa.float64()).to_numpy(zero_copy_only=False) * SCALE)
    bad = gap | ~np.isfinite(pc.fill_null(flat, 0).cast(pa.float64()).to_numpy(zero_copy_only=False))
    at = 0
    for n in size.tolist():
        if n < 0:
            out.append(None)
            continue
        part, at = slice(at, at + n), at + n
        if bad[part].any():
            out.append(None)
            continue
        most = np.abs(x[part]).max(initial=0)
        if not most < 2.0 ** 63:
            raise OverflowError("a component beyond 64 bits")
        out.append(x[part].astype("<i4" if most < 2.0 ** 31 else "<i8").tobytes())
    return out


def integer_rows(df: DataFrame, id_col: str, vec: str, name: str, **more) -> DataFrame:
    """(uid, id, dim, vec, and the columns ``more``) of the rows that have a part,
    written once: ``uid`` names a row for good."""
    extra = {f"m_{k}": c for k, c in more.items()}
    base = df.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
                     F.col(vec).cast("array<double>").alias("vec"), *[c.alias(k) for k, c in extra.items()])
    kept = [f for f in base.schema.fields if f.name != "vec"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)

    def run(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            col = t.column("vec").combine_chunks()
            size = pc.list_value_length(col)
            t = t.drop_columns("vec").append_column("dim", size.cast(pa.int32()))
            t = t.append_column("vec", pa.array(_floored(col), pa.binary()))
            yield from t.filter(pc.is_valid(t.column("vec"))).combine_chunks().to_batches()

    out = materialise(base.mapInArrow(run, schema + ", dim int, vec binary"), name)
    return out.withColumnsRenamed({k: k[2:] for k in extra})


def folded(rows: DataFrame, keys: list[str], top: int, name: str) -> DataFrame:
    """One row per class of rows with equal ``keys``: ``cls`` (the uid of its first
    row) and ``members``, its first ``top`` rows as (id, uid) by id (null last).
    Spark keeps ``top`` rows a class before it shuffles, so no task meets a large
    class whole."""
    by = Window.partitionBy(*keys).orderBy(F.col("id").asc_nulls_last(), "uid")
    first = rows.select(*keys, "id", "uid").withColumn("rn", F.row_number().over(by)).where(F.col("rn") <= top)
    made = first.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rn", "id", "uid"))).alias("m"))
    return materialise(made.select(F.col("m")[0]["uid"].alias("cls"), *keys, F.transform(
        "m", lambda x: F.struct(x["id"].alias("id"), x["uid"].alias("uid"))).alias("members")), name)


def unpacked(vecs: list[bytes], dim: int) -> np.ndarray:
    """The vectors as rows of an int64 matrix."""
    out = np.empty((len(vecs), dim), "int64")
    short = [i for i, v in enumerate(vecs) if len(v) == 4 * dim]
    if len(short) == len(vecs):
        return np.frombuffer(b"".join(vecs), "<i4").reshape(-1, dim).astype("int64") if dim else out
    for i, v in enumerate(vecs):
        out[i] = np.frombuffer(v, "<i4" if len(v) == 4 * dim else "<i8")
    return out


class Factor:
    """A matrix of integers, ready to be multiplied exactly."""

    def __init__(self, ints: np.ndarray):
        self.ints = ints
        self.most = int(max(int(ints.max(initial=0)), -int(ints.min(initial=0))))
        self.floats = ints.astype("float64")

    def __getitem__(self, rows) -> "Factor":
        return Factor(self.ints[rows])

    def __len__(self) -> int:
        return len(self.ints)

    def bound(self, other: "Factor") -> int:
        return self.most * other.most * max(1, self.ints.shape[1])


def products(a: Factor, b: Factor) -> np.ndarray:
    """All inner products (rows of ``a`` x rows of ``b``), float64 where these are
    exact, else int64; raises if one may be beyond 64 bits and is."""
    most = a.bound(b)
    if most < EXACT:
        return a.floats @ b.floats.T
    if most < 1 << 63:
        return a.ints @ b.ints.T
    out = a.ints.astype(object) @ b.ints.T.astype(object)
    if out.size and (out.max() >= 1 << 63 or out.min() < -(1 << 63)):
        raise OverflowError("an inner product beyond 64 bits")
    return out.astype("int64")


def query_blocks(queries: DataFrame) -> list[DataFrame]:
    """Rows with ``cls`` and ``vec`` in blocks of some ``BLOCK_BYTES``, dealt by a hash."""
    n = queries.agg(F.sum(F.octet_length("vec") + 64)).first()[0] or 0
    blocks = int(-(-n // BLOCK_BYTES))
    of = F.pmod(F.xxhash64("cls"), F.lit(max(blocks, 1)))
    return [queries.where(of == b) for b in range(blocks)]


def best_members(found: DataFrame, classes: DataFrame, keys: list[str], top: int) -> DataFrame:
    """``found``: (keys, cls, score).  Per key ``best``: the ``top`` rows by score, then
    id (null last), as an array of (rn, id, uid, score).  Of the classes, those that
    are not among the first ``top`` by score and smallest id cannot matter."""
    ids = spread_join(found, classes.select("cls", "members", F.col("members")[0].alias("first")), ["cls"],
                      ["members", "first"])
    by = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("first.id").asc_nulls_last(), "cls")
    ids = (ids.withColumn("rn", F.row_number().over(by)).where(F.col("rn") <= top)
           .select(*keys, "score", F.explode("members").alias("m")).select(*keys, "score", "m.id", "m.uid"))
    by = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "uid")
    return (ids.withColumn("rn", F.row_number().over(by)).where(F.col("rn") <= top).groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("rn", "id", "uid", "score"))).alias("best")))
