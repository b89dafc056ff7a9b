"""Polyline -> segment rows (one row per pair of consecutive vertices).

Per part of *n* vertices there are *n - 1* segments; segments never cross
parts; parts with fewer than two vertices yield none.

Pure Catalyst expressions, linear in the number of vertices: a per-vertex
(part, index-in-part) array is built once, the segments of a geometry are
built as one array of small structs (consecutive vertices of the same part),
and ``inline`` turns them into rows.  The coordinate array itself is never
repeated per output row, and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoframe.functions.geometry import col_of


def vertex_parts(xy_num) -> Column:
    """Per vertex: struct(p = part number, k = index inside the part)."""
    num = col_of(xy_num)
    empty = F.array().cast("array<int>")
    return F.flatten(F.transform(num, lambda n, p: F.transform(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(empty),
        lambda k: F.struct(p.alias("p"), k.alias("k")))))


def segments(df: DataFrame, geom: str, keep: list[str] | None = None,
             stride: int = 3) -> DataFrame:
    """Explode the poly column ``geom`` into segments.

    Output: ``keep`` columns, ``part`` (0-based), ``seg`` (0-based within the
    part), then ``ax, ay[, am], bx, by[, bm]``.  ``stride`` 3 reads x, y, m
    triples (polylineM); 2 reads x, y pairs and emits no m.
    """
    keep = list(keep or [])
    g = F.col(geom)
    base = df.select(*keep, g.getField("xyArr").alias("_arr"),
                     vertex_parts(g.getField("xyNum")).alias("_v"))
    v, arr = F.col("_v"), F.col("_arr")
    names = ["x", "y", "m"][:stride]

    def seg(j):
        a = j * stride
        b = a + stride
        fields = [F.get(v, j).getField("p").alias("part"),
                  F.get(v, j).getField("k").alias("seg"),
                  F.get(v, j + 1).getField("p").alias("_pb")]
        fields += [F.get(arr, a + k).alias("a" + nm) for k, nm in enumerate(names)]
        fields += [F.get(arr, b + k).alias("b" + nm) for k, nm in enumerate(names)]
        return F.struct(*fields)

    nv = F.size(v)
    all_pairs = F.transform(F.sequence(F.lit(0), F.greatest(nv - 2, F.lit(0))), seg)
    same_part = F.filter(all_pairs, lambda s: s.getField("part") == s.getField("_pb"))
    segs = F.when(nv >= 2, same_part)
    out = base.select(*keep, F.inline(segs))
    cols = ["part", "seg"] + ["a" + nm for nm in names] + ["b" + nm for nm in names]
    return out.select(*keep, *cols)
