"""Polylines assembled from vertex rows (one row per vertex, ordered within
a group), e.g. a track per user from timestamped events.

A polyline is one value, so a group's vertices must meet in one row - and a
group may hold a third of all rows.  The group is therefore cut into
*pieces* of at most ``max_vertices`` vertices; consecutive pieces share their
boundary vertex, so the union of the pieces' segments is exactly the
segments of the whole track (nothing dropped, nothing capped).  Ranks come
from the skew-safe ordered scan; each piece is a small bounded
``collect_list``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.functions.geometry import poly, poly_from_coords
from geoframe.operators.ordered import running_sum

PIECE = 8192              # vertices of the pieces that a whole track is made of
FAN = 64                  # pieces that are joined at a time


def polylines_from_rows(df: DataFrame, group_cols: list[str], order_cols: list[str],
                        x: str, y: str, m: str | None = None,
                        max_vertices: int | None = None, num_ranges: int | None = None) -> DataFrame:
    """One polyline (or polylineM when ``m`` is given) per group piece.

    Output: ``group_cols``, ``piece`` (0-based), ``Shape`` (poly struct, one
    part, bbox from its vertices), ``n_vertices``, ``first_rank``.  Without
    ``max_vertices`` a group is one polyline, however long (it then is one row, joined
    from bounded pieces by a tree of groupings); with it, tracks are cut and piece *p*
    holds ranks ``p*(K-1) .. (p+1)*(K-1)`` with ``K = max_vertices``.
    """
    if max_vertices is None:
        return _whole(df, group_cols, order_cols, x, y, m, num_ranges)
    if max_vertices < 2:
        raise ValueError("max_vertices must be at least 2")
    step = max_vertices - 1
    needed = list(dict.fromkeys([*group_cols, *order_cols, x, y, *([m] if m else [])]))
    ranked = running_sum(df.select(*needed), group_cols, order_cols,
                         {"_rk": F.lit(1).cast("long")}, num_ranges)
    rk = F.col("_rk") - 1
    q = F.floor(rk / F.lit(step)).cast("long")
    # a vertex opens piece rk // step; a vertex on a boundary also closes the previous one
    pieces = F.when((rk % step == 0) & (rk > 0), F.array(q, q - 1)).otherwise(F.array(q))
    exploded = ranked.select(*group_cols, rk.alias("rk"), F.col(x).cast("double").alias("_x"),
                             F.col(y).cast("double").alias("_y"),
                             *([F.col(m).cast("double").alias("_m")] if m else []),
                             F.explode(pieces).alias("piece"))
    vert = F.struct(F.col("rk"), F.col("_x"), F.col("_y"), *([F.col("_m")] if m else []))
    grouped = exploded.groupBy(*group_cols, "piece").agg(
        F.sort_array(F.collect_list(vert)).alias("_verts"))
    n = F.size("_verts")
    # a last piece holding only the shared boundary vertex adds no segment
    grouped = grouped.filter((n > 1) | (F.col("piece") == 0))
    coords = F.flatten(F.transform("_verts", lambda v: F.array(
        v.getField("_x"), v.getField("_y"), *([v.getField("_m")] if m else []))))
    return grouped.select(*group_cols, "piece",
                          poly_from_coords(coords, None, 3 if m else 2).alias("Shape"),
                          n.alias("n_vertices"),
                          F.get(F.col("_verts"), 0).getField("rk").alias("first_rank"))


def _whole(df, group_cols, order_cols, x, y, m, num_ranges) -> DataFrame:
    """One polyline per group, from pieces of ``PIECE`` vertices that are joined
    ``FAN`` at a time, with their boxes; only the last join holds a whole track."""
    names = ["_x", "_y", *(["_m"] if m else [])]
    needed = list(dict.fromkeys([*group_cols, *order_cols, x, y, *([m] if m else [])]))
    ranked = running_sum(df.select(*needed), group_cols, order_cols, {"_rk": F.lit(1).cast("long")}, num_ranges)
    ranked = ranked.select(*group_cols, "_rk", *[F.col(c).cast("double").alias(n)
                                                 for n, c in zip(names, (x, y, m))])
    pieces = -(-(ranked.agg(F.max("_rk")).first()[0] or 0) // PIECE)
    vertices = F.sort_array(F.collect_list(F.struct("_rk", F.array(*names).alias("xy"))))
    box = [F.min("_x").alias("_x0"), F.min("_y").alias("_y0"), F.max("_x").alias("_x1"), F.max("_y").alias("_y1")]
    parts = ranked.groupBy(*group_cols, F.floor((F.col("_rk") - 1) / PIECE).alias("_at")).agg(
        F.flatten(vertices["xy"]).alias("_xy"), *box, F.count(F.lit(1)).alias("_n"))
    while pieces > 1:
        joined = F.sort_array(F.collect_list(F.struct("_at", "_xy")))
        parts = parts.groupBy(*group_cols, F.floor(F.col("_at") / FAN).alias("_up")).agg(
            F.flatten(joined["_xy"]).alias("_xy"), F.min("_x0").alias("_x0"), F.min("_y0").alias("_y0"),
            F.max("_x1").alias("_x1"), F.max("_y1").alias("_y1"), F.sum("_n").alias("_n")) \
            .withColumnRenamed("_up", "_at")
        pieces = -(-pieces // FAN)
    n = F.col("_n").cast("int")
    return parts.select(*group_cols, F.lit(0).cast("long").alias("piece"),
                        poly("_x0", "_y0", "_x1", "_y1", F.array(n), F.col("_xy")).alias("Shape"),
                        n.alias("n_vertices"), F.lit(0).cast("long").alias("first_rank"))
