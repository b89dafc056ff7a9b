"""T checks: column functions and DataFrame operators over the driver's
parquet tables, each paired with DuckDB SQL that computes the same rows.

Results are flat scalar columns (arrays exploded, structs split) so that the
comparison does not depend on how nested values are hashed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.functions import columns as C
from geoframe.functions import geometry as G
from geoframe.operators.ordered import assign_object_ids, ordered_scan
from geoframe.operators.segments import segments
from geoframe.plans.registry import query, table
from geoframe.session import register, shared_path


def xym(e="embedding"):
    """Whole embedding as polylineM ordinates: consecutive values are the
    x, y of each vertex, m is the vertex number."""
    e = F.col(e)
    n = (F.size(e) / 2).cast("int")
    triples = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array(
        F.get(e, 2 * i).cast("double"), F.get(e, 2 * i + 1).cast("double"), i.cast("double")))
    return F.when(n > 0, F.flatten(triples)).otherwise(F.array().cast("array<double>"))


# the same in DuckDB
XYM_SQL = ("flatten([[CAST(embedding[2 * i + 1] AS DOUBLE), CAST(embedding[2 * i + 2] AS DOUBLE), "
           "CAST(i AS DOUBLE)] FOR i IN range(len(embedding) // 2)])")


def _emb_poly_m(spark, sf_dir):
    """polylineM from the whole embedding (one vertex per value pair)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", G.poly_from_coords(xym(), None, 3).alias("Shape"))


def _flat_poly(g: str):
    s = F.col(g)
    return [s.getField("xmin").alias("xmin"), s.getField("ymin").alias("ymin"),
            s.getField("xmax").alias("xmax"), s.getField("ymax").alias("ymax")]


# ---------------------------------------------------------------- segments E8

_SEG_SQL = """
WITH p AS (
  SELECT vec_id, {xym} AS arr, {num} AS num
  FROM embeddings
), parts AS (
  SELECT vec_id, arr, i - 1 AS part, num[i] AS n, CAST(coalesce(list_sum(num[1:i-1]), 0) AS BIGINT) AS s
  FROM p, range(1, len(num) + 1) r(i)
)
SELECT vec_id, CAST(part AS INTEGER) AS part, CAST(j AS INTEGER) AS seg,
       arr[(s + j) * 3 + 1] AS ax, arr[(s + j) * 3 + 2] AS ay, arr[(s + j) * 3 + 3] AS am,
       arr[(s + j + 1) * 3 + 1] AS bx, arr[(s + j + 1) * 3 + 2] AS by,
       arr[(s + j + 1) * 3 + 3] AS bm
FROM parts, range(0, n - 1) q(j)
"""


@query("segments_m", _SEG_SQL.format(xym=XYM_SQL, num="[CAST(len(embedding) // 2 AS INTEGER)]"))
def segments_m(spark, sf_dir):
    return segments(_emb_poly_m(spark, sf_dir), "Shape", keep=["vec_id"], stride=3)


def _multi_num():
    """Three parts: 1-5 vertices, 0-6 vertices (an empty part), the rest."""
    a = (F.col("vec_id") % 5 + 1).cast("int")
    b = (F.col("vec_id") % 7).cast("int")
    return F.array(a, b, ((F.size("embedding") / 2).cast("int") - a - b).cast("int"))


_MULTI_NUM_SQL = ("[CAST(vec_id % 5 + 1 AS INTEGER), CAST(vec_id % 7 AS INTEGER), "
                  "CAST(len(embedding) // 2 - (vec_id % 5 + 1) - vec_id % 7 AS INTEGER)]")


@query("segments_multipart", _SEG_SQL.format(xym=XYM_SQL, num=_MULTI_NUM_SQL))
def segments_multipart(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    poly = emb.select("vec_id", G.poly_from_coords(xym(), _multi_num(), 3).alias("Shape"))
    return segments(poly, "Shape", keep=["vec_id"], stride=3)


@query("segments_sql", _SEG_SQL.format(xym=XYM_SQL, num=_MULTI_NUM_SQL))
def segments_sql(spark, sf_dir):
    """The segments of the same geometries by the SQL table function."""
    emb = table(spark, sf_dir, "embeddings")
    emb.select("vec_id", G.poly_from_coords(xym(), _multi_num(), 3).alias("Shape")) \
        .createOrReplaceTempView("gf_segment_polys")
    return spark.sql("SELECT vec_id, s.* FROM gf_segment_polys, LATERAL segmentsM(Shape) s")


# ----------------------------------------------------------- constructors E1

@query("make_point", """
SELECT c_custkey, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer
""")
def make_point(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    p = c.select("c_custkey", G.point("c_acctbal", "c_nationkey").alias("Shape"))
    return p.select("c_custkey", G.get_x("Shape").alias("x"), G.get_y("Shape").alias("y"))


@query("make_point_m", """
SELECT l_orderkey, l_linenumber, l_extendedprice AS x, l_quantity AS y, l_tax AS m FROM lineitem
""")
def make_point_m(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = li.select("l_orderkey", "l_linenumber",
                  G.point_m("l_extendedprice", "l_quantity", "l_tax").alias("Shape"))
    return p.select("l_orderkey", "l_linenumber", G.get_x("Shape").alias("x"),
                    G.get_y("Shape").alias("y"), G.get_m("Shape").alias("m"))


@query("make_point_z", """
SELECT l_orderkey, l_linenumber, l_extendedprice AS x, l_quantity AS y, l_discount AS z
FROM lineitem
""")
def make_point_z(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = li.select("l_orderkey", "l_linenumber",
                  G.point_z("l_extendedprice", "l_quantity", "l_discount").alias("Shape"))
    return p.select("l_orderkey", "l_linenumber", G.get_x("Shape").alias("x"),
                    G.get_y("Shape").alias("y"), G.get_z("Shape").alias("z"))


@query("make_point_zm", """
SELECT event_id, CAST(event_id AS DOUBLE) AS x, value AS y, CAST(user_id AS DOUBLE) AS z,
       0.0::DOUBLE AS m
FROM events
""")
def make_point_zm(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    p = ev.select("event_id", G.point_zm("event_id", "value", "user_id").alias("Shape"))
    return p.select("event_id", *[G.col_of("Shape").getField(n).alias(n) for n in "xyzm"])


# ------------------------------------------------------------ polys E2 / E3

_XS = "[CAST(embedding[2 * i + 1] AS DOUBLE) FOR i IN range(len(embedding) // 2)]"
_YS = "[CAST(embedding[2 * i + 2] AS DOUBLE) FOR i IN range(len(embedding) // 2)]"


@query("make_polyline", f"""
SELECT vec_id, list_min({_XS}) AS xmin, list_min({_YS}) AS ymin,
       list_max({_XS}) AS xmax, list_max({_YS}) AS ymax,
       1 AS n_parts, CAST(len(embedding) // 2 AS INTEGER) AS n_vertices
FROM embeddings
""")
def make_polyline(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    p = emb.select("vec_id", G.poly_from_coords("embedding", None, 2).alias("Shape"))
    return p.select("vec_id", *_flat_poly("Shape"), G.num_parts("Shape").alias("n_parts"),
                    G.num_vertices("Shape", 2).alias("n_vertices"))


@query("make_polyline_m", f"""
SELECT vec_id, list_min({_XS}) AS xmin, list_min({_YS}) AS ymin,
       list_max({_XS}) AS xmax, list_max({_YS}) AS ymax,
       CAST(len(embedding) // 2 - 1 AS DOUBLE) AS mmax,
       1 AS n_parts, CAST(len(embedding) // 2 AS INTEGER) AS n_vertices
FROM embeddings
""")
def make_polyline_m(spark, sf_dir):
    p = _emb_poly_m(spark, sf_dir)
    return p.select("vec_id", *_flat_poly("Shape"),
                    F.array_max(G.ordinates(F.col("Shape.xyArr"), 3, 2)).alias("mmax"),
                    G.num_parts("Shape").alias("n_parts"),
                    G.num_vertices("Shape", 3).alias("n_vertices"))


@query("make_polygon", f"""
SELECT vec_id, list_min({_XS}) AS xmin, list_min({_YS}) AS ymin,
       list_max({_XS}) AS xmax, list_max({_YS}) AS ymax,
       CAST(len(embedding) // 2 + 1 AS INTEGER) AS n_vertices, true AS closed
FROM embeddings
""")
def make_polygon(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    ring = F.concat(F.col("embedding"), F.slice("embedding", 1, 2))
    p = emb.select("vec_id", G.poly_from_coords(ring, None, 2).alias("Shape"))
    arr = F.col("Shape.xyArr")
    closed = (F.get(arr, 0) == F.get(arr, F.size(arr) - 2)) & \
        (F.get(arr, 1) == F.get(arr, F.size(arr) - 1))
    return p.select("vec_id", *_flat_poly("Shape"),
                    G.num_vertices("Shape", 2).alias("n_vertices"), closed.alias("closed"))


@query("point_fields", """
SELECT l_orderkey, l_linenumber, l_extendedprice AS x, l_quantity AS y,
       l_discount AS z, l_tax AS m
FROM lineitem
""")
def point_fields(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = li.select("l_orderkey", "l_linenumber",
                  G.point_zm("l_extendedprice", "l_quantity", "l_discount", "l_tax").alias("S"))
    return p.select("l_orderkey", "l_linenumber", "S.x", "S.y", "S.z", "S.m")


@query("poly_fields", f"""
SELECT vec_id, CAST(len(embedding) // 2 AS INTEGER) AS num0,
       CAST(len(embedding) // 2 * 3 AS INTEGER) AS n_ords,
       CAST(embedding[1] AS DOUBLE) AS x0, CAST(embedding[2] AS DOUBLE) AS y0,
       0.0::DOUBLE AS m0, list_min({_XS}) AS xmin
FROM embeddings
""")
def poly_fields(spark, sf_dir):
    p = _emb_poly_m(spark, sf_dir)
    s = F.col("Shape")
    return p.select("vec_id", F.get(s.getField("xyNum"), 0).alias("num0"),
                    F.size(s.getField("xyArr")).alias("n_ords"),
                    F.get(s.getField("xyArr"), 0).alias("x0"),
                    F.get(s.getField("xyArr"), 1).alias("y0"),
                    F.get(s.getField("xyArr"), 2).alias("m0"),
                    s.getField("xmin").alias("xmin"))


@query("trajectory_extent", """
SELECT user_id, CAST(min(event_id) AS DOUBLE) AS xmin, min(value) AS ymin,
       CAST(max(event_id) AS DOUBLE) AS xmax, max(value) AS ymax, count(*) AS n_vertices
FROM events GROUP BY user_id
""")
def trajectory_extent(spark, sf_dir):
    """Bounding box of each user's track (x = event_id, y = value): the bbox
    of the polyline, computed with partial aggregates, no vertex list."""
    ev = table(spark, sf_dir, "events").select("user_id", G.point("event_id", "value").alias("p"))
    return ev.groupBy("user_id").agg(
        F.min("p.x").alias("xmin"), F.min("p.y").alias("ymin"),
        F.max("p.x").alias("xmax"), F.max("p.y").alias("ymax"),
        F.count(F.lit(1)).alias("n_vertices"))


@query("trajectory_polylines", """
WITH r AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rk,
         CAST(event_id AS DOUBLE) AS x, value AS y
  FROM events
), p AS (
  SELECT user_id, rk // 15 AS piece, rk, x, y FROM r
  UNION ALL
  SELECT user_id, rk // 15 - 1 AS piece, rk, x, y FROM r WHERE rk % 15 = 0 AND rk > 0
), g AS (
  SELECT user_id, piece, count(*) AS n, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax,
         max(y) AS ymax, arg_min(x, rk) AS x_first, arg_max(x, rk) AS x_last,
         min(rk) AS first_rank
  FROM p GROUP BY user_id, piece
)
SELECT user_id, CAST(piece AS BIGINT) AS piece, CAST(n AS INTEGER) AS n_vertices,
       xmin, ymin, xmax, ymax, x_first, x_last, CAST(first_rank AS BIGINT) AS first_rank
FROM g WHERE n > 1 OR piece = 0
""")
def trajectory_polylines(spark, sf_dir):
    """Each user's track (x = event_id, y = value, in time order) as
    polylines of at most 16 vertices sharing their boundary vertices."""
    from geoframe.operators.trajectories import polylines_from_rows
    ev = table(spark, sf_dir, "events")
    pl = polylines_from_rows(ev, ["user_id"], ["ts", "event_id"], "event_id", "value",
                             max_vertices=16)
    arr = F.col("Shape.xyArr")
    return pl.select("user_id", "piece", "n_vertices", *_flat_poly("Shape"),
                     F.get(arr, 0).alias("x_first"), F.get(arr, F.size(arr) - 2).alias("x_last"),
                     "first_rank")


@query("trajectory_whole", """
WITH r AS (
  SELECT user_id, list(CAST(event_id AS DOUBLE) ORDER BY ts, event_id) AS x, list(value ORDER BY ts, event_id) AS y
  FROM events GROUP BY user_id
)
SELECT user_id, CAST(len(x) AS INTEGER) AS n_vertices, list_min(x) AS xmin, list_min(y) AS ymin, list_max(x) AS xmax,
       list_max(y) AS ymax, x[1] AS x_first, y[len(y) // 2 + 1] AS y_mid, x[len(x)] AS x_last
FROM r
""")
def trajectory_whole(spark, sf_dir):
    """Each user's track as one polyline, however long."""
    from geoframe.operators.trajectories import polylines_from_rows
    pl = polylines_from_rows(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_id", "value")
    arr, n = F.col("Shape.xyArr"), F.col("n_vertices")
    return pl.select("user_id", "n_vertices", *_flat_poly("Shape"), F.get(arr, 0).alias("x_first"),
                     F.get(arr, 2 * F.floor(n / 2).cast("int") + 1).alias("y_mid"),
                     F.get(arr, F.size(arr) - 2).alias("x_last"))


# ------------------------------------------------------ equality / grouping

@query("point_equality_group", """
SELECT CAST(c_nationkey AS DOUBLE) AS x, floor(c_acctbal / 1000.0) AS y, count(*) AS cnt
FROM customer GROUP BY 1, 2
""")
def point_equality_group(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    p = c.select(G.point("c_nationkey", F.floor(F.col("c_acctbal") / 1000.0)).alias("Shape"))
    g = p.groupBy("Shape").agg(F.count(F.lit(1)).alias("cnt"))
    return g.select(G.get_x("Shape").alias("x"), G.get_y("Shape").alias("y"), "cnt")


@query("poly_equality_group", """
WITH p AS (
  SELECT CAST(label AS DOUBLE) AS a, CAST(vec_id % 3 AS DOUBLE) AS b FROM embeddings
)
SELECT a - 1 AS xmin, b - 1 AS ymin, a + 1 AS xmax, b + 1 AS ymax, 5 AS n_vertices,
       count(*) AS cnt
FROM p GROUP BY a, b
""")
def poly_equality_group(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    a, b = F.col("label").cast("double"), (F.col("vec_id") % 3).cast("double")
    ring = F.array(a - 1, b - 1, a + 1, b - 1, a + 1, b + 1, a - 1, b + 1, a - 1, b - 1)
    p = emb.select(G.poly_from_coords(ring, None, 2).alias("Shape"))
    g = p.groupBy("Shape").agg(F.count(F.lit(1)).alias("cnt"))
    return g.select(*_flat_poly("Shape"), G.num_vertices("Shape", 2).alias("n_vertices"), "cnt")


# -------------------------------------------------------------- text E6

@query("geometry_text", """
SELECT c_custkey,
  'PointType(' || CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) || ', '
    || CAST(CAST(c_custkey % 10 AS DOUBLE) AS VARCHAR) || ')' AS point_text,
  'PointMType(' || CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_custkey % 10 AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_custkey AS DOUBLE) AS VARCHAR) || ')' AS point_m_text,
  'PolylineType(' || CAST(CAST(c_nationkey - 2 AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_custkey % 10 - 2 AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_nationkey + 2 AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_custkey % 10 + 2 AS DOUBLE) AS VARCHAR) || ')' AS poly_text,
  'PointZMType(' || CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_custkey % 10 AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_custkey % 7 AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_custkey % 3 AS DOUBLE) AS VARCHAR) || ')' AS point_zm_text,
  'PolygonType(' || CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_custkey % 10 AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) || ','
    || CAST(CAST(c_custkey % 10 AS DOUBLE) AS VARCHAR) || ')' AS polygon_text
FROM customer
""")
def geometry_text(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    p = c.select("c_custkey", G.point("c_nationkey", F.col("c_custkey") % 10).alias("P"),
                 G.point_m("c_nationkey", F.col("c_custkey") % 10, "c_custkey").alias("PM"))
    zm = G.point_zm(F.col("P.x"), F.col("P.y"), F.col("c_custkey") % 7, F.col("c_custkey") % 3)
    ring = G.poly_from_coords(F.array(F.col("P.x"), F.col("P.y"), F.col("P.x"), F.col("P.y")))
    return p.select("c_custkey", G.geometry_text("P", "point").alias("point_text"),
                    G.geometry_text("PM", "pointM").alias("point_m_text"),
                    G.geometry_text(G.point_to_line("P"), "polyline").alias("poly_text"),
                    G.geometry_text(zm, "pointZM").alias("point_zm_text"),
                    G.geometry_text(ring, "polygon").alias("polygon_text"))


# ------------------------------------------------------- SQL functions F*

def _customer_points(spark, sf_dir):
    register(spark)
    c = table(spark, sf_dir, "customer")
    pts = c.select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING",
                                       G.point("c_acctbal", "c_nationkey")).alias("Shape"))
    pts.createOrReplaceTempView("gf_customer_points")
    return pts


_NULL_SHAPE = "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE {v} END"


@query("get_x_y", f"""
SELECT c_custkey, {_NULL_SHAPE.format(v='c_acctbal')} AS x,
       {_NULL_SHAPE.format(v='CAST(c_nationkey AS DOUBLE)')} AS y
FROM customer
""")
def get_x_y(spark, sf_dir):
    _customer_points(spark, sf_dir)
    return spark.sql("SELECT c_custkey, getX(Shape) AS x, getY(Shape) AS y FROM gf_customer_points")


@query("translate_point", f"""
SELECT c_custkey, {_NULL_SHAPE.format(v='c_acctbal + 2.0')} AS x,
       {_NULL_SHAPE.format(v='CAST(c_nationkey AS DOUBLE) + 2.0')} AS y,
       {_NULL_SHAPE.format(v='c_acctbal - 1.5')} AS x_shift,
       {_NULL_SHAPE.format(v='CAST(c_nationkey AS DOUBLE) + 0.25')} AS y_shift
FROM customer
""")
def translate_point(spark, sf_dir):
    pts = _customer_points(spark, sf_dir)
    df = pts.select("c_custkey", F.expr("plus2(Shape)").alias("P2"),
                    G.translate("Shape", -1.5, 0.25).alias("T"))
    return df.select("c_custkey", F.col("P2.x").alias("x"), F.col("P2.y").alias("y"),
                     F.col("T.x").alias("x_shift"), F.col("T.y").alias("y_shift"))


@query("translate_polyline", f"""
SELECT vec_id, list_min({_XS}) + 1.5 AS xmin, list_min({_YS}) + -2.0 AS ymin,
       list_max({_XS}) + 1.5 AS xmax, list_max({_YS}) + -2.0 AS ymax,
       CAST(embedding[1] AS DOUBLE) + 1.5 AS x0, CAST(embedding[2] AS DOUBLE) + -2.0 AS y0,
       CAST(embedding[len(embedding)] AS DOUBLE) + -2.0 AS y_last
FROM embeddings
""")
def translate_polyline(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    p = emb.select("vec_id", G.poly_from_coords("embedding", None, 2).alias("P"))
    t = p.select("vec_id", G.translate("P", 1.5, -2.0, "polyline").alias("T"))
    arr = F.col("T.xyArr")
    return t.select("vec_id", *_flat_poly("T"), F.get(arr, 0).alias("x0"),
                    F.get(arr, 1).alias("y0"), F.get(arr, F.size(arr) - 1).alias("y_last"))


@query("nested_point_udf", f"""
SELECT c_custkey, {_NULL_SHAPE.format(v='c_acctbal + 2.0')} AS x2
FROM customer
""")
def nested_point_udf(spark, sf_dir):
    _customer_points(spark, sf_dir)
    return spark.sql("SELECT c_custkey, getX(plus2(Shape)) AS x2 FROM gf_customer_points")


@query("ordinate_arithmetic", f"""
SELECT c_custkey, {_NULL_SHAPE.format(v='c_acctbal - 2.0')} AS x_minus_2
FROM customer
""")
def ordinate_arithmetic(spark, sf_dir):
    _customer_points(spark, sf_dir)
    return spark.sql("SELECT c_custkey, getX(Shape) - 2 AS x_minus_2 FROM gf_customer_points")


@query("point_to_line", f"""
SELECT c_custkey, {_NULL_SHAPE.format(v='c_acctbal - 2.0')} AS xmin,
       {_NULL_SHAPE.format(v='CAST(c_nationkey AS DOUBLE) - 2.0')} AS ymin,
       {_NULL_SHAPE.format(v='c_acctbal + 2.0')} AS xmax,
       {_NULL_SHAPE.format(v='CAST(c_nationkey AS DOUBLE) + 2.0')} AS ymax,
       {_NULL_SHAPE.format(v='2')} AS n_vertices,
       {_NULL_SHAPE.format(v='c_acctbal + 2.0')} AS x_last
FROM customer
""")
def point_to_line(spark, sf_dir):
    _customer_points(spark, sf_dir)
    df = spark.sql("SELECT c_custkey, line(Shape) AS L FROM gf_customer_points")
    return df.select("c_custkey", *_flat_poly("L"),
                     F.get(F.col("L.xyNum"), 0).alias("n_vertices"),
                     F.get(F.col("L.xyArr"), 2).alias("x_last"))


# ---------------------------------------------------- value decoders C*/D*

@query("dequantize_point", """
SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice * 100.0) + 1 AS BIGINT) AS vx,
       (CAST(floor(l_extendedprice * 100.0) + 1 AS BIGINT) - 1.0) / 100.0 + -500.0 AS x
FROM lineitem
""")
def dequantize_point(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    vx = C.quantize_point(F.col("l_extendedprice"), F.lit(100.0), F.lit(0.0)).cast("bigint")
    return li.select("l_orderkey", "l_linenumber", vx.alias("vx"),
                     C.dequantize_point(vx, F.lit(100.0), F.lit(-500.0)).alias("x"))


@query("bbox_decode", """
WITH q AS (
  SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity * 10) AS BIGINT) AS qx,
         CAST(floor(l_discount * 100) AS BIGINT) AS qy, CAST(l_linenumber AS BIGINT) AS ex,
         CAST(floor(l_tax * 100) AS BIGINT) AS ey
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, qx / 10.0 + 1000.0 AS xmin, qy / 10.0 + -50.0 AS ymin,
       ex / 10.0 + (qx / 10.0 + 1000.0) AS xmax, ey / 10.0 + (qy / 10.0 + -50.0) AS ymax
FROM q
""")
def bbox_decode(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = li.select("l_orderkey", "l_linenumber",
                  F.floor(F.col("l_quantity") * 10).alias("qx"),
                  F.floor(F.col("l_discount") * 100).alias("qy"),
                  F.col("l_linenumber").cast("bigint").alias("ex"),
                  F.floor(F.col("l_tax") * 100).alias("ey"))
    b = C.bbox_decode("qx", "qy", "ex", "ey", F.lit(10.0), F.lit(1000.0), F.lit(-50.0))
    return q.select("l_orderkey", "l_linenumber", b.alias("B")).select(
        "l_orderkey", "l_linenumber", "B.xmin", "B.ymin", "B.xmax", "B.ymax")


@query("delta_decode_rows", """
WITH q AS (
  SELECT event_id, user_id, ts, CAST(floor(value * 100.0) AS BIGINT) AS v FROM events
), d AS (
  SELECT *, v - coalesce(lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS delta
  FROM q
)
SELECT event_id, user_id, delta,
       sum(delta) OVER (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / 100.0 + 0.0 AS y
FROM d
""")
def delta_decode_rows(spark, sf_dir):
    """Per-user delta coding of a quantised ordinate and its decoding, from one
    ordered scan: the deltas' running sums come with the previous values."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", F.floor(F.col("value") * 100.0).cast("bigint").alias("v"))
    dec = ordered_scan(ev, ["user_id"], ["ts", "event_id"], lags={"prev": "v"}, difference_sums={"cum": "v"}) \
        .withColumn("delta", F.col("v") - F.coalesce("prev", F.lit(0)))
    return dec.select("event_id", "user_id", "delta",
                      C.dequantize("cum", F.lit(100.0), F.lit(0.0)).alias("y"))


@query("delta_decode_array", """
SELECT vec_id, CAST(i AS INTEGER) AS pos,
       floor(CAST(embedding[i + 1] AS DOUBLE) * 1000.0) / 1000.0 + 0.0 AS value
FROM embeddings, range(0, len(embedding)) r(i)
""")
def delta_decode_array(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    q = emb.select("vec_id", F.transform("embedding", lambda e: F.floor(e.cast("double") * 1000.0))
                   .alias("q"))
    deltas = C.delta_encode_array("q")
    dec = q.select("vec_id", C.delta_decode_array(deltas, F.lit(1000.0), F.lit(0.0)).alias("d"))
    return dec.select("vec_id", F.posexplode("d").alias("pos", "value"))


@query("part_counts", """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS part,
       ([CAST(vec_id % 5 + 1 AS INTEGER), CAST(vec_id % 7 AS INTEGER),
         CAST(len(embedding) // 2 - (vec_id % 5 + 1) - vec_id % 7 AS INTEGER)])[i] AS n
FROM embeddings, range(1, 4) r(i)
""")
def part_counts(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    lead = F.array((F.col("vec_id") % 5 + 1).cast("int"), (F.col("vec_id") % 7).cast("int"))
    full = C.complete_part_counts((F.size("embedding") / 2).cast("int"), lead)
    return emb.select("vec_id", F.posexplode(full).alias("part", "n"))


@query("ole_date_to_timestamp", """
WITH d AS (SELECT event_id, epoch_us(ts) / 86400000000.0 + 25569.0 AS days FROM events)
SELECT event_id, days, CAST(ceil((days - 25569) * 1000 * 60 * 60 * 24) AS BIGINT) AS ms,
       epoch_ms(CAST(ceil((days - 25569) * 1000 * 60 * 60 * 24) AS BIGINT)) AS ts
FROM d
""")
def ole_date_to_timestamp(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    d = ev.select("event_id", C.timestamp_to_ole_days("ts").alias("days"))
    return d.select("event_id", "days", C.ole_days_millis("days").alias("ms"),
                    C.ole_days_to_timestamp("days").cast("timestamp_ntz").alias("ts"))


@query("guid_text", """
WITH h AS (SELECT c_custkey, upper(md5(CAST(c_custkey AS VARCHAR))) AS h FROM customer)
SELECT c_custkey, '{' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2)
  || '-' || substr(h, 11, 2) || substr(h, 9, 2) || '-' || substr(h, 15, 2) || substr(h, 13, 2)
  || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) || '}' AS guid
FROM h
""")
def guid_text(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    b = F.unhex(F.md5(F.col("c_custkey").cast("string")))
    return c.select("c_custkey", C.guid_text(b).alias("guid"))


# ------------------------------------------------------- table operators

@query("layer_extent", """
SELECT c_mktsegment, min(c_acctbal) AS xmin, min(CAST(c_nationkey AS DOUBLE)) AS ymin,
       max(c_acctbal) AS xmax, max(CAST(c_nationkey AS DOUBLE)) AS ymax, count(*) AS n
FROM customer GROUP BY c_mktsegment
""")
def layer_extent(spark, sf_dir):
    from geoframe.operators.tables import data_extent
    c = table(spark, sf_dir, "customer")
    p = c.select("c_mktsegment", G.point("c_acctbal", "c_nationkey").alias("Shape"))
    return data_extent(p, "Shape", "point", ["c_mktsegment"])


@query("rows_as_map", """
WITH c AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
         CAST(nullif(c_nationkey, 3) AS VARCHAR) AS c_nationkey,
         CAST(c_acctbal AS VARCHAR) AS c_acctbal,
         nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, c_custkey AS id
  FROM customer
)
SELECT id, name AS "key", value
FROM (UNPIVOT c ON c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
      INTO NAME name VALUE value)
""")
def rows_as_map(spark, sf_dir):
    from geoframe.operators.tables import rows_as_map as to_map
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.expr("nullif(c_nationkey, 3)").alias("c_nationkey"),
        "c_acctbal", F.expr("nullif(c_mktsegment, 'BUILDING')").alias("c_mktsegment"))
    m = to_map(c).alias("m")
    return c.select(F.col("c_custkey").alias("id"), F.explode(m).alias("key", "value"))


@query("assign_object_ids", """
SELECT l_orderkey, l_linenumber,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS OBJECTID
FROM lineitem
""")
def assign_object_ids_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return assign_object_ids(li, ["l_orderkey", "l_linenumber"], start_id=0)


# ------------------------------------------------------------- round trips

@query("json_sink_roundtrip", """
SELECT c_custkey, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y, c_mktsegment FROM customer
""")
def json_sink_roundtrip(spark, sf_dir):
    import uuid
    c = table(spark, sf_dir, "customer")
    df = c.select("c_custkey", G.point("c_acctbal", "c_nationkey").alias("Shape"), "c_mktsegment")
    out = shared_path(spark, "geoframe-json", uuid.uuid4().hex)
    df.write.mode("overwrite").json(out)
    back = spark.read.schema("c_custkey bigint, Shape struct<x: double, y: double>, "
                             "c_mktsegment string").json(out)
    return back.select("c_custkey", F.col("Shape.x").alias("x"), F.col("Shape.y").alias("y"),
                       "c_mktsegment")


@query("geometry_roundtrip", """
SELECT vec_id, CAST(i AS INTEGER) AS pos, CAST(embedding[i + 1] AS DOUBLE) AS ord,
       [CAST(embedding[2 * j + 1] AS DOUBLE) FOR j IN range(32)].list_min() AS xmin
FROM embeddings, range(0, 64) r(i)
""")
def geometry_roundtrip(spark, sf_dir):
    import uuid
    emb = table(spark, sf_dir, "embeddings")
    df = emb.select("vec_id", G.poly_from_coords("embedding", None, 2).alias("Shape"))
    out = shared_path(spark, "geoframe-parquet", uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(out)
    back = spark.read.parquet(out)
    return back.select("vec_id", F.col("Shape.xmin").alias("xmin"),
                       F.posexplode("Shape.xyArr").alias("pos", "ord"))
