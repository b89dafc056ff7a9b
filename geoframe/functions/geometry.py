"""Geometry values as plain Spark structs, and column functions over them.

A geometry is an ordinary ``struct`` column, so field access (``Shape.x``),
equality, grouping, sorting, Parquet/JSON I/O and whole-stage codegen all work
without a Python UDT.  Every function here returns a ``Column`` built from
built-in expressions: no Python runs per row.

Point kinds:  point ``<x,y>``, pointM ``<x,y,m>``, pointZ ``<x,y,z>``,
              pointZM ``<x,y,z,m>``.
Equality and grouping are Spark's struct semantics: ordinate-wise, NaN
equals NaN and 0.0 equals -0.0; a polyline equals a polygon with the same
content (same struct layout).

Poly kinds:   polyline / polylineM / polygon share one layout
              ``<xmin,ymin,xmax,ymax,xyNum:array<int>,xyArr:array<double>>``;
              ``xyNum[i]`` is the vertex count of part *i* and ``xyArr`` the
              flat ordinates, stride 2 (polyline, polygon) or 3 (polylineM:
              x, y, m per vertex).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField,
                               StructType)

_D = DoubleType()


def _struct(*names: str) -> StructType:
    return StructType([StructField(n, _D, False) for n in names])


POINT = _struct("x", "y")
POINT_M = _struct("x", "y", "m")
POINT_Z = _struct("x", "y", "z")
POINT_ZM = _struct("x", "y", "z", "m")
POLY = StructType([
    StructField("xmin", _D, False),
    StructField("ymin", _D, False),
    StructField("xmax", _D, False),
    StructField("ymax", _D, False),
    StructField("xyNum", ArrayType(IntegerType(), False), False),
    StructField("xyArr", ArrayType(_D, False), False),
])

# Geometry kind names (field metadata ``geometryType``) and the
# class names used by the text rendering of each kind.
KIND_TYPES = {
    "point": POINT,
    "pointM": POINT_M,
    "pointZ": POINT_Z,
    "pointZM": POINT_ZM,
    "polyline": POLY,
    "polylineM": POLY,
    "polygon": POLY,
}
KIND_TEXT_NAMES = {
    "point": "PointType",
    "pointM": "PointMType",
    "pointZ": "PointZType",
    "pointZM": "PointZMType",
    "polyline": "PolylineType",
    "polylineM": "PolylineMType",
    "polygon": "PolygonType",
}
KIND_STRIDE = {"polyline": 2, "polylineM": 3, "polygon": 2}
POINT_KINDS = ("point", "pointM", "pointZ", "pointZM")
POLY_KINDS = ("polyline", "polylineM", "polygon")


def col_of(v) -> Column:
    """Column from a Column, a column name, or a Python literal."""
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit(v)


def _dbl(v) -> Column:
    return col_of(v).cast("double")


# --------------------------------------------------------------- constructors

def point(x, y) -> Column:
    return F.struct(_dbl(x).alias("x"), _dbl(y).alias("y"))


def point_m(x, y, m=0.0) -> Column:
    return F.struct(_dbl(x).alias("x"), _dbl(y).alias("y"), _dbl(m).alias("m"))


def point_z(x, y, z=0.0) -> Column:
    return F.struct(_dbl(x).alias("x"), _dbl(y).alias("y"), _dbl(z).alias("z"))


def point_zm(x, y, z=0.0, m=0.0) -> Column:
    return F.struct(_dbl(x).alias("x"), _dbl(y).alias("y"),
                    _dbl(z).alias("z"), _dbl(m).alias("m"))


def poly(xmin, ymin, xmax, ymax, xy_num, xy_arr) -> Column:
    """Polyline / polylineM / polygon value with a caller-supplied bbox."""
    return F.struct(
        _dbl(xmin).alias("xmin"), _dbl(ymin).alias("ymin"),
        _dbl(xmax).alias("xmax"), _dbl(ymax).alias("ymax"),
        col_of(xy_num).cast("array<int>").alias("xyNum"),
        col_of(xy_arr).cast("array<double>").alias("xyArr"),
    )


polyline = poly
polyline_m = poly
polygon = poly


def ordinates(xy_arr, stride: int, offset: int) -> Column:
    """Every ``stride``-th ordinate starting at ``offset`` (0 = x, 1 = y, 2 = m)."""
    arr = col_of(xy_arr)
    return F.filter(arr, lambda v, i: (i % F.lit(stride)) == F.lit(offset))


def poly_from_coords(xy_arr, xy_num=None, stride: int = 2) -> Column:
    """Poly value whose bbox is computed from its own vertices.

    ``xy_num`` defaults to a single part holding every vertex.  An empty
    coordinate array gives the empty geometry (zero bbox, empty arrays).
    """
    arr = col_of(xy_arr).cast("array<double>")
    n_vertices = (F.size(arr) / F.lit(stride)).cast("int")
    num = (F.when(n_vertices > 0, F.array(n_vertices)).otherwise(F.array().cast("array<int>"))
           if xy_num is None else col_of(xy_num))
    xs, ys = ordinates(arr, stride, 0), ordinates(arr, stride, 1)
    empty = F.size(arr) == 0
    zero = F.lit(0.0)
    return F.when(arr.isNotNull(), poly(
        F.when(empty, zero).otherwise(F.array_min(xs)),
        F.when(empty, zero).otherwise(F.array_min(ys)),
        F.when(empty, zero).otherwise(F.array_max(xs)),
        F.when(empty, zero).otherwise(F.array_max(ys)),
        num, arr,
    ))


# ----------------------------------------------------------------- accessors

def get_x(g) -> Column:
    return col_of(g).getField("x")


def get_y(g) -> Column:
    return col_of(g).getField("y")


def get_z(g) -> Column:
    return col_of(g).getField("z")


def get_m(g) -> Column:
    return col_of(g).getField("m")


def num_vertices(g, stride: int) -> Column:
    return (F.size(col_of(g).getField("xyArr")) / F.lit(stride)).cast("int")


def num_parts(g) -> Column:
    return F.size(col_of(g).getField("xyNum"))


# --------------------------------------------------------------- transforms

def translate(g, dx, dy, kind: str = "point") -> Column:
    """Shift a geometry by (dx, dy); null stays null.

    Without the ``isNotNull`` guard a null point would become a non-null
    struct of nulls.
    """
    g = col_of(g)
    dx, dy = _dbl(dx), _dbl(dy)
    if kind in POINT_KINDS:
        fields = [f.name for f in KIND_TYPES[kind].fields]
        parts = []
        for name in fields:
            v = g.getField(name)
            if name == "x":
                v = v + dx
            elif name == "y":
                v = v + dy
            parts.append(v.alias(name))
        return F.when(g.isNotNull(), F.struct(*parts))
    stride = KIND_STRIDE[kind]
    arr = F.transform(
        g.getField("xyArr"),
        lambda v, i: F.when(i % stride == 0, v + dx)
        .when(i % stride == 1, v + dy).otherwise(v))
    return F.when(g.isNotNull(), poly(
        g.getField("xmin") + dx, g.getField("ymin") + dy,
        g.getField("xmax") + dx, g.getField("ymax") + dy,
        g.getField("xyNum"), arr))


def point_to_line(g, d=2.0) -> Column:
    """Point -> two-vertex polyline from (x-d, y-d) to (x+d, y+d)."""
    g = col_of(g)
    d = _dbl(d)
    x, y = g.getField("x"), g.getField("y")
    return F.when(g.isNotNull(), poly(
        x - d, y - d, x + d, y + d, F.array(F.lit(2)),
        F.array(x - d, y - d, x + d, y + d)))


def _num_text(v: Column) -> Column:
    return F.coalesce(v.cast("string"), F.lit("null"))


def geometry_text(g, kind: str) -> Column:
    """Text form: ``PointType(x, y)``; ``PointMType(x,y,m)`` (and Z, ZM);
    polys: class name followed by the comma-joined ordinates."""
    g = col_of(g)
    name = KIND_TEXT_NAMES[kind]
    if kind == "point":
        body = F.concat_ws(", ", _num_text(g.getField("x")), _num_text(g.getField("y")))
    elif kind in POINT_KINDS:
        body = F.concat_ws(",", *[_num_text(g.getField(f.name)) for f in KIND_TYPES[kind].fields])
    else:
        body = F.array_join(F.transform(g.getField("xyArr"), _num_text), ",")
    return F.when(g.isNotNull(), F.concat(F.lit(name + "("), body, F.lit(")")))


# ------------------------------------------------------------ SQL functions

_POINT_SQL = "STRUCT<x: DOUBLE, y: DOUBLE>"
_POLY_SQL = ("STRUCT<xmin: DOUBLE, ymin: DOUBLE, xmax: DOUBLE, ymax: DOUBLE, "
             "xyNum: ARRAY<INT>, xyArr: ARRAY<DOUBLE>>")

SQL_FUNCTIONS = {
    "getX": f"CREATE OR REPLACE TEMPORARY FUNCTION getX(p {_POINT_SQL}) "
            "RETURNS DOUBLE RETURN p.x",
    "getY": f"CREATE OR REPLACE TEMPORARY FUNCTION getY(p {_POINT_SQL}) "
            "RETURNS DOUBLE RETURN p.y",
    "plus2": f"CREATE OR REPLACE TEMPORARY FUNCTION plus2(p {_POINT_SQL}) "
             f"RETURNS {_POINT_SQL} RETURN "
             "CASE WHEN p IS NULL THEN NULL "
             "ELSE named_struct('x', p.x + 2D, 'y', p.y + 2D) END",
    "line": f"CREATE OR REPLACE TEMPORARY FUNCTION line(p {_POINT_SQL}) "
            f"RETURNS {_POLY_SQL} RETURN "
            "CASE WHEN p IS NULL THEN NULL ELSE named_struct("
            "'xmin', p.x - 2D, 'ymin', p.y - 2D, 'xmax', p.x + 2D, 'ymax', p.y + 2D, "
            "'xyNum', array(2), 'xyArr', array(p.x - 2D, p.y - 2D, p.x + 2D, p.y + 2D)) END",
}


_POLY_SQL = ("STRUCT<xmin: DOUBLE, ymin: DOUBLE, xmax: DOUBLE, ymax: DOUBLE, xyNum: ARRAY<INT>, "
             "xyArr: ARRAY<DOUBLE>>")


def _segments_sql(name: str, ordinates: str) -> str:
    """A SQL table function: one row per pair of consecutive vertices of a part, as
    ``operators.segments`` gives them.  A list of (part, index) per vertex is made once
    per geometry, so the work is linear in its vertices."""
    stride = len(ordinates)
    ends = [(e + o, f"get(shape.xyArr, {stride} * j + {k + step})") for e, step in (("a", 0), ("b", stride))
            for k, o in enumerate(ordinates)]
    fields = ", ".join(f"'{n}', {x}" for n, x in ends)
    none = "CAST(array() AS ARRAY<INT>)"
    return f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(shape {_POLY_SQL})
RETURNS TABLE (part INT, seg INT, {", ".join(n + " DOUBLE" for n, _ in ends)})
RETURN SELECT s.part, s.seg, {", ".join("s." + n for n, _ in ends)} FROM (
  SELECT explode(flatten(transform(
    array(flatten(transform(shape.xyNum, (n, p) -> transform(
      IF(n > 0, sequence(0, n - 1), {none}), k -> named_struct('p', p, 'k', k))))),
    v -> filter(transform(IF(size(v) > 1, sequence(0, size(v) - 2), {none}), j -> named_struct(
      'part', v[j].p, 'seg', v[j].k, 'to', v[j + 1].p, {fields})), s -> s.part = s.to)))) AS s)"""


#: Table functions for LATERAL: ``segments`` of polylines and polygons, ``segmentsM`` of polylineM.
SQL_TABLE_FUNCTIONS = {"segments": _segments_sql("segments", "xy"), "segmentsM": _segments_sql("segmentsM", "xym")}


def register_sql_functions(spark: SparkSession) -> None:
    """SQL functions ``getX``, ``getY``, ``plus2`` and ``line``, and table functions
    ``segments`` and ``segmentsM`` (SQL UDFs, so they inline into Catalyst
    expressions: no Python at run time)."""
    for stmt in (*SQL_FUNCTIONS.values(), *SQL_TABLE_FUNCTIONS.values()):
        spark.sql(stmt)
