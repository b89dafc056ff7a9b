"""Table-level helpers: rows as maps, field descriptions, extents, and the
shape-versus-attribute tolerance check."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from geoframe.functions.geometry import KIND_STRIDE, POINT_KINDS, ordinates


def rows_as_map(df: DataFrame, columns: list[str] | None = None) -> Column:
    """``map<string,string>`` of field name -> value text; null fields are
    absent from the map (the name->value view of a row)."""
    cols = columns or df.columns
    pairs = []
    for c in cols:
        pairs += [F.lit(c), F.col(f"`{c}`").cast("string")]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def rows_as_json(df: DataFrame) -> Column:
    """JSON object per row; ``to_json`` leaves out null fields."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def data_extent(df: DataFrame, geom: str, kind: str,
                group_cols: list[str] | None = None) -> DataFrame:
    """Extent (xmin, ymin, xmax, ymax) and row count of a geometry column,
    optionally per group; plain partial aggregates."""
    g = F.col(geom)
    if kind in POINT_KINDS:
        lo_x, lo_y, hi_x, hi_y = g.getField("x"), g.getField("y"), g.getField("x"), g.getField("y")
    else:
        lo_x, lo_y, hi_x, hi_y = (g.getField("xmin"), g.getField("ymin"),
                                  g.getField("xmax"), g.getField("ymax"))
    aggs = [F.min(lo_x).alias("xmin"), F.min(lo_y).alias("ymin"),
            F.max(hi_x).alias("xmax"), F.max(hi_y).alias("ymax"),
            F.count(g).alias("n")]
    grouped = df.groupBy(*(group_cols or []))
    return grouped.agg(*aggs)


_DESCRIBE_SCHEMA = (
    "position int, name string, type string, nullable boolean, alias string, "
    "max_length long, geometry_type string, crs string, has_z boolean, has_m boolean, "
    "xy_tolerance double, z_tolerance double, m_tolerance double, "
    "xmin double, ymin double, xmax double, ymax double, is_object_id boolean, metadata string")


def describe_fields(spark: SparkSession, schema: StructType | DataFrame) -> DataFrame:
    """One row per field with its type and the geodatabase field metadata
    (alias, maxLength, spatial reference, extent, Z/M flags, tolerances)."""
    if isinstance(schema, DataFrame):
        schema = schema.schema
    rows = []
    for i, f in enumerate(schema.fields):
        md = dict(f.metadata or {})
        rows.append((
            i, f.name, f.dataType.simpleString(), bool(md.get("sourceNullable", f.nullable)),
            md.get("alias"), md.get("maxLength"), md.get("geometryType"), md.get("crs"),
            md.get("hasZ"), md.get("hasM"), md.get("xyTolerance"), md.get("zTolerance"),
            md.get("mTolerance"), md.get("xmin"), md.get("ymin"), md.get("xmax"),
            md.get("ymax"), bool(md.get("isObjectId", False)), json.dumps(md, sort_keys=True)))
    return spark.createDataFrame(rows, _DESCRIBE_SCHEMA)


def tolerance_check(df: DataFrame, geom: str, kind: str, expected: dict[str, str],
                    tolerance: float | dict[str, float] | None = None, id_col: str = "OBJECTID",
                    rid_col: str | None = "RID") -> DataFrame:
    """Violations of "shape agrees with its attribute columns".

    ``expected`` maps an ordinate reference to an attribute column:
    ``"x"``/``"y"``/``"z"``/``"m"`` for points, ``"xmin"`` etc. for boxes,
    ``"v0.x"`` / ``"v2.m"`` for the ordinate of vertex *i* of a poly.  A row
    is reported when any ``abs(shape - attribute) > tolerance`` (or either is
    null), or ``rid_col`` differs from ``id_col``.  ``tolerance`` is one number
    for all, or one per ordinate (``"xy"`` stands for x and y); without it the
    geometry column's own ``xyTolerance`` / ``zTolerance`` / ``mTolerance`` are
    taken.  An ordinate without a tolerance is an error.  Output: id, check name,
    shape value, attribute value.  An empty result means the layer passes.
    """
    g = F.col(geom)
    if tolerance is None:
        md = df.schema[geom].metadata or {}
        tolerance = {k: md[k + "Tolerance"] for k in ("xy", "z", "m") if md.get(k + "Tolerance") is not None}

    def within(ordinate: str) -> float:
        if not isinstance(tolerance, dict):
            return float(tolerance)
        # boxes: xmin, ymax ... follow their axis
        axis = ordinate[0]
        for key in (ordinate, axis, "xy" if axis in "xy" else None):
            if key in tolerance:
                return float(tolerance[key])
        raise ValueError(f"tolerance_check: no tolerance for ordinate {ordinate}")

    checks = []
    for ref, attr in expected.items():
        if ref.startswith("v") and "." in ref:
            idx, ordn = ref[1:].split(".")
            stride = KIND_STRIDE[kind]
            off = {"x": 0, "y": 1, "m": 2}[ordn]
            shape_v = F.get(g.getField("xyArr"), int(idx) * stride + off)
            t = within(ordn)
        else:
            shape_v = g.getField(ref)
            t = within(ref)
        attr_v = F.col(attr).cast("double")
        bad = (F.abs(shape_v - attr_v) > F.lit(float(t))) | shape_v.isNull() | attr_v.isNull()
        checks.append(F.when(bad, F.struct(F.lit(ref).alias("check"),
                                           shape_v.alias("shape_value"),
                                           attr_v.alias("attribute_value"))))
    if rid_col:
        rid_bad = ~F.col(rid_col).eqNullSafe(F.col(id_col))
        checks.append(F.when(rid_bad, F.struct(
            F.lit(rid_col).alias("check"), F.col(id_col).cast("double").alias("shape_value"),
            F.col(rid_col).cast("double").alias("attribute_value"))))
    found = df.select(F.col(id_col).alias("id"),
                      F.explode(F.filter(F.array(*checks), lambda s: s.isNotNull())).alias("v"))
    return found.select("id", "v.check", "v.shape_value", "v.attribute_value")
