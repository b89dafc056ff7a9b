"""Tolerance checks, whole tracks and nulls in geometry functions."""

import pytest
from pyspark.sql import functions as F

from geoframe.functions import geometry as G
from geoframe.operators.tables import tolerance_check
from geoframe.operators.trajectories import polylines_from_rows


def points(spark, metadata):
    df = spark.createDataFrame([(1, 1, 1.0, 2.0, 5.0, 1.0, 2.0, 5.5), (2, 3, 1.0, 2.0, 5.0, 1.2, 2.0, 5.0)],
                               "OBJECTID int, RID int, x double, y double, m double, X1 double, Y1 double, M1 double")
    shape = F.struct("x", "y", "m").alias("Shape", metadata=metadata)
    return df.select("OBJECTID", "RID", "X1", "Y1", "M1", shape)


EXPECTED = {"x": "X1", "y": "Y1", "m": "M1"}


def found(df, *args, **kw):
    return sorted((r["id"], r["check"]) for r in tolerance_check(df, "Shape", "pointm", EXPECTED, *args, **kw).collect())


def test_tolerance_from_metadata(spark):
    df = points(spark, {"xyTolerance": 0.5, "mTolerance": 0.1})
    assert found(df) == [(1, "m"), (2, "RID")]
    assert found(df, {"xy": 0.1, "m": 1.0}, rid_col=None) == [(2, "x")]
    assert found(df, 1.0, rid_col=None) == []


def test_every_ordinate_needs_a_tolerance(spark):
    with pytest.raises(ValueError, match="m"):
        found(points(spark, {"xyTolerance": 0.5}))
    with pytest.raises(ValueError, match="m"):
        found(points(spark, {}), {"xy": 1.0})


def test_whole_tracks(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), "id", F.col("id").cast("double").alias("x"))
    rows = {r["g"]: r for r in polylines_from_rows(df, ["g"], ["id"], "x", "x").collect()}
    assert [rows[g]["n_vertices"] for g in (0, 1)] == [1500, 1500]
    assert rows[1]["Shape"]["xyArr"][:4] == [1.0, 1.0, 3.0, 3.0] and rows[0]["Shape"]["xmax"] == 2998.0


def test_nulls(spark):
    df = spark.sql("SELECT CAST(NULL AS ARRAY<DOUBLE>) AS a, named_struct('x', 1.0D, 'y', CAST(NULL AS DOUBLE)) AS p")
    r = df.select(G.poly_from_coords("a").alias("s"), G.geometry_text("p", "point").alias("t")).first()
    assert r["s"] is None and r["t"] == "PointType(1.0, null)"
