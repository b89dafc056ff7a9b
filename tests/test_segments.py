"""Segment explode: the literal vectors of the surveyed library's segment suite
(xyArr stride 3: 10,20,30 / 20,30,40 / ...)."""

import pytest
from pyspark.sql import functions as F

from geoframe.functions.geometry import poly
from geoframe.operators.segments import segments

CASES = [
    ([], []),
    ([0], []),
    ([2], [(0, 0)]),
    ([3], [(0, 0), (0, 1)]),
    ([2, 2], [(0, 0), (1, 0)]),
    ([4, 3], [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]),
    ([2, 2, 2], [(0, 0), (1, 0), (2, 0)]),
    # quirk fixed: a one-vertex part yields nothing and does not stop the rest
    ([1, 3], [(1, 0), (1, 1)]),
]


def _arr(n):
    out = []
    for v in range(n):
        out += [10.0 * (v + 1), 10.0 * (v + 2), 10.0 * (v + 3)]
    return out


@pytest.mark.parametrize("num,expected", CASES)
def test_segment_vectors(spark, num, expected):
    arr = _arr(sum(num))
    df = spark.createDataFrame([(1, num, arr)], "id int, num array<int>, arr array<double>")
    df = df.select("id", poly(0, 0, 0, 0, "num", "arr").alias("G"))
    got = segments(df, "G", keep=["id"], stride=3).orderBy("part", "seg").collect()
    assert [(r.part, r.seg) for r in got] == expected
    starts = [sum(num[:p]) for p in range(len(num))]
    for r in got:
        v = starts[r.part] + r.seg
        assert (r.ax, r.ay, r.am) == tuple(arr[3 * v:3 * v + 3])
        assert (r.bx, r.by, r.bm) == tuple(arr[3 * v + 3:3 * v + 6])


def test_segments_stride2(spark):
    df = spark.createDataFrame([([3], [0.0, 0.0, 1.0, 1.0, 2.0, 0.0])],
                               "num array<int>, arr array<double>")
    g = df.select(poly(0, 0, 2, 1, "num", "arr").alias("G"))
    rows = segments(g, "G", stride=2).orderBy("seg").collect()
    assert [(r.ax, r.ay, r.bx, r.by) for r in rows] == [(0, 0, 1, 1), (1, 1, 2, 0)]
    assert "am" not in rows[0].asDict()


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([([3], _arr(3))], "num array<int>, arr array<double>")
    g = df.select(poly(0, 0, 0, 0, "num", "arr").alias("G"))
    plan = segments(g, "G")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert F is not None


def test_long_polyline_is_linear(spark):
    """400k vertices in one geometry: the coordinate array is not copied per
    output row, so this stays a few seconds."""
    import time
    n = 400_000
    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(3 * n - 1)),
                                           lambda i: i.cast("double")).alias("a"))
    from geoframe.functions.geometry import poly_from_coords
    g = df.select(poly_from_coords("a", None, 3).alias("G"))
    t0 = time.time()
    assert segments(g, "G").count() == n - 1
    assert time.time() - t0 < 60


def test_segments_in_sql(spark):
    """The table function: parts of no, one and more vertices, empty and null
    geometries, no Python in the plan; both strides agree with the operator."""
    from pyspark.sql import functions as F

    from geoframe.operators.segments import segments
    from geoframe.session import register
    register(spark)
    rows = [(1, [2, 0, 3, 1, 2], 8), (2, [], 0), (3, [1], 1), (4, None, 0)]
    df = spark.createDataFrame(rows, "id int, num array<int>, n int")
    for stride, name in ((2, "segments"), (3, "segmentsM")):
        ords = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), stride * F.col("n")), lambda x: x.cast("double"))) \
            .otherwise(F.array().cast("array<double>"))
        shape = F.when(F.col("num").isNotNull(), F.struct(*[F.lit(0.0).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
                                                          F.col("num").alias("xyNum"), ords.alias("xyArr")))
        df.select("id", shape.alias("Shape")).createOrReplaceTempView("gf_test_polys")
        got = spark.sql(f"SELECT id, s.* FROM gf_test_polys, LATERAL {name}(Shape) s")
        want = segments(spark.table("gf_test_polys"), "Shape", keep=["id"], stride=stride)
        assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert got.count() == 4 and "Python" not in got._jdf.queryExecution().toString()
