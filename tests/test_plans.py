"""Plan shape: geometry functions and query patterns run as Catalyst
expressions (no Python UDF nodes); pushdown prunes partitions."""

import pytest

SF = "/root/testdata/sf0.001"
JVM_ONLY = ["segments_m", "segments_multipart", "make_point", "make_polyline",
            "make_polyline_m", "make_polygon", "point_fields", "poly_fields",
            "point_equality_group", "poly_equality_group", "geometry_text", "get_x_y",
            "translate_point", "nested_point_udf", "ordinate_arithmetic", "point_to_line",
            "dequantize_point", "bbox_decode", "guid_text", "ole_date_to_timestamp",
            "part_counts", "layer_extent", "rows_as_map", "trajectory_extent"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", JVM_ONLY)
def test_no_python_udf(spark, key):
    import geoframe.plans  # noqa: F401
    from geoframe.plans.registry import QUERIES
    plan = _plan(QUERIES[key](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow",
                 "PythonUDF"):
        assert node not in plan, f"{key}: {node} in plan"


def test_parquet_scan_prunes_columns(spark):
    import geoframe.plans  # noqa: F401
    from geoframe.plans.registry import QUERIES
    plan = _plan(QUERIES["guid_text"](spark, SF))
    assert "ReadSchema: struct<c_custkey:bigint>" in plan or "c_name" not in plan
