"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is run to completion with the ``noop`` sink (full evaluation, no
driver collect).  Fixture geodatabases are encoded first (timed separately
under ``build_*``); the scan is then measured at 1, 4 and 8 partitions.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

HEADLINE = [
    # column functions / operators on the driver's tables
    "segments_m", "segments_multipart", "delta_decode_rows", "delta_decode_array",
    "assign_object_ids", "trajectory_extent", "trajectory_polylines", "geometry_text",
    "guid_text",
    "ole_date_to_timestamp", "point_equality_group", "rows_as_map",
    # round trips through the filegdb source
    "scan_table", "scan_nulls", "shape_point_zm", "shape_polyline_m", "shape_polygon",
    "decode_shapes", "oid_point_lookup", "tolerance_check", "user_tables_v10",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _median(work) -> float:
    took = []
    for _ in range(3):
        t0 = time.time()
        work()
        took.append(time.time() - t0)
    return round(sorted(took)[1], 3)


def main() -> None:
    from geoframe.session import get_session
    import geoframe.plans  # noqa: F401
    from geoframe.plans import catalog_checks
    from geoframe.plans import fixtures as FX
    from geoframe.plans.registry import QUERIES

    spark = get_session(f"local[{CPUS}]", shuffle_partitions=max(CPUS, 1) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    sf = float(m.group(1)) if m else None

    timings: dict[str, float] = {}
    for key in FX._specs():          # every fixture table, outside the timed queries
        t0 = time.time()
        FX.ensure(spark, SF_DIR, key)
        timings[f"build_{key}"] = round(time.time() - t0, 3)
    t0 = time.time()
    catalog_checks.ensure_parts(spark, SF_DIR)
    catalog_checks.ensure_classes(spark, SF_DIR)
    timings["build_v9_catalog"] = round(time.time() - t0, 3)

    # warm-up (JVM, Python workers, data source planner) on tiny queries
    _run(QUERIES["make_point"](spark, SF_DIR))
    FX.read(spark, SF_DIR, "customer").count()

    queries: dict[str, float] = {}
    for key in HEADLINE:             # one run to warm up, then the median of three
        _run(QUERIES[key](spark, SF_DIR))
        queries[key] = _median(lambda key=key: _run(QUERIES[key](spark, SF_DIR)))

    # scan throughput of the largest fixture (lineitem as Z+M points)
    n_rows = FX.read(spark, SF_DIR, "points_zm").count()
    scan = {}
    for parts in (1, 4, 8):
        df = FX.read(spark, SF_DIR, "points_zm", numPartitions=parts)
        dt = _median(lambda df=df: _run(df))
        scan[f"scan_points_zm_p{parts}"] = round(dt, 3)
        scan[f"rows_per_sec_p{parts}"] = round(n_rows / dt, 1) if dt > 0 else None
    queries.update({k: v for k, v in scan.items() if k.startswith("scan_")})

    out = {"metric": "total_query_sec", "value": round(sum(queries.values()), 3), "unit": "sec",
           "queries": queries, "sf": sf, "cpus": CPUS, "scan_rows": n_rows,
           "throughput": {k: v for k, v in scan.items() if k.startswith("rows_")},
           "fixture_build_total_sec": round(sum(timings.values()), 3), "fixture_build_sec": timings}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
