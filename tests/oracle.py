"""Run registered queries next to their DuckDB oracle SQL and compare.

CLI: ``python -m tests.oracle [sf_dir] [key ...]`` prints one line per key.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None) if v.tzinfo else v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare_frames(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame,
                   rel_tol: float = 0.0) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return False, f"columns {sorted(spark_pdf.columns)} != {sorted(oracle_pdf.columns)}"
    if len(spark_pdf) != len(oracle_pdf):
        return False, f"rows {len(spark_pdf)} != {len(oracle_pdf)}"
    a, b = _rows(spark_pdf), _rows(oracle_pdf)
    for i, (ra, rb) in enumerate(zip(a, b)):
        for x, y in zip(ra, rb):
            if x == y:
                continue
            if isinstance(x, (int, float)) and isinstance(y, (int, float)) and rel_tol and \
                    math.isclose(float(x), float(y), rel_tol=rel_tol, abs_tol=rel_tol):
                continue
            return False, f"row {i}: {ra} != {rb}"
    return True, f"{len(a)} rows"


_SPARK_TO_DUCK = {"smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT",
                  "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                  "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                  "binary": "BLOB", "date": "DATE"}


def type_mismatches(schema, rel) -> list:
    """Columns whose Spark type differs from the DuckDB result type."""
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in schema.fields:
        want = _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if duck_types.get(f.name) != want:
            out.append((f.name, f.dataType.simpleString(), duck_types.get(f.name)))
    return out


def run(spark, key: str, sf_dir: str, con=None) -> tuple[bool, str, float]:
    import geoframe.plans  # noqa: F401
    from geoframe.plans.registry import ORACLE_SQL, QUERIES

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[key](spark, sf_dir)
    spdf = sdf.toPandas()
    dt = time.time() - t0
    if key not in ORACLE_SQL:
        return True, f"{len(spdf)} rows (no oracle)", dt
    rel = con.sql(ORACLE_SQL[key])
    bad_types = type_mismatches(sdf.schema, rel)
    odf = rel.df()
    ok, msg = compare_frames(spdf, odf)
    if ok and bad_types:
        return False, f"types differ: {bad_types}", dt
    return ok, msg, dt


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    from geoframe.session import get_session
    import geoframe.plans  # noqa: F401
    from geoframe.plans.registry import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(QUERIES)
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            ok, msg, dt = run(spark, k, sf_dir, con)
        except Exception as e:  # report and go on
            ok, msg, dt = False, f"ERROR {type(e).__name__}: {str(e)[:400]}", 0.0
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k:28s} {dt:6.2f}s {msg}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
