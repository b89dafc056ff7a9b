"""Registry of check queries: a Spark builder and, where SQL can say the same
thing, the DuckDB oracle SQL over the original parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE_SQL: dict[str, str] = {}
KIND: dict[str, str] = {}   # "T" column check, "R" round trip through the source


def query(key: str, sql: str | None = None, kind: str = "T"):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""
    def wrap(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from geoframe.session import register
            register(spark)       # source, SQL functions, package on the executors
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        KIND[key] = kind
        if sql is not None:
            ORACLE_SQL[key] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (timestamps compared in UTC)."""
    from geoframe.session import register
    register(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
