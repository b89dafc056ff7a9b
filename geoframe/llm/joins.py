"""Joins that split hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 2048              # rows of a key that go to one task
HOTTEST = 4096            # keys that may be split


def spread_join(rows: DataFrame, values: DataFrame, keys: list[str], columns: list[str],
                share: int = SHARE) -> DataFrame:
    """``rows`` with ``columns`` of ``values``, which has one row per key; null
    keys match nothing.  The ``HOTTEST`` keys with the most rows are dealt into parts
    of some ``share`` rows, with a copy of their value each; any other key has less
    than a ``HOTTEST``-th of all rows.  Keys are counted partially before their
    shuffle, and what is broadcast has ``HOTTEST`` rows at the most."""
    hot = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("gf_n")).where(F.col("gf_n") > share)
           .orderBy(F.desc("gf_n")).limit(HOTTEST)
           .select(*keys, F.ceil(F.col("gf_n") / share).cast("int").alias("gf_parts")))
    held = (values.select(*keys, *columns).join(F.broadcast(hot), keys, "left")
            .withColumn("gf_part", F.explode(F.expr("sequence(0, coalesce(gf_parts, 1) - 1)"))).drop("gf_parts"))
    dealt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("gf_parts", F.lit(1))).cast("int")
    asked = rows.join(F.broadcast(hot), keys, "left").withColumn("gf_part", dealt).drop("gf_parts")
    return asked.join(held, [*keys, "gf_part"]).drop("gf_part")
