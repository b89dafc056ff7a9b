"""Skew-safe ordered scans against a plain window (brute force), including a
group that holds a third of all rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from geoframe.operators.ordered import assign_object_ids, lag_in_group, running_sum

SF = "/root/testdata/sf0.01"


def _skewed_events(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    # a third of the rows go to one hot user
    user = F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    return ev.select("event_id", "ts", user.alias("user_id"),
                     F.floor(F.col("value") * 100).cast("long").alias("v"))


@pytest.mark.parametrize("finish", ["arrow", "window"])
def test_running_sum_and_lag_hot_group(spark, finish):
    ev = _skewed_events(spark)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = ev.select("event_id",
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                     F.lag("v", 1).over(w).alias("prev"))
    got = running_sum(ev, ["user_id"], ["ts", "event_id"], {"cum": "v"}, num_ranges=16,
                      finish=finish)
    got = lag_in_group(got, ["user_id"], ["ts", "event_id"], {"prev": "v"}, num_ranges=16,
                       finish=finish)
    a = sorted(tuple(r) for r in got.select("event_id", "cum", "prev").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert a == b


def test_hot_group_is_split(spark):
    from geoframe.operators.ordered import RANGE_COL, ranged
    ev = _skewed_events(spark)
    r = ranged(ev, ["user_id"], ["ts", "event_id"], num_ranges=16)
    spans = r.filter("user_id = -1").select(RANGE_COL).distinct().count()
    assert spans > 3


@pytest.mark.parametrize("finish", ["arrow", "window"])
def test_assign_object_ids(spark, finish):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    got = assign_object_ids(li, ["l_orderkey", "l_linenumber"], start_id=100, count=5000,
                            finish=finish)
    w = Window.orderBy("l_orderkey", "l_linenumber")
    want = li.select("*", (F.row_number().over(w) + 100).alias("OBJECTID")) \
        .filter("OBJECTID <= 5100")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_track_pieces_keep_every_segment(spark):
    """Pieces of at most 8 vertices: their segments are exactly the track's
    consecutive vertex pairs, also for the hot user."""
    from geoframe.operators.segments import segments
    from geoframe.operators.trajectories import polylines_from_rows
    ev = _skewed_events(spark).withColumn("x", F.col("event_id").cast("double")) \
        .withColumn("y", F.col("v").cast("double"))
    pl = polylines_from_rows(ev, ["user_id"], ["ts", "event_id"], "x", "y", max_vertices=8,
                             num_ranges=16)
    assert pl.agg(F.max("n_vertices")).head()[0] <= 8
    got = segments(pl, "Shape", keep=["user_id"], stride=2) \
        .select("user_id", "ax", "ay", "bx", "by")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = ev.select("user_id", F.lag("x").over(w).alias("ax"), F.lag("y").over(w).alias("ay"),
                     F.col("x").alias("bx"), F.col("y").alias("by")).filter("ax IS NOT NULL")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("values", [
    [("a", 1.0), ("a", NAN), ("b", 1.0), ("b", 2.0)], [("a", 1e17), ("b", 0.1), ("b", 0.2)],
    [("a", INF), ("a", 1.0), ("b", None), ("b", 5.0), ("c", None)], [(None, 1.0), (None, 2.0), ("x", -INF)]])
def test_running_sum_of_floats_is_a_window(spark, values):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(g, i, v) for i, (g, v) in enumerate(values)], "g string, o int, v double")
    frame = Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["o"]: str(r["s"]) for r in df.withColumn("s", F.sum("v").over(frame)).collect()}
    for ranges in (1, 3):
        got = {r["o"]: str(r["s"]) for r in running_sum(df, ["g"], ["o"], {"s": "v"}, num_ranges=ranges).collect()}
        assert got == want


def test_nan_keys_are_one_group(spark):
    df = spark.createDataFrame([(NAN, i) for i in range(3)], "g double, o int").selectExpr("*", "1L AS one")
    for ranges in (1, 3):
        got = sorted(r["n"] for r in running_sum(df, ["g"], ["o"], {"n": "one"}, num_ranges=ranges).collect())
        assert got == [1, 2, 3]


def test_types_and_overflow(spark):
    from pyspark.sql import functions as F
    small = spark.createDataFrame([(1, 100), (2, 100)], "o int, v int").withColumn("v", F.col("v").cast("tinyint"))
    out = running_sum(small, [], ["o"], {"s": "v"})
    assert out.schema["s"].dataType.simpleString() == "bigint" and out.agg(F.max("s")).first()[0] == 200
    with pytest.raises(TypeError):
        running_sum(small.withColumn("v", F.col("v").cast("decimal(20,2)")), [], ["o"], {"s": "v"})
    big = spark.createDataFrame([(1, 1 << 62), (2, 1 << 62)], "o int, v long")
    with pytest.raises(Exception, match="64 bits"):
        running_sum(big, [], ["o"], {"s": "v"}, num_ranges=1).collect()


def test_ranges_follow_the_size(spark):
    from geoframe.operators.ordered import TARGET_RANGE_BYTES, _num_ranges
    df = spark.range(100_000_000_000)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size > 1000 * TARGET_RANGE_BYTES and _num_ranges(df, None) == -(-size // TARGET_RANGE_BYTES)


def test_ties_span_ranges(spark):
    from pyspark.sql import functions as F

    from geoframe.operators.ordered import RANGE_COL, ranged
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.lit(1).alias("o"), "id")
    assert ranged(df, ["g"], ["o"], 8).select(RANGE_COL).distinct().count() == 8


def _key_rows():
    import datetime
    import random
    from decimal import Decimal
    rng = random.Random(3)
    pick = lambda *x: rng.choice(x)
    return [(pick(None, "", "a", "é", "\U0001f600", "b"), pick(None, NAN, INF, -INF, 0.0, -0.0, 1.5),
             pick(None, Decimal("1.20"), Decimal("-3.00")), pick(None, datetime.date(2020, 1, 2), datetime.date(1960, 1, 1)),
             pick(None, datetime.datetime(2020, 1, 2, 3), datetime.datetime(1960, 1, 1)), pick(None, True, False),
             pick(None, b"", b"\xff", b"a\0"), rng.randrange(5)) for _ in range(400)]


@pytest.mark.parametrize("order", [["s"], ["f", "i"], ["d", "s", "f"], ["a", "t", "b"], ["y", "i"], ["i"]])
def test_ids_follow_sparks_order(spark, order):
    """Every key type, nulls, ties: consecutive ids in Spark's own order."""
    df = spark.createDataFrame(_key_rows(), "s string, f double, d decimal(9,2), a date, t timestamp, b boolean, "
                                            "y binary, i int").repartition(3)
    got = assign_object_ids(df, order, num_ranges=7).orderBy("OBJECTID").collect()
    assert [r["OBJECTID"] for r in got] == list(range(1, 401))
    key = lambda r: str(tuple(x + 0.0 if isinstance(x, float) else x for x in (r[c] for c in order)))
    assert [key(r) for r in got] == [key(r) for r in df.orderBy(*order).collect()]


def test_ids_without_a_copy(spark):
    """No checkpoint; a hot key spans buckets; later buckets are not shuffled."""
    from geoframe.operators.ordered import _bucketed
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    out = assign_object_ids(df, ["k"], num_ranges=20)
    plan = out._jdf.queryExecution().toString()
    assert "Scan ExistingRDD" not in plan and "LogicalRDD" not in plan
    assert sorted(r["OBJECTID"] for r in out.collect()) == list(range(1, 6001))
    assert _bucketed(df, ["k"], 20)[0].where("k = 7").select("_gf_bucket").distinct().count() > 8
    few = assign_object_ids(df, ["k"], count=50, start_id=9, num_ranges=20).collect()
    assert sorted(r["OBJECTID"] for r in few) == list(range(10, 60))
    assert sorted(r["k"] for r in few) == sorted(r["k"] for r in df.collect())[:50]
    for n in (0, 6000, 9999):
        assert assign_object_ids(df, ["k"], count=n, num_ranges=20).count() == min(n, 6000)
    assert assign_object_ids(df.where("id < 0"), ["k"]).collect() == []


@pytest.mark.parametrize("kind", ["long", "double"])
def test_sums_of_differences(spark, kind):
    """A null is neither a difference nor a value before one; ranges of a few rows
    carry the last value and the sum, also where a group spans several."""
    import random
    from pyspark.sql import Window
    rng = random.Random(8)
    rows = [(rng.choice([1, 1, 1, 2, None]), i, rng.choice([None, *range(-5, 9)])) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, o int, v long").withColumn("v", F.col("v").cast(kind))
    w = Window.partitionBy("g").orderBy("o")
    want = df.withColumn("d", F.col("v") - F.coalesce(F.lag("v").over(w), F.lit(0))).select(
        "o", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"), F.lag("v").over(w).alias("p"))
    for n in (1, 2, 9, 60):
        from geoframe.operators.ordered import ordered_scan
        got = ordered_scan(df, ["g"], ["o"], lags={"p": "v"}, difference_sums={"s": "v"}, num_ranges=n)
        assert sorted(map(tuple, got.select("o", "s", "p").collect())) == sorted(map(tuple, want.collect()))


def test_floats_of_many_small_groups():
    """The same additions as one after the other, whatever the groups' sizes."""
    import numpy as np

    from geoframe.operators.ordered import LONG, _running
    rng = np.random.default_rng(4)
    size = np.concatenate([rng.integers(1, 9, 400), [LONG - 1, LONG, LONG + 1, 300], rng.integers(1, 3, 50)])
    vals = rng.standard_normal(size.sum()) * 10.0 ** rng.integers(-9, 9, size.sum())
    starts = np.zeros(len(vals), bool)
    starts[np.cumsum(size) - size] = True
    for carry in (None, 0.1):
        want, acc = [], 0.0
        for v, s in zip(vals.tolist(), starts.tolist()):
            acc = v + (carry or 0.0) if s and not want else v if s else acc + v
            want.append(acc)
        assert _running(vals, np.ones(len(vals), bool), starts, carry)[0].tolist() == want
