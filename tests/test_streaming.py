"""Geometry expressions on a streaming DataFrame (memory sink)."""

from pyspark.sql import functions as F

from geoframe.functions.geometry import poly_from_coords
from geoframe.operators.segments import segments


def test_segments_on_stream(spark):
    src = "/root/testdata/sf0.001/embeddings.parquet"
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "embeddings.parquet") \
        .parquet("/root/testdata/sf0.001")
    shapes = stream.select("vec_id", poly_from_coords(F.slice("embedding", 1, 63), None, 3)
                           .alias("Shape"))
    segs = segments(shapes, "Shape", keep=["vec_id"], stride=3)
    q = segs.writeStream.format("memory").queryName("gf_stream_segments") \
        .outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    n_stream = spark.sql("SELECT count(*) FROM gf_stream_segments").head()[0]
    batch = segments(spark.read.parquet(src).select(
        "vec_id", poly_from_coords(F.slice("embedding", 1, 63), None, 3).alias("Shape")),
        "Shape", keep=["vec_id"], stride=3)
    assert n_stream == batch.count() > 0
