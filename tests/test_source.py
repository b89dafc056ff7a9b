"""End-to-end behaviour of the filegdb source on fixtures written by the
distributed test encoder (the surveyed suite's Types / Points checks, plus
errors, metadata, pushdown, layouts)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from geoframe.session import local_path
from geoframe.sources.catalog import id_column
from geoframe.sources.filegdb import read_table
from geoframe.testing.encoder import FieldSpec, ShapeSpec, TableSpec, write_table

GUID = "{2AA7D58D-2BF4-4943-83A8-457B70DB1871}"
GUID_BYTES = bytes.fromhex("8DD5A72AF42B434983A8457B70DB1871")


def _types_table(spark, path):
    df = spark.createDataFrame(
        [(1, 33.8869, 35.5131, "Beirut", 33.8869, 35.5131, 33, 35,
          dt.datetime(2016, 1, 1, 7, 24, 32), GUID_BYTES)],
        "k int, px double, py double, A_TEXT string, A_FLOAT float, A_DOUBLE double, "
        "A_SHORT short, A_LONG int, A_DATE timestamp_ntz, A_GUID binary")
    spec = TableSpec([
        ShapeSpec("Shape", "point", x="px", y="py", x_orig=-400.0, y_orig=-400.0,
                  xy_scale=1e8, xy_tol=1e-8),
        FieldSpec("A_TEXT", "string", alias="A Text", max_length=32),
        FieldSpec("A_FLOAT", "float32", alias="A Float"),
        FieldSpec("A_DOUBLE", "float64", alias="A Double"),
        FieldSpec("A_SHORT", "int16", alias="A Short"),
        FieldSpec("A_LONG", "int32", alias="A Long"),
        FieldSpec("A_DATE", "datetime", alias="A Date"),
        FieldSpec("A_GUID", "guid", alias="A GUID"),
    ])
    write_table(spark, path, "a00000009", df, spec, ["k"], num_partitions=1)
    return spark.read.format("filegdb").option("path", path).option("table", "a00000009").load()


def test_types_first_row(spark, tmp_gdb):
    df = _types_table(spark, tmp_gdb)
    row = df.head()
    assert abs(row.Shape.x - 33.8869) <= 1e-8 and abs(row.Shape.y - 35.5131) <= 1e-8
    assert row.A_TEXT == "Beirut"
    assert abs(row.A_FLOAT - 33.8869) < 1e-5 and row.A_DOUBLE == 35.5131
    assert row.A_SHORT == 33 and row.A_LONG == 35
    got = df.select(F.unix_millis("A_DATE")).head()[0]
    assert abs(got - 1451633072000) <= 1        # ceil may add 1 ms
    assert row.A_GUID == GUID
    md = {f.name: f.metadata for f in df.schema.fields}
    assert md["A_TEXT"]["alias"] == "A Text" and md["A_TEXT"]["maxLength"] == 32
    assert md["A_GUID"]["alias"] == "A GUID" and md["Shape"]["alias"] == "Shape"
    assert md["Shape"]["geometryType"] == "point" and md["Shape"]["xyTolerance"] == 1e-8
    assert md["OBJECTID"]["isObjectId"] is True


def test_describe_fields(spark, tmp_gdb):
    from geoframe.operators.tables import describe_fields
    df = _types_table(spark, tmp_gdb)
    d = {r.name: r for r in describe_fields(spark, df).collect()}
    assert d["A_DATE"].type == "timestamp" and d["A_DATE"].alias == "A Date"
    assert d["Shape"].geometry_type == "point" and d["Shape"].has_z is False


def test_required_options(spark, tmp_gdb):
    with pytest.raises(Exception, match="path"):
        spark.read.format("filegdb").option("name", "x").load()
    with pytest.raises(Exception, match="name"):
        spark.read.format("filegdb").option("path", tmp_gdb).load()


def _catalog(spark, path, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "slot long, Name string")
    write_table(spark, path, "a00000001", df,
                TableSpec([FieldSpec("Name", "string")], oid_name="ID", slot_col="slot"),
                ["slot"], num_partitions=1)


def test_missing_table_is_empty(spark, tmp_gdb):
    _catalog(spark, tmp_gdb, ["GDB_SystemCatalog"])
    df = spark.read.format("filegdb").option("path", tmp_gdb).option("name", "Nope").load()
    assert df.columns == [] and df.count() == 0
    assert id_column(spark, tmp_gdb, "Nope") is None


def _customers(spark, path, **kw):
    c = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    spec = TableSpec([FieldSpec("c_custkey", "int32"), FieldSpec("c_name", "string"),
                      ShapeSpec("Shape", "point", x="c_acctbal", y="c_nationkey",
                                x_orig=-2000, y_orig=-10)], **kw)
    write_table(spark, path, "a00000009", c.withColumn("bad", F.col("c_custkey") % 5 == 1),
                spec, ["c_custkey"], num_partitions=3)
    return c


def test_user_schema_and_errors(spark, tmp_gdb):
    _customers(spark, tmp_gdb)
    r = spark.read.format("filegdb").option("path", tmp_gdb).option("table", "a00000009")
    df = r.schema("c_name string, OBJECTID int").load()
    assert df.columns == ["c_name", "OBJECTID"] and df.count() == 150
    with pytest.raises(Exception, match="not in table"):
        r.schema("nope string").load().collect()
    with pytest.raises(Exception, match="is int"):
        r.schema("c_custkey string").load().collect()


def test_malformed_modes(spark, tmp_gdb):
    c = _customers(spark, tmp_gdb, corrupt_col="bad")
    r = spark.read.format("filegdb").option("path", tmp_gdb).option("table", "a00000009")
    perm = r.load()
    n_bad = c.filter(F.col("c_custkey") % 5 == 1).count()
    assert perm.filter(F.col("OBJECTID").isNull()).count() == n_bad
    assert perm.filter(F.col("c_name").isNull() & F.col("Shape").isNull()).count() == n_bad
    assert r.option("mode", "DROPMALFORMED").load().count() == c.count() - n_bad
    with pytest.raises(Exception, match="malformed"):
        r.option("mode", "FAILFAST").load().collect()


def test_pushdown_prunes_partitions(spark, tmp_gdb):
    _catalog(spark, tmp_gdb, [f"t{i}" for i in range(8)] + ["Customers"])
    _customers(spark, tmp_gdb)
    full = read_table(spark, tmp_gdb, "Customers", num_partitions=8, pushdown=False)
    one = read_table(spark, tmp_gdb, "Customers", num_partitions=8).filter("OBJECTID = 7")
    rng = read_table(spark, tmp_gdb, "Customers", num_partitions=8) \
        .filter("OBJECTID >= 1 AND OBJECTID <= 2")
    assert full.rdd.getNumPartitions() == 8
    assert one.rdd.getNumPartitions() == 1
    assert [r.OBJECTID for r in one.collect()] == [7]
    assert sorted(r.OBJECTID for r in rng.collect()) == [1, 2]
    assert id_column(spark, tmp_gdb, "Customers") == "OBJECTID"


def test_wide_offsets_beyond_4gb(spark, tmp_gdb):
    """5-byte offsets pointing past 4 GiB (a sparse hole before the rows)."""
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    spec = TableSpec([FieldSpec("n_nationkey", "int32"), FieldSpec("n_name", "string")],
                     offset_width=5, row_gap=(1 << 32) + 12345)
    write_table(spark, tmp_gdb, "a00000002", nation, spec, ["n_nationkey"], num_partitions=2)
    df = spark.read.format("filegdb").option("path", tmp_gdb).option("table", "a00000002").load()
    got = sorted((r.n_nationkey, r.n_name) for r in df.collect())
    want = sorted((r.n_nationkey, r.n_name) for r in nation.collect())
    assert got == want
    assert os.path.getsize(os.path.join(local_path(tmp_gdb), "a00000002.gdbtable")) > 1 << 32


@pytest.mark.parametrize("gap", [(1 << 32) + 12345, (1 << 32) - 400])
def test_offsets_past_4gib_by_default(spark, tmp_gdb, gap):
    """The default width grows with the file, also where only some rows need it."""
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    spec = TableSpec([FieldSpec("n_nationkey", "int32"), FieldSpec("n_name", "string")], row_gap=gap)
    write_table(spark, tmp_gdb, "a00000002", nation, spec, ["n_nationkey"], num_partitions=2)
    df = spark.read.format("filegdb").option("path", tmp_gdb).option("table", "a00000002").load()
    got = sorted((r.n_nationkey, r.n_name) for r in df.collect())
    assert got == sorted((r.n_nationkey, r.n_name) for r in nation.collect())
    assert os.path.getsize(os.path.join(local_path(tmp_gdb), "a00000002.gdbtable")) > 1 << 32


def test_offset_width_of_a_size():
    from geoframe.testing.encoder import _offset_width
    sizes = (0, 41, 1 << 32, (1 << 32) + 1, 1 << 40, (1 << 40) + 1, 1 << 48)
    assert [_offset_width(TableSpec([]), n) for n in sizes] == [4, 4, 4, 5, 5, 6, 6]
    assert _offset_width(TableSpec([], offset_width=6), 41) == 6
    with pytest.raises(ValueError, match="6 bytes"):
        _offset_width(TableSpec([]), (1 << 48) + 1)


def _patch(path, table, offset, value):
    with open(os.path.join(local_path(path), table + ".gdbtable"), "r+b") as fh:
        fh.seek(offset)
        fh.write(bytes([value]))


def test_polyline_z_and_unknown_type_rejected(spark, tmp_gdb):
    df = spark.createDataFrame([(1, [0.0, 0.0, 1.0, 1.0])], "k int, xy array<double>")
    spec = TableSpec([ShapeSpec("Shape", "polyline", coords="xy")], oid_name=None)
    write_table(spark, tmp_gdb, "a00000003", df, spec, ["k"], num_partitions=1)
    r = spark.read.format("filegdb").option("path", tmp_gdb).option("table", "a00000003")
    assert r.load().head().Shape.xyArr == [0.0, 0.0, 1.0, 1.0]
    _patch(tmp_gdb, "a00000003", 40 + 11, 0x80)          # geometry property: Z
    with pytest.raises(Exception, match="Z values"):
        r.load()
    _patch(tmp_gdb, "a00000003", 40 + 11, 0x00)
    _patch(tmp_gdb, "a00000003", 40 + 14 + 1 + 10 + 1, 42)   # type code of field 1
    with pytest.raises(Exception, match="type code 42"):
        r.load()


def test_in_pushdown_and_columns_option(spark, tmp_gdb):
    _catalog(spark, tmp_gdb, [f"t{i}" for i in range(8)] + ["Customers"])
    _customers(spark, tmp_gdb)
    ids = [3, 4, 5, 77, 140]
    df = read_table(spark, tmp_gdb, "Customers", num_partitions=10) \
        .filter(F.col("OBJECTID").isin(ids))
    assert sorted(r.OBJECTID for r in df.collect()) == ids
    assert df.rdd.getNumPartitions() <= 3
    cols = read_table(spark, tmp_gdb, "Customers", columns="c_name, OBJECTID")
    assert cols.columns == ["c_name", "OBJECTID"] and cols.count() == 150
    with pytest.raises(Exception, match="not in table"):
        read_table(spark, tmp_gdb, "Customers", columns="nope")


def test_raster_column_and_rdd_reader(spark, tmp_gdb):
    from geoframe.sources.filegdb import read_rdd
    _catalog(spark, tmp_gdb, [f"t{i}" for i in range(8)] + ["Rasters"])
    df = spark.range(5).select(F.col("id").cast("int").alias("k"))
    spec = TableSpec([FieldSpec("k", "int32"), FieldSpec("Img", "raster", source="IMG_COL",
                                                         alias="Image"),
                      FieldSpec("after", "int32", source="k")])
    write_table(spark, tmp_gdb, "a00000009", df, spec, ["k"], num_partitions=1)
    r = read_table(spark, tmp_gdb, "Rasters", pushdown=False)
    md = r.schema["Img"].metadata
    assert md["RasterColumn"] == "IMG_COL" and md["alias"] == "Image"
    assert r.schema["Img"].dataType.simpleString() == "binary"
    rows = sorted(r.collect(), key=lambda x: x.k)
    assert [x.Img for x in rows] == [None] * 5 and [x.after for x in rows] == list(range(5))
    rdd = read_rdd(spark, tmp_gdb, "Rasters", num_partitions=2)
    assert sorted(row["k"] for row in rdd.collect()) == list(range(5))


def test_unsupported_geometry_kind_gives_raw_blob(spark, tmp_gdb):
    """A geometry kind without a decoder (here: the layer type patched to
    multipoint) comes back as the stored blob; other columns stay intact."""
    df = spark.createDataFrame([(1, 5.0, 6.0), (2, 7.0, 8.0)], "k int, x double, y double")
    spec = TableSpec([FieldSpec("k", "int32"), ShapeSpec("Shape", "point", x="x", y="y")])
    write_table(spark, tmp_gdb, "a00000005", df, spec, ["k"], num_partitions=1)
    _patch(tmp_gdb, "a00000005", 40 + 8, 2)     # geometry type byte: multipoint
    r = spark.read.format("filegdb").option("path", tmp_gdb).option("table", "a00000005").load()
    assert r.schema["Shape"].dataType.simpleString() == "binary"
    assert r.schema["Shape"].metadata["geometryType"] == "unsupported"
    rows = sorted(r.collect(), key=lambda x: x.k)
    assert [x.k for x in rows] == [1, 2]
    assert all(isinstance(x.Shape, (bytes, bytearray)) and len(x.Shape) > 0 for x in rows)


def test_layer_extent_metadata_matches_data(spark, tmp_gdb):
    c = _customers(spark, tmp_gdb)
    r = spark.read.format("filegdb").option("path", tmp_gdb).option("table", "a00000009").load()
    md = r.schema["Shape"].metadata
    want = c.agg(F.min("c_acctbal"), F.min("c_nationkey"), F.max("c_acctbal"),
                 F.max("c_nationkey")).head()
    assert (md["xmin"], md["ymin"], md["xmax"], md["ymax"]) == tuple(float(v) for v in want)


def test_partitions_sized_by_file_bytes(spark, tmp_gdb):
    _customers(spark, tmp_gdb)
    r = spark.read.format("filegdb").option("path", tmp_gdb).option("table", "a00000009")
    assert r.load().rdd.getNumPartitions() == 8           # small file: the default 8
    size = os.path.getsize(os.path.join(local_path(tmp_gdb), "a00000009.gdbtable"))
    many = r.option("bytesPerPartition", str(size // 20)).load()
    assert many.rdd.getNumPartitions() >= 15 and many.count() == 150
