"""Geodatabase fixtures for the round-trip (R) checks.

Each fixture table is encoded from one of the driver's parquet tables by the
distributed test writer, into a folder below the shared checkpoint
directory, once per session and scale.  The checks then read it back through
the ``filegdb`` source; their oracle SQL works on the original tables.

Encoding rules the oracle SQL mirrors:
* point ordinate stored as ``floor((x - origin) * scale) + 1``
* poly ordinate stored as ``floor((x - origin) * scale)``, delta coded
* dates stored as ``epoch_us / 86400e6 + 25569`` days
* rows are written in the order of the ``order_by`` key, so ``OBJECTID`` is
  the key's rank (plus gaps for the deleted / sparse layouts)
"""

from __future__ import annotations

import hashlib
import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.operators.ordered import assign_object_ids
from geoframe.plans.registry import table
from geoframe.session import local_path, shared_path
from geoframe.testing.encoder import FieldSpec, ShapeSpec, TableSpec, write_table

_LOCK = threading.Lock()

# point layer parameters
PT = dict(x_orig=-2000.0, y_orig=-10.0, xy_scale=1000.0)
LI = dict(x_orig=0.0, y_orig=0.0, xy_scale=100.0, z_orig=-1.0, z_scale=1000.0,
          m_orig=-1.0, m_scale=1000.0)
EMB = dict(x_orig=-10.0, y_orig=-10.0, xy_scale=1000000.0, m_orig=-10.0, m_scale=100000.0)


def _customer(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("*", F.col("c_acctbal").alias("X"),
                    F.col("c_nationkey").cast("double").alias("Y"))


def _customer_rid(spark, sf):
    c = _customer(spark, sf)
    return assign_object_ids(c, ["c_custkey"], id_col="RID")


def _orders_types(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 3

    def nul(c, r):
        return F.when(k != r, c)
    return o.select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"),
        nul(F.col("o_custkey").cast("int"), 0).alias("o_custkey"),
        nul(F.col("o_orderstatus"), 1).alias("o_orderstatus"),
        nul(F.col("o_totalprice"), 2).alias("o_totalprice"),
        nul(F.col("o_totalprice").cast("float"), 0).alias("price32"),
        nul(F.col("o_orderdate"), 1).alias("o_orderdate"),
        nul(F.col("o_orderpriority"), 2).alias("o_orderpriority"),
        nul(F.concat(F.lit("<p>"), F.col("o_orderpriority"), F.lit("</p>")), 0).alias("prio_xml"),
        nul((F.col("o_custkey") % 30000).cast("short"), 1).alias("cust16"),
        nul(F.unhex(F.md5(F.col("o_orderkey").cast("string"))), 2).alias("guid"),
        nul(F.unhex(F.md5(F.col("o_custkey").cast("string"))), 0).alias("uuid"),
        nul(F.encode(F.col("o_orderpriority"), "UTF-8"), 1).alias("raw"))


_TYPES_FIELDS = [
    FieldSpec("o_orderkey", "int32", nullable=False),
    FieldSpec("o_custkey", "int32", alias="Customer"),
    FieldSpec("o_orderstatus", "string", max_length=1),
    FieldSpec("o_totalprice", "float64", default=b"\0" * 8),
    FieldSpec("price32", "float32"),
    FieldSpec("o_orderdate", "datetime"),
    FieldSpec("o_orderpriority", "string", alias="Priority", max_length=32, default=b"x"),
    FieldSpec("prio_xml", "xml"),
    FieldSpec("cust16", "int16", default=b"\0\0"),
    FieldSpec("guid", "guid"),
    FieldSpec("uuid", "uuid"),
    FieldSpec("raw", "binary"),
    FieldSpec("RasterCol", "raster", source="RASTER"),
]


def _lineitem_points(spark, sf):
    li = table(spark, sf, "lineitem")
    sub = F.element_at(F.array(F.lit(1), F.lit(9), F.lit(21), F.lit(11)),
                       (F.col("l_linenumber") % 4 + 1).cast("int"))
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount",
                     "l_tax", sub.alias("subtype"))


def _emb_lines(spark, sf):
    e = table(spark, sf, "embeddings")
    vid = F.col("vec_id")
    xy = F.when(vid % 50 == 7, F.array().cast("array<double>")) \
        .otherwise(F.col("embedding").cast("array<double>"))
    k = (vid % 5 + 1).cast("int")
    parts = F.when(vid % 50 == 7, F.array().cast("array<int>")) \
        .otherwise(F.array(k, (F.size("embedding") / 2).cast("int") - k))
    from geoframe.plans.column_checks import xym
    m_xy = xym()
    m_parts = F.array((vid % 4 + 2).cast("int"),
                      ((F.size("embedding") / 2).cast("int") - vid % 4 - 2).cast("int"))
    ring = F.concat(F.col("embedding"), F.slice("embedding", 1, 2)).cast("array<double>")
    return e.select("vec_id", xy.alias("xy"), parts.alias("parts"), m_xy.alias("xym"),
                    m_parts.alias("m_parts"), ring.alias("ring"),
                    (vid % 9 == 0).alias("curve"))


def _nation(spark, sf):
    return table(spark, sf, "nation")


# key -> (hex table name, catalog name, frame builder, spec, order key)
def _specs():
    point = ShapeSpec("Shape", "point", x="c_acctbal", y="c_nationkey", **PT)
    cust_fields = [FieldSpec("c_custkey", "int32", nullable=False),
                   FieldSpec("c_name", "string", alias="Customer Name", max_length=25),
                   FieldSpec("c_nationkey", "int16"), FieldSpec("c_acctbal", "float64"),
                   FieldSpec("c_mktsegment", "string", max_length=10), point,
                   FieldSpec("X", "float64"), FieldSpec("Y", "float64")]
    li = [FieldSpec("l_orderkey", "int32", nullable=False),
          FieldSpec("l_linenumber", "int16", nullable=False)]
    return {
        "customer": ("a00000009", "Customers", _customer_rid,
                     TableSpec(cust_fields + [FieldSpec("RID", "int32")]), ["c_custkey"]),
        "orders_types": ("a0000000a", "OrderTypes", _orders_types,
                         TableSpec(_TYPES_FIELDS), ["o_orderkey"]),
        "customer_deleted": ("a0000000b", "CustomersDeleted", _customer,
                             TableSpec(cust_fields, deleted_every=7), ["c_custkey"]),
        "orders_sparse": ("a0000000c", "OrdersSparse", _orders_types,
                          TableSpec(_TYPES_FIELDS[:4], sparse_blocks=True), ["o_orderkey"]),
        "nation_w5": ("a0000000d", "Nation5", _nation,
                      TableSpec([FieldSpec("n_nationkey", "int32"), FieldSpec("n_name", "string"),
                                 FieldSpec("n_regionkey", "int32")], offset_width=5),
                      ["n_nationkey"]),
        "nation_w6": ("a0000000e", "Nation6", _nation,
                      TableSpec([FieldSpec("n_nationkey", "int32"), FieldSpec("n_name", "string"),
                                 FieldSpec("n_regionkey", "int32")], offset_width=6,
                                no_block_count=True), ["n_nationkey"]),
        "customer_malformed": ("a0000000f", "CustomersMalformed",
                               lambda s, d: _customer(s, d).withColumn(
                                   "bad", F.col("c_custkey") % 11 == 5),
                               TableSpec(cust_fields, corrupt_col="bad"), ["c_custkey"]),
        "points_m": ("a00000010", "LinePointsM", _lineitem_points,
                     TableSpec(li + [ShapeSpec("Shape", "pointM", x="l_extendedprice",
                                               y="l_quantity", m="l_tax", **LI)]),
                     ["l_orderkey", "l_linenumber"]),
        "points_z": ("a00000011", "LinePointsZ", _lineitem_points,
                     TableSpec(li + [ShapeSpec("Shape", "pointZ", x="l_extendedprice",
                                               y="l_quantity", z="l_discount", **LI)]),
                     ["l_orderkey", "l_linenumber"]),
        "points_zm": ("a00000012", "LinePointsZM", _lineitem_points,
                      TableSpec(li + [ShapeSpec("Shape", "pointZM", x="l_extendedprice",
                                                y="l_quantity", z="l_discount", m="l_tax",
                                                subtype="subtype", **LI)]),
                      ["l_orderkey", "l_linenumber"]),
        "lines": ("a00000013", "EmbeddingLines", _emb_lines,
                  TableSpec([FieldSpec("vec_id", "int32"),
                             ShapeSpec("Shape", "polyline", coords="xy", parts="parts",
                                       curve="curve", **EMB)]), ["vec_id"]),
        "lines_m": ("a00000014", "EmbeddingLinesM", _emb_lines,
                    TableSpec([FieldSpec("vec_id", "int32"),
                               ShapeSpec("Shape", "polylineM", coords="xym", parts="m_parts",
                                         **EMB)]), ["vec_id"]),
        "polygons": ("a00000015", "EmbeddingPolygons", _emb_lines,
                     TableSpec([FieldSpec("vec_id", "int32"),
                                ShapeSpec("Shape", "polygon", coords="ring", trailing_m=True,
                                          **EMB)]), ["vec_id"]),
    }


# Names of the system tables.
SYSTEM_TABLES = [(1, "GDB_SystemCatalog"), (2, "GDB_DBTune"), (3, "GDB_SpatialRefs"),
                 (4, "GDB_Items"), (5, "GDB_ItemTypes"), (6, "GDB_ItemRelationships"),
                 (7, "GDB_ItemRelationshipTypes"), (8, "GDB_ReplicaLog")]


def catalog_entries() -> list[tuple[int, str]]:
    """The catalog by which the fixture tables are found."""
    return sorted([*SYSTEM_TABLES, *((int(h[1:], 16), name) for h, name, *_ in _specs().values())])


def gdb_path(spark: SparkSession, sf_dir: str, flavour: str = "v10") -> str:
    tag = hashlib.md5(os.path.abspath(sf_dir).encode()).hexdigest()[:10]
    return shared_path(spark, "geoframe-fixtures", f"{tag}-{flavour}.gdb")


def _ready(path: str, name: str) -> str:
    return os.path.join(local_path(path), f".{name}.ready")


def _write_once(spark, path, name, make):
    marker = _ready(path, name)
    if os.path.exists(marker):
        return
    make()
    with open(marker, "w") as fh:
        fh.write("ok")


def _write_catalog(spark, path):
    rows = catalog_entries()
    df = spark.createDataFrame([(i - 1, n, 2) for i, n in rows],
                               "slot long, Name string, FileFormat int")
    spec = TableSpec([FieldSpec("Name", "string", max_length=160),
                      FieldSpec("FileFormat", "int32")], oid_name="ID", slot_col="slot")
    write_table(spark, path, "a00000001", df, spec, ["slot"], num_partitions=2)


def ensure(spark: SparkSession, sf_dir: str, key: str) -> str:
    """Path of the v10 fixture geodatabase with table ``key`` written."""
    from geoframe.session import register
    register(spark)
    path = gdb_path(spark, sf_dir)
    with _LOCK:
        os.makedirs(local_path(path), exist_ok=True)
        _write_once(spark, path, "catalog", lambda: _write_catalog(spark, path))
        hexname, _, build, spec, order = _specs()[key]
        _write_once(spark, path, key, lambda: write_table(
            spark, path, hexname, build(spark, sf_dir), spec, order))
    return path


def ensure_written(spark: SparkSession, path: str, makers: dict) -> str:
    """``path`` with what each of ``makers`` writes, once per session and scale."""
    from geoframe.session import register
    register(spark)
    with _LOCK:
        os.makedirs(local_path(path), exist_ok=True)
        for name, make in makers.items():
            _write_once(spark, path, name, make)
    return path


def read(spark: SparkSession, sf_dir: str, key: str, **opts) -> DataFrame:
    from geoframe.session import register
    path = ensure(spark, sf_dir, key)
    register(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")   # checks compare UTC values
    r = spark.read.format("filegdb").option("path", path).option("name", _specs()[key][1])
    for k, v in opts.items():
        r = r.option(k, str(v))
    return r.load()


def catalog_name(key: str) -> str:
    return _specs()[key][1]
