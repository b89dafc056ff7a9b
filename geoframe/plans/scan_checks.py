"""R checks: parquet table -> geodatabase fixture (distributed test writer)
-> ``filegdb`` source -> query; the oracle SQL runs on the original table.

See ``plans.fixtures`` for the encoding rules the SQL mirrors.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoframe.operators.shapes import decode_shapes, shape_params
from geoframe.operators.tables import tolerance_check
from geoframe.plans import fixtures as FX
from geoframe.plans.column_checks import XYM_SQL
from geoframe.plans.registry import query
from geoframe.sources.filegdb import read_table


def _deq_point(col: str, orig: float, scale: float) -> str:
    return (f"(CAST(floor((CAST({col} AS DOUBLE) - ({orig})) * {scale}) + 1 AS BIGINT) - 1.0)"
            f" / {scale} + ({orig})")


def _deq(col: str, orig: float, scale: float) -> str:
    return f"CAST(floor((CAST({col} AS DOUBLE) - ({orig})) * {scale}) AS BIGINT) / {scale} + ({orig})"


_X = _deq_point("c_acctbal", -2000.0, 1000.0)
_Y = _deq_point("c_nationkey", -10.0, 1000.0)
_RN_C = "CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER)"

_CUSTOMER_SQL = f"""
SELECT {_RN_C} AS OBJECTID, CAST(c_custkey AS INTEGER) AS c_custkey, c_name,
       CAST(c_nationkey AS SMALLINT) AS c_nationkey, c_acctbal, c_mktsegment,
       {_X} AS x, {_Y} AS y, c_acctbal AS X_attr, CAST(c_nationkey AS DOUBLE) AS Y_attr,
       {_RN_C} AS RID
FROM customer
"""


def _customer_cols(df):
    return df.select("OBJECTID", "c_custkey", "c_name", "c_nationkey", "c_acctbal",
                     "c_mktsegment", F.col("Shape.x").alias("x"), F.col("Shape.y").alias("y"),
                     F.col("X").alias("X_attr"), F.col("Y").alias("Y_attr"), "RID")


@query("scan_table", _CUSTOMER_SQL, kind="R")
def scan_table(spark, sf_dir):
    return _customer_cols(FX.read(spark, sf_dir, "customer"))


@query("read_helper", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name FROM customer",
       kind="R")
def read_helper(spark, sf_dir):
    path = FX.ensure(spark, sf_dir, "customer")
    df = read_table(spark, path, FX.catalog_name("customer"), num_partitions=3,
                    columns="c_custkey,c_name")
    return df.select("c_custkey", "c_name")


@query("ddl_source", f"SELECT {_RN_C} AS OBJECTID, c_name FROM customer", kind="R")
def ddl_source(spark, sf_dir):
    path = FX.ensure(spark, sf_dir, "customer")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW gf_ddl_customers USING filegdb "
              f"OPTIONS (path '{path}', name '{FX.catalog_name('customer')}', "
              f"numPartitions '2', columns 'OBJECTID,c_name')")
    return spark.sql("SELECT OBJECTID, c_name FROM gf_ddl_customers")


@query("sql_over_view", """
SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS max_bal,
       min(CAST(c_nationkey AS SMALLINT)) AS min_nation
FROM customer GROUP BY c_mktsegment
""", kind="R")
def sql_over_view(spark, sf_dir):
    FX.read(spark, sf_dir, "customer", columns="c_mktsegment,c_acctbal,c_nationkey") \
        .createOrReplaceTempView("gf_customers")
    return spark.sql("SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS max_bal, "
                     "min(c_nationkey) AS min_nation FROM gf_customers GROUP BY c_mktsegment")


@query("scan_user_schema", f"SELECT c_name, {_RN_C} AS OBJECTID FROM customer", kind="R")
def scan_user_schema(spark, sf_dir):
    path = FX.ensure(spark, sf_dir, "customer")
    return spark.read.format("filegdb").schema("c_name string, OBJECTID int") \
        .option("path", path).option("name", FX.catalog_name("customer")).load()


@query("scan_columns_option", f"SELECT c_name, {_RN_C} AS OBJECTID, {_X} AS x FROM customer",
       kind="R")
def scan_columns_option(spark, sf_dir):
    """Explicit column pruning: only the listed fields are decoded."""
    df = FX.read(spark, sf_dir, "customer", columns="c_name, OBJECTID, Shape")
    return df.select("c_name", "OBJECTID", F.col("Shape.x").alias("x"))


@query("project_columns", f"""
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, {_X} AS x, {_Y} AS y FROM customer
""", kind="R")
def project_columns(spark, sf_dir):
    df = FX.read(spark, sf_dir, "customer", columns="c_custkey,Shape")
    return df.select("c_custkey", F.col("shape.x").alias("x"), F.col("SHAPE.y").alias("y"))


@query("shape_point", f"SELECT {_RN_C} AS OBJECTID, {_X} AS x, {_Y} AS y FROM customer",
       kind="R")
def shape_point(spark, sf_dir):
    df = FX.read(spark, sf_dir, "customer", columns="OBJECTID,Shape")
    return df.select("OBJECTID", "Shape.x", "Shape.y")


_RANKED = f"(SELECT {_RN_C} AS OBJECTID, * FROM customer)"


@query("oid_point_lookup", f"""
SELECT OBJECTID, c_name, {_X} AS x FROM {_RANKED} WHERE OBJECTID = 7
""", kind="R")
def oid_point_lookup(spark, sf_dir):
    path = FX.ensure(spark, sf_dir, "customer")
    df = read_table(spark, path, FX.catalog_name("customer"), pushdown=True)
    return df.filter(F.col("OBJECTID") == 7).select("OBJECTID", "c_name",
                                                     F.col("shape.x").alias("x"))


@query("oid_range_filter", f"""
SELECT OBJECTID, c_custkey::INTEGER AS c_custkey FROM {_RANKED}
WHERE OBJECTID >= 1 AND OBJECTID <= 250
""", kind="R")
def oid_range_filter(spark, sf_dir):
    path = FX.ensure(spark, sf_dir, "customer")
    df = read_table(spark, path, FX.catalog_name("customer"), pushdown=True)
    return df.filter((F.col("OBJECTID") >= 1) & (F.col("OBJECTID") <= 250)) \
        .select("OBJECTID", "c_custkey")


@query("oid_min_max", """
SELECT CAST(max(rn) AS INTEGER) AS max_oid, CAST(min(rn) AS INTEGER) AS min_oid,
       count(*) AS n
FROM (SELECT row_number() OVER (ORDER BY c_custkey) AS rn FROM customer)
""", kind="R")
def oid_min_max(spark, sf_dir):
    df = FX.read(spark, sf_dir, "customer", columns="OBJECTID")
    return df.agg(F.max("OBJECTID").alias("max_oid"), F.min("OBJECTID").alias("min_oid"),
                  F.count(F.lit(1)).alias("n"))


@query("count_rows", "SELECT count(*) AS n FROM customer", kind="R")
def count_rows(spark, sf_dir):
    return FX.read(spark, sf_dir, "customer", columns="OBJECTID").groupBy().agg(F.count(F.lit(1)).alias("n"))


@query("oid_synthesis", f"SELECT {_RN_C} AS OBJECTID, CAST(c_custkey AS INTEGER) AS c_custkey "
       "FROM customer", kind="R")
def oid_synthesis(spark, sf_dir):
    return FX.read(spark, sf_dir, "customer", columns="OBJECTID,c_custkey").select("OBJECTID", "c_custkey")


@query("scan_partitions", f"""
SELECT OBJECTID, CAST((OBJECTID - 1) // CAST(ceil(n / 7.0) AS BIGINT) AS INTEGER) AS part
FROM (SELECT {_RN_C} AS OBJECTID, count(*) OVER () AS n FROM customer)
""", kind="R")
def scan_partitions(spark, sf_dir):
    """Slot ranges: partition i holds slots [i*per, (i+1)*per), per =
    ceil(slots / numPartitions)."""
    df = FX.read(spark, sf_dir, "customer", numPartitions=7, columns="OBJECTID")
    return df.select("OBJECTID", F.spark_partition_id().alias("part"))


@query("scan_row_range", f"""
SELECT OBJECTID, c_name FROM {_RANKED} WHERE OBJECTID BETWEEN 101 AND 400
""", kind="R")
def scan_row_range(spark, sf_dir):
    return FX.read(spark, sf_dir, "customer", startRow=100, numRows=300) \
        .select("OBJECTID", "c_name")


@query("tolerance_check", f"""
WITH c AS (SELECT {_RN_C} AS id, {_RN_C} + CASE WHEN c_custkey % 97 = 5 THEN 1 ELSE 0 END AS rid, {_X} AS x, {_Y} AS y,
                  c_acctbal AS ax, CAST(c_nationkey AS DOUBLE) AS ay FROM customer)
SELECT id, 'x' AS "check", x AS shape_value, ax AS attribute_value FROM c WHERE abs(x - ax) > 0.001
UNION ALL
SELECT id, 'y', y, ay FROM c WHERE abs(y - ay) > 0.001
UNION ALL
SELECT id, 'RID', CAST(id AS DOUBLE), CAST(rid AS DOUBLE) FROM c WHERE rid <> id
""", kind="R")
def tolerance_check_q(spark, sf_dir):
    """The layer's own tolerance, and row ids that differ from the object ids."""
    df = FX.read(spark, sf_dir, "customer", columns="OBJECTID,c_custkey,RID,X,Y,Shape")
    df = df.withColumn("RID", F.col("RID") + F.when(F.col("c_custkey") % 97 == 5, 1).otherwise(0))
    return tolerance_check(df, "Shape", "point", {"x": "X", "y": "Y"})


# ----------------------------------------------------------- deleted / sparse

_RN0_C = "(row_number() OVER (ORDER BY c_custkey) - 1)"


@query("scan_deleted_rows", f"""
SELECT CAST({_RN0_C} + {_RN0_C} // 6 + 1 AS INTEGER) AS OBJECTID,
       CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal, {_X} AS x
FROM customer
""", kind="R")
def scan_deleted_rows(spark, sf_dir):
    df = FX.read(spark, sf_dir, "customer_deleted", numPartitions=5,
                 columns="OBJECTID,c_custkey,c_name,c_acctbal,Shape")
    return df.select("OBJECTID", "c_custkey", "c_name", "c_acctbal", F.col("Shape.x").alias("x"))


@query("scan_sparse_blocks", """
WITH r AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS r0, * FROM orders)
SELECT CAST(2048 * (r0 // 1024) + r0 % 1024 + 1 AS INTEGER) AS OBJECTID,
       CAST(o_orderkey AS INTEGER) AS o_orderkey,
       CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM r
""", kind="R")
def scan_sparse_blocks(spark, sf_dir):
    df = FX.read(spark, sf_dir, "orders_sparse", numPartitions=4, columns="OBJECTID,o_orderkey,o_totalprice")
    return df.select("OBJECTID", "o_orderkey", "o_totalprice")


@query("scan_offset_width", """
SELECT 5 AS width, n_nationkey, n_name, n_regionkey FROM nation
UNION ALL
SELECT 6, n_nationkey, n_name, n_regionkey FROM nation
""", kind="R")
def scan_offset_width(spark, sf_dir):
    a = FX.read(spark, sf_dir, "nation_w5").select(F.lit(5).alias("width"), "n_nationkey",
                                                   "n_name", "n_regionkey")
    b = FX.read(spark, sf_dir, "nation_w6").select(F.lit(6).alias("width"), "n_nationkey",
                                                   "n_name", "n_regionkey")
    return a.unionByName(b)


_BAD = "c_custkey % 11 = 5"


@query("scan_malformed", f"""
SELECT CASE WHEN {_BAD} THEN NULL ELSE {_RN_C} END AS OBJECTID,
       CASE WHEN {_BAD} THEN NULL ELSE CAST(c_custkey AS INTEGER) END AS c_custkey,
       CASE WHEN {_BAD} THEN NULL ELSE c_name END AS c_name,
       CASE WHEN {_BAD} THEN NULL ELSE {_X} END AS x
FROM customer
""", kind="R")
def scan_malformed(spark, sf_dir):
    df = FX.read(spark, sf_dir, "customer_malformed", columns="OBJECTID,c_custkey,c_name,Shape")
    return df.select("OBJECTID", "c_custkey", "c_name", F.col("Shape.x").alias("x"))


@query("scan_malformed_drop", f"""
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name FROM customer WHERE NOT ({_BAD})
""", kind="R")
def scan_malformed_drop(spark, sf_dir):
    df = FX.read(spark, sf_dir, "customer_malformed", mode="DROPMALFORMED", columns="c_custkey,c_name")
    return df.select("c_custkey", "c_name")


# ------------------------------------------------------------------ types

_ORD = "(SELECT *, o_orderkey % 3 AS k FROM orders)"


def _nul(expr: str, r: int) -> str:
    return f"CASE WHEN k = {r} THEN NULL ELSE {expr} END"


@query("scan_nulls", f"""
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey,
       {_nul('CAST(o_custkey AS INTEGER)', 0)} AS o_custkey,
       {_nul('o_orderstatus', 1)} AS o_orderstatus, {_nul('o_totalprice', 2)} AS o_totalprice,
       {_nul("'<p>' || o_orderpriority || '</p>'", 0)} AS prio_xml,
       {_nul('CAST(o_custkey % 30000 AS SMALLINT)', 1)} AS cust16,
       CAST(NULL AS BLOB) IS NULL AS raster_null
FROM {_ORD}
""", kind="R")
def scan_nulls(spark, sf_dir):
    df = FX.read(spark, sf_dir, "orders_types",
                 columns="o_orderkey,o_custkey,o_orderstatus,o_totalprice,prio_xml,cust16,RasterCol")
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "prio_xml",
                     "cust16", F.col("RasterCol").isNull().alias("raster_null"))


def _type_query(key, spark_cols, sql_cols, read=None):
    sql = f"SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, {sql_cols} FROM {_ORD}"

    @query(key, sql, kind="R")
    def fn(spark, sf_dir):
        df = FX.read(spark, sf_dir, "orders_types",
                     columns="o_orderkey," + (read or ",".join(spark_cols())))
        return df.select("o_orderkey", *spark_cols())
    fn.__name__ = key
    return fn


_type_query("type_int16", lambda: ["cust16"],
            _nul("CAST(o_custkey % 30000 AS SMALLINT)", 1) + " AS cust16")
_type_query("type_int32", lambda: ["o_custkey"],
            _nul("CAST(o_custkey AS INTEGER)", 0) + " AS o_custkey")
_type_query("type_float32", lambda: ["price32"],
            _nul("CAST(o_totalprice AS FLOAT)", 0) + " AS price32")
_type_query("type_float64", lambda: ["o_totalprice"],
            _nul("o_totalprice", 2) + " AS o_totalprice")
_type_query("type_string", lambda: ["o_orderstatus", "o_orderpriority"],
            _nul("o_orderstatus", 1) + " AS o_orderstatus, "
            + _nul("o_orderpriority", 2) + " AS o_orderpriority")
_type_query("type_xml", lambda: ["prio_xml"],
            _nul("'<p>' || o_orderpriority || '</p>'", 0) + " AS prio_xml")
_type_query("type_binary", lambda: [F.hex("raw").alias("raw_hex")],
            _nul("hex(encode(o_orderpriority))", 1) + " AS raw_hex", read="raw")
_type_query("type_datetime",
            lambda: [F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
                     F.unix_millis("o_orderdate").alias("ms")],
            _nul("epoch_ms(CAST(ceil((((epoch_us(o_orderdate) / 86400000000.0 + 25569.0) "
                 "- 25569) * 1000 * 60 * 60 * 24)) AS BIGINT))", 1) + " AS o_orderdate, "
            + _nul("CAST(ceil((((epoch_us(o_orderdate) / 86400000000.0 + 25569.0) - 25569) "
                   "* 1000 * 60 * 60 * 24)) AS BIGINT)", 1) + " AS ms", read="o_orderdate")


def _guid_sql(hexexpr: str) -> str:
    h = f"upper({hexexpr})"
    return (f"'{{' || substr({h}, 7, 2) || substr({h}, 5, 2) || substr({h}, 3, 2) || "
            f"substr({h}, 1, 2) || '-' || substr({h}, 11, 2) || substr({h}, 9, 2) || '-' || "
            f"substr({h}, 15, 2) || substr({h}, 13, 2) || '-' || substr({h}, 17, 4) || '-' || "
            f"substr({h}, 21, 12) || '}}'")


_type_query("type_guid", lambda: ["guid", "uuid"],
            _nul(_guid_sql("md5(CAST(o_orderkey AS VARCHAR))"), 2) + " AS guid, "
            + _nul(_guid_sql("md5(CAST(o_custkey AS VARCHAR))"), 0) + " AS uuid")


# ----------------------------------------------------------------- shapes

_LI_X = _deq_point("l_extendedprice", 0.0, 100.0)
_LI_Y = _deq_point("l_quantity", 0.0, 100.0)
_LI_Z = _deq_point("l_discount", -1.0, 1000.0)
_LI_M = _deq_point("l_tax", -1.0, 1000.0)
_LI_KEYS = "CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber"


def _li(spark, sf_dir, key, names):
    df = FX.read(spark, sf_dir, key)
    return df.select("l_orderkey", "l_linenumber", *[F.col("Shape." + n).alias(n) for n in names])


@query("shape_point_m", f"SELECT {_LI_KEYS}, {_LI_X} AS x, {_LI_Y} AS y, {_LI_M} AS m "
       "FROM lineitem", kind="R")
def shape_point_m(spark, sf_dir):
    return _li(spark, sf_dir, "points_m", ["x", "y", "m"])


@query("shape_point_z", f"SELECT {_LI_KEYS}, {_LI_X} AS x, {_LI_Y} AS y, {_LI_Z} AS z "
       "FROM lineitem", kind="R")
def shape_point_z(spark, sf_dir):
    return _li(spark, sf_dir, "points_z", ["x", "y", "z"])


@query("shape_point_zm", f"""
SELECT {_LI_KEYS}, {_LI_X} AS x, {_LI_Y} AS y,
       CASE WHEN l_linenumber % 4 IN (1, 3) THEN {_LI_Z} ELSE 0.0 END AS z,
       CASE WHEN l_linenumber % 4 IN (2, 3) THEN {_LI_M} ELSE 0.0 END AS m
FROM lineitem
""", kind="R")
def shape_point_zm(spark, sf_dir):
    """Per-row subtypes 1 (plain), 9 (z), 21 (m), 11 (z and m)."""
    return _li(spark, sf_dir, "points_zm", ["x", "y", "z", "m"])


@query("decode_points_raw", f"""
SELECT {_LI_KEYS}, {_LI_X} AS x, {_LI_Y} AS y,
       CASE WHEN l_linenumber % 4 IN (1, 3) THEN {_LI_Z} ELSE 0.0 END AS z,
       CASE WHEN l_linenumber % 4 IN (2, 3) THEN {_LI_M} ELSE 0.0 END AS m
FROM lineitem
""", kind="R")
def decode_points_raw(spark, sf_dir):
    """Z+M point blobs read raw, decoded by the user-level job."""
    raw = FX.read(spark, sf_dir, "points_zm", rawShapes="true")
    dec = decode_shapes(raw.select("l_orderkey", "l_linenumber", "Shape"), "Shape",
                        shape_params(raw, "Shape"))
    return dec.select("l_orderkey", "l_linenumber",
                      *[F.col("Shape." + n).alias(n) for n in ("x", "y", "z", "m")])


def _poly_sql(stride: int, arr: str, parts: str, empty_cond: str = "false") -> str:
    """Expected polys per vertex ordinate, from the quantised coordinates."""
    s = stride
    q = "CAST(floor((a[i + 1] - (-10.0)) * {scale}) AS BIGINT)"
    qxy = q.format(scale=1000000.0)
    qm = q.format(scale=100000.0)
    return f"""
WITH e AS (
  SELECT vec_id, {arr} AS a, {parts} AS parts FROM embeddings WHERE NOT ({empty_cond})
), v AS (
  SELECT vec_id, parts, i, i % {s} AS o,
         CASE WHEN i % {s} = 2 THEN {qm} ELSE {qxy} END AS q
  FROM (SELECT e.*, i FROM e, range(0, len(a)) r(i))
), b AS (
  SELECT vec_id, min(q) FILTER (WHERE o = 0) AS qx0, max(q) FILTER (WHERE o = 0) AS qx1,
         min(q) FILTER (WHERE o = 1) AS qy0, max(q) FILTER (WHERE o = 1) AS qy1
  FROM v GROUP BY vec_id
)
SELECT v.vec_id::INTEGER AS vec_id, CAST(len(v.parts) AS INTEGER) AS n_parts,
       CAST(i AS INTEGER) AS pos,
       CASE WHEN o = 2 THEN q / 100000.0 + (-10.0) ELSE q / 1000000.0 + (-10.0) END AS ord,
       qx0 / 1000000.0 + (-10.0) AS xmin, qy0 / 1000000.0 + (-10.0) AS ymin,
       (qx1 - qx0) / 1000000.0 + (qx0 / 1000000.0 + (-10.0)) AS xmax,
       (qy1 - qy0) / 1000000.0 + (qy0 / 1000000.0 + (-10.0)) AS ymax
FROM v JOIN b USING (vec_id)
"""


def _poly_rows(df):
    s = F.col("Shape")
    return df.select(F.col("vec_id"), F.size(s.getField("xyNum")).alias("n_parts"),
                     s.getField("xmin").alias("xmin"), s.getField("ymin").alias("ymin"),
                     s.getField("xmax").alias("xmax"), s.getField("ymax").alias("ymax"),
                     F.posexplode(s.getField("xyArr")).alias("pos", "ord"))


_EMB2 = "CAST(embedding AS DOUBLE[])"
_EMB3 = XYM_SQL
_RING = "CAST(embedding || embedding[1:2] AS DOUBLE[])"


@query("shape_polyline", _poly_sql(2, _EMB2, "[1, 2]", "vec_id % 50 = 7"), kind="R")
def shape_polyline(spark, sf_dir):
    """Two-part polylines (one with the curve flag every 9th row)."""
    return _poly_rows(FX.read(spark, sf_dir, "lines"))


@query("shape_polyline_m", _poly_sql(3, _EMB3, "[1, 2]"), kind="R")
def shape_polyline_m(spark, sf_dir):
    return _poly_rows(FX.read(spark, sf_dir, "lines_m"))


@query("shape_polygon", _poly_sql(2, _RING, "[1]"), kind="R")
def shape_polygon(spark, sf_dir):
    """Polygons; the stored (ignored) M values are skipped."""
    return _poly_rows(FX.read(spark, sf_dir, "polygons"))


@query("shape_parts", """
SELECT CAST(vec_id AS INTEGER) AS vec_id, CAST(i AS INTEGER) AS part,
       CAST(CASE WHEN i = 0 THEN vec_id % 5 + 1
                 ELSE len(embedding) // 2 - (vec_id % 5 + 1) END AS INTEGER) AS n
FROM embeddings, range(0, 2) r(i) WHERE vec_id % 50 <> 7
""", kind="R")
def shape_parts(spark, sf_dir):
    df = FX.read(spark, sf_dir, "lines")
    return df.select("vec_id", F.posexplode("Shape.xyNum").alias("part", "n"))


@query("shape_empty", """
SELECT CAST(vec_id AS INTEGER) AS vec_id, vec_id % 50 = 7 AS is_empty FROM embeddings
""", kind="R")
def shape_empty(spark, sf_dir):
    """Empty geometries: non-null value, zero bbox, no parts, no vertices."""
    df = FX.read(spark, sf_dir, "lines")
    s = F.col("Shape")
    empty = s.isNotNull() & (F.size(s.getField("xyNum")) == 0) & \
        (F.size(s.getField("xyArr")) == 0) & (s.getField("xmin") == 0) & \
        (s.getField("ymax") == 0)
    return df.select("vec_id", empty.alias("is_empty"))


@query("decode_shapes", _poly_sql(3, _EMB3, "[1, 2]"), kind="R")
def decode_shapes_q(spark, sf_dir):
    """Blobs read raw (``rawShapes``), decoded by the user-level job."""
    raw = FX.read(spark, sf_dir, "lines_m", rawShapes="true")
    params = shape_params(raw, "Shape")
    return _poly_rows(decode_shapes(raw.select("vec_id", "Shape"), "Shape", params))
