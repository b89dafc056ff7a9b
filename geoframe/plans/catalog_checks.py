"""R checks of the catalog: geodatabases whose catalog, item and class tables Spark
derives from ``part`` and ``supplier``, so that listing, finding, filtering, joining
and excluding are recomputed by the SQL from these tables.

The text of the expressions below is both Spark's and the oracle's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.plans import fixtures as FX
from geoframe.plans.registry import query, table
from geoframe.sources.catalog import find_table, first_rows, item_definitions, list_tables, user_tables
from geoframe.sources.lookup import lookup_rows
from geoframe.testing.encoder import FieldSpec, TableSpec, write_table

FIRST = 8                 # ids of system tables; then one table per type of part
PARTS = 1000              # entries of parts come after it

ID = f"p_partkey + {PARTS}"
NAME = """CASE WHEN p_size = 7 THEN 'ND_50_DirtyAreas' WHEN p_size = 11 THEN 'ND_50_DirtyObjects'
  WHEN p_size = 13 THEN NULL ELSE replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS STRING) END"""
KIND = """CASE p_partkey % 5 WHEN 0 THEN 'DEFeatureClassInfo' WHEN 1 THEN 'DETableInfo' WHEN 2 THEN 'DEWorkspace'
  WHEN 3 THEN 'DETopology' END"""
SHAPE = """CASE WHEN p_partkey % 5 = 0 THEN CASE WHEN p_size % 3 = 0 THEN 'esriGeometryPoint'
  WHEN p_size % 3 = 1 THEN 'esriGeometryPolyline' ELSE 'esriGeometryPolygon' END END"""
HAS_Z = "CASE WHEN p_partkey % 5 = 0 THEN p_size % 2 = 0 END"
COMMENT = "CASE WHEN p_partkey % 10 = 3 THEN 'made from a DETableInfo &amp; more' END"
DEFINITION = f"""'<' || ({KIND}) || ' version="1"><Name>' || coalesce(({NAME}), '') || '</Name><DatasetType>esriDT'
  || p_brand || '</DatasetType>' || coalesce('<ShapeType>' || ({SHAPE}) || '</ShapeType>', '')
  || coalesce('<HasZ>' || CAST(({HAS_Z}) AS STRING) || '</HasZ>', '')
  || coalesce('<Comment>' || ({COMMENT}) || '</Comment>', '') || '</' || ({KIND}) || '>'"""

CLASS_NAME = "CASE WHEN s_nationkey = 3 THEN 'ND_50_DirtyAreas' WHEN s_nationkey = 4 THEN NULL ELSE s_name END"
CLASS_ID = "CASE WHEN s_nationkey = 5 THEN NULL ELSE '{' || md5(s_name) || '}' END"
FEATURE_CLASS = "p_partkey * 7 % 113 + 1"
GEOMETRY = "CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_size % 4 + 1 END"
SHAPE_FIELD = "CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'Shape' END"

_NAMES = TableSpec([FieldSpec("Name", "string", max_length=160)], oid_name="ID", slot_col="slot")


def _system(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "slot long, Name string")


def _types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table for each type of part: id, name, type."""
    kinds = table(spark, sf_dir, "part").select("p_type").distinct().orderBy("p_type").collect()     # a few
    return spark.createDataFrame([(FIRST + i + 1, "Parts_" + k[0], k[0]) for i, k in enumerate(kinds)],
                                 "id long, Name string, p_type string")


def ensure_parts(spark: SparkSession, sf_dir: str) -> str:
    """The 10.x geodatabase: a catalog entry per type of part, with its table, and one
    per part, described in GDB_Items, without."""
    path = FX.gdb_path(spark, sf_dir, "parts10")
    part = table(spark, sf_dir, "part")

    def catalog():
        system = _system(spark, ["GDB_SystemCatalog", "GDB_DBTune", "GDB_SpatialRefs", "GDB_Items"])
        types = _types(spark, sf_dir).select((F.col("id") - 1).alias("slot"), "Name")
        parts = part.select(F.expr(f"{ID} - 1").alias("slot"), F.expr(NAME).alias("Name"))
        write_table(spark, path, "a00000001", system.unionAll(types).unionAll(parts), _NAMES, ["slot"])

    def items():
        df = part.select(F.expr(f"{ID} - 1").alias("slot"), F.expr(NAME).alias("Name"),
                         F.expr(DEFINITION).alias("Definition"))
        write_table(spark, path, "a00000004", df, TableSpec(
            [FieldSpec("Name", "string", max_length=160), FieldSpec("Definition", "xml")], slot_col="slot"), ["slot"])

    def tables():
        for r in _types(spark, sf_dir).collect():
            write_table(spark, path, f"a{r['id']:08x}", part.where(F.col("p_type") == r["p_type"]),
                        TableSpec([FieldSpec("p_partkey", "int32"), FieldSpec("p_name", "string")]), ["p_partkey"],
                        num_partitions=2)

    return FX.ensure_written(spark, path, {"catalog": catalog, "items": items, "tables": tables})


def ensure_classes(spark: SparkSession, sf_dir: str) -> str:
    """The 9.x geodatabase: object classes from suppliers, feature classes from parts."""
    path = FX.gdb_path(spark, sf_dir, "parts9")

    def catalog():
        names = ["GDB_SystemCatalog", "GDB_DBTune", "GDB_ObjectClasses", "GDB_FeatureClasses"]
        write_table(spark, path, "a00000001", _system(spark, names), _NAMES, ["slot"], num_partitions=1)

    def objects():
        df = table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("slot"), F.expr(CLASS_NAME).alias("Name"), F.expr(CLASS_ID).alias("CLSID"))
        write_table(spark, path, "a00000003", df, TableSpec(
            [FieldSpec("Name", "string"), FieldSpec("CLSID", "string")], slot_col="slot"), ["slot"])

    def features():
        df = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("slot"), F.expr(FEATURE_CLASS).cast("int").alias("ObjectClassID"),
            F.expr(GEOMETRY).cast("int").alias("GeometryType"), F.expr(SHAPE_FIELD).alias("ShapeField"))
        write_table(spark, path, "a00000004", df, TableSpec(
            [FieldSpec("ObjectClassID", "int32"), FieldSpec("GeometryType", "int32"),
             FieldSpec("ShapeField", "string")], slot_col="slot"), ["slot"])

    return FX.ensure_written(spark, path, {"catalog": catalog, "objects": objects, "features": features})


_LISTED = f"""
SELECT CAST({FIRST} + row_number() OVER (ORDER BY p_type) AS INTEGER) AS ID, 'Parts_' || p_type AS Name,
       printf('a%08x', {FIRST} + row_number() OVER (ORDER BY p_type)) AS hex_name, count(*) AS live_rows
FROM part GROUP BY p_type
UNION ALL
SELECT CAST({ID} AS INTEGER), {NAME}, printf('a%08x', {ID}), CAST(NULL AS BIGINT) FROM part
"""


@query("list_tables", _LISTED, kind="R")
def list_tables_q(spark, sf_dir):
    """The catalog's entries, with the live rows that the headers of their tables give."""
    found = list_tables(spark, ensure_parts(spark, sf_dir), with_counts=True)
    return found.where(F.col("Name").isNull() | ~F.col("Name").startswith("GDB_"))


@query("find_table", f"""
WITH listed AS ({_LISTED})
SELECT ID, Name, hex_name, live_rows FROM listed
WHERE Name IN ('Parts_STANDARD', 'ND_50_DirtyAreas', 'parts_standard')
QUALIFY row_number() OVER (PARTITION BY Name ORDER BY ID) = 1
""", kind="R")
def find_table_q(spark, sf_dir):
    """Entries by their exact names: a table, the first of many entries of one name, none."""
    path = ensure_parts(spark, sf_dir)
    found = [find_table(spark, path, n) for n in ("Parts_STANDARD", "ND_50_DirtyAreas", "parts_standard")]
    counts = list_tables(spark, path, with_counts=True).select("ID", "live_rows")
    return found[0].unionAll(found[1]).unionAll(found[2]).join(counts, "ID").select(
        "ID", "Name", "hex_name", "live_rows")


@query("user_tables_v10", f"""
SELECT CAST({ID} AS INTEGER) AS OBJECTID, {NAME} AS Name FROM part
WHERE (contains({DEFINITION}, 'DEFeatureClassInfo') OR contains({DEFINITION}, 'DETableInfo'))
  AND ({NAME}) NOT IN ('ND_50_DirtyAreas', 'ND_50_DirtyObjects')
""", kind="R")
def user_tables_v10(spark, sf_dir):
    """User tables of a 10.x geodatabase: definitions that contain a marker, wherever."""
    return user_tables(spark, ensure_parts(spark, sf_dir)).select("OBJECTID", "Name")


@query("user_tables_v9", f"""
SELECT CAST(p_partkey + 1 AS INTEGER) AS OBJECTID, {CLASS_NAME} AS Name
FROM part JOIN supplier ON s_suppkey + 1 = {FEATURE_CLASS}
WHERE ({CLASS_ID}) IS NOT NULL AND ({GEOMETRY}) IS NOT NULL AND ({SHAPE_FIELD}) IS NOT NULL
  AND ({CLASS_NAME}) NOT IN ('ND_50_DirtyAreas', 'ND_50_DirtyObjects')
""", kind="R")
def user_tables_v9(spark, sf_dir):
    """User tables of a 9.x geodatabase: its class tables joined."""
    return user_tables(spark, ensure_classes(spark, sf_dir)).select("OBJECTID", "Name")


@query("item_definitions", f"""
SELECT CAST({ID} AS INTEGER) AS OBJECTID, {NAME} AS Name, {KIND} AS kind, 'esriDT' || p_brand AS dataset_type,
       {SHAPE} AS shape_type, {HAS_Z} AS has_z, replace({COMMENT}, '&amp;', '&') AS comment
FROM part WHERE ({KIND}) IS NOT NULL
""", kind="R")
def item_definitions_q(spark, sf_dir):
    """Definitions of a 10.x geodatabase as typed rows."""
    found = item_definitions(spark, ensure_parts(spark, sf_dir), {"Comment": "string"})
    return found.withColumnRenamed("Comment", "comment")


_CUSTOMERS = "(SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS OBJECTID, * FROM customer)"


@query("first_rows", f"SELECT OBJECTID, c_name FROM {_CUSTOMERS} ORDER BY OBJECTID LIMIT 20", kind="R")
def first_rows_q(spark, sf_dir):
    """The first 20 rows by OBJECTID (the head / show(20) report): slots are read until
    20 hold a row."""
    path = FX.ensure(spark, sf_dir, "customer")
    return first_rows(spark, path, FX.catalog_name("customer"), 20, columns="OBJECTID,c_name")


@query("first_rows_deleted", """
SELECT CAST(r + r // 6 + 1 AS INTEGER) AS OBJECTID, CAST(c_custkey AS INTEGER) AS c_custkey
FROM (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS r, c_custkey FROM customer) ORDER BY r LIMIT 100
""", kind="R")
def first_rows_deleted(spark, sf_dir):
    """The first 100 rows of a table with deleted slots."""
    path = FX.ensure(spark, sf_dir, "customer_deleted")
    return first_rows(spark, path, FX.catalog_name("customer_deleted"), 100, columns="OBJECTID,c_custkey")


@query("oid_lookup_join", """
WITH o AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS lookup_id, *, o_orderkey % 3 AS k FROM orders)
SELECT lookup_id, CAST(o_orderkey AS INTEGER) AS o_orderkey,
       CASE WHEN k = 1 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN k = 2 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM o WHERE lookup_id IN (SELECT l_suppkey * 37 + l_linenumber FROM lineitem WHERE l_quantity >= 45)
""", kind="R")
def oid_lookup_join(spark, sf_dir):
    """Orders by the ids that a table of line items gives (repeated, and out of range)."""
    path = FX.ensure(spark, sf_dir, "orders_types")
    ids = table(spark, sf_dir, "lineitem").where("l_quantity >= 45").select(
        (F.col("l_suppkey") * 37 + F.col("l_linenumber")).alias("id"))
    return lookup_rows(spark, path, FX.catalog_name("orders_types"), ids, "id",
                       columns="o_orderkey,o_orderstatus,o_totalprice")
