"""Catalog queries over a geodatabase: list, find, user tables, id column.

All of them read system tables through the ``filegdb`` source, so the work
is ordinary DataFrame work (filters, joins) rather than driver loops.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.sources import layout as L
from geoframe.sources.filegdb import FileGDBDataSource, resolve_table

# Names of the system tables and markers the listing uses.
ITEMS_TABLE = "GDB_Items"
OBJECT_CLASSES_TABLE = "GDB_ObjectClasses"
FEATURE_CLASSES_TABLE = "GDB_FeatureClasses"
DEFINITION_MARKERS = ("DEFeatureClassInfo", "DETableInfo")
EXCLUDED_NAMES = ("ND_50_DirtyAreas", "ND_50_DirtyObjects")


def _read(spark: SparkSession, path: str, **opts) -> DataFrame:
    from geoframe.session import register
    register(spark)
    r = spark.read.format("filegdb").option("path", path)
    for k, v in opts.items():
        r = r.option(k, str(v))
    return r.load()


def list_tables(spark: SparkSession, path: str, with_counts: bool = False) -> DataFrame:
    """Every catalog entry (system tables included): ID, Name, hex_name;
    ``with_counts`` adds ``live_rows``, from the headers, of tables whose files exist."""
    cat = _read(spark, path, table=L.CATALOG_TABLE)
    out = cat.select(F.col("ID").alias("ID"), F.col("Name").alias("Name"),
                     F.format_string("a%08x", F.col("ID")).alias("hex_name"))
    if not with_counts:
        return out
    return out.join(table_row_counts(spark, path, out), "hex_name", "left") \
        .select("ID", "Name", "hex_name", "live_rows")


def table_row_counts(spark: SparkSession, path: str, tables: DataFrame | list[str] | None = None) -> DataFrame:
    """``(hex_name, live_rows)`` of the given table files (names, or a frame with
    ``hex_name``; default: every catalog entry), as their headers give it.  Tasks read
    some bytes of each file; tables without files are left out."""
    from geoframe.session import register
    register(spark)
    if tables is None:
        tables = list_tables(spark, path)
    elif not isinstance(tables, DataFrame):
        tables = spark.createDataFrame([(t,) for t in tables], "hex_name string")

    def run(batches):
        for batch in batches:
            names = [t for t in batch.column(0).to_pylist() if t is not None and L.exists(path, t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([L.read_live_rows(path, t) for t in names], pa.int64())],
                names=["hex_name", "live_rows"])

    return tables.select("hex_name").distinct().mapInArrow(run, "hex_name string, live_rows bigint")


def first_rows(spark: SparkSession, path: str, name: str, n: int = 20, **options) -> DataFrame:
    """The first ``n`` live rows in slot order (all, if fewer): the driver reads index
    entries, more at a time, until ``n`` slots hold a row, and one task reads the rows
    of these slots.  ``options`` are the reader's."""
    table = resolve_table(path, name)
    stop = L.slots_of_rows(path, table, n) if table else 0
    return _read(spark, path, name=name, startRow=0, numRows=stop, numPartitions=1, **options).limit(max(n, 0))


def item_definitions(spark: SparkSession, path: str, more: dict[str, str] | None = None) -> DataFrame:
    """The definitions of a 10.x geodatabase's items as typed rows: ``OBJECTID``,
    ``Name``, ``kind`` (the definition's root element), ``dataset_type``, ``shape_type``,
    ``has_z``, and elements given in ``more`` as name -> type.  Items without a
    definition are left out; elements that a definition lacks, or one that is not
    well formed, give nulls."""
    fields = {"DatasetType": "string", "ShapeType": "string", "HasZ": "boolean", **(more or {})}
    schema = ", ".join(f"`{k}` {t}" for k, t in fields.items())
    items = _read(spark, path, name=ITEMS_TABLE, columns="OBJECTID,Name,Definition").where("Definition IS NOT NULL")
    parsed = items.withColumn("d", F.from_xml("Definition", schema)).withColumn(
        "kind", F.regexp_extract("Definition", r"<([A-Za-z_][\w.:-]*)", 1))
    return parsed.select("OBJECTID", "Name", "kind", F.col("d.DatasetType").alias("dataset_type"),
                         F.col("d.ShapeType").alias("shape_type"), F.col("d.HasZ").alias("has_z"),
                         *[F.col(f"d.`{k}`").alias(k) for k in (more or {})])


def find_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The first entry whose name equals ``name`` exactly (case-sensitive);
    entries with a null name are skipped.  Zero or one row."""
    t = list_tables(spark, path)
    return t.filter(F.col("Name").isNotNull() & (F.col("Name") == F.lit(name))) \
        .orderBy("ID").limit(1)


def has_table(path: str, name: str) -> bool:
    t = resolve_table(path, name)
    return t is not None and L.exists(path, t)


def user_tables(spark: SparkSession, path: str) -> DataFrame:
    """Names of user tables and feature classes.

    10.x geodatabases: rows of ``GDB_Items`` whose ``Definition`` contains a
    feature-class or table marker.  9.x (no ``GDB_Items``): object classes
    that are feature classes, i.e. ``GDB_FeatureClasses.ObjectClassID``
    joined to ``GDB_ObjectClasses`` ids.  Dirty-area bookkeeping tables are
    left out.  Output: ``Name`` (plus ``OBJECTID`` for file order).
    """
    if has_table(path, ITEMS_TABLE):
        items = _read(spark, path, name=ITEMS_TABLE)
        marker = None
        for m in DEFINITION_MARKERS:
            c = F.col("Definition").contains(m)
            marker = c if marker is None else marker | c
        names = items.filter(F.col("Name").isNotNull() & F.col("Definition").isNotNull()
                             & marker).select("OBJECTID", "Name")
    else:
        oc = _read(spark, path, name=OBJECT_CLASSES_TABLE).filter(
            F.col("CLSID").isNotNull() & F.col("Name").isNotNull()).select(
            F.col("OBJECTID").alias("oc_id"), "Name")
        fc = _read(spark, path, name=FEATURE_CLASSES_TABLE).filter(
            F.col("ObjectClassID").isNotNull() & F.col("GeometryType").isNotNull()
            & F.col("ShapeField").isNotNull()).select(
            F.col("OBJECTID"), F.col("ObjectClassID").alias("oc_id"))
        names = fc.join(oc, "oc_id").select("OBJECTID", "Name")
    return names.filter(~F.col("Name").isin(*EXCLUDED_NAMES))


def id_column(spark: SparkSession, path: str, name: str) -> str | None:
    """Name of the table's object-id field (the last one if several),
    ``OBJECTID`` if it has none, ``None`` if the table does not exist."""
    src = FileGDBDataSource({"path": path, "name": name})
    hdr = src.header()
    return hdr.object_id_name if hdr else None
