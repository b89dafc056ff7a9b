"""Index joins, first rows, catalog counts, typed definitions, whole tracks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from geoframe.plans import fixtures as FX
from geoframe.sources import layout as L
from geoframe.sources.catalog import first_rows, list_tables, table_row_counts
from geoframe.sources.lookup import lookup_rows
from geoframe.testing.encoder import FieldSpec, TableSpec, write_table

SF = "/root/testdata/sf0.001"


def ids_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "k long")


def test_lookup_of_any_ids(spark):
    """Null, repeated, out of range and deleted ids; every field type."""
    path = FX.ensure(spark, SF, "customer_deleted")
    name = FX.catalog_name("customer_deleted")
    whole = FX.read(spark, SF, "customer_deleted").collect()
    want = {r["OBJECTID"]: r for r in whole if r["OBJECTID"] in (1, 7, 8, 100)}
    assert 7 not in want
    got = lookup_rows(spark, path, name, ids_of(spark, None, 1, 1, 7, 8, 0, -3, 100, 1 << 40), "k").collect()
    assert {r["lookup_id"]: tuple(r)[1:] for r in got} == {k: tuple(r) for k, r in want.items()} and len(got) == 3
    assert lookup_rows(spark, path, name, ids_of(spark), "k").collect() == []
    assert lookup_rows(spark, path, "nothing", ids_of(spark, 1), "k").collect() == []
    path = FX.ensure(spark, SF, "orders_types")
    want = FX.read(spark, SF, "orders_types").where("OBJECTID IN (2, 3, 901)").orderBy("OBJECTID").collect()
    got = lookup_rows(spark, path, FX.catalog_name("orders_types"), ids_of(spark, 901, 3, 2), "k").orderBy("lookup_id")
    assert [tuple(r)[1:] for r in got.collect()] == [tuple(r) for r in want]


def test_lookup_of_malformed_rows(spark):
    path, name = FX.ensure(spark, SF, "customer_malformed"), FX.catalog_name("customer_malformed")
    rows = FX.read(spark, SF, "customer_malformed", columns="OBJECTID,c_custkey").collect()
    bad = [i + 1 for i, r in enumerate(rows) if r["OBJECTID"] is None][:2]
    ask = lambda mode: lookup_rows(spark, path, name, ids_of(spark, 1, *bad), "k", "c_custkey", mode)
    assert sorted(map(tuple, ask("PERMISSIVE").collect()), key=str) == sorted(
        [(1, rows[0]["c_custkey"]), *[(b, None) for b in bad]], key=str)
    assert [r["lookup_id"] for r in ask("DROPMALFORMED").collect()] == [1]
    with pytest.raises(Exception, match="malformed"):
        ask("FAILFAST").collect()


def test_lookup_reads_little(spark, monkeypatch):
    """Bytes follow the ids: ten rows at both ends of a table read a few blocks."""
    from geoframe.sources import filegdb
    path = FX.ensure(spark, SF, "orders_types")
    hdr = L.read_table_header(path, "a0000000a")
    index = L.read_index_header(path, "a0000000a")
    n, read = index.num_slots, []
    real = L.read_at
    monkeypatch.setattr(L, "read_at", lambda fh, k, at: read.append(k) or real(fh, k, at))
    monkeypatch.setattr(filegdb, "read_at", L.read_at)
    monkeypatch.setattr(filegdb, "READ_GAP", 1000)
    import numpy as np
    fs, p = L.filesystem(path)
    tpath, xpath = L.table_paths(p, hdr.table)
    slots = np.array([0, 1, 2, n - 3, n - 2, n - 1])
    with fs.open_input_file(tpath) as fh, fs.open_input_file(xpath) as xh:
        offs = np.concatenate([L.read_offsets(xh, index, s) for s in (slots[:3], slots[3:])])
        rows = sum(b.num_rows for s, o in filegdb._byte_bounded(slots, offs, fh.size())
                   for b in filegdb._decode_chunk(fh, fh.size(), s, o, hdr, [0], ["x"], "PERMISSIVE", True))
        assert rows == 6 and sum(read) < fh.size() / 20


def test_first_rows(spark):
    path, name = FX.ensure(spark, SF, "customer_deleted"), FX.catalog_name("customer_deleted")
    whole = [r["OBJECTID"] for r in FX.read(spark, SF, "customer_deleted").orderBy("OBJECTID").collect()]
    for n in (0, 1, 6, 7, 20, len(whole), len(whole) + 5):
        out = first_rows(spark, path, name, n, columns="OBJECTID")
        assert [r["OBJECTID"] for r in out.collect()] == whole[:n]
    assert first_rows(spark, path, name, 20, columns="OBJECTID").rdd.getNumPartitions() == 1


def test_first_rows_after_many_deleted_slots(spark, tmp_path):
    df = spark.range(3).select((F.col("id") * 2 + 9000).alias("slot"), F.col("id").cast("int").alias("v"))
    write_table(spark, str(tmp_path), "a00000009", df, TableSpec([FieldSpec("v", "int32")], slot_col="slot"), ["slot"],
                num_partitions=1)
    assert [L.slots_of_rows(str(tmp_path), "a00000009", n) for n in (0, 1, 2, 3, 9)] == [0, 9001, 9003, 9005, 9005]


def test_live_rows_come_from_headers(spark):
    path = FX.ensure(spark, SF, "customer_deleted")
    found = {r["hex_name"]: r["live_rows"] for r in table_row_counts(spark, path, ["a0000000b", "a00ffffff"]).collect()}
    assert found == {"a0000000b": FX.read(spark, SF, "customer_deleted").count()}
    listed = list_tables(spark, path, with_counts=True)
    assert listed.where("live_rows IS NULL").count() > 0


def test_definitions(spark, tmp_path):
    """Root element and fields, whatever a definition holds."""
    from geoframe.sources.catalog import item_definitions
    rows = [(0, "a", "<?xml version='1.0'?><DETableInfo><DatasetType>t</DatasetType></DETableInfo>"),
            (1, None, "<typens:DEFeatureClassInfo xmlns:typens='u'><HasZ>true</HasZ></typens:DEFeatureClassInfo>"),
            (2, "c", None), (3, "d", "no markup"), (4, "e", "<broken><HasZ>true"), (5, "f", "<X><HasZ>what</HasZ></X>")]
    df = spark.createDataFrame(rows, "slot long, Name string, Definition string")
    spec = TableSpec([FieldSpec("Name", "string"), FieldSpec("Definition", "xml")], slot_col="slot")
    write_table(spark, str(tmp_path), "a00000004", df, spec, ["slot"], num_partitions=1)
    names = spark.createDataFrame([(0, "GDB_SystemCatalog"), (3, "GDB_Items")], "slot long, Name string")
    write_table(spark, str(tmp_path), "a00000001", names, TableSpec([FieldSpec("Name", "string")], oid_name="ID",
                slot_col="slot"), ["slot"], num_partitions=1)
    got = {r["OBJECTID"]: tuple(r)[1:] for r in item_definitions(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2, 4, 5, 6}
    assert got[1] == ("a", "DETableInfo", "t", None, None)
    assert got[2] == (None, "typens:DEFeatureClassInfo", None, None, True)
    assert got[4][1] == "" and got[4][2:] == (None, None, None)
    assert got[5][1] == "broken" and got[6] == ("f", "X", None, None, None)


@pytest.mark.parametrize("m", [None, "event_id"])
def test_whole_track_of_a_hot_group(spark, monkeypatch, m):
    """A third of all rows in one track, pieces and joins of a few rows each."""
    from geoframe.operators import trajectories as J
    monkeypatch.setattr(J, "PIECE", 7)
    monkeypatch.setattr(J, "FAN", 3)
    ev = spark.read.parquet(f"{SF}/events.parquet").limit(900).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("user_id")))
    got = J.polylines_from_rows(ev, ["user_id"], ["ts", "event_id"], "event_id", "value", m, num_ranges=9)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = ev.withColumn("rk", F.row_number().over(w)).orderBy("user_id", "rk").collect()
    want = {}
    for r in rows:
        want.setdefault(r["user_id"], []).append((float(r["event_id"]), r["value"], *([float(r["event_id"])] if m else [])))
    found = {r["user_id"]: r for r in got.collect()}
    assert set(found) == set(want) and None in found
    for k, v in want.items():
        s = found[k]["Shape"]
        assert s["xyArr"] == [o for p in v for o in p] and s["xyNum"] == [len(v)] and found[k]["n_vertices"] == len(v)
        assert (s["xmin"], s["ymin"], s["xmax"], s["ymax"]) == (
            min(p[0] for p in v), min(p[1] for p in v), max(p[0] for p in v), max(p[1] for p in v))


def test_spatial_metadata_from_files(spark, tmp_path):
    """crs, extent, Z and M flags and all tolerances as a file's descriptor has them."""
    from geoframe.sources.filegdb import FileGDBDataSource
    from geoframe.testing.encoder import ShapeSpec
    df = spark.range(4).select("id", *[(F.col("id") * k).cast("double").alias(c) for k, c in enumerate("xyzm", 1)])
    for i, (kind, z, m) in enumerate([("point", False, False), ("pointM", False, True), ("pointZ", True, False),
                                      ("pointZM", True, True)]):
        crs = f'PROJCS["Proj_{i}é"]'
        shape = ShapeSpec("Shape", kind, x="x", y="y", z="z" if z else None, m="m" if m else None, crs=crs,
                          xy_tol=0.25, z_tol=0.5, m_tol=0.125)
        name = f"a{16 + i:08x}"
        write_table(spark, str(tmp_path), name, df, TableSpec([FieldSpec("id", "int32"), shape]), ["id"], num_partitions=1)
        md = FileGDBDataSource({"path": str(tmp_path), "table": name}).schema()["Shape"].metadata
        z = z or m                          # a descriptor with M has Z as well
        assert (md["crs"], md["geometryType"], md["hasZ"], md["hasM"], md["xyTolerance"]) == (crs, kind, z, m, 0.25)
        assert (md["xmin"], md["ymin"], md["xmax"], md["ymax"]) == (0.0, 0.0, 3.0, 6.0)
        assert md.get("zTolerance") == (0.5 if z else None) and md.get("mTolerance") == (0.125 if m else None)


def test_ranges_of_equal_bytes(spark, tmp_path):
    """Rows that grow from 1 to 1,000 bytes: tasks within a factor of two, every row once."""
    from geoframe.sources.filegdb import FileGDBDataSource
    df = spark.range(4000).select(F.col("id").cast("int").alias("v"), F.expr("repeat('x', 1 + int(id / 4))").alias("t"))
    write_table(spark, str(tmp_path), "a00000009", df, TableSpec(
        [FieldSpec("v", "int32"), FieldSpec("t", "string", max_length=2000)]), ["v"], num_partitions=2)
    options = {"path": str(tmp_path), "table": "a00000009", "numPartitions": "8", "balance": "bytes"}
    source = FileGDBDataSource(options)
    parts = [r for p in source.reader(source.schema()).partitions() for r in p.ranges]
    assert [a for a, _ in parts[1:]] == [b for _, b in parts[:-1]] and parts[0][0] == 0 and parts[-1][1] == 4000
    size = [sum(12 + i // 4 for i in range(a, b)) for a, b in parts]
    assert len(parts) == 8 and max(size) < 2 * min(size)
    got = spark.read.format("filegdb").options(**options).load()
    assert sorted(r["v"] for r in got.collect()) == list(range(4000))
    with pytest.raises(Exception, match="balance"):
        spark.read.format("filegdb").options(**{**options, "balance": "rows"}).load().count()


def test_bytes_of_deleted_and_sparse_tables(spark):
    """Deleted slots and absent blocks: the same rows whatever the balance."""
    for key in ("customer_deleted", "orders_sparse"):
        n = FX.read(spark, SF, key).count()
        got = FX.read(spark, SF, key, balance="bytes", numPartitions=5)
        assert got.count() == n and got.select("OBJECTID").distinct().count() == n
