"""Damaged or missing files are refused, never read as fewer rows."""

import os

import numpy as np
import pyarrow as pa
import pytest

from geoframe.session import local_path
from geoframe.sources import decode as D
from geoframe.sources import filegdb as FG
from geoframe.sources import layout as L
from geoframe.sources.filegdb import FileGDBDataSource, resolve_table
from geoframe.sources.lookup import lookup_rows

SF = "/root/testdata/sf0.001"
MODES = ["PERMISSIVE", "DROPMALFORMED", "FAILFAST"]


@pytest.fixture()
def damaged(spark, tmp_gdb):
    """A copy of the nation fixture whose files may be spoilt."""
    import shutil

    from geoframe.plans import fixtures as FX
    source = local_path(FX.ensure(spark, SF, "customer"))
    target = local_path(tmp_gdb)
    for f in os.listdir(source):
        if f.endswith((".gdbtable", ".gdbtablx")):
            shutil.copyfile(f"{source}/{f}", f"{target}/{f}")
    table = resolve_table(target, FX.catalog_name("customer"))
    return target, table, FX.catalog_name("customer")


def load(spark, path, name, mode):
    return spark.read.format("filegdb").option("path", path).option("name", name).option("mode", mode).load()


@pytest.mark.parametrize("mode", MODES)
def test_index_cut_short(spark, damaged, mode):
    path, table, name = damaged
    _, index = L.table_paths(path, table)
    os.truncate(index, 16 + 4 * 60)
    with pytest.raises(Exception, match="truncated"):
        load(spark, path, name, mode).count()


@pytest.mark.parametrize("mode", MODES)
def test_listed_table_without_file(spark, damaged, mode):
    path, table, name = damaged
    os.remove(L.table_paths(path, table)[0])
    with pytest.raises(Exception, match="missing"):
        load(spark, path, name, mode).count()


def test_unlisted_table_is_empty_and_logged(spark, damaged, caplog):
    path, _, _ = damaged
    source = FileGDBDataSource({"path": path, "name": "NoSuchTable"})
    with caplog.at_level("WARNING"):
        assert len(source.schema()) == 0
    assert "NoSuchTable" in caplog.text


def test_user_schema_spelling(spark, damaged):
    path, _, name = damaged
    df = (spark.read.format("filegdb").schema("objectid int, C_NAME string")
          .option("path", path).option("name", name).load())
    assert df.columns == ["objectid", "C_NAME"] and df.where("objectid = 3").first()["objectid"] == 3


def spoil(path, table, slot, at, data):
    """Writes ``data`` at byte ``at`` of a slot's row; the row's offset."""
    hdr = L.read_index_header(path, table)
    with open(L.table_paths(path, table)[1], "rb") as fh:
        offset = int(L.read_offsets(pa.PythonFile(fh, "r"), hdr, np.array([slot]))[0])
    with open(L.table_paths(path, table)[0], "r+b") as fh:
        fh.seek(offset + at)
        fh.write(data)
    return offset


def by_mode(spark, path, name):
    """(malformed ids, ids that DROPMALFORMED keeps); FAILFAST raises."""
    read = spark.read.format("filegdb").option("path", path).option("name", name)
    rows = lookup_rows(spark, path, name, spark.range(1, 151).toDF("i"), "i").collect()
    found = [r["OBJECTID"] for r in read.option("mode", "DROPMALFORMED").load().collect()]
    with pytest.raises(Exception, match="malformed row"):
        read.option("mode", "FAILFAST").load().collect()
    return [r["lookup_id"] for r in rows if r["OBJECTID"] is None], found


@pytest.mark.parametrize("length", [2**31 - 1, 100_000, 0, -5])
def test_row_length_is_bounded_by_the_next_row(spark, damaged, monkeypatch, length):
    """A length that runs over the next row is malformed, and nothing is read for it."""
    path, table, name = damaged
    spoil(path, table, 40, 0, length.to_bytes(4, "little", signed=True))
    bad, kept = by_mode(spark, path, name)
    assert bad == [41] and sorted(kept) == [i for i in range(1, 151) if i != 41]
    size = os.path.getsize(L.table_paths(path, table)[0])
    read = []
    real = FG.read_at
    monkeypatch.setattr(FG, "read_at", lambda fh, n, at: read.append(n) or real(fh, n, at))
    hdr = L.read_table_header(path, table)
    batches = list(FG._scan(path, hdr, [0], [(0, None)], "PERMISSIVE", 16))
    assert sum(b.num_rows for b in batches) == 150 and sum(read) <= size


def test_length_of_the_last_row(spark, damaged):
    path, table, name = damaged
    spoil(path, table, 149, 0, (2**31 - 1).to_bytes(4, "little"))
    assert by_mode(spark, path, name) == ([150], list(range(1, 150)))


def test_corrupt_column(spark, damaged):
    path, table, name = damaged
    spoil(path, table, 7, 0, (2**30).to_bytes(4, "little"))
    read = spark.read.format("filegdb").option("path", path).option("name", name).option("corruptColumn", "why")
    df = read.load()
    assert df.columns[-1] == "why"
    assert [(r["OBJECTID"], r["why"]) for r in df.where("why IS NOT NULL").collect()] == [(None, "row length")]
    few = read.option("columns", "why,OBJECTID").load()
    assert few.columns == ["why", "OBJECTID"] and few.where("why IS NULL").count() == 149
    assert read.option("mode", "DROPMALFORMED").load().where("why IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="is a column of table"):
        read.option("corruptColumn", "objectid").load()


@pytest.mark.parametrize("bad", [b"\x80" * 10 + b"\x01", b"\x81" * 12 + b"\x00"])
def test_varints_of_over_ten_bytes(bad):
    """In shapes a longer varint is malformed where the shape needs it, whatever it
    would decode to; bytes behind the shape's varints are not looked at."""
    f = L.FieldDesc("Shape", "Shape", L.SHAPE, True, kind="polyline", xy_scale=1.0)
    head, body = bytes([3, 2, 1, 0, 0, 2, 2]), bytes([0, 0, 1, 1])
    for blob, want in ((head + body, False), (head + bad + body[1:], True), (head + body[:-1] + bad, True),
                       (bad + head[1:] + body, True), (head + body + bad, False), (head + body[:-1] + b"\x81", True),
                       (b"\x03\x00", False), (bad + b"\x00", True)):
        buf = np.frombuffer(blob + b"\0" * D.PAD, np.uint8)
        arr, found = D.decode_polys(buf, np.array([0]), np.array([len(blob)]), np.array([True]), f)
        assert found.tolist() == [want] and (arr[0].as_py() is None) == want, blob
    point = L.FieldDesc("Shape", "Shape", L.SHAPE, True, kind="point", xy_scale=1.0)
    blob = b"\x01" + bad + b"\x05"
    buf = np.frombuffer(blob + b"\0" * D.PAD, np.uint8)
    assert D.decode_points(buf, np.array([0]), np.array([len(blob)]), np.array([True]), point)[1].tolist() == [True]
