"""Paths and URIs of geodatabases."""

from types import SimpleNamespace

from pyarrow import fs as pafs

from geoframe.sources import layout as L


def test_local_spellings():
    for path in ("/data/x.gdb", "file:/data/x.gdb", "file:///data/x.gdb"):
        files, p = L.filesystem(path)
        assert isinstance(files, pafs.LocalFileSystem) and p == "/data/x.gdb"


def test_hadoop_spellings_of_s3(monkeypatch):
    asked = []
    system = SimpleNamespace(from_uri=lambda uri: asked.append(uri) or (None, uri))
    monkeypatch.setattr(L, "pafs", SimpleNamespace(FileSystem=system))
    for path in ("s3a://bucket/x.gdb", "s3n://bucket/x.gdb", "s3://bucket/x.gdb"):
        L.filesystem(path)
    assert asked == ["s3://bucket/x.gdb"] * 3
