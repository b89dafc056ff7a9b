"""File layout of a geodatabase table: header, field descriptors, row index.

A table ``aXXXXXXXX`` is two files: ``.gdbtable`` (header, field section,
rows) and ``.gdbtablx`` (one fixed-width row offset per slot).  This module
parses the small fixed parts (driver side, a few KB) and describes fields as
plain picklable records that travel with the read tasks.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql.types import (BinaryType, DataType, DoubleType, FloatType, IntegerType,
                               ShortType, StringType, StructField, StructType, TimestampType)

from geoframe.functions.geometry import KIND_TYPES

# Fixed values of the format: field type codes, the catalog table's file
# name, geometryProp bits (M, Z) and the zAndM descriptor byte (7 = Z and M
# parameters present, 5 = Z only).
INT16 = 0
INT32 = 1
FLOAT32 = 2
FLOAT64 = 3
STRING = 4
DATETIME = 5
OID = 6
SHAPE = 7
BINARY = 8
RASTER = 9
UUID = 10
GUID = 11
XML = 12
CATALOG_TABLE = "a00000001"
PROP_M, PROP_Z = 0x40, 0x80
ZM_BOTH, ZM_Z = 7, 5

TYPE_NAMES = {INT16: "int16", INT32: "int32", FLOAT32: "float32", FLOAT64: "float64",
              STRING: "string", DATETIME: "datetime", OID: "objectid", SHAPE: "shape",
              BINARY: "binary", RASTER: "raster", UUID: "uuid", GUID: "guid", XML: "xml"}
FIXED_WIDTH = {INT16: 2, INT32: 4, FLOAT32: 4, FLOAT64: 8, DATETIME: 8, UUID: 16, GUID: 16}


class GDBFormatError(ValueError):
    pass


def hex_name(table_id: int) -> str:
    return "a%08x" % table_id


# ------------------------------------------------------------------ files

def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem + path for a local path or any URI pyarrow understands, and
    for the Hadoop spellings of S3."""
    scheme, mark, rest = path.partition("://")
    if mark and scheme in ("s3a", "s3n"):
        path = "s3://" + rest
    if "://" in path and not path.startswith("file://"):
        return pafs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = path[len("file://"):] if path.startswith("file://") else path[len("file:"):]
    return pafs.LocalFileSystem(), path


def table_paths(path: str, table: str) -> tuple[str, str]:
    base = path.rstrip("/")
    return f"{base}/{table}.gdbtable", f"{base}/{table}.gdbtablx"


def exists(path: str, table: str) -> bool:
    fs, p = filesystem(path)
    t, _ = table_paths(p, table)
    return fs.get_file_info(t).type == pafs.FileType.File


def read_at(fh, nbytes: int, offset: int) -> bytes:
    """Positional read returning bytes (whatever buffer type the file gives)."""
    if nbytes <= 0:
        return b""
    out = fh.read_at(nbytes, offset)
    return out if isinstance(out, bytes) else out.to_pybytes()


class _Reader:
    """Little-endian cursor over a bytes object."""

    def __init__(self, data: bytes, pos: int = 0):
        self.data, self.pos = data, pos

    def take(self, fmt: str):
        size = struct.calcsize("<" + fmt)
        if self.pos + size > len(self.data):
            raise GDBFormatError("field section truncated")
        v = struct.unpack_from("<" + fmt, self.data, self.pos)
        self.pos += size
        return v if len(v) > 1 else v[0]

    def skip(self, n: int):
        self.pos += n

    def utf16(self, nchars: int) -> str:
        raw = self.data[self.pos:self.pos + 2 * nchars]
        self.pos += 2 * nchars
        return raw.decode("utf-16-le")


# --------------------------------------------------------------- fields

@dataclass
class FieldDesc:
    name: str
    alias: str
    type_code: int
    nullable: bool
    max_length: int | None = None
    kind: str | None = None            # geometry kind, or "unsupported"
    crs: str | None = None
    has_z: bool = False
    has_m: bool = False
    x_orig: float = 0.0
    y_orig: float = 0.0
    xy_scale: float = 0.0
    z_orig: float = 0.0
    z_scale: float = 0.0
    m_orig: float = 0.0
    m_scale: float = 0.0
    xy_tol: float = 0.0
    z_tol: float = 0.0
    m_tol: float = 0.0
    extent: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)
    raster_column: str | None = None
    extra: dict = field(default_factory=dict)

    def spark_type(self) -> DataType:
        t = self.type_code
        if t == INT16:
            return ShortType()
        if t in (INT32, OID):
            return IntegerType()
        if t == FLOAT32:
            return FloatType()
        if t == FLOAT64:
            return DoubleType()
        if t in (STRING, XML, UUID, GUID):
            return StringType()
        if t == DATETIME:
            return TimestampType()
        if t == SHAPE:
            return KIND_TYPES[self.kind] if self.kind in KIND_TYPES else BinaryType()
        return BinaryType()   # BINARY, RASTER

    def metadata(self) -> dict:
        md: dict = {"alias": self.alias, "fieldType": TYPE_NAMES[self.type_code],
                    "sourceNullable": self.nullable}
        if self.type_code == OID:
            md["isObjectId"] = True
        if self.type_code == STRING:
            md["maxLength"] = int(self.max_length or 0)
        if self.type_code in (SHAPE, RASTER):
            md.update({"crs": self.crs or "", "hasZ": self.has_z, "hasM": self.has_m,
                       "xyTolerance": self.xy_tol})
            if self.has_z:
                md["zTolerance"] = self.z_tol
            if self.has_m:
                md["mTolerance"] = self.m_tol
        if self.type_code == SHAPE:
            md["geometryType"] = self.kind
            md.update(dict(zip(("xmin", "ymin", "xmax", "ymax"), self.extent)))
            md.update({"xorigin": self.x_orig, "yorigin": self.y_orig, "xyscale": self.xy_scale})
            if self.has_z:
                md.update({"zorigin": self.z_orig, "zscale": self.z_scale})
            if self.has_m:
                md.update({"morigin": self.m_orig, "mscale": self.m_scale})
        if self.type_code == RASTER:
            md.update({"RasterColumn": self.raster_column or "", "xorigin": self.x_orig,
                       "yorigin": self.y_orig, "xyscale": self.xy_scale})
            if self.has_z:
                md.update({"zorigin": self.z_orig, "zscale": self.z_scale})
            if self.has_m:
                md.update({"morigin": self.m_orig, "mscale": self.m_scale})
        md.update(self.extra)
        return md

    def struct_field(self) -> StructField:
        # every column is nullable: a malformed row comes back as all nulls
        return StructField(self.name, self.spark_type(), True, self.metadata())


def _spatial_params(r: _Reader, f: FieldDesc, with_extent: bool):
    crs_len = r.take("h")
    f.crs = r.utf16(max(crs_len, 0) // 2)
    zm = r.take("B")
    f.has_z, f.has_m = zm in (ZM_BOTH, ZM_Z), zm == ZM_BOTH
    f.x_orig, f.y_orig, f.xy_scale = r.take("ddd")
    if f.has_m:
        f.m_orig, f.m_scale = r.take("dd")
    if f.has_z:
        f.z_orig, f.z_scale = r.take("dd")
    f.xy_tol = r.take("d")
    if f.has_m:
        f.m_tol = r.take("d")
    if f.has_z:
        f.z_tol = r.take("d")
    if with_extent:
        f.extent = tuple(r.take("dddd"))


def _skip_grid(r: _Reader):
    """Spatial-index grid sizes: doubles until the marker ``00 n 00 00 00``
    (n > 0), then n more doubles."""
    data = r.data
    while True:
        if r.pos + 5 > len(data):
            raise GDBFormatError("shape descriptor: grid marker not found")
        b = data[r.pos:r.pos + 5]
        n = b[1] if b[1] < 128 else 0
        if b[0] == 0 and n > 0 and b[2] == 0 and b[3] == 0 and b[4] == 0:
            r.skip(5 + 8 * n)
            return
        r.skip(8)


def _geometry_kind(geom_type: int, prop: int, f: FieldDesc) -> str:
    if geom_type == 1:
        kind = {0x00: "point", PROP_M: "pointM", PROP_Z: "pointZ"}.get(prop, "pointZM")
    elif geom_type == 3:
        if prop not in (0x00, PROP_M):
            raise GDBFormatError("polylines with Z values are not supported")
        kind = "polyline" if prop == 0x00 else "polylineM"
    elif geom_type in (4, 5):
        return "polygon"          # Z/M of polygons are ignored: 2D only
    else:
        return "unsupported"
    if kind in ("pointM", "pointZM", "polylineM") and not f.has_m:
        raise GDBFormatError(f"field {f.name}: layer declares M values but the descriptor "
                             "carries no M origin/scale")
    if kind in ("pointZ", "pointZM") and not f.has_z:
        raise GDBFormatError(f"field {f.name}: layer declares Z values but the descriptor "
                             "carries no Z origin/scale")
    return kind


def parse_fields(section: bytes, geom_type: int, prop: int, nfields: int) -> list[FieldDesc]:
    r = _Reader(section)
    out = []
    for _ in range(nfields):
        name = r.utf16(r.take("B"))
        alias = r.utf16(r.take("B")) or name
        t = r.take("B")
        if t in (INT16, INT32, FLOAT32, FLOAT64, DATETIME):
            _, flag, dlen = r.take("BBB")
            f = FieldDesc(name, alias, t, bool(flag & 1))
            if flag & 4 and dlen == FIXED_WIDTH[t]:
                r.skip(dlen)
        elif t == STRING:
            maxlen, flag, dlen = r.take("iBB")
            f = FieldDesc(name, alias, t, bool(flag & 1), max_length=maxlen)
            if flag & 4 and dlen > 0:
                r.skip(dlen)
        elif t in (BINARY, UUID, GUID, XML, OID):
            _, flag = r.take("BB")
            f = FieldDesc(name, alias, t, bool(flag & 1))
        elif t == SHAPE:
            _, flag = r.take("BB")
            f = FieldDesc(name, alias, t, bool(flag & 1))
            _spatial_params(r, f, with_extent=True)
            _skip_grid(r)
            f.kind = _geometry_kind(geom_type, prop, f)
        elif t == RASTER:
            _, flag = r.take("BB")
            f = FieldDesc(name, alias, t, bool(flag & 1))
            f.raster_column = r.utf16(r.take("B"))
            _spatial_params(r, f, with_extent=False)
            r.skip(1)
        else:
            raise GDBFormatError(f"field {name}: type code {t} is not supported")
        out.append(f)
    return out


@dataclass
class TableHeader:
    table: str                 # hex file name, e.g. a00000009
    live_rows: int
    version: int
    geom_type: int
    geom_prop: int
    fields: list[FieldDesc]
    file_size: int

    @property
    def object_id_name(self) -> str:
        names = [f.name for f in self.fields if f.type_code == OID]
        return names[-1] if names else "OBJECTID"

    def schema(self) -> StructType:
        return StructType([f.struct_field() for f in self.fields])


def read_table_header(path: str, table: str) -> TableHeader:
    fs, p = filesystem(path)
    tpath, _ = table_paths(p, table)
    with fs.open_input_file(tpath) as fh:
        size = fh.size()
        head = read_at(fh, 40, 0)
        if len(head) < 40:
            raise GDBFormatError(f"{table}: header truncated")
        live = struct.unpack_from("<i", head, 4)[0]
        field_off = struct.unpack_from("<Q", head, 32)[0]
        if field_off + 14 > size:
            raise GDBFormatError(f"{table}: field section offset {field_off} beyond file")
        fixed = read_at(fh, 14, field_off)
        length, version, geom_type, _, _, prop, nfields = struct.unpack("<iibBBBh", fixed)
        section = read_at(fh, max(length - 10, 0), field_off + 14)
    fields = parse_fields(section, geom_type, prop, nfields)
    return TableHeader(table, live, version, geom_type, prop, fields, size)


def read_live_rows(path: str, table: str) -> int:
    """Number of live rows by the table's header."""
    fs, p = filesystem(path)
    with fs.open_input_file(table_paths(p, table)[0]) as fh:
        head = read_at(fh, 8, 0)
    if len(head) < 8:
        raise GDBFormatError(f"{table}: header truncated")
    return struct.unpack_from("<I", head, 4)[0]


# ---------------------------------------------------------------- index

@dataclass
class IndexHeader:
    num_slots: int
    width: int
    n_blocks: int
    block_map: np.ndarray | None    # bool per logical 1024-slot block, or None
    _before: np.ndarray | None = None

    def physical_slots(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(stored?, physical position) of logical slots."""
        if self.block_map is None:
            return np.ones(len(slots), bool), slots
        if self._before is None:
            # stored blocks before each logical block, computed once per reader
            self._before = np.concatenate([[0], np.cumsum(self.block_map, dtype=np.int64)])
        blk = slots // 1024
        inside = blk < len(self.block_map)
        present = np.zeros(len(slots), bool)
        present[inside] = self.block_map[blk[inside]]
        phys = self._before[np.minimum(blk, len(self.block_map))] * 1024 + slots % 1024
        return present, phys


def read_index_header(path: str, table: str) -> IndexHeader:
    fs, p = filesystem(path)
    _, xpath = table_paths(p, table)
    with fs.open_input_file(xpath) as fh:
        head = read_at(fh, 16, 0)
        if len(head) < 16:
            raise GDBFormatError(f"{table}: index header truncated")
        _, n_blocks, num_slots, width = struct.unpack("<iiii", head)
        if width not in (4, 5, 6):
            raise GDBFormatError(f"{table}: offset width {width} not supported")
        block_map = None
        if n_blocks != 0:
            tail = read_at(fh, 16, 16 + width * 1024 * n_blocks)
            if len(tail) < 16:
                raise GDBFormatError(f"{table}: index trailer truncated")
            else:
                magic, nbits, n_blocks2, _ = struct.unpack("<iiii", tail)
                if magic != 0:
                    if n_blocks2 != n_blocks or num_slots > nbits * 1024:
                        raise GDBFormatError(f"{table}: inconsistent block map")
                    raw = read_at(fh, math.ceil(nbits / 8), 16 + width * 1024 * n_blocks + 16)
                    bits = np.unpackbits(np.frombuffer(raw, np.uint8),
                                         bitorder="little")[:nbits]
                    block_map = bits.astype(bool)
    return IndexHeader(num_slots, width, n_blocks, block_map)


def read_offsets(fh, header: IndexHeader, slots: np.ndarray) -> np.ndarray:
    """Row offsets (uint64, 0 = deleted/absent) of sorted logical slots,
    fetched with one contiguous read of the index."""
    if len(slots) == 0:
        return np.zeros(0, np.uint64)
    present, phys = header.physical_slots(slots)
    out = np.zeros(len(slots), np.uint64)
    if not present.any():
        return out
    p = phys[present]
    lo, hi = int(p.min()), int(p.max())
    w = header.width
    raw = read_at(fh, (hi - lo + 1) * w, 16 + lo * w)
    arr = np.frombuffer(raw, np.uint8)
    have = len(arr) // w
    rel = p - lo
    ok = rel < have
    if not ok.all():
        raise GDBFormatError("index truncated: fewer entries than slots")
    idx = rel[ok][:, None] * w + np.arange(w)
    b = arr[idx].astype(np.uint64)
    shifts = (np.arange(w, dtype=np.uint64) * np.uint64(8))
    vals = (b << shifts).sum(axis=1, dtype=np.uint64)
    tmp = np.zeros(len(p), np.uint64)
    tmp[ok] = vals
    out[present] = tmp
    return out


def slots_of_rows(path: str, table: str, n: int) -> int:
    """How many slots from the first on hold the first ``n`` rows.  Index entries are
    read 1,024 at first and up to 2**20 at a time."""
    header = read_index_header(path, table)
    fs, p = filesystem(path)
    at, step, seen = 0, 1024, 0
    with fs.open_input_file(table_paths(p, table)[1]) as fh:
        while at < header.num_slots and seen < n:
            slots = np.arange(at, min(at + step, header.num_slots), dtype=np.int64)
            live = np.flatnonzero(read_offsets(fh, header, slots))
            if seen + len(live) >= n:
                return int(slots[live[n - seen - 1]]) + 1
            seen, at, step = seen + len(live), at + step, min(4 * step, 1 << 20)
    return header.num_slots if n > 0 else 0
