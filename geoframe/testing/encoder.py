"""Distributed writer of geodatabase test fixtures (test support only).

The library is read-only, like the format reader it mirrors; this writer
exists so that round-trip checks can encode the driver's parquet tables into
real ``.gdbtable`` / ``.gdbtablx`` files and read them back.  It is written
from the published layout (header, field descriptors, row index, varint and
shape encodings), independently of the reader.

Two Spark passes, both distributed:

1. *encode*: rows are range-partitioned by the ordering key, sorted, and
   turned into row records (``mapInArrow``, numpy per batch); the result is
   checkpointed so its partitions are fixed.
2. *place*: per-partition byte and row totals (one row per partition) give
   every partition its file offset; each task then writes its rows and
   index entries into the shared, pre-sized files with positional writes.
   Re-running a task writes the same bytes at the same places.

Needs a POSIX path visible to every executor (the checkpoint folder).
"""

from __future__ import annotations

import math
import os
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.session import checkpoint_dir, local_path

# Field type codes and shape type codes of the format.
TYPE_CODES = {"int16": 0, "int32": 1, "float32": 2, "float64": 3, "string": 4, "datetime": 5,
              "objectid": 6, "shape": 7, "binary": 8, "raster": 9, "uuid": 10, "guid": 11,
              "xml": 12}
GEOMETRY_TYPE = {"point": 1, "pointM": 1, "pointZ": 1, "pointZM": 1, "multipoint": 2,
                 "polyline": 3, "polylineM": 3, "polygon": 5}
GEOMETRY_PROP = {"point": 0x00, "pointM": 0x40, "pointZ": 0x80, "pointZM": 0xC0,
                 "multipoint": 0x00, "polyline": 0x00, "polylineM": 0x40, "polygon": 0x00}
SHAPE_CODE = {"point": 1, "pointZ": 9, "pointM": 21, "pointZM": 11, "multipoint": 8,
              "polyline": 3, "polylineM": 23, "polygon": 5}
CURVE_FLAG = 0x20000000
DAY_OFFSET = 25569.0          # 1899-12-30 .. 1970-01-01
US_PER_DAY = 86400000000.0


@dataclass
class FieldSpec:
    name: str
    type: str                      # key of TYPE_CODES (not "shape": see ShapeSpec)
    source: str | None = None      # column of the input frame (default: name)
    alias: str | None = None
    nullable: bool = True
    max_length: int = 255
    default: bytes | None = None   # stored in the descriptor, never used by readers


@dataclass
class ShapeSpec:
    name: str
    kind: str                      # point, pointM, pointZ, pointZM, polyline, polylineM, polygon
    x: str | None = None           # point ordinate columns
    y: str | None = None
    z: str | None = None
    m: str | None = None
    subtype: str | None = None     # pointZM: per-row shape code column (1, 9, 21, 11)
    coords: str | None = None      # polys: array<double> column, stride 2 or 3
    parts: str | None = None       # polys: array<int> part sizes (default: one part)
    curve: str | None = None       # polys: boolean column -> curve flag + curve bytes
    trailing_m: bool = False       # polygons: append (ignored) M deltas
    x_orig: float = 0.0
    y_orig: float = 0.0
    xy_scale: float = 1000.0
    z_orig: float = 0.0
    z_scale: float = 1000.0
    m_orig: float = 0.0
    m_scale: float = 1000.0
    xy_tol: float = 0.001
    z_tol: float = 0.001
    m_tol: float = 0.001
    extent: tuple | None = None    # None: computed from the data (one aggregate)
    crs: str = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984"]]'
    nullable: bool = True
    extra_grid_doubles: int = 1
    alias: str | None = None

    @property
    def z_and_m(self) -> int:
        if self.kind in ("pointM", "pointZM", "polylineM"):
            return 7
        if self.kind == "pointZ":
            return 5
        return 0


@dataclass
class TableSpec:
    fields: list                   # FieldSpec / ShapeSpec, in file order, OID included
    oid_name: str | None = "OBJECTID"   # None: no object-id field
    oid_position: int = 0
    version: int = 4
    offset_width: int = 4          # bytes of a row offset at least (wider if the file needs it)
    deleted_every: int = 0         # every k-th slot left empty (offset 0)
    sparse_blocks: bool = False    # only even 1024-slot blocks stored (block map)
    no_block_count: bool = False   # index header without block count / trailer
    slot_col: str | None = None    # explicit 0-based slots (rows sorted by it)
    corrupt_col: str | None = None # true -> row length zeroed or truncated
    row_gap: int = 0               # hole before the first row (exercises wide offsets)
    extras: dict = field(default_factory=dict)


# ----------------------------------------------------------- byte helpers

def _u16(s: str) -> bytes:
    return s.encode("utf-16-le")


def _name(s: str) -> bytes:
    return struct.pack("<B", len(s)) + _u16(s)


def _spatial(sp: ShapeSpec, extent: bool) -> bytes:
    crs = _u16(sp.crs)
    out = struct.pack("<h", len(crs)) + crs + struct.pack("<B", sp.z_and_m)
    has_m, has_z = sp.z_and_m == 7, sp.z_and_m in (5, 7)
    out += struct.pack("<ddd", sp.x_orig, sp.y_orig, sp.xy_scale)
    if has_m:
        out += struct.pack("<dd", sp.m_orig, sp.m_scale)
    if has_z:
        out += struct.pack("<dd", sp.z_orig, sp.z_scale)
    out += struct.pack("<d", sp.xy_tol)
    if has_m:
        out += struct.pack("<d", sp.m_tol)
    if has_z:
        out += struct.pack("<d", sp.z_tol)
    if extent:
        out += struct.pack("<dddd", *(sp.extent or (0.0, 0.0, 0.0, 0.0)))
    return out


def field_descriptor(f) -> bytes:
    if isinstance(f, ShapeSpec):
        out = _name(f.name) + _name(f.alias or "") + struct.pack("<B", TYPE_CODES["shape"])
        out += struct.pack("<BB", 0, 7 if f.nullable else 6) + _spatial(f, True)
        out += struct.pack("<d", 0.0) * f.extra_grid_doubles
        out += bytes([0, 1, 0, 0, 0]) + struct.pack("<d", 1000.0)
        return out
    code = TYPE_CODES[f.type]
    out = _name(f.name) + _name(f.alias or "") + struct.pack("<B", code)
    flag = (1 if f.nullable else 0) | (4 if f.default is not None else 0)
    width = {"int16": 2, "int32": 4, "float32": 4, "float64": 8, "datetime": 8}.get(f.type)
    if width:
        d = f.default or b""
        out += struct.pack("<BBB", width, flag, len(d)) + d
    elif f.type == "string":
        d = f.default or b""
        out += struct.pack("<iBB", f.max_length, flag, len(d)) + d
    elif f.type == "raster":
        sp = ShapeSpec(f.name, "point")
        out += struct.pack("<BB", 0, 7 if f.nullable else 6) + _name(f.source or "RASTER")
        out += _spatial(sp, False) + b"\x00"
    else:   # binary, uuid, guid, xml, objectid
        out += struct.pack("<BB", 0, flag if f.type != "objectid" else 2)
    return out


def varuint(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """LEB128 of unsigned values -> (bytes per value, concatenated bytes)."""
    v = np.asarray(v).astype(np.uint64)
    groups = np.stack([(v >> np.uint64(7 * k)) & np.uint64(0x7F) for k in range(10)], axis=1)
    higher = np.stack([(v >> np.uint64(7 * k)) != 0 for k in range(1, 10)], axis=1)
    n = 1 + higher.sum(axis=1)
    k = np.arange(10)
    cont = (k[None, :] < (n - 1)[:, None]).astype(np.uint64) * np.uint64(0x80)
    mat = (groups | cont).astype(np.uint8)
    return n.astype(np.int64), mat[k[None, :] < n[:, None]]


def varint(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign-magnitude varint: first byte = continue bit, sign bit, 6 value
    bits; following bytes 7 value bits each."""
    v = np.asarray(v).astype(np.int64)
    mag = np.abs(v).astype(np.uint64)
    neg = v < 0
    later = np.stack([(mag >> np.uint64(6 + 7 * (k - 1))) & np.uint64(0x7F)
                      for k in range(1, 10)], axis=1)
    higher = np.stack([(mag >> np.uint64(6 + 7 * (k - 1))) != 0 for k in range(1, 10)], axis=1)
    n = 1 + higher.sum(axis=1)
    first = (mag & np.uint64(0x3F)) | np.where(neg, np.uint64(0x40), np.uint64(0))
    groups = np.concatenate([first[:, None], later], axis=1)
    k = np.arange(10)
    cont = (k[None, :] < (n - 1)[:, None]).astype(np.uint64) * np.uint64(0x80)
    mat = (groups | cont).astype(np.uint8)
    return n.astype(np.int64), mat[k[None, :] < n[:, None]]


def _spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    lens = lens.astype(np.int64)
    tot = int(lens.sum())
    if tot == 0:
        return np.zeros(0, np.int64)
    first = np.cumsum(lens) - lens
    return np.repeat(starts.astype(np.int64) - first, lens) + np.arange(tot)


def concat_rows(segments: list[tuple[np.ndarray, np.ndarray]], n: int):
    """Per-row concatenation of byte segments given as (lens, flat bytes)."""
    total = np.zeros(n, np.int64)
    for lens, _ in segments:
        total += lens
    start = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), np.uint8)
    pos = start.copy()
    for lens, flat in segments:
        out[_spread(pos, lens)] = flat
        pos += lens
    return total, out


def _fixed(values: np.ndarray, valid: np.ndarray, dtype: str):
    raw = np.ascontiguousarray(values.astype(dtype)).view(np.uint8).reshape(len(values), -1)
    w = raw.shape[1]
    return np.where(valid, w, 0).astype(np.int64), raw[valid].reshape(-1)


def _with_length(lens: np.ndarray, flat: np.ndarray, valid: np.ndarray):
    """varuint(length) + bytes, for valid rows."""
    ln, lb = varuint(lens[valid])
    hdr = np.zeros(len(lens), np.int64)
    hdr[valid] = ln
    return [(hdr, lb), (np.where(valid, lens, 0), flat)]


def _bytes_of(arr: pa.Array, valid: np.ndarray):
    arr = arr.cast(pa.large_binary()) if not pa.types.is_large_binary(arr.type) else arr
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] else np.zeros(0, np.uint8)
    lens = np.diff(offs)
    lens = np.where(valid, lens, 0)
    idx = _spread(offs[:-1], lens)
    return lens.astype(np.int64), data[idx]


def _num(arr: pa.Array, dtype) -> np.ndarray:
    return pc.fill_null(arr.cast(pa.float64() if dtype == "f" else pa.int64()), 0) \
        .to_numpy(zero_copy_only=False)


# -------------------------------------------------------------- shapes

def _point_blobs(sp: ShapeSpec, batch: pa.RecordBatch, valid: np.ndarray):
    def q(colname, orig, scale):
        x = _num(batch.column(colname), "f")
        v = (np.floor((x - orig) * scale) + 1).astype(np.int64)
        if (v[valid] < 1).any():
            raise ValueError(f"{sp.name}: {colname} below the layer origin {orig}")
        return v

    rows = np.flatnonzero(valid)
    vals = [np.full(len(valid), SHAPE_CODE[sp.kind], np.int64)]
    if sp.kind == "pointZM" and sp.subtype:
        vals[0] = _num(batch.column(sp.subtype), "i")
    vals += [q(sp.x, sp.x_orig, sp.xy_scale), q(sp.y, sp.y_orig, sp.xy_scale)]
    segs = []
    for v in vals:
        ln, fl = varuint(v[rows])
        full = np.zeros(len(valid), np.int64)
        full[rows] = ln
        segs.append((full, fl))
    code = vals[0]
    if sp.kind in ("pointZ", "pointM", "pointZM"):
        has_z = np.full(len(valid), sp.kind != "pointM")
        has_m = np.full(len(valid), sp.kind != "pointZ")
        if sp.kind == "pointZM":
            has_z = (code != 1) & (code != 21)
            has_m = (code != 1) & (code != 9)
        for on, colname, orig, scale in ((has_z, sp.z, sp.z_orig, sp.z_scale),
                                         (has_m, sp.m, sp.m_orig, sp.m_scale)):
            sel = valid & on
            if colname is None:
                continue
            v = q(colname, orig, scale)
            ln, fl = varuint(v[sel])
            full = np.zeros(len(valid), np.int64)
            full[sel] = ln
            segs.append((full, fl))
    return concat_rows(segs, len(valid))


def _poly_blobs(sp: ShapeSpec, batch: pa.RecordBatch, valid: np.ndarray):
    stride = 3 if sp.kind == "polylineM" else 2
    coords = batch.column(sp.coords)
    n = len(valid)
    clen = pc.fill_null(pc.list_value_length(coords), 0).to_numpy(zero_copy_only=False)
    clen = np.where(valid, clen, 0).astype(np.int64)
    flat = pc.list_flatten(coords).cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.frombuffer(coords.buffers()[1], np.int32)[coords.offset:coords.offset + n]
    starts = starts - int(np.frombuffer(coords.buffers()[1], np.int32)[coords.offset])
    vals = flat[_spread(starts, clen)]
    npts = clen // stride
    if sp.parts:
        parts_arr = batch.column(sp.parts)
        plen = pc.fill_null(pc.list_value_length(parts_arr), 0).to_numpy(zero_copy_only=False)
        pflat = pc.list_flatten(parts_arr).cast(pa.int64()).to_numpy(zero_copy_only=False)
        pstart = np.cumsum(plen) - plen
        nparts = np.where(valid, plen, 0).astype(np.int64)
        part_vals = pflat[_spread(pstart, nparts)]
    else:
        nparts = np.where(npts > 0, 1, 0).astype(np.int64)
        part_vals = npts[npts > 0]
    curve = np.zeros(n, bool)
    if sp.curve:
        curve = pc.fill_null(batch.column(sp.curve), False).to_numpy(zero_copy_only=False)
        curve = curve & valid & (npts > 0)
    xs, ys = vals[0::stride], vals[1::stride]
    qx = np.floor((xs - sp.x_orig) * sp.xy_scale).astype(np.int64)
    qy = np.floor((ys - sp.y_orig) * sp.xy_scale).astype(np.int64)
    if (qx < 0).any() or (qy < 0).any():
        raise ValueError(f"{sp.name}: vertices below the layer origin")
    owner = np.repeat(np.arange(n), npts)
    has = npts > 0
    big = np.iinfo(np.int64).max
    xmin = np.full(n, big)
    ymin = np.full(n, big)
    xmax = np.full(n, -big)
    ymax = np.full(n, -big)
    np.minimum.at(xmin, owner, qx)
    np.minimum.at(ymin, owner, qy)
    np.maximum.at(xmax, owner, qx)
    np.maximum.at(ymax, owner, qy)

    def deltas(q):
        d = np.diff(q, prepend=0)
        first = np.cumsum(npts) - npts
        d[first[has]] = q[first[has]]
        return d

    dx, dy = deltas(qx), deltas(qy)
    xy = np.empty(2 * len(dx), np.int64)
    xy[0::2], xy[1::2] = dx, dy
    m_rows = np.zeros(0, np.int64)
    with_m = stride == 3 or (sp.trailing_m and sp.kind == "polygon")
    if stride == 3:
        qm = np.floor((vals[2::3] - sp.m_orig) * sp.m_scale).astype(np.int64)
        m_rows = deltas(qm)
    elif with_m:
        m_rows = deltas(np.arange(len(dx), dtype=np.int64) % 7)
    code = np.full(n, SHAPE_CODE[sp.kind], np.int64) | np.where(curve, CURVE_FLAG, 0)

    # value list per row: [code, npts] + ([nparts, (ncurves), bbox4, parts-1, xy, (m)] if npts)
    n_head = np.where(has, 3 + curve + 4, 2)
    n_lead = np.where(has, nparts - 1, 0)
    n_xy = 2 * npts
    n_m = npts if with_m else np.zeros(n, np.int64)
    total = np.where(valid, n_head + n_lead + n_xy + n_m, 0)
    rstart = np.cumsum(total) - total
    values = np.zeros(int(total.sum()), np.int64)
    signed = np.zeros(len(values), bool)
    r = np.flatnonzero(valid)
    values[rstart[r]] = code[r]
    values[rstart[r] + 1] = npts[r]
    rh = np.flatnonzero(valid & has)
    c = curve[rh].astype(np.int64)
    values[rstart[rh] + 2] = nparts[rh]
    values[rstart[rh] + 3] = np.where(curve[rh], 1, 0)   # overwritten below when no curve
    base = rstart[rh] + 3 + c
    values[base] = xmin[rh]
    values[base + 1] = ymin[rh]
    values[base + 2] = xmax[rh] - xmin[rh]
    values[base + 3] = ymax[rh] - ymin[rh]
    # leading part sizes
    pstarts_all = np.cumsum(nparts) - nparts
    lead_src = _spread(pstarts_all[rh], n_lead[rh])
    lead_dst = _spread(base + 4, n_lead[rh])
    values[lead_dst] = part_vals[lead_src]
    xy_dst = _spread(base + 4 + n_lead[rh], n_xy[rh])
    xy_src = _spread((np.cumsum(2 * npts) - 2 * npts)[rh], n_xy[rh])
    values[xy_dst] = xy[xy_src]
    signed[xy_dst] = True
    if with_m:
        m_dst = _spread(base + 4 + n_lead[rh] + n_xy[rh], npts[rh])
        m_src = _spread((np.cumsum(npts) - npts)[rh], npts[rh])
        values[m_dst] = m_rows[m_src]
        signed[m_dst] = True
    ul, ub = varuint(values[~signed])
    sl, sb = varint(values[signed])
    per_val = np.zeros(len(values), np.int64)
    per_val[~signed] = ul
    per_val[signed] = sl
    # interleave encoded bytes in value order
    vstart = np.cumsum(per_val) - per_val
    out = np.zeros(int(per_val.sum()), np.uint8)
    out[_spread(vstart[~signed], ul)] = ub
    out[_spread(vstart[signed], sl)] = sb
    owner_v = np.repeat(np.arange(n), total)
    blob_len = np.bincount(owner_v, weights=per_val, minlength=n).astype(np.int64)
    if curve.any():
        # curve descriptions follow the vertices; readers skip them
        extra = np.where(curve, 9, 0).astype(np.int64)
        trailer = np.tile(np.array([1, 0, 0, 0, 0, 0, 0, 0, 0], np.uint8), int(curve.sum()))
        return concat_rows([(blob_len, out), (extra, trailer)], n)
    return blob_len, out


def shape_bytes(sp: ShapeSpec, batch: pa.RecordBatch, valid: np.ndarray):
    if sp.kind in ("point", "pointM", "pointZ", "pointZM"):
        return _point_blobs(sp, batch, valid)
    if sp.kind in ("polyline", "polylineM", "polygon"):
        return _poly_blobs(sp, batch, valid)
    raise ValueError(f"no encoder for shape kind {sp.kind}")


# ---------------------------------------------------------------- rows

def encode_batch(spec: TableSpec, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row records (length field included) of one batch -> (lens, bytes)."""
    n = batch.num_rows
    fields = _file_fields(spec)
    nullable = [f for f in fields if f.nullable and not _is_oid(f)]
    nbytes = (len(nullable) + 7) // 8
    bitmap = np.zeros((n, nbytes), np.uint8)
    segs: list[tuple[np.ndarray, np.ndarray]] = []
    bit = 0
    for f in fields:
        if _is_oid(f):
            continue
        if isinstance(f, ShapeSpec):
            src = f.x if f.kind.startswith("point") else f.coords
            valid = batch.column(src).is_valid().to_numpy(zero_copy_only=False)
        elif f.type == "raster":
            valid = np.zeros(n, bool)
        else:
            valid = batch.column(f.source or f.name).is_valid().to_numpy(zero_copy_only=False)
        if not f.nullable:
            valid = np.ones(n, bool) if f.type != "raster" else valid
        if f.nullable:
            nulls = ~valid
            bitmap[:, bit >> 3] |= (nulls.astype(np.uint8) << (bit & 7))
            bit += 1
        if isinstance(f, ShapeSpec):
            lens, flat = shape_bytes(f, batch, valid)
            segs += _with_length(lens, flat, valid)
            continue
        t = f.type
        col = batch.column(f.source or f.name) if t != "raster" else None
        if t in ("int16", "int32", "float32", "float64"):
            dt = {"int16": "<i2", "int32": "<i4", "float32": "<f4", "float64": "<f8"}[t]
            segs.append(_fixed(_num(col, "f" if t.startswith("float") else "i"), valid, dt))
        elif t == "datetime":
            us = pc.fill_null(col.cast(pa.timestamp("us")).cast(pa.int64()), 0) \
                .to_numpy(zero_copy_only=False)
            days = us.astype(np.float64) / US_PER_DAY + DAY_OFFSET
            segs.append(_fixed(days, valid, "<f8"))
        elif t in ("string", "xml", "binary"):
            lens, flat = _bytes_of(col.cast(pa.binary()) if t != "binary" else col, valid)
            segs += _with_length(lens, flat, valid)
        elif t in ("uuid", "guid"):
            lens, flat = _bytes_of(col, valid)
            if (lens[valid] != 16).any():
                raise ValueError(f"{f.name}: GUID values must be 16 bytes")
            segs.append((lens, flat))
        elif t == "raster":
            pass
        else:
            raise ValueError(f"unsupported field type {t}")
    body_len, body = concat_rows([(np.full(n, nbytes, np.int64), bitmap.reshape(-1))] + segs, n)
    length_field = body_len.astype("<i4")
    if spec.corrupt_col:
        bad = pc.fill_null(batch.column(spec.corrupt_col), False).to_numpy(zero_copy_only=False)
        # half of the corrupt rows claim length 0, the others are cut short
        key = np.arange(n) % 2 == 0
        length_field = np.where(bad & key, 0, np.where(bad, np.minimum(body_len, 3),
                                                        body_len)).astype("<i4")
    hdr = np.ascontiguousarray(length_field).view(np.uint8)
    return concat_rows([(np.full(n, 4, np.int64), hdr), (body_len, body)], n)


def _is_oid(f) -> bool:
    return isinstance(f, FieldSpec) and f.type == "objectid"


def _file_fields(spec: TableSpec) -> list:
    fields = list(spec.fields)
    if spec.oid_name and not any(_is_oid(f) for f in fields):
        fields.insert(spec.oid_position, FieldSpec(spec.oid_name, "objectid", nullable=False))
    return fields


def field_section(spec: TableSpec) -> bytes:
    fields = _file_fields(spec)
    shape = next((f for f in fields if isinstance(f, ShapeSpec)), None)
    gtype = GEOMETRY_TYPE[shape.kind] if shape else 0
    gprop = GEOMETRY_PROP[shape.kind] if shape else 0
    body = struct.pack("<ibBBBh", spec.version, gtype, 3, 0, gprop, len(fields))
    body += b"".join(field_descriptor(f) for f in fields)
    return struct.pack("<i", len(body)) + body


# ------------------------------------------------------------- the job

def _slots(spec: TableSpec, r: np.ndarray) -> np.ndarray:
    if spec.deleted_every:
        k = spec.deleted_every
        return r + r // (k - 1)
    if spec.sparse_blocks:
        return 2048 * (r // 1024) + r % 1024
    return r


def _physical(spec: TableSpec, slots: np.ndarray) -> np.ndarray:
    if spec.sparse_blocks:
        return (slots // 2048) * 1024 + slots % 1024
    return slots


def _with_extent(df: DataFrame, spec: TableSpec) -> TableSpec:
    """Fill in a missing layer extent with the data's extent (a single
    partial aggregate over the shape's ordinate columns)."""
    import dataclasses
    fields = []
    for f in spec.fields:
        if isinstance(f, ShapeSpec) and f.extent is None:
            if f.kind.startswith("point"):
                xs, ys = F.col(f.x).cast("double"), F.col(f.y).cast("double")
            else:
                stride = 3 if f.kind == "polylineM" else 2
                arr = F.col(f.coords).cast("array<double>")
                xs = F.array_min(F.filter(arr, lambda v, i: i % stride == 0))
                ys = F.array_min(F.filter(arr, lambda v, i: i % stride == 1))
                xs_hi = F.array_max(F.filter(arr, lambda v, i: i % stride == 0))
                ys_hi = F.array_max(F.filter(arr, lambda v, i: i % stride == 1))
            row = df.agg(F.min(xs), F.min(ys),
                         F.max(xs if f.kind.startswith("point") else xs_hi),
                         F.max(ys if f.kind.startswith("point") else ys_hi)).head()
            ext = tuple(float(v) if v is not None else 0.0 for v in row)
            f = dataclasses.replace(f, extent=ext)
        fields.append(f)
    return dataclasses.replace(spec, fields=fields)


def _offset_width(spec: TableSpec, size: int) -> int:
    """Bytes of a row offset (4, 5 or 6) that reach every row of a file of
    ``size`` bytes, the spec's at least."""
    w = max(spec.offset_width, (max(size - 1, 0).bit_length() + 7) // 8)
    if w > 6:
        raise ValueError(f"offsets of a file of {size} bytes do not fit 6 bytes")
    return w


def write_table(spark: SparkSession, gdb_path: str, table: str, df: DataFrame,
                spec: TableSpec, order_by: list[str], num_partitions: int | None = None) -> dict:
    """Encode ``df`` as table ``table`` (hex name) under ``gdb_path``."""
    from geoframe.session import ship_package
    ship_package(spark)
    checkpoint_dir(spark)
    spec = _with_extent(df, spec)
    path = local_path(gdb_path)
    os.makedirs(path, exist_ok=True)
    nparts = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    cols = sorted({c for c in df.columns})
    ordered = df.repartitionByRange(nparts, *[F.col(c) for c in order_by]) \
        .sortWithinPartitions(*order_by).select(*cols)
    if spec.slot_col:
        ordered = ordered.withColumn("_slot", F.col(spec.slot_col).cast("long"))

    def encode(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        seq = 0
        for b in batches:
            if b.num_rows == 0:
                continue
            lens, data = encode_batch(spec, b)
            offs = np.zeros(len(lens) + 1, np.int64)
            np.cumsum(lens, out=offs[1:])
            rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lens),
                                                    [None, pa.py_buffer(offs),
                                                     pa.py_buffer(data.tobytes())])
            slot = (b.column("_slot") if spec.slot_col else pa.nulls(len(lens), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(lens), pid, np.int32)),
                 pa.array(np.arange(seq, seq + len(lens), dtype=np.int64)),
                 rows.cast(pa.binary()), slot.cast(pa.int64())],
                names=["pid", "seq", "row", "slot"])
            seq += len(lens)

    encoded = ordered.mapInArrow(encode, "pid int, seq long, row binary, slot long") \
        .checkpoint(eager=True)
    totals = encoded.groupBy("pid").agg(F.count(F.lit(1)).alias("n"),
                                        F.sum(F.length("row")).alias("bytes"),
                                        F.max("slot").alias("max_slot")).collect()
    totals = sorted(totals, key=lambda r: r["pid"])
    section = field_section(spec)
    data_start = 40 + len(section) + spec.row_gap
    row_base, byte_base = {}, {}
    acc_rows, acc_bytes = 0, data_start
    for t in totals:
        row_base[t["pid"]] = acc_rows
        byte_base[t["pid"]] = acc_bytes
        acc_rows += t["n"]
        acc_bytes += t["bytes"]
    live = acc_rows
    if spec.slot_col:
        n_slots = (max(t["max_slot"] for t in totals) + 1) if totals else 0
    else:
        n_slots = int(_slots(spec, np.array([live - 1]))[0]) + 1 if live else 0
    n_phys = int(_physical(spec, np.array([n_slots - 1]))[0]) + 1 if n_slots else 0
    w = _offset_width(spec, acc_bytes)
    n_blocks = 0 if spec.no_block_count else math.ceil(n_phys / 1024)
    index_entries = n_blocks * 1024 if n_blocks else n_phys

    tpath = os.path.join(path, table + ".gdbtable")
    xpath = os.path.join(path, table + ".gdbtablx")
    header = struct.pack("<iiiiiiiiQ", 3, live, 0, 5, 0, 0, acc_bytes & 0x7FFFFFFF, 0, 40)
    with open(tpath, "wb") as fh:
        fh.write(header + section)
        fh.truncate(acc_bytes)
    with open(xpath, "wb") as fh:
        fh.write(struct.pack("<iiii", 3, n_blocks, n_slots, w))
        fh.truncate(16 + index_entries * w)
        if n_blocks:
            fh.seek(16 + index_entries * w)
            if spec.sparse_blocks:
                nbits = math.ceil(n_slots / 1024)
                bits = (np.arange(nbits) % 2 == 0)
                fh.write(struct.pack("<iiii", 1, nbits, n_blocks, 0))
                fh.write(np.packbits(bits, bitorder="little").tobytes())
            else:
                fh.write(struct.pack("<iiii", 0, 0, n_blocks, 0))

    bases = {int(k): (row_base[k], byte_base[k]) for k in row_base}

    def place(batches):
        prior_bytes: dict[int, int] = {}
        tfd = os.open(tpath, os.O_WRONLY)
        xfd = os.open(xpath, os.O_WRONLY)
        try:
            for b in batches:
                if b.num_rows == 0:
                    continue
                pids = b.column("pid").to_numpy()
                seq = b.column("seq").to_numpy()
                if (pids != pids[0]).any() or (np.diff(seq) != 1).any():
                    raise RuntimeError("encoded partitions changed between passes")
                rb, bb = bases[int(pids[0])]
                rows = b.column("row").cast(pa.large_binary())
                offs = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset:
                                                                  rows.offset + len(rows) + 1]
                data = rows.buffers()[2]
                first_off = int(offs[0])
                # byte position of this batch: bases + bytes of earlier batches
                prior = prior_bytes.get(int(pids[0]), 0)
                pos = bb + prior
                os.pwrite(tfd, memoryview(data)[first_off:int(offs[-1])], pos)
                prior_bytes[int(pids[0])] = prior + int(offs[-1]) - first_off
                row_off = pos + (offs[:-1] - first_off)
                if spec.slot_col:
                    slots = b.column("slot").to_numpy()
                else:
                    slots = _slots(spec, rb + seq)
                phys = _physical(spec, slots)
                lo, hi = int(phys.min()), int(phys.max())
                if int(row_off.max()) >> (8 * w):
                    raise RuntimeError(f"row offset {int(row_off.max())} does not fit {w} bytes")
                block = np.zeros((hi - lo + 1, 8), np.uint8)
                block[phys - lo] = row_off.astype("<u8").view(np.uint8).reshape(-1, 8)
                os.pwrite(xfd, block[:, :w].tobytes(), 16 + lo * w)
                yield pa.RecordBatch.from_arrays([pa.array([int(pids[0])], pa.int32()),
                                                  pa.array([b.num_rows], pa.int64())],
                                                 names=["pid", "n"])
        finally:
            os.close(tfd)
            os.close(xfd)

    done = encoded.mapInArrow(place, "pid int, n long").groupBy().sum("n").collect()
    written = done[0][0] or 0
    if written != live:
        raise RuntimeError(f"wrote {written} rows, expected {live}")
    return {"table": table, "rows": live, "slots": n_slots, "bytes": acc_bytes}
