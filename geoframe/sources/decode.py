"""Columnar decoding of a batch of rows into Arrow arrays.

Rows have variable length, so every row keeps its own cursor; each field is
decoded for the whole batch at once (numpy gathers at the cursor vector), and
the cursors advance by each row's own width.  Geometry blobs are split into
varints in one pass over all their bytes (continuation-bit mask +
``np.add.reduceat``), then headers, part counts and delta-coded vertices are
picked out with index arithmetic; running sums of the deltas are exact int64
``cumsum``s with a per-row carry removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from geoframe.sources.layout import (BINARY, DATETIME, FLOAT32, FLOAT64, GUID, INT16, INT32,
                                     OID, RASTER, SHAPE, STRING, UUID, XML, FieldDesc)

MAX_VARINT = 10   # bytes of a 64-bit number
#: why a row is malformed, by the number that ``decode_rows`` gives
REASONS = [None, "row length", "raster value", "field value", "geometry"]
PAD = 64   # zero bytes appended to every buffer so fixed-size gathers stay in bounds
_HEX = np.frombuffer(b"0123456789ABCDEF", np.uint8)
# Fixed values of the format: GUID text byte order (see
# functions.columns.GUID_GROUPS), the curve flag of a poly shape type, and
# the point subtypes inside a Z+M point layer (plain, with Z, with M).
_GUID_ORDER = np.array([3, 2, 1, 0, 5, 4, 7, 6, 8, 9, 10, 11, 12, 13, 14, 15])
_CURVE_FLAG = 0x20000000
_PT_PLAIN, _PT_Z, _PT_M = 1, 9, 21


def _validity(valid: np.ndarray):
    if valid.all():
        return None
    return pa.py_buffer(np.packbits(valid, bitorder="little"))


def _gather(buf: np.ndarray, pos: np.ndarray, width: int) -> np.ndarray:
    """``width`` bytes at every position, as an (n, width) array.  Positions
    of rows already known to be bad may point anywhere: they are clamped
    (their values are masked out later)."""
    pos = np.clip(pos, 0, len(buf) - width)
    return np.lib.stride_tricks.sliding_window_view(buf, width)[pos]


def _varuint_fixed(b: np.ndarray, dtype):
    cont = (b & 0x80) != 0
    stop = np.argmin(cont, axis=1)
    k = np.arange(b.shape[1])
    keep = k[None, :] <= stop[:, None]
    shifted = (b & 0x7F).astype(dtype) << (7 * k).astype(dtype)
    val = np.where(keep, shifted, 0).sum(axis=1, dtype=dtype)
    return val, (stop + 1).astype(np.int64), cont.all(axis=1)


def fixed_at(buf: np.ndarray, pos: np.ndarray, dtype: str) -> np.ndarray:
    """Little-endian values of ``dtype`` starting at arbitrary byte positions:
    one gather through an unaligned strided view of the buffer."""
    width = np.dtype(dtype).itemsize
    view = np.ndarray((len(buf) - width + 1,), dtype=dtype, buffer=buf, strides=(1,))
    return view[np.clip(pos, 0, len(buf) - width)]


_LEN_MASK = np.array([0, 0x7F, 0x3FFF, 0x1FFFFF, 0xFFFFFFF], np.uint32)


def read_varuint(buf: np.ndarray, pos: np.ndarray, maxlen: int = 10):
    """LEB128 at each position -> (value uint64, byte count, malformed).

    Values that end within 4 bytes (< 2**28, nearly all) are decoded from
    one 32-bit word per row with shifts and masks; only the rest read the
    full width."""
    if len(pos) == 0:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, np.zeros(0, bool)
    w = fixed_at(buf, pos, "<u4")
    nb = np.where((w & 0x80) == 0, 1,
                  np.where((w & 0x8000) == 0, 2,
                           np.where((w & 0x800000) == 0, 3,
                                    np.where((w & 0x80000000) == 0, 4, 0))))
    val = (w & 0x7F) | ((w >> 1) & 0x3F80) | ((w >> 2) & 0x1FC000) | ((w >> 3) & 0xFE00000)
    val = (val & _LEN_MASK[nb]).astype(np.uint64)
    nb = nb.astype(np.int64)
    bad = np.zeros(len(pos), bool)
    long_ = nb == 0
    if long_.any():
        idx = np.flatnonzero(long_)
        if maxlen > 4:
            v2, n2, b2 = _varuint_fixed(_gather(buf, pos[idx], maxlen), np.uint64)
            val[idx], nb[idx], bad[idx] = v2, n2, b2
        else:
            nb[idx] = 1
            bad[idx] = True
    return val, nb, bad


def _ragged_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``arange(s, s + n)`` for every (s, n)."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    offs = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=offs[1:])
    return np.repeat(starts.astype(np.int64) - offs, lengths) + np.arange(total)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def binary_array(buf, starts, lengths, valid, string: bool) -> pa.Array:
    lengths = np.where(valid, lengths, 0)
    offs = _offsets(lengths)
    data = buf[_ragged_index(starts, lengths)]
    typ = pa.string() if string else pa.binary()
    if offs[-1] > 2**31 - 1:
        typ = pa.large_string() if string else pa.large_binary()
        off_buf = pa.py_buffer(offs)
    else:
        off_buf = pa.py_buffer(offs.astype(np.int32))
    arr = pa.Array.from_buffers(typ, len(lengths), [_validity(valid), off_buf,
                                                    pa.py_buffer(data.tobytes())])
    if typ != (pa.string() if string else pa.binary()):
        arr = arr.cast(pa.string() if string else pa.binary())
    return arr


# two upper-case hex digits per byte value, as little-endian uint16 pairs
_HEX2 = np.array([ord("%X" % (i >> 4)) | (ord("%X" % (i & 15)) << 8) for i in range(256)],
                 np.uint16)
# output columns of the 32 hex digits inside "{8-4-4-4-12}"
_GUID_COLS = np.array([c for c in range(1, 37) if c not in (9, 14, 19, 24)])


def guid_array(buf, pos, valid) -> pa.Array:
    n = len(pos)
    b = _gather(buf, pos, 16)[:, _GUID_ORDER]
    hexed = np.ascontiguousarray(_HEX2[b]).view(np.uint8).reshape(n, 32)
    out = np.empty((n, 38), np.uint8)
    out[:, 0] = ord("{")
    out[:, 37] = ord("}")
    out[:, [9, 14, 19, 24]] = ord("-")
    out[:, _GUID_COLS] = hexed
    offs = np.arange(n + 1, dtype=np.int32) * 38
    # invalid rows keep their (ignored) bytes; validity masks them
    return pa.Array.from_buffers(pa.string(), n, [_validity(valid), pa.py_buffer(offs),
                                                  pa.py_buffer(out.tobytes())])


def datetime_millis(days: np.ndarray) -> np.ndarray:
    """``ceil((d - 25569) * 1000 * 60 * 60 * 24)`` in float64, left to right."""
    with np.errstate(invalid="ignore", over="ignore"):
        ms = np.ceil(((((days - 25569.0) * 1000.0) * 60.0) * 60.0) * 24.0)
        ok = np.isfinite(ms) & (np.abs(ms) < 9.2e15)     # also keeps ms * 1000 in int64
        return np.where(ok, ms, 0).astype(np.int64)


# ------------------------------------------------------------- geometries

def _point_struct(f: FieldDesc, cols: dict[str, np.ndarray], valid: np.ndarray) -> pa.Array:
    names = [x.name for x in f.spark_type().fields]
    arrays = [pa.array(np.where(valid, cols[n], 0.0), pa.float64()) for n in names]
    fields = [pa.field(n, pa.float64(), nullable=False) for n in names]
    return pa.StructArray.from_arrays(arrays, fields=fields,
                                      mask=pa.array(~valid) if not valid.all() else None)


def decode_points(buf, bstart, blen, valid, f: FieldDesc):
    """Point blobs: geomType, vx, vy [, vz] [, vm] as varuints; ordinate =
    (v - 1) / scale + origin.  Returns (arrow array, malformed mask)."""
    n = len(bstart)
    pos = bstart.copy()
    bad = np.zeros(n, bool)

    def nxt():
        nonlocal pos
        v, nb, b = read_varuint(buf, pos)
        pos = pos + nb
        return v, b

    gt, b0 = nxt()
    vx, b1 = nxt()
    vy, b2 = nxt()
    bad |= b0 | b1 | b2
    cols = {"x": (vx.astype(np.float64) - 1.0) / f.xy_scale + f.x_orig,
            "y": (vy.astype(np.float64) - 1.0) / f.xy_scale + f.y_orig}
    zero = np.zeros(n)
    if f.kind == "pointZ":
        vz, b = nxt()
        bad |= b
        cols["z"] = (vz.astype(np.float64) - 1.0) / f.z_scale + f.z_orig
    elif f.kind == "pointM":
        vm, b = nxt()
        bad |= b
        cols["m"] = (vm.astype(np.float64) - 1.0) / f.m_scale + f.m_orig
    elif f.kind == "pointZM":
        # per-row subtype: 1 plain, 9 with z, 21 with m, anything else z and m
        sub = gt.astype(np.int64)
        has_z = (sub != _PT_PLAIN) & (sub != _PT_M)
        has_m = (sub != _PT_PLAIN) & (sub != _PT_Z)
        v3, n3, b3 = read_varuint(buf, pos)
        pos3 = pos + np.where(has_z | has_m, n3, 0)
        v4, n4, b4 = read_varuint(buf, pos3)
        both = has_z & has_m
        pos = pos3 + np.where(both, n4, 0)
        bad |= ((has_z | has_m) & b3) | (both & b4)
        vz = np.where(has_z, v3, 1).astype(np.float64)
        vm = np.where(has_z, v4, v3).astype(np.float64)
        with np.errstate(invalid="ignore", divide="ignore"):
            cols["z"] = np.where(has_z, (vz - 1.0) / f.z_scale + f.z_orig, zero)
            cols["m"] = np.where(has_m, (vm - 1.0) / f.m_scale + f.m_orig, zero)
    bad |= pos > bstart + blen
    bad &= valid
    with np.errstate(invalid="ignore", divide="ignore"):
        return _point_struct(f, cols, valid & ~bad), bad


def _varint_stream(buf, bstart, blen, broken: list | None = None):
    """All varints of the given blobs: (unsigned values, signed values,
    first varint index per blob, count per blob).  ``broken`` takes the indices of
    those that are no number: above ``MAX_VARINT`` bytes, or cut off by the blob's end.

    A varint ends at a byte without the continuation bit or at the end of
    its blob.  Boundaries come from one pass over the blob bytes; each varint
    is then decoded from one unaligned 64-bit word (7-bit groups shifted into
    place, masked to its length), so the arithmetic runs per varint, not per
    byte.  Varints longer than 8 bytes (values >= 2**56) take a slow path."""
    nblob = len(bstart)
    idx = _ragged_index(bstart, blen)
    b = buf[idx]
    offs = _offsets(blen)
    nonempty = blen > 0
    term = b < 0x80
    last = (offs[1:] - 1)[nonempty]
    cut = last[~term[last]]
    term[last] = True
    ends = np.flatnonzero(term)
    count = np.zeros(nblob, np.int64)
    if len(ends) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), count, count
    count[nonempty] = np.add.reduceat(term.astype(np.int64), offs[:-1][nonempty])
    first = _offsets(count)[:-1]
    starts = np.empty_like(ends)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    length = ends - starts + 1
    longest = int(length.max())
    # 32-bit words suffice while every varint has at most 4 bytes (< 2**28)
    ut = np.uint32 if longest <= 4 else np.uint64
    w = fixed_at(buf, idx[starts], "<u4" if longest <= 4 else "<u8")
    uval = w & ut(0x7F)
    smag = w & ut(0x3F)
    for j in range(1, min(longest, 8)):
        g = (w >> ut(8 * j)) & ut(0x7F)
        uval |= g << ut(7 * j)
        smag |= g << ut(7 * j - 1)
    lc = np.minimum(length, 8).astype(ut)
    one = ut(1)
    uval = (uval & ((one << (ut(7) * lc)) - one)).astype(np.uint64)
    smag = smag & ((one << (ut(7) * lc - one)) - one)
    sval = smag.astype(np.int64)
    sval = np.where((w & ut(0x40)) != 0, -sval, sval)
    for i in np.flatnonzero(length > 8):      # rare: values of 57+ bits
        raw = [int(x) for x in b[starts[i]:ends[i] + 1]]
        u = sum((x & 0x7F) << (7 * k) for k, x in enumerate(raw[:10]))
        m = (raw[0] & 0x3F) | sum((x & 0x7F) << (7 * k - 1) for k, x in enumerate(raw[:10])
                                  if k > 0)
        uval[i] = np.uint64(u & 0xFFFFFFFFFFFFFFFF)
        m &= 0x7FFFFFFFFFFFFFFF
        sval[i] = -m if raw[0] & 0x40 else m
    if broken is not None:
        broken.extend(np.union1d(np.flatnonzero(length > MAX_VARINT), np.searchsorted(ends, cut)).tolist())
    return uval, sval, first, count


def decode_polys(buf, bstart, blen, valid, f: FieldDesc):
    """Polyline / polylineM / polygon blobs -> struct arrays.

    Blob: geomType, numPoints, [numParts, [curve count if flagged], xmin,
    ymin, xext, yext (varuint), numParts-1 part sizes, x/y deltas (varint),
    [m deltas]].  Running sums carry across parts.  numPoints = 0 gives the
    empty geometry.
    """
    n = len(bstart)
    stride = 3 if f.kind == "polylineM" else 2
    use = valid & (blen > 0)
    rows = np.flatnonzero(use)
    broken: list[int] = []
    uval, sval, first, count = _varint_stream(buf, bstart[rows], blen[rows], broken)
    m = len(rows)
    nv = len(uval)

    def at(i, arr=uval, default=0):
        ok = (i >= 0) & (i < nv)
        out = np.full(len(i), default, dtype=arr.dtype)
        out[ok] = arr[i[ok]]
        return out, ok

    bad = np.zeros(m, bool)
    gt, _ = at(first)
    npts, ok1 = at(first + 1)
    bad |= (count < 2) | ~ok1
    npts = npts.astype(np.int64)
    empty = (npts == 0) & ~bad
    nparts, _ = at(first + 2)
    nparts = nparts.astype(np.int64)
    curve = ((gt & np.uint64(_CURVE_FLAG)) != 0) & (stride == 2)
    bb = first + 3 + curve.astype(np.int64)
    q = [at(bb + j)[0].astype(np.float64) for j in range(4)]
    pc_start = bb + 4
    body = ~empty & ~bad
    nparts = np.where(body, nparts, 0)
    npts = np.where(body, npts, 0)
    bad |= body & ((nparts <= 0) | (nparts > 2**31) | (npts > 2**40))
    nparts = np.where(bad, 0, nparts)
    npts = np.where(bad, 0, npts)
    d_start = pc_start + np.maximum(nparts - 1, 0)
    # varints this blob must hold: header, bbox, part sizes, x/y (and m) deltas
    need = d_start + npts * stride - first
    bad |= body & (need > count)
    # (what follows the varints a blob must hold may be no varints at all)
    if broken:
        owner = np.searchsorted(first, broken, side="right") - 1
        bad[owner[np.array(broken) - first[owner] < np.where(empty, 2, need)[owner]]] = True
    empty &= ~bad
    npts = np.where(bad, 0, npts)
    nparts = np.where(bad, 0, nparts)

    # part sizes: stored leading counts, the last one implied
    lead_n = np.maximum(nparts - 1, 0)
    lead_idx = _ragged_index(pc_start, lead_n)
    lead_vals = at(lead_idx)[0].astype(np.int64) if len(lead_idx) else np.zeros(0, np.int64)
    part_offs = _offsets(nparts)
    xy_num = np.zeros(int(part_offs[-1]), np.int64)
    is_last = np.zeros(len(xy_num), bool)
    if len(xy_num):
        is_last[part_offs[1:][nparts > 0] - 1] = True
    xy_num[~is_last] = lead_vals
    lead_sum = np.zeros(m, np.int64)
    if len(lead_vals):
        owner = np.repeat(np.arange(m), lead_n)
        lead_sum = np.bincount(owner, weights=lead_vals, minlength=m).astype(np.int64)
    xy_num[is_last] = (npts - lead_sum)[nparts > 0]
    bad_parts = (npts - lead_sum < 0) & (nparts > 0)
    bad |= bad_parts

    # coordinates
    xy_idx = _ragged_index(d_start, 2 * npts)
    d = sval[xy_idx] if len(xy_idx) else np.zeros(0, np.int64)
    dx, dy = d[0::2], d[1::2]
    vert_offs = _offsets(npts)

    def running(deltas):
        if len(deltas) == 0:
            return np.zeros(0, np.float64)
        tot = np.cumsum(deltas, dtype=np.int64)
        starts = vert_offs[:-1]
        carry = np.where(starts > 0, tot[np.maximum(starts - 1, 0)], 0)
        return (tot - np.repeat(carry, npts)).astype(np.float64)

    xs = running(dx) / f.xy_scale + f.x_orig
    ys = running(dy) / f.xy_scale + f.y_orig
    coords = np.empty(len(xs) * stride, np.float64)
    coords[0::stride] = xs
    coords[1::stride] = ys
    if stride == 3:
        m_idx = _ragged_index(d_start + 2 * npts, npts)
        dm = sval[m_idx] if len(m_idx) else np.zeros(0, np.int64)
        coords[2::stride] = running(dm) / f.m_scale + f.m_orig

    # whole-batch arrays (rows not decoded: null, empty children)
    full_parts = np.zeros(n, np.int64)
    full_pts = np.zeros(n, np.int64)
    full_parts[rows] = nparts
    full_pts[rows] = npts
    ok_rows = np.zeros(n, bool)
    ok_rows[rows] = ~bad
    bad_full = np.zeros(n, bool)
    bad_full[rows] = bad
    bad_full |= valid & (blen <= 0)
    bbox = np.zeros((4, n))
    xmin = q[0] / f.xy_scale + f.x_orig
    ymin = q[1] / f.xy_scale + f.y_orig
    xmax = q[2] / f.xy_scale + xmin
    ymax = q[3] / f.xy_scale + ymin
    for j, v in enumerate((xmin, ymin, xmax, ymax)):
        bbox[j][rows] = np.where(empty | bad, 0.0, v)
    # drop parts/coords of rows found bad after their counts were taken
    keep_part = np.repeat(~bad, nparts)
    keep_vert = np.repeat(~bad, npts * stride)
    xy_num = xy_num[keep_part]
    coords = coords[keep_vert]
    full_parts[rows] = np.where(bad, 0, nparts)
    full_pts[rows] = np.where(bad, 0, npts)
    vmask = ~ok_rows
    num_arr = pa.ListArray.from_arrays(pa.array(_offsets(full_parts).astype(np.int32)),
                                       pa.array(xy_num.astype(np.int32), pa.int32()))
    arr_arr = pa.ListArray.from_arrays(pa.array(_offsets(full_pts * stride).astype(np.int32)),
                                       pa.array(coords, pa.float64()))
    num_t = pa.list_(pa.field("element", pa.int32(), nullable=False))
    arr_t = pa.list_(pa.field("element", pa.float64(), nullable=False))
    fields = [pa.field(c, pa.float64(), nullable=False) for c in ("xmin", "ymin", "xmax", "ymax")]
    fields += [pa.field("xyNum", num_t, nullable=False), pa.field("xyArr", arr_t, nullable=False)]
    children = [pa.array(bbox[j], pa.float64()) for j in range(4)]
    children += [num_arr.cast(num_t), arr_arr.cast(arr_t)]
    out = pa.StructArray.from_arrays(children, fields=fields,
                                     mask=pa.array(vmask) if vmask.any() else None)
    return out, bad_full & valid


def decode_shape(buf, bstart, blen, valid, f: FieldDesc):
    if f.kind in ("point", "pointM", "pointZ", "pointZM"):
        return decode_points(buf, bstart, blen, valid, f)
    if f.kind in ("polyline", "polylineM", "polygon"):
        return decode_polys(buf, bstart, blen, valid, f)
    return binary_array(buf, bstart, blen, valid, string=False), np.zeros(len(bstart), bool)


# ------------------------------------------------------------------- rows

def decode_rows(buf: np.ndarray, buf_len: int, row_pos: np.ndarray, oids: np.ndarray,
                fields: list[FieldDesc], wanted: list[int], room: np.ndarray | None = None,
                why: np.ndarray | None = None):
    """Decode rows starting (at their length field) at ``row_pos`` of ``buf``.

    Returns ``(arrays for the wanted field indices, malformed mask)``.
    Malformed rows (bad length, overrun, undecodable value) come back with
    every column null; the caller applies the read mode.  ``room``: the most
    bytes that each row can have.  ``why``: takes the place in ``REASONS`` of each
    row's first fault (geometries are looked at only where they are wanted).
    """
    n = len(row_pos)
    rl = fixed_at(buf, row_pos, "<i4").astype(np.int64) if n else \
        np.zeros(0, np.int64)
    p0 = row_pos + 4
    bad = (rl <= 0) | (p0 + rl > buf_len)
    if room is not None:
        bad |= rl > room
    why = np.zeros(n, np.int8) if why is None else why
    why[bad] = 1
    row_end = p0 + np.maximum(rl, 0)
    n_nullable = sum(1 for f in fields if f.nullable)
    cur = p0 + (n_nullable + 7) // 8
    bit = 0
    poisoned = np.zeros(n, bool)       # a non-null raster: later bytes unknown
    values: dict[int, tuple] = {}
    wanted_set = set(wanted)
    for i, f in enumerate(fields):
        if f.nullable:
            isnull = ((buf[p0 + (bit >> 3)] >> (bit & 7)) & 1).astype(bool)
            bit += 1
        else:
            isnull = np.zeros(n, bool)
        present = ~isnull & ~bad & ~poisoned
        t = f.type_code
        want = i in wanted_set
        if t == OID:
            if want:
                values[i] = ("oid", ~bad)
            continue
        if t == RASTER:
            poisoned |= present
            bad |= present      # its length is not known: neither are the later fields
            if want:
                values[i] = ("null",)
            continue
        if t in (INT16, INT32, FLOAT32, FLOAT64, DATETIME, UUID, GUID):
            w = {INT16: 2, INT32: 4, FLOAT32: 4, FLOAT64: 8, DATETIME: 8}.get(t, 16)
            if want:
                values[i] = ("fixed", cur.copy(), present.copy(), w)
            cur = np.where(present, cur + w, cur)
        else:   # varuint length + bytes: STRING, XML, BINARY, SHAPE
            ln, nb, vbad = read_varuint(buf, cur, 5)
            vbad &= present
            bad |= vbad
            present &= ~vbad
            ln = ln.astype(np.int64)
            start = cur + nb
            if want:
                values[i] = ("var", start.copy(), ln.copy(), present.copy())
            cur = np.where(present, start + ln, cur)
        over = present & (cur > row_end)
        bad |= over
    bad |= ~bad & (cur > row_end)

    why[bad & (why == 0)] = 3
    why[poisoned] = 2
    out = []
    shape_bad = np.zeros(n, bool)
    for i in wanted:
        f = fields[i]
        spec = values.get(i, ("null",))
        kind = spec[0]
        if kind == "oid":
            v = ~bad
            out.append(pa.array(oids.astype(np.int32), pa.int32(), mask=~v if not v.all() else None))
            continue
        if kind == "null":
            out.append(pa.nulls(n, _arrow_type(f)))
            continue
        if kind == "fixed":
            _, pos, present, w = spec
            v = present & ~bad & ~poisoned_before(i, fields, poisoned)
            t = f.type_code
            if t in (UUID, GUID):
                out.append(guid_array(buf, pos, v))
                continue
            dt = {INT16: "<i2", INT32: "<i4", FLOAT32: "<f4", FLOAT64: "<f8", DATETIME: "<f8"}[t]
            vals = fixed_at(buf, pos, dt)
            if t == DATETIME:
                us = np.where(v, datetime_millis(vals), 0) * 1000
                arr = pa.Array.from_buffers(pa.timestamp("us", tz="UTC"), n,
                                            [_validity(v), pa.py_buffer(us.tobytes())])
            else:
                arr = pa.Array.from_buffers(_arrow_type(f), n,
                                            [_validity(v), pa.py_buffer(vals.tobytes())])
            out.append(arr)
            continue
        _, start, ln, present = spec
        v = present & ~bad & ~poisoned_before(i, fields, poisoned)
        if f.type_code == SHAPE:
            arr, sbad = decode_shape(buf, start, ln, v, f)
            shape_bad |= sbad
            out.append(arr)
        else:
            out.append(binary_array(buf, start, ln, v, string=f.type_code in (STRING, XML)))
    why[shape_bad & (why == 0)] = 4
    return out, bad | shape_bad


def poisoned_before(i: int, fields: list[FieldDesc], poisoned: np.ndarray) -> np.ndarray:
    """Rows where a non-null raster precedes field ``i``."""
    if not poisoned.any():
        return np.zeros(len(poisoned), bool)
    if any(f.type_code == RASTER for f in fields[:i]):
        return poisoned
    return np.zeros(len(poisoned), bool)


def _arrow_type(f: FieldDesc) -> pa.DataType:
    t = f.type_code
    return {INT16: pa.int16(), INT32: pa.int32(), OID: pa.int32(), FLOAT32: pa.float32(),
            FLOAT64: pa.float64(), STRING: pa.string(), XML: pa.string(), UUID: pa.string(),
            GUID: pa.string(), DATETIME: pa.timestamp("us", tz="UTC"), BINARY: pa.binary(),
            RASTER: pa.binary()}.get(t, pa.binary())


def null_rows(arrays: list[pa.Array], bad: np.ndarray) -> list[pa.Array]:
    """Null every column of the malformed rows."""
    if not bad.any():
        return arrays
    mask = pa.array(bad)

    def nulled(a):
        if pa.types.is_struct(a.type):      # its children, never null, stay as they are
            return pa.StructArray.from_arrays([a.field(k) for k in range(a.type.num_fields)], fields=list(a.type),
                                              mask=pa.compute.or_(mask, a.is_null()))
        return pa.compute.if_else(mask, pa.nulls(len(a), a.type), a)
    return [nulled(a) for a in arrays]
