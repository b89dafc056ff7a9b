"""The ``filegdb`` batch data source.

``spark.read.format("filegdb").option("path", gdb).option("name", table).load()``

Driver (planning): resolve the table name through the catalog table, parse
the header into a schema with field metadata, split the slot range into
partitions.  Executors: read the offsets of a slot range in one request,
fetch row bytes in large coalesced reads, decode them column by column into
Arrow record batches.  Everything above the scan is ordinary Catalyst.

Options (case-insensitive):

``path``            geodatabase folder (local path or any pyarrow filesystem URI)
``name``            table name as listed in the catalog (case-sensitive), or
``table``           the table's file name, e.g. ``a00000009`` (skips the lookup)
``numPartitions``   number of slot ranges; default: 8, raised so no range
                    covers more than ``bytesPerPartition`` (default 128 MiB)
                    of the table file
``mode``            PERMISSIVE (malformed rows -> all nulls), DROPMALFORMED,
                    FAILFAST
``corruptColumn``   name of a string column, the last one, that says why a row is
                    malformed: ``row length`` (not positive, or beyond the next
                    row or the file), ``field value``, ``raster value``,
                    ``geometry``; null in sound rows.  With ``columns`` it comes
                    where it is named, and what is wrong with a geometry shows
                    only where that geometry is read
``startRow``        first slot (0-based) and
``numRows``         number of slots to read (slots, not live rows)
``batchRows``       slots decoded per Arrow batch (default 65536)
``columns``         comma-separated fields to decode (explicit column pruning;
                    Spark does not prune columns of Python sources)
``rawShapes``       ``true``: shape columns come back as the stored blobs
                    (binary; decode later with ``operators.shapes``)
``pushdown``        ``true``: accept OBJECTID comparisons as slot ranges
                    (needs ``spark.sql.python.filterPushdown.enabled``)
"""

from __future__ import annotations

import bisect
import logging
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, LessThan,
                                    LessThanOrEqual)
from pyspark.sql.types import StringType, StructField, StructType

from geoframe.sources import decode as D
from geoframe.sources import layout as L
from geoframe.sources.layout import read_at

DEFAULT_PARTITIONS = 8
BYTES_PER_PARTITION = 128 << 20
BATCH_ROWS = 65536
BATCH_BYTES = 64 << 20      # bound on row bytes decoded at once
READ_GAP = 1 << 20          # join row reads whose gap is below this
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


class MalformedRowError(RuntimeError):
    pass


@dataclass
class SlotRange(InputPartition):
    table: str
    ranges: list          # [(start, stop), ...] half-open slot ranges


def _opt(options, key, default=None):
    for k, v in options.items():
        if k.lower() == key.lower():
            return v
    return default


def _merge(intervals):
    """Sorted, merged half-open intervals."""
    out = []
    for s, e in sorted(intervals):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _slot_ranges(idx: L.IndexHeader, lo: int, hi: int, nparts: int):
    """Contiguous slot ranges covering [lo, hi).  Without a block map: equal
    slot counts, ``ceil(slots / nparts)`` each.  With one: equal numbers of
    *stored* 1024-slot blocks, so absent blocks do not unbalance the tasks."""
    if idx.block_map is None or not idx.block_map.any():
        per = math.ceil((hi - lo) / nparts)
        for i in range(nparts):
            a, b = lo + i * per, min(lo + (i + 1) * per, hi)
            if a < b:
                yield a, b
        return
    first_blk, last_blk = lo // 1024, (hi - 1) // 1024
    stored = np.flatnonzero(idx.block_map[first_blk:last_blk + 1]) + first_blk
    if len(stored) == 0:
        return
    per = math.ceil(len(stored) / nparts)
    prev_end = lo
    for i in range(0, len(stored), per):
        grp = stored[i:i + per]
        a = prev_end
        b = hi if i + per >= len(stored) else int(grp[-1] + 1) * 1024
        b = min(b, hi)
        if a < b:
            yield a, b
        prev_end = b


def _bool(v) -> bool:
    return str(v).strip().lower() in ("1", "true", "yes", "on")


# ----------------------------------------------------------- name lookup

def catalog_rows(path: str) -> list[tuple[int, str]]:
    """(ID, Name) of every catalog entry, in slot order (driver side: the
    catalog holds one short row per table)."""
    hdr = L.read_table_header(path, L.CATALOG_TABLE)
    names = [f.name for f in hdr.fields]
    if "Name" not in names:
        raise L.GDBFormatError("catalog table has no Name field")
    want = [names.index("Name")]
    id_idx = names.index("ID") if "ID" in names else None
    if id_idx is not None:
        want.append(id_idx)
    out = []
    for batch in _scan(path, hdr, want, [(0, None)], "FAILFAST", BATCH_ROWS, with_oid=True):
        name_col = batch.column(0).to_pylist()
        ids = batch.column(1).to_pylist() if id_idx is not None else batch.column(-1).to_pylist()
        out += [(i, n) for i, n in zip(ids, name_col)]
    return out


def resolve_table(path: str, name: str) -> str | None:
    """File name of the first catalog entry named exactly ``name``."""
    for tid, tname in catalog_rows(path):
        if tname is not None and tid is not None and tname == name:
            return L.hex_name(tid)
    return None


# ------------------------------------------------------------------ scan

def _room(offsets: np.ndarray, known: np.ndarray, file_size: int) -> np.ndarray:
    """The most bytes that each row can have behind its length field: up to the next
    row among ``known`` (sorted offsets), else up to the end of the file."""
    at = np.searchsorted(known, offsets, side="right")
    stop = np.append(known, file_size)[at].astype(np.int64)
    return np.maximum(np.minimum(stop, file_size) - offsets.astype(np.int64) - 4, 0)


def _read_rows(fh, offsets: np.ndarray, file_size: int, room: np.ndarray):
    """Fetch the rows at ``offsets`` (any order) with coalesced reads; of a row
    that claims more than its ``room`` nothing but the length is fetched for its
    sake.  Returns (buffer, length of real data, row positions in the buffer)."""
    n = len(offsets)
    if n == 0:
        return np.zeros(D.PAD, np.uint8), 0, np.zeros(0, np.int64)
    order = np.argsort(offsets, kind="stable")
    so = offsets[order].astype(np.int64)
    gaps = np.diff(so) > READ_GAP
    cuts = np.concatenate([[0], np.flatnonzero(gaps) + 1, [n]])
    pieces, pos_sorted, base = [], np.zeros(n, np.int64), 0
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, last = int(so[a]), int(so[b - 1])
        chunk = read_at(fh, min(last + 4, file_size) - lo, lo)
        tail = 0
        if len(chunk) >= last - lo + 4:
            tail = max(int.from_bytes(chunk[last - lo:last - lo + 4], "little", signed=True), 0)
            tail = tail if tail <= room[order[b - 1]] else 0
        pieces.append(chunk)
        if tail:
            pieces.append(read_at(fh, tail, last + 4))
        pos_sorted[a:b] = base + (so[a:b] - lo)
        base += len(chunk) + tail
    # one copy of the pieces into a zero-padded buffer
    buf = np.zeros(base + D.PAD, np.uint8)
    at = 0
    for piece in pieces:
        buf[at:at + len(piece)] = np.frombuffer(piece, np.uint8)
        at += len(piece)
    pos = np.empty(n, np.int64)
    pos[order] = pos_sorted
    return buf, at, pos


def _scan(path: str, hdr: L.TableHeader, wanted: list[int], ranges, mode: str,
          batch_rows: int, with_oid: bool = False, names: list[str] | None = None):
    """Yield Arrow record batches of the wanted fields (-1: why a row is malformed)
    for the slot ranges."""
    fs, p = L.filesystem(path)
    tpath, xpath = L.table_paths(p, hdr.table)
    idx = L.read_index_header(path, hdr.table)
    names = names or [hdr.fields[i].name for i in wanted]
    with fs.open_input_file(tpath) as fh, fs.open_input_file(xpath) as xh:
        size = fh.size()
        for start, stop in ranges:
            stop = idx.num_slots if stop is None else min(stop, idx.num_slots)
            for s0 in range(max(start, 0), stop, batch_rows):
                end = min(s0 + batch_rows, stop)
                slots = np.arange(s0, min(end + NEXT_SLOTS, idx.num_slots), dtype=np.int64)
                offs = L.read_offsets(xh, idx, slots)
                live = offs != 0
                slots, offs = slots[live], offs[live]
                known = np.sort(offs)
                slots, offs = slots[slots < end], offs[slots < end]
                for sl, of in _byte_bounded(slots, offs, size):
                    yield from _decode_chunk(fh, size, sl, of, hdr, wanted, names, mode,
                                             with_oid, known)


NEXT_SLOTS = 64           # index entries read beyond a batch: where its last rows must end
OFFSET_SAMPLES = 256      # index entries that the driver reads to balance tasks by bytes


def _byte_bounded(slots, offs, file_size):
    """Split a slot batch so that no chunk spans more than BATCH_BYTES of
    row data (row sizes estimated from the gaps between sorted offsets)."""
    if len(slots) == 0:
        return
    order = np.argsort(offs, kind="stable")
    so = offs[order].astype(np.int64)
    est = np.empty(len(so), np.int64)
    est[:-1] = np.diff(so)
    est[-1] = max(min(file_size - int(so[-1]), BATCH_BYTES), 0)
    size = np.empty(len(so), np.int64)
    size[order] = est
    cum = np.cumsum(size)
    if cum[-1] <= BATCH_BYTES:
        yield slots, offs
        return
    chunk = cum // BATCH_BYTES
    cuts = np.flatnonzero(np.diff(chunk)) + 1
    for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(slots)]])):
        yield slots[a:b], offs[a:b]


def _decode_chunk(fh, size, slots, offs, hdr, wanted, names, mode, with_oid, known=None):
    """Read and decode the rows of one chunk; apply the read mode.  ``known``: sorted
    offsets of rows, by which the rows' lengths are checked (default: the chunk's)."""
    room = _room(offs, np.sort(offs) if known is None else known, size)
    buf, real, pos = _read_rows(fh, offs, size, room)
    oids = slots + 1
    why = np.zeros(len(slots), np.int8)
    arrays, bad = D.decode_rows(buf, real, pos, oids, hdr.fields, [i for i in wanted if i >= 0], room, why)
    cols, out_names = D.null_rows(arrays, bad), list(names)
    if -1 in wanted:
        cols.insert(wanted.index(-1), pa.array([D.REASONS[k] for k in why], pa.string()))
    if with_oid:
        cols.append(pa.array(oids.astype(np.int32)))
        out_names.append("__oid")
    if bad.any():
        if mode == "FAILFAST":
            first = int(np.flatnonzero(bad)[0])
            raise MalformedRowError(f"{hdr.table}: malformed row at OBJECTID {int(oids[first])} "
                                    f"({D.REASONS[why[first]]})")
        if mode == "DROPMALFORMED":
            keep = pa.array(~bad)
            cols = [a.filter(keep) for a in cols]
    if cols and len(cols[0]):
        yield pa.RecordBatch.from_arrays(cols, names=out_names)


def _byte_ranges(path: str, hdr: L.TableHeader, idx: L.IndexHeader, lo: int, hi: int, nparts: int):
    """Slot ranges of about equal bytes: the offsets of ``OFFSET_SAMPLES`` live slots
    give the bytes before each, and cuts are placed between them.  None where offsets
    do not follow the slots (rows were rewritten): slots are then all there is."""
    fs, p = L.filesystem(path)
    slots = np.unique(np.linspace(lo, hi - 1, OFFSET_SAMPLES).astype(np.int64))
    with fs.open_input_file(L.table_paths(p, hdr.table)[1]) as xh:
        offs = np.array([int(L.read_offsets(xh, idx, slots[i:i + 1])[0]) for i in range(len(slots))])
    slots, offs = slots[offs > 0], offs[offs > 0]
    if len(slots) < 2 or (np.diff(offs) <= 0).any():
        return None
    end = hdr.file_size if hi >= idx.num_slots else offs[-1] + (offs[-1] - offs[-2]) // max(slots[-1] - slots[-2], 1)
    at = np.interp(np.linspace(offs[0], max(end, offs[-1] + 1), nparts + 1),
                   np.append(offs, max(end, offs[-1] + 1)), np.append(slots, hi)).astype(np.int64)
    at[0], at[-1] = lo, hi
    return [(int(a), int(b)) for a, b in zip(at[:-1], at[1:]) if b > a]


# ---------------------------------------------------------------- source

class FileGDBDataSource(DataSource):
    """``format("filegdb")``: one table of a File Geodatabase."""

    @classmethod
    def name(cls):
        return "filegdb"

    def __init__(self, options):
        super().__init__(options)
        self._header = None
        self._resolved = False

    # driver side ---------------------------------------------------------
    def _options(self):
        path = _opt(self.options, "path")
        if not path:
            raise ValueError("filegdb: option 'path' is required")
        name = _opt(self.options, "name")
        table = _opt(self.options, "table")
        if not name and not table:
            raise ValueError("filegdb: option 'name' is required")
        return path, name, table

    def header(self) -> L.TableHeader | None:
        if not self._resolved:
            path, name, table = self._options()
            if not table:
                table = resolve_table(path, name)
            if table and not L.exists(path, table):
                raise FileNotFoundError(f"filegdb: the file of table {name or table} is missing in {path}")
            if not table:
                logging.getLogger(__name__).warning("filegdb: no table %s in %s: empty result", name, path)
            self._header = L.read_table_header(path, table) if table else None
            if self._header and _bool(_opt(self.options, "rawShapes", "false")):
                for f in self._header.fields:
                    if f.type_code == L.SHAPE and f.kind != "unsupported":
                        f.extra["sourceGeometryType"] = f.kind
                        f.kind = "unsupported"
            self._resolved = True
        return self._header

    def schema(self):
        hdr = self.header()
        if not hdr:
            return StructType([])
        full = hdr.schema()
        cols = _opt(self.options, "columns")
        corrupt = _opt(self.options, "corruptColumn")
        if corrupt:
            if corrupt.lower() in (f.name.lower() for f in full.fields):
                raise ValueError(f"filegdb: corruptColumn {corrupt} is a column of table {hdr.table}")
            full = StructType([*full.fields, StructField(corrupt, StringType())])
        if not cols:
            return full
        # explicit column pruning: only these fields are decoded
        by_name = {f.name.lower(): f for f in full.fields}
        out = []
        for c in (x.strip() for x in cols.split(",")):
            if c.lower() not in by_name:
                raise ValueError(f"filegdb: column {c} is not in table {hdr.table}")
            out.append(by_name[c.lower()])
        return StructType(out)

    def reader(self, schema):
        hdr = self.header()
        pushdown = _bool(_opt(self.options, "pushdown", "false"))
        cls = FileGDBPushdownReader if pushdown else FileGDBReader
        return cls(dict(self.options), hdr, schema)


class FileGDBReader(DataSourceReader):
    def __init__(self, options: dict, hdr: L.TableHeader | None, schema: StructType):
        self.path = _opt(options, "path")
        self.hdr = hdr
        self.mode = str(_opt(options, "mode", "PERMISSIVE")).upper()
        if self.mode not in MODES:
            raise ValueError(f"filegdb: mode must be one of {MODES}")
        self.batch_rows = int(_opt(options, "batchRows", BATCH_ROWS))
        self.num_partitions = _opt(options, "numPartitions")
        self.bytes_per_part = max(int(_opt(options, "bytesPerPartition", BYTES_PER_PARTITION)), 1)
        self.start_row = int(_opt(options, "startRow", 0))
        n = int(_opt(options, "numRows", -1))
        self.num_rows = None if n < 0 else n
        self.balance = str(_opt(options, "balance", "slots")).lower()
        if self.balance not in ("slots", "bytes"):
            raise ValueError("filegdb: balance must be slots or bytes")
        self.corrupt = _opt(options, "corruptColumn")
        self.wanted = self._columns(schema)
        self.names = [f.name for f in schema.fields]     # as the caller spells them
        self.oid_intervals = None     # set by pushFilters

    def _columns(self, schema: StructType) -> list[int]:
        """Indices of the requested columns: the whole table, or the fields
        named by a user schema (checked against the file)."""
        if self.hdr is None:
            return []
        by_name = {f.name.lower(): i for i, f in enumerate(self.hdr.fields)}
        if self.corrupt:
            by_name[self.corrupt.lower()] = -1
        out = []
        for sf in schema.fields:
            i = by_name.get(sf.name.lower())
            if i is None:
                raise ValueError(f"filegdb: column {sf.name} is not in table {self.hdr.table}")
            have = self.hdr.fields[i].spark_type() if i >= 0 else StringType()
            if have.simpleString() != sf.dataType.simpleString():
                raise ValueError(f"filegdb: column {sf.name} is {have.simpleString()}, "
                                 f"not {sf.dataType.simpleString()}")
            out.append(i)
        return out

    def partitions(self):
        if self.hdr is None:
            return []
        idx = L.read_index_header(self.path, self.hdr.table)
        lo = max(self.start_row, 0)
        hi = idx.num_slots if self.num_rows is None else min(idx.num_slots, lo + self.num_rows)
        if hi <= lo:
            return []
        if self.num_partitions is not None:
            nparts = max(int(self.num_partitions), 1)
        else:
            nparts = max(DEFAULT_PARTITIONS, math.ceil(self.hdr.file_size / self.bytes_per_part))
        ivs = _merge(self.oid_intervals) if self.oid_intervals is not None else None
        starts = [s for s, _ in ivs] if ivs else []
        parts = []
        cuts = _byte_ranges(self.path, self.hdr, idx, lo, hi, nparts) if self.balance == "bytes" else None
        for a, b in cuts or _slot_ranges(idx, lo, hi, nparts):
            ranges = [(a, b)]
            if ivs is not None:
                j = max(bisect.bisect_right(starts, a) - 1, 0)
                ranges = []
                while j < len(ivs) and ivs[j][0] < b:
                    s, e = ivs[j]
                    if max(a, s) < min(b, e):
                        ranges.append((max(a, s), min(b, e)))
                    j += 1
            if ranges:
                parts.append(SlotRange(self.hdr.table, ranges))
        return parts

    def read(self, partition):
        if partition is None or self.hdr is None:
            return
        yield from _scan(self.path, self.hdr, self.wanted, partition.ranges, self.mode,
                         self.batch_rows, names=self.names)


class FileGDBPushdownReader(FileGDBReader):
    """Reader that turns OBJECTID comparisons into slot ranges.  Every filter
    is handed back, so Spark still evaluates it: pushdown only skips slots."""

    def pushFilters(self, filters):
        if self.hdr is not None:
            oid = self.hdr.object_id_name.lower()
            lo, hi = 0, None            # slot interval [lo, hi)
            points = None
            for f in filters:
                attr = getattr(f, "attribute", None)
                if not attr or len(attr) != 1 or attr[0].lower() != oid:
                    continue
                if getattr(f, "value", 0) is None:      # "= null" keeps no row: Spark's to say
                    continue
                if isinstance(f, EqualTo):
                    points = {int(f.value)} if points is None else points & {int(f.value)}
                elif isinstance(f, In):
                    vals = {int(v) for v in f.value if v is not None}
                    points = vals if points is None else points & vals
                elif isinstance(f, GreaterThan):
                    lo = max(lo, math.floor(f.value))
                elif isinstance(f, GreaterThanOrEqual):
                    lo = max(lo, math.ceil(f.value) - 1)
                elif isinstance(f, LessThan):
                    v = math.ceil(f.value) - 1
                    hi = v if hi is None else min(hi, v)
                elif isinstance(f, LessThanOrEqual):
                    v = math.floor(f.value)
                    hi = v if hi is None else min(hi, v)
            if points is not None:
                ivs = sorted((p - 1, p) for p in points
                             if p >= 1 and p - 1 >= lo and (hi is None or p - 1 < hi))
                self.oid_intervals = ivs
            elif lo > 0 or hi is not None:
                self.oid_intervals = [(max(lo, 0), hi if hi is not None else 2**62)]
        # hand everything back: Spark re-applies each filter
        yield from filters


def read_table(spark, path: str, name: str, num_partitions: int | None = None,
               pushdown: bool = True, **options):
    """``DataFrame`` of one table (the programmatic reader)."""
    from geoframe.session import register
    register(spark)
    r = spark.read.format("filegdb").option("path", path).option("name", name)
    if num_partitions is not None:
        r = r.option("numPartitions", str(num_partitions))
    if pushdown:
        r = r.option("pushdown", "true")
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()


def read_rdd(spark, path: str, name: str, num_partitions: int | None = None):
    """``RDD[Row]`` of one table (rows addressable by field name); the
    DataFrame reader underneath does the work."""
    return read_table(spark, path, name, num_partitions=num_partitions, pushdown=False).rdd


__all__ = ["FileGDBDataSource", "read_table", "read_rdd", "resolve_table", "catalog_rows"]
