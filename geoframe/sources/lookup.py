"""Rows of a table for many ids at once: an index join.

The ids are shuffled by range and sorted, so that a task has neighbouring slots.  It
reads the index entries of its slots (runs of them at a time), then only the rows
those point to, coalesced as in a scan.  Nothing of the table is shuffled, and the
bytes read follow from the number of ids, not from the table's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from geoframe.sources import layout as L
from geoframe.sources.filegdb import FileGDBDataSource, _byte_bounded, _decode_chunk

LOOKUP_ID = "lookup_id"
INDEX_GAP = 4096          # slots between two ids whose index entries are read together


def lookup_rows(spark: SparkSession, path: str, name: str, ids: DataFrame, id_col: str = "OBJECTID",
                columns: str | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """The rows whose object id is in column ``id_col`` of ``ids``: ``lookup_id`` and
    the table's columns (``columns``: only these, comma-separated).

    An id that repeats is read once; ids that are null, out of range, deleted or in no
    stored block have no row.  ``mode`` is the reader's: a malformed row comes out with
    its ``lookup_id`` and nulls, is dropped, or raises.  A name that the catalog does
    not list gives no rows."""
    from geoframe.session import register
    register(spark)
    options = {"path": path, "name": name, "mode": mode, **({"columns": columns} if columns else {})}
    source = FileGDBDataSource(options)
    schema = source.schema()
    out = StructType([StructField(LOOKUP_ID, LongType()), *schema.fields])
    reader = source.reader(schema)
    hdr = reader.hdr
    if hdr is None:
        return spark.createDataFrame([], out)
    index = L.read_index_header(path, hdr.table)
    target = to_arrow_schema(out)
    wanted, names, mode = reader.wanted, reader.names, reader.mode

    def run(batches):
        fs, p = L.filesystem(path)
        tpath, xpath = L.table_paths(p, hdr.table)
        with fs.open_input_file(tpath) as fh, fs.open_input_file(xpath) as xh:
            size = fh.size()
            for batch in batches:
                slots = np.asarray(batch.column(0)) - 1
                cuts = np.flatnonzero(np.diff(slots) > INDEX_GAP) + 1
                # (each id with the slot behind it, whose row bounds its own)
                near = [np.unique(np.append(part, part + 1)) for part in np.split(slots, cuts) if len(part)]
                near = [part[part < index.num_slots] for part in near]
                found = np.concatenate([L.read_offsets(xh, index, part) for part in near]) if near else slots
                known = np.sort(found[found != 0])
                asked = np.isin(np.concatenate(near), slots) if near else slots > 0
                offsets = found[asked]
                live = offsets != 0
                for s, o in _byte_bounded(slots[live], offsets[live], size):
                    for rows in _decode_chunk(fh, size, s, o, hdr, wanted, names, mode, True, known):
                        cols = [rows.column(rows.num_columns - 1), *rows.columns[:-1]]
                        yield pa.RecordBatch.from_arrays(
                            [c.cast(f.type) for c, f in zip(cols, target)], schema=target)

    keyed = (ids.select(F.col(id_col).cast("long").alias("id"))
             .where((F.col("id") >= 1) & (F.col("id") <= index.num_slots)).distinct()
             .repartitionByRange("id").sortWithinPartitions("id"))
    return keyed.mapInArrow(run, out)
