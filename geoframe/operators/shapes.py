"""Decode raw shape blobs of any table into geometry structs.

The same Arrow kernel the ``filegdb`` source uses, run with ``mapInArrow``
over a column of blobs (for example a table read with ``rawShapes=true``, or
blobs stored elsewhere): one pass per batch, no per-row Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from geoframe.sources import decode as D
from geoframe.sources.layout import SHAPE, FieldDesc


def shape_params(df: DataFrame, col: str, kind: str | None = None) -> FieldDesc:
    """Decoding parameters of a shape column from its field metadata
    (``rawShapes=true`` keeps origins and scales there)."""
    md = dict(df.schema[col].metadata or {})
    f = FieldDesc(col, md.get("alias", col), SHAPE, True)
    f.kind = kind or md.get("sourceGeometryType") or md.get("geometryType")
    for attr, key in (("x_orig", "xorigin"), ("y_orig", "yorigin"), ("xy_scale", "xyscale"),
                      ("z_orig", "zorigin"), ("z_scale", "zscale"), ("m_orig", "morigin"),
                      ("m_scale", "mscale")):
        if key in md:
            setattr(f, attr, float(md[key]))
    return f


def decode_shapes(df: DataFrame, col: str, params: FieldDesc, out_col: str | None = None,
                  mode: str = "PERMISSIVE") -> DataFrame:
    """Replace (or add as ``out_col``) the blob column ``col`` by decoded
    geometry structs; malformed blobs give null (or fail with FAILFAST)."""
    from geoframe.session import ship_package
    ship_package(df.sparkSession)
    out_col = out_col or col
    geom_type = params.spark_type()
    out_fields = []
    for f in df.schema.fields:
        if f.name == col and out_col == col:
            out_fields.append(StructField(col, geom_type, True))
        elif f.name != out_col:
            out_fields.append(f)
    if out_col != col:
        out_fields.append(StructField(out_col, geom_type, True))
    schema = StructType(out_fields)

    def run(batches):
        for b in batches:
            blobs = b.column(col).cast(pa.large_binary())
            n = len(blobs)
            valid = blobs.is_valid().to_numpy(zero_copy_only=False)
            offs = np.frombuffer(blobs.buffers()[1], np.int64)[blobs.offset:blobs.offset + n + 1]
            data = blobs.buffers()[2]
            raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            buf = np.concatenate([raw, np.zeros(D.PAD, np.uint8)])
            starts = offs[:-1].astype(np.int64)
            lens = np.diff(offs).astype(np.int64)
            arr, bad = D.decode_shape(buf, starts, lens, valid, params)
            if bad.any() and mode == "FAILFAST":
                raise ValueError(f"malformed shape blob in column {col}")
            cols, names = [], []
            for f in schema.fields:
                if f.name == out_col:
                    cols.append(arr)
                else:
                    cols.append(b.column(f.name))
                names.append(f.name)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.mapInArrow(run, schema)
