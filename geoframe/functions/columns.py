"""Column-level value decoders of the geodatabase encoding.

These are the per-value rules the ``filegdb`` source applies inside its Arrow
kernels, exposed as built-in Spark expressions so they can be used on any
table of raw integers / day numbers / GUID bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from geoframe.functions.geometry import col_of

# Fixed values of the date encoding: day numbers count from 1899-12-30, which
# is day 25569 before the Unix epoch; one day has 1000*60*60*24 ms.
OLE_EPOCH_OFFSET_DAYS = 25569
MS_PER_DAY = 1000 * 60 * 60 * 24


def dequantize_point(v, scale, origin) -> Column:
    """Point ordinate: ``(v - 1) / scale + origin`` (points store v + 1)."""
    return (col_of(v).cast("double") - F.lit(1.0)) / col_of(scale) + col_of(origin)


def dequantize(v, scale, origin) -> Column:
    """Poly ordinate / bbox corner: ``v / scale + origin``."""
    return col_of(v).cast("double") / col_of(scale) + col_of(origin)


def quantize_point(x, scale, origin) -> Column:
    """Inverse of :func:`dequantize_point` on the grid (floor, then + 1)."""
    return F.floor((col_of(x) - col_of(origin)) * col_of(scale)) + F.lit(1)


def quantize(x, scale, origin) -> Column:
    return F.floor((col_of(x) - col_of(origin)) * col_of(scale))


def bbox_decode(xmin_q, ymin_q, xext_q, yext_q, scale, x_orig, y_orig) -> Column:
    """Bounding box: the min corner is absolute, the max corner is stored as
    an extent added to the decoded min corner."""
    xmin = dequantize(xmin_q, scale, x_orig)
    ymin = dequantize(ymin_q, scale, y_orig)
    xmax = col_of(xext_q).cast("double") / col_of(scale) + xmin
    ymax = col_of(yext_q).cast("double") / col_of(scale) + ymin
    return F.struct(xmin.alias("xmin"), ymin.alias("ymin"),
                    xmax.alias("xmax"), ymax.alias("ymax"))


def ole_days_millis(days) -> Column:
    """Epoch milliseconds of a day number: ``ceil((d - 25569)*1000*60*60*24)``
    evaluated left to right, as the format's readers do."""
    d = col_of(days).cast("double")
    return F.ceil((d - F.lit(OLE_EPOCH_OFFSET_DAYS)) * F.lit(1000) * F.lit(60)
                  * F.lit(60) * F.lit(24))


def ole_days_to_timestamp(days) -> Column:
    return F.timestamp_millis(ole_days_millis(days))


def timestamp_to_ole_days(ts) -> Column:
    """Day number (float64) of a timestamp: ``micros / 86400e6 + 25569``."""
    return F.unix_micros(col_of(ts).cast("timestamp")).cast("double") / F.lit(86400000000.0) \
        + F.lit(float(OLE_EPOCH_OFFSET_DAYS))


# Fixed value: byte order of the GUID text form (bytes 3,2,1,0 - 5,4 - 7,6 -
# 8,9 - 10..15), upper-case hex, in braces.
GUID_GROUPS = ((3, 2, 1, 0), (5, 4), (7, 6), (8, 9), (10, 11, 12, 13, 14, 15))


def guid_text(b16) -> Column:
    """16 GUID bytes -> ``{XXXXXXXX-XXXX-XXXX-XXXX-XXXXXXXXXXXX}``."""
    h = F.hex(col_of(b16))
    groups = [F.concat(*[F.substring(h, 2 * i + 1, 2) for i in g]) for g in GUID_GROUPS]
    return F.when(F.length(col_of(b16)) == 16,
                  F.concat(F.lit("{"), F.concat_ws("-", *groups), F.lit("}")))


def complete_part_counts(num_points, leading_counts) -> Column:
    """Part sizes from the stored ``numParts - 1`` leading counts: the last
    part holds whatever vertices remain."""
    lead = col_of(leading_counts).cast("array<int>")
    rest = col_of(num_points).cast("int") - F.aggregate(lead, F.lit(0), lambda a, b: a + b)
    return F.concat(lead, F.array(rest))


@F.arrow_udf(ArrayType(LongType()))
def _list_prefix_sum(arr: pa.Array) -> pa.Array:
    """Running sum inside each list (Arrow-batched, one numpy pass)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(arr)
    vals = pc.fill_null(flat, 0).cast(pa.int64()).to_numpy(zero_copy_only=False)
    total = np.cumsum(vals, dtype=np.int64)
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    starts = offsets[:-1]
    carry = np.where(starts > 0, total[np.maximum(starts - 1, 0)] if len(total) else 0, 0)
    out = total - np.repeat(carry, lengths)
    mask = arr.is_null().to_numpy(zero_copy_only=False)
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(out, pa.int64()),
                                         mask=pa.array(mask)).cast(pa.list_(pa.int64()))


def delta_encode_array(values) -> Column:
    """Integer array -> deltas (first value kept): ``v[i] - v[i-1]``, linear
    (``zip_with`` against the array shifted by one)."""
    v = col_of(values).cast("array<bigint>")
    n = F.size(v)
    prev = F.concat(F.array(F.lit(0).cast("bigint")), F.slice(v, 1, F.greatest(n - 1, F.lit(0))))
    return F.when(n > 0, F.zip_with(v, prev, lambda a, b: a - b)) \
        .otherwise(F.array().cast("array<bigint>"))


def delta_decode_array(deltas, scale=1.0, origin=0.0) -> Column:
    """Delta-coded integer array -> ordinates: running sum (exact, int64),
    then one division: ``cumsum(d)[i] / scale + origin``."""
    from pyspark.sql import SparkSession

    from geoframe.session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)          # the Arrow UDF lives in this package
    cum = _list_prefix_sum(col_of(deltas).cast("array<bigint>"))
    return F.transform(cum, lambda v: v.cast("double") / col_of(scale) + col_of(origin))
