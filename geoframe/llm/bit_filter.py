"""A set of 64-bit hashes as bits, small enough to send to all tasks.

The number of bits follows from the number of hashes (``PER_KEY`` each) up to
``2**most``; a filter that is full lets more pass and never drops a member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PER_KEY = 16
MOST = 28                 # 2**28 bits are 32 MB
SEGMENT = 18              # bits of a filter that one task sets: 2**18


def _bitmaps(bits: int):
    """mapInArrow over (segment, cell) sorted by segment: a bitmap for each."""
    size = 1 << min(bits, SEGMENT)

    def run(batches):
        segment, held = None, np.zeros(size, bool)

        def done():
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()),
                                               pa.array([np.packbits(held).tobytes()], pa.binary())],
                                              names=["segment", "bits"])
        for batch in batches:
            of, cells = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for s in np.unique(of).tolist():
                if s != segment:
                    if segment is not None:
                        yield done()
                    segment, held = s, np.zeros(size, bool)
                held[cells[of == s] & (size - 1)] = True
        if segment is not None:
            yield done()
    return run


class BitFilter:
    def __init__(self, bits: int, packed: np.ndarray):
        self.bits, self.packed = bits, packed

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each of some uint64 hashes may be a member."""
        cell = hashes >> np.uint64(64 - self.bits)
        byte = self.packed[(cell >> np.uint64(3)).astype("int64")]
        return (byte >> (np.uint64(7) - (cell & np.uint64(7))).astype("u1")) & 1 == 1


def bit_filter(keys: DataFrame, column: str, most: int = MOST) -> BitFilter:
    """The filter of the long column ``column``.  What the driver receives is the
    filter itself, ``2**most / 8`` bytes at the most, in pieces."""
    n = keys.count()
    bits = min(most, max(16, (PER_KEY * n).bit_length()))
    packed = np.zeros((1 << bits) // 8, "u1")
    if n:
        cells = keys.select(F.shiftrightunsigned(F.col(column), 64 - bits).alias("cell"))
        made = (cells.select(F.shiftright("cell", min(bits, SEGMENT)).alias("segment"), "cell")
                .repartition("segment").sortWithinPartitions("segment")
                .mapInArrow(_bitmaps(bits), "segment long, bits binary"))
        for row in made.toLocalIterator():
            part = np.frombuffer(row["bits"], "u1")
            at = row["segment"] * len(part)
            packed[at:at + len(part)] = part
    return BitFilter(bits, packed)
