"""Components of similar sets, from buckets of candidates.

Input: rows (key, rid) - items that may be similar share a key - and for every
rid its item.  Every pair inside a bucket is checked exactly, but no pair ever
leaves its task: a bucket hands out a spanning forest of its links.  Buckets of
one item go at once, those with the same smallest member are joined, and what is
above ``BLOCK`` items is dealt into blocks whose pairs are units of work of
their own, so a hot key is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoframe.llm.common import components, materialise

BLOCK = 256
CELLS = 8_000_000        # numbers in a matrix while sets are compared


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component, from pairs of rows."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections (each set without repeats)."""
    n = len(sets)
    out = np.zeros((n, n), dtype="float32")
    if n == 2:
        out[0, 1] = out[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
        return out
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    found, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.nonzero(count > 1)[0]              # others meet nobody
    new = np.full(len(found), -1)
    new[shared] = np.arange(len(shared))
    column = new[column]
    owner, column = owner[column >= 0], column[column >= 0]
    step = max(1, CELLS // n)
    for at in range(0, len(shared), step):
        part = (column >= at) & (column < at + step)
        x = np.zeros((n, min(step, len(shared) - at)), dtype="float32")
        x[owner[part], column[part] - at] = 1
        out += x @ x.T
    return out


def multiple(batches):
    """mapInArrow over rows (key, rid, ...) sorted by these two: the first row of
    each rid, of the keys that have two rids or more."""
    carried = None                                 # one row: not known yet, or its key went on
    alone = True                                   # the carried row has not come out
    for batch in batches:
        if not batch.num_rows:
            continue
        if carried is not None:
            table = pa.Table.from_batches([carried, batch]).combine_chunks()
            batch = table.to_batches()[0]
        keys, rids = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        where = np.nonzero(np.concatenate(
            [[True], (keys[1:] != keys[:-1]) | (rids[1:] != rids[:-1])]))[0]
        keys = keys[where]
        same = keys[1:] == keys[:-1]
        out = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        if len(out) > 1:
            came = bool(out[-1])
        else:
            came = not alone
        if carried is not None and not alone:
            out[0] = False
        alone = not came
        carried = batch.slice(int(where[-1]), 1)
        yield batch.take(pa.array(where[out]))


def _compare(similar: Callable):
    """mapInArrow over rows (key, i, j, own, rid, item) sorted by the first
    three: (a, b) edges of a spanning forest per group."""
    def group(key, rows):
        _, i, j = key
        rows = sorted(set(rows), key=lambda r: r[1])
        own = np.array([r[0] for r in rows])
        rid = np.array([r[1] for r in rows])
        a, b = similar([r[2] for r in rows])
        if i != j:
            cross = own[a] != own[b]
            a, b = a[cross], b[cross]
        label = forest(len(rows), a, b)
        linked = np.nonzero(label != np.arange(len(rows)))[0]
        return rid[linked], rid[label[linked]]

    def run(batches):
        key, rows, out = None, [], []

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[k] for p in out]))
                                               for k in range(2)], names=["a", "b"])

        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for k, v in zip(zip(*cols[:3]), zip(*cols[3:])):
                if k != key:
                    if len(rows) > 1:
                        out.append(group(key, rows))
                    key, rows = k, []
                rows.append(v)
            if sum(len(p[0]) for p in out) > 50_000:
                yield batch_of()
                out = []
        if len(rows) > 1:
            out.append(group(key, rows))
        if out:
            yield batch_of()
    return run


def similar_components(buckets: DataFrame, items: DataFrame | Callable, similar: Callable, name: str) -> DataFrame:
    """``buckets``: (key long, rid long), repeats allowed.  ``items``: (rid long,
    item binary), or what makes them from the rids that are needed, (rid long); others
    may be among them; equal rids have equal items.  ``similar(list of items)`` gives
    two arrays with the places of the pairs that link (first below second).
    Result: (node, component) for every linked rid."""
    rows = materialise(buckets.select("key", "rid").repartition("key").sortWithinPartitions("key", "rid")
                       .mapInArrow(multiple, "key long, rid long"), f"{name}-buckets")
    # buckets with the same smallest member become one: items that share one
    # bucket share many, and go through only once
    pivots = rows.groupBy("key").agg(F.min("rid").alias("pivot"))
    rows = materialise(rows.join(pivots, "key").select(F.col("pivot").alias("key"), "rid").distinct(),
                       f"{name}-members")
    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(sizes, "key")
    needed = rows.select("rid").distinct()
    if not isinstance(items, DataFrame):
        needed = materialise(needed, f"{name}-needed")
        items = items(needed)
    held = materialise(items.join(needed, "rid", "left_semi").groupBy("rid").agg(F.first("item").alias("item")),
                       f"{name}-items")
    rows = (rows.withColumn("own", F.pmod(F.xxhash64("rid", "key"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    "own", "rid"))
    edges = (rows.join(held, "rid").select("key", "i", "j", "own", "rid", "item")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
             .mapInArrow(_compare(similar), "a long, b long"))
    return components(edges)
