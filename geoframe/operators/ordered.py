"""Ordered scans per group that stay balanced when one group is huge.

``sum(v) OVER (PARTITION BY g ORDER BY o)`` puts a whole group into one task,
and a single group may hold a third of all rows.  Here:

1. rows are range-partitioned on ``(g, o)`` and sorted inside each range
   (Spark samples the composite key, so a hot group spans many ranges); the
   range number is pinned with a reliable ``checkpoint()`` so every later
   pass sees the same ranges;
2. one narrow pass over each sorted range (no shuffle) yields a single edge
   row: its first and last group key, the last group's partial sum and the
   range's last value - one row per range, whatever the number of groups;
3. the carry into each range (the running total of its first group over
   the earlier ranges, or the previous row for ``lag``) is derived from those
   edge rows - a table bounded by the number of ranges;
4. a final pass adds the carry inside each range.  By default it runs over
   the checkpointed, already sorted ranges (``mapInArrow``: a numpy cumsum
   per batch, no further shuffle); ``finish="window"`` instead joins the
   carries and uses a Spark window per (range, group) (one more shuffle).

No task ever sees more than one range and no group is collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StructField, StructType)

from geoframe.session import checkpoint_dir

RANGE_COL = "_gf_range"


TARGET_RANGE_BYTES = 128 << 20
LONG = 64                 # rows of a group whose floats are summed on their own
SAMPLE = 32               # rows sampled for each bucket of running ids


def _num_ranges(df: DataFrame, num_ranges: int | None) -> int:
    """Explicit count, else enough ranges for ~128 MiB each by the
    optimizer's size estimate, never fewer than the shuffle partitions (which
    are all there is to go by when the size is unknown)."""
    if num_ranges:
        return int(num_ranges)
    base = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size <= 0 or size >= 1 << 62:    # unknown size
        return base
    return max(base, -(-size // TARGET_RANGE_BYTES))


def _sort_keys(group_cols, order_cols):
    return [F.col(c).asc_nulls_first() for c in group_cols + order_cols]


def ranged(df: DataFrame, group_cols: list[str], order_cols: list[str],
           num_ranges: int | None = None) -> DataFrame:
    """Range-partition and sort on (group, order), tag each row with its
    range number, and checkpoint to the shared checkpoint folder."""
    from geoframe.session import ship_package
    ship_package(df.sparkSession)      # the final pass runs geoframe code in workers
    checkpoint_dir(df.sparkSession)
    keys = _sort_keys(group_cols, order_cols)
    # rows that tie on group and order are told apart by their other values, so
    # that many of them (equal timestamps, say) can still span ranges
    rest = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    keys.append(F.xxhash64(*rest))
    out = (df.repartitionByRange(_num_ranges(df, num_ranges), *keys)
           .sortWithinPartitions(*keys)
           .withColumn(RANGE_COL, F.spark_partition_id()))
    return out.checkpoint(eager=True)


def _differences(col: pa.Array, before, starts: np.ndarray, dtype):
    """Values less the one before them in their group (0 where there is none),
    and where they are; ``before`` is the value before the first row, or None."""
    vals = pc.fill_null(col, 0).to_numpy(zero_copy_only=False).astype(dtype)
    valid = pc.is_valid(col).to_numpy(zero_copy_only=False)
    prev = np.zeros(len(vals), dtype)
    prev[1:] = np.where(starts[1:], 0, vals[:-1])      # a null counts as 0
    if before is not None and len(prev):
        prev[0] = before
    return np.where(valid, vals - prev, 0), valid


def _edges(data: DataFrame, group_cols: list[str], tmp: dict[str, str],
           sum_types: dict[str, object], summed: set[str], diffed: set[str]) -> list:
    """One row per range, from one narrow pass over the sorted ranges (no
    shuffle): the range's first and last group key, the sum of the last
    group's values (or differences) inside the range, and the range's first and
    last value.  A range's first difference is taken as if nothing were before it;
    the carry corrects it.  The result is bounded by the number of ranges."""
    by_name = {f.name: f for f in data.schema.fields}
    fields = [StructField(RANGE_COL, IntegerType(), True)]
    fields += [StructField("f_" + g, by_name[g].dataType, True) for g in group_cols]
    fields += [StructField("l_" + g, by_name[g].dataType, True) for g in group_cols]
    fields += [StructField("s_" + t, sum_types[k], True) for k, t in tmp.items()]
    fields += [StructField("v_" + t, by_name[t].dataType, True) for t in tmp.values()]
    fields += [StructField("h_" + t, by_name[t].dataType, True) for t in tmp.values()]
    schema = StructType(fields)
    sum_arrow = {k: pa.int64() if isinstance(sum_types[k], LongType) else pa.float64()
                 for k in tmp}

    def run(batches):
        rng, head, tail, open_key = None, None, None, None
        acc = {k: None for k in tmp}
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            if rng is None:
                rng = b.column(RANGE_COL)[0].as_py()
                head = b.slice(0, 1)
            starts = _group_starts(b, group_cols)
            cont = _same_key(open_key, _key_at(b, group_cols, 0))
            last_start = int(np.flatnonzero(starts)[-1])
            for k, t in tmp.items():
                if k in diffed:
                    dtype = sum_arrow[k].to_pandas_dtype()
                    before = tail.column(t)[0].as_py() if cont else None
                    vals, valid = _differences(b.column(t), before, starts, dtype)
                    seg = _sum(vals[last_start:][valid[last_start:]])
                elif k in summed:
                    seg = pc.sum(b.column(t).slice(last_start).cast(sum_arrow[k])).as_py()
                else:
                    continue
                acc[k] = _add(acc[k], seg) if (last_start == 0 and cont) else seg
            open_key = _key_at(b, group_cols, n - 1)
            tail = b.slice(n - 1, 1)
        if rng is None:
            return
        cols = [pa.array([rng], pa.int32())]
        cols += [head.column(g) for g in group_cols] + [tail.column(g) for g in group_cols]
        cols += [pa.array([acc[k]], sum_arrow[k]) for k in tmp]
        cols += [tail.column(t) for t in tmp.values()]
        cols += [head.column(t) for t in tmp.values()]
        yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return data.mapInArrow(run, schema).collect()


def _sum(vals: np.ndarray):
    """A sum as Python's number, exact for integers; None of no values."""
    if not len(vals):
        return None
    if vals.dtype.kind == "i" and np.abs(vals.astype(np.float64)).sum() > 9.2e18:
        return _checked(sum(vals.tolist()))
    return vals.sum().item()


def _carries(edge_rows, group_cols, tmp, diffed=()):
    """Per range: (carry-in sums, value of the previous row if it belongs to
    the range's first group) - a sequential pass over one row per range."""
    carry = {}
    open_key, acc, last = None, None, None
    for r in sorted(edge_rows, key=lambda r: r[RANGE_COL]):
        first = tuple(r["f_" + g] for g in group_cols)
        final = tuple(r["l_" + g] for g in group_cols)
        cont = _same_key(open_key, first)
        c_sum = {k: acc[k] if cont else None for k in tmp}
        c_lag = {k: last[k] if cont else None for k in tmp}
        carry[r[RANGE_COL]] = (c_sum, c_lag)
        part = {k: r["s_" + t] for k, t in tmp.items()}
        for k, t in tmp.items():
            # the first difference was taken without the value before it
            if k in diffed and c_lag[k] is not None and r["h_" + t] is not None and _same_key(final, first):
                part[k] = part[k] - c_lag[k]
        acc = {k: _add(c_sum[k], part[k]) for k in tmp} if _same_key(final, first) else part
        last = {k: r["v_" + t] for k, t in tmp.items()}
        open_key = final
    return carry


def _add(a, b):
    """Sum of two partial sums; null where there was no value yet."""
    if a is None or b is None:
        return b if a is None else a
    return _checked(a + b) if isinstance(a, int) else a + b


def _checked(total: int) -> int:
    if not -(1 << 63) <= total < 1 << 63:
        raise OverflowError("running sum beyond 64 bits")
    return total


def _running(vals: np.ndarray, valid: np.ndarray, starts: np.ndarray, carry):
    """Running sums that start anew at every group; ``carry`` goes into the
    first one.  Returns the sums and where there is a value yet.  Integers are
    summed at once and rebased (exact); floats inside their groups, since a NaN or a
    large value of one group must not touch the next."""
    n = len(vals)
    sidx = np.flatnonzero(starts)
    seg = np.cumsum(starts) - 1
    count = np.cumsum(valid)
    seen = count - (count[sidx] - valid[sidx])[seg] > 0
    if vals.dtype.kind == "i":
        total = np.cumsum(vals)
        near = np.cumsum(np.abs(vals.astype(np.float64)))
        if n and (near[-1] + abs(carry or 0)) > 9.2e18:
            _exact(vals, sidx, carry)
        out = total - (total[sidx] - vals[sidx])[seg]
        if carry is not None:
            out[seg == 0] += carry
    else:
        out = vals.astype(np.float64)
        if n and carry is not None:
            out[0] += carry
        size = np.diff(np.append(sidx, n))
        for a, k in zip(sidx[size >= LONG], size[size >= LONG]):
            out[a:a + k] = np.cumsum(out[a:a + k])
        # short groups together, place by place: the same additions in the same order
        short, size = sidx[size < LONG], size[size < LONG]
        for k in range(1, int(size.max(initial=1))):
            at = short[size > k] + k
            out[at] += out[at - 1]
    if carry is not None:
        seen = seen | (seg == 0)
    return out, seen


def _exact(vals: np.ndarray, sidx: np.ndarray, carry) -> None:
    """Raises where a running sum leaves 64 bits (values are that large)."""
    for a, b in zip(sidx, [*sidx[1:], len(vals)]):
        total = (carry or 0) if a == 0 else 0
        for v in vals[a:b].tolist():
            total = _checked(total + v)


def _same_key(a, b) -> bool:
    """Equal keys as Spark groups them: null = null, NaN = NaN."""
    return a is not None and b is not None and all(
        x == y or (isinstance(x, float) and isinstance(y, float) and x != x and y != y)
        for x, y in zip(a, b))


def _group_starts(batch: pa.RecordBatch, group_cols: list[str]) -> np.ndarray:
    n = batch.num_rows
    starts = np.zeros(n, bool)
    if n:
        starts[0] = True
    for c in group_cols:
        col = batch.column(c)
        if n < 2:
            break
        a, b = col.slice(1), col.slice(0, n - 1)
        ne = pc.fill_null(pc.not_equal(a, b), False)
        if pa.types.is_floating(col.type):
            ne = pc.and_not(ne, pc.and_(pc.fill_null(pc.is_nan(a), False),
                                        pc.fill_null(pc.is_nan(b), False)))
        nulls = pc.xor(pc.is_null(a), pc.is_null(b))
        starts[1:] |= pc.or_(ne, nulls).to_numpy(zero_copy_only=False)
    return starts


def _key_at(batch, group_cols, i):
    return tuple(batch.column(c)[i].as_py() for c in group_cols)


def _finish_arrow(data: DataFrame, group_cols, tmp: dict[str, str], carry, summed: set[str],
                  diffed: set[str], out_types: dict[str, object]) -> DataFrame:
    fields = list(data.schema.fields) + [StructField(k, out_types[k], True) for k in tmp]
    schema = StructType(fields)
    names = [f.name for f in fields]

    def run(batches):
        state = None
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            if state is None:
                rng = b.column(RANGE_COL)[0].as_py()
                c_sum, c_lag = carry.get(rng, ({k: None for k in tmp}, {k: None for k in tmp}))
                state = (_key_at(b, group_cols, 0), c_sum, c_lag)
            open_key, acc, last = state
            starts = _group_starts(b, group_cols)
            cont = _same_key(_key_at(b, group_cols, 0), open_key)
            outs = []
            new_acc, new_last = {}, {}
            for k, t in tmp.items():
                v = b.column(t)
                if k in summed or k in diffed:
                    is_int = pa.types.is_integer(v.type)
                    dtype = np.int64 if is_int else np.float64
                    if k in diffed:
                        vals, valid = _differences(v, last[k] if cont else None, starts, dtype)
                        new_last[k] = v[n - 1].as_py()
                    else:
                        vals = pc.fill_null(v, 0).to_numpy(zero_copy_only=False).astype(dtype)
                        valid = pc.is_valid(v).to_numpy(zero_copy_only=False)
                    cum, seen = _running(vals, valid, starts, acc[k] if cont else None)
                    outs.append(pa.array(cum, type=pa.int64() if is_int else pa.float64(), mask=~seen))
                    new_acc[k] = cum[-1].item() if seen[-1] else None
                else:
                    prev_idx = np.arange(n) - 1
                    taken = v.take(pa.array(np.maximum(prev_idx, 0)))
                    mask = starts.copy()
                    arr = pc.if_else(pa.array(mask), pa.nulls(n, v.type), taken)
                    if cont and last[k] is not None:
                        head = np.zeros(n, bool)
                        head[0] = True
                        arr = pc.if_else(pa.array(head), pa.scalar(last[k], v.type), arr)
                    outs.append(arr.cast(v.type))
                    new_last[k] = v[n - 1].as_py()
            state = (_key_at(b, group_cols, n - 1), new_acc, new_last)
            yield pa.RecordBatch.from_arrays(list(b.columns) + outs, names=names)

    return data.mapInArrow(run, schema)


def _value_type(df: DataFrame, col: Column, how: str):
    t = df.select(col.alias("_t")).schema["_t"].dataType
    if how == "lag":
        return t
    if isinstance(t, (LongType, IntegerType, ShortType, ByteType)):
        return LongType()
    if isinstance(t, (DoubleType, FloatType)):
        return DoubleType()
    raise TypeError(f"running sums take integers or floating-point numbers, not {t.simpleString()}")


def ordered_scan(df: DataFrame, group_cols: list[str], order_cols: list[str],
                 sums: dict[str, Column | str] | None = None,
                 lags: dict[str, Column | str] | None = None, num_ranges: int | None = None,
                 finish: str = "arrow", difference_sums: dict[str, Column | str] | None = None) -> DataFrame:
    """Running sums, previous values and running sums of differences from one sorted
    pass; see :func:`running_sum` and :func:`lag_in_group`.  A difference is a value
    less the one before it in its group, or less 0 where that is missing or null; a
    null has none.  Its scan's state is the last value and the sum, and states of
    neighbouring ranges combine, so that encoding and decoding deltas takes one
    shuffle."""
    given = {**(sums or {}), **(lags or {}), **(difference_sums or {})}
    vals = {k: (F.col(v) if isinstance(v, str) else v) for k, v in given.items()}
    summed, diffed = set(sums or {}), set(difference_sums or {})
    tmp = {k: f"_gf_v_{i}" for i, k in enumerate(vals)}
    out_types = {k: _value_type(df, v, "lag" if k in (lags or {}) else "sum") for k, v in vals.items()}
    casts = {k: (v if k in (lags or {}) else v.cast(out_types[k])) for k, v in vals.items()}
    base = df.select("*", *[casts[k].alias(tmp[k]) for k in vals])
    data = ranged(base, group_cols, order_cols, num_ranges)
    if finish == "arrow":
        # lag needs no sums: the carried value is the previous range's last row
        sum_types = {k: (LongType() if k in (lags or {}) else out_types[k]) for k in tmp}
        edges = _edges(data, group_cols, tmp, sum_types, summed, diffed)
        carry = _carries(edges, group_cols, tmp, diffed)
        out = _finish_arrow(data, group_cols, tmp, carry, summed, diffed, out_types)
        return out.select(*df.columns, *vals.keys())
    if (sums and lags) or difference_sums:
        raise ValueError("finish='window' takes sums or lags, not both")
    return _finish_window(data, df, group_cols, order_cols, tmp, "sum" if sums else "lag")


def _finish_window(data, df, group_cols, order_cols, tmp, how):
    """Carry per (range, group) joined in, then a window per (range, group)."""
    keys = [RANGE_COL, *group_cols]
    order_struct = F.struct(*[F.col(c) for c in order_cols])
    by_group = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))
    if how == "sum":
        partial = data.groupBy(*keys).agg(*[F.sum(t).alias(f"p_{t}") for t in tmp.values()])
        before = by_group.orderBy(RANGE_COL).rowsBetween(Window.unboundedPreceding, -1)
        carry = partial.select(*keys, *[F.sum(f"p_{t}").over(before).alias(f"c_{t}")
                                        for t in tmp.values()])
    else:
        partial = data.groupBy(*keys).agg(*[F.max_by(F.col(t), order_struct).alias(f"p_{t}")
                                            for t in tmp.values()])
        carry = partial.select(*keys, *[F.lag(f"p_{t}", 1).over(by_group.orderBy(RANGE_COL))
                                        .alias(f"c_{t}") for t in tmp.values()])
    cond = [data[k].eqNullSafe(carry[k]) for k in keys]
    joined = data.join(carry, on=cond, how="left").select(
        data["*"], *[carry[f"c_{t}"] for t in tmp.values()])
    within = Window.partitionBy(*keys).orderBy(*order_cols)
    if how == "sum":
        frame = within.rowsBetween(Window.unboundedPreceding, 0)
        res = [F.coalesce(F.sum(t).over(frame) + F.col(f"c_{t}"), F.sum(t).over(frame), F.col(f"c_{t}"))
               .alias(k) for k, t in tmp.items()]
    else:
        first = F.row_number().over(within) == 1
        res = [F.when(first, F.col(f"c_{t}")).otherwise(F.lag(t, 1).over(within)).alias(k)
               for k, t in tmp.items()]
    return joined.select(*df.columns, *res)


def running_sum(df: DataFrame, group_cols: list[str], order_cols: list[str],
                value_cols: dict[str, Column | str], num_ranges: int | None = None,
                finish: str = "arrow") -> DataFrame:
    """Add inclusive running sums per group in ``order_cols`` order:
    ``sum(v) OVER (PARTITION BY group ORDER BY order ROWS UNBOUNDED
    PRECEDING)``, with SQL's nulls: null until the group's first value.
    Integers are summed exactly in 64 bits (``OverflowError`` beyond), floats
    as doubles; other types are refused.  Rows that tie on the order keys are
    taken in the order of a hash of their values."""
    return ordered_scan(df, group_cols, order_cols, value_cols, None, num_ranges, finish)


def lag_in_group(df: DataFrame, group_cols: list[str], order_cols: list[str],
                 value_cols: dict[str, Column | str], num_ranges: int | None = None,
                 finish: str = "arrow") -> DataFrame:
    """Add the previous row's value per group (``lag(v, 1)``), null for the
    first row of a group."""
    return ordered_scan(df, group_cols, order_cols, None, value_cols, num_ranges, finish)


class KeyBuckets:
    """Bounds in key order, and the bucket of any row by binary search.

    Each column's values become numbers that compare with the bounds' numbers as
    the values do: twice the place among the bounds' distinct values, and one more
    if the value is one of them.  Numbers of the columns so far and of the next one
    are joined and made small again the same way, so any number of columns fits."""

    def __init__(self, bounds: pa.Table):
        self.distinct, self.joined = [], []
        code = np.zeros(bounds.num_rows, np.int64)
        for col in bounds.columns:
            vals, null = _comparable(col.combine_chunks())
            self.distinct.append(np.unique(vals[~null]))
            code = self._join(code, vals, null, self.distinct[-1])
            self.joined.append(np.unique(code))
            code = self._place(self.joined[-1], code)
        self.bounds = np.unique(code)

    @staticmethod
    def _place(known: np.ndarray, vals: np.ndarray) -> np.ndarray:
        at = np.searchsorted(known, vals)
        same = np.zeros(len(vals), bool)
        if len(known):
            same = (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == vals)
        return 2 * at + same

    def _join(self, code, vals, null, known):
        own = np.zeros(len(vals), np.int64)              # nulls come first
        own[~null] = self._place(known, vals[~null]) + 1
        return code * (2 * len(known) + 2) + own

    def __call__(self, columns: list[pa.Array]) -> np.ndarray:
        """Per row how many bounds are below it or equal."""
        n = len(columns[0])
        code = np.zeros(n, np.int64)
        for col, known, joined in zip(columns, self.distinct, self.joined):
            vals, null = _comparable(col)
            code = self._place(joined, self._join(code, vals, null, known))
        return np.searchsorted(self.bounds, code, "right")

    def __len__(self) -> int:
        return len(self.bounds) + 1


def _comparable(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values that numpy compares as Spark does, and where they are null."""
    null = pc.is_null(col).to_numpy(zero_copy_only=False)
    if pa.types.is_timestamp(col.type) or pa.types.is_date64(col.type):
        col = col.cast(pa.int64())
    elif pa.types.is_date32(col.type):
        col = col.cast(pa.int32())
    if pa.types.is_floating(col.type):
        vals = pc.fill_null(col, 0).to_numpy(zero_copy_only=False).astype(np.float64)
        return vals + 0.0, null                          # NaN sorts last, -0.0 equals 0.0
    if pa.types.is_integer(col.type):
        return pc.fill_null(col, 0).to_numpy(zero_copy_only=False).astype(np.int64), null
    if pa.types.is_boolean(col.type):
        return pc.fill_null(col, False).to_numpy(zero_copy_only=False).astype(np.int64), null
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) or pa.types.is_binary(col.type) \
            or pa.types.is_decimal(col.type):
        vals = np.empty(len(col), object)
        vals[:] = [x if x is not None else 0 for x in col.to_pylist()]
        return vals, null
    raise TypeError(f"rows cannot be numbered by {col.type}")


def _bucketed(df: DataFrame, order_cols: list[str], n: int) -> tuple[DataFrame, list[str], int]:
    """``df`` with a hash of its rows and its bucket in key order; the bounds of some
    ``n`` buckets come from a sample of ``SAMPLE`` rows each."""
    rest = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    keys = [f"_gf_k{i}" for i in range(len(order_cols) + 1)]
    keyed = df.select("*", *[F.col(c).alias(k) for c, k in zip(order_cols, keys)],
                      F.xxhash64(*rest).alias(keys[-1]))
    drawn = (keyed.select(*keys).orderBy(F.rand(17)).limit(SAMPLE * n)
             .orderBy(*[F.col(k).asc_nulls_first() for k in keys]).toArrow())
    bounds = KeyBuckets(drawn.take(pa.array(np.arange(SAMPLE, drawn.num_rows, SAMPLE))))
    schema = StructType([*keyed.schema.fields, StructField("_gf_bucket", IntegerType())])

    def run(batches):
        for b in batches:
            found = bounds([b.column(k) for k in keys]).astype("int32")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found)], names=[*b.schema.names, "_gf_bucket"])

    return keyed.mapInArrow(run, schema), keys, len(bounds)


def _numbered(df: DataFrame, order_cols: list[str], start_id: int, count: int, id_col: str,
              num_ranges: int | None) -> DataFrame:
    from geoframe.session import ship_package
    ship_package(df.sparkSession)
    base = df.drop(id_col) if id_col in df.columns and id_col not in order_cols else df
    bucketed, keys, n = _bucketed(base, order_cols, _num_ranges(df, num_ranges))
    sizes = np.zeros(n, np.int64)
    for r in bucketed.groupBy("_gf_bucket").agg(F.count(F.lit(1)).alias("n")).collect():    # one row a bucket
        sizes[r["_gf_bucket"]] = r["n"]
    before = np.cumsum(sizes) - sizes
    if count >= 0:
        # nothing beyond the bucket that holds the last id is sorted
        last = int(np.searchsorted(before, count)) - 1
        bucketed = bucketed.where(F.col("_gf_bucket") <= last)
    ordered = (bucketed.repartition(n, "_gf_bucket")
               .sortWithinPartitions("_gf_bucket", *[F.col(k).asc_nulls_first() for k in keys]))
    given = base.columns
    schema = StructType([*base.schema.fields, StructField(id_col, LongType())])

    def run(batches):
        open_, seen = -1, 0
        for b in batches:
            if not b.num_rows:
                continue
            of = b.column("_gf_bucket").to_numpy()
            edge = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            place = np.arange(len(of)) - np.repeat(edge, np.diff(np.append(edge, len(of))))
            if of[0] == open_:
                place[:edge[1] if len(edge) > 1 else len(of)] += seen
            open_, seen = of[-1], int(place[-1]) + 1
            ids = pa.array(start_id + 1 + before[of] + place)
            out = pa.RecordBatch.from_arrays([*[b.column(c) for c in given], ids], names=[*given, id_col])
            yield out if count < 0 else out.filter(pc.less_equal(ids, start_id + count))

    return ordered.mapInArrow(run, schema)


def assign_object_ids(df: DataFrame, order_cols: list[str], start_id: int = 0,
                      count: int = -1, id_col: str = "OBJECTID",
                      num_ranges: int | None = None, finish: str = "arrow") -> DataFrame:
    """Running ids ``start_id + 1, + 2, ...`` in ``order_cols`` order over the
    whole table, without a single-partition window or a copy of the table: rows
    fall into buckets of the keys (and a hash of the row, so that hot and tied keys
    span buckets), one pass counts the buckets, and a second one shuffles by bucket,
    sorts and numbers each from what lies before it.  ``df`` is evaluated three
    times (sample, counts, rows) and must give the same rows each time.
    ``count >= 0`` keeps the first ``count`` ids, as the sequential scan with a row
    budget does; buckets beyond them are not shuffled.  Nulls come first, NaN last.
    ``finish="window"`` numbers by the ordered scan instead."""
    if finish != "window":
        return _numbered(df, order_cols, int(start_id), int(count), id_col, num_ranges)
    out = running_sum(df, [], order_cols, {id_col: F.lit(1).cast("long")}, num_ranges, finish)
    out = out.withColumn(id_col, F.col(id_col) + F.lit(int(start_id)))
    if count >= 0:
        out = out.filter(F.col(id_col) <= F.lit(int(start_id) + int(count)))
    return out
