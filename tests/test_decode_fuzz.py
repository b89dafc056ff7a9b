"""Corrupted bytes never crash the row decoder: every row either decodes or
is reported malformed (PERMISSIVE turns it into an all-null row)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from geoframe.sources import decode as D
from geoframe.sources.layout import (DATETIME, FLOAT64, GUID, INT16, INT32, OID, SHAPE,
                                     STRING, FieldDesc)


def _fields(kind):
    return [FieldDesc("OBJECTID", "OBJECTID", OID, False),
            FieldDesc("a", "a", INT32, True), FieldDesc("b", "b", STRING, True),
            FieldDesc("c", "c", FLOAT64, False), FieldDesc("d", "d", DATETIME, True),
            FieldDesc("e", "e", GUID, True), FieldDesc("f", "f", INT16, True),
            FieldDesc("Shape", "Shape", SHAPE, True, kind=kind, xy_scale=10.0, m_scale=10.0,
                      z_scale=10.0, has_m=True, has_z=True)]


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=0, max_size=600), st.integers(min_value=1, max_value=12),
       st.sampled_from(["point", "pointZM", "polyline", "polylineM", "polygon"]))
def test_random_rows_do_not_crash(data, nrows, kind):
    rng = np.random.default_rng(len(data))
    buf = np.frombuffer(data + b"\0" * D.PAD, np.uint8)
    pos = np.sort(rng.integers(0, max(len(data), 1), nrows)).astype(np.int64)
    fields = _fields(kind)
    arrays, bad = D.decode_rows(buf, len(data), pos, pos + 1, fields, list(range(len(fields))))
    assert len(bad) == nrows
    assert all(len(a) == nrows for a in arrays)
    fixed = D.null_rows(arrays, bad)
    for a in fixed:
        assert a.null_count >= int(bad.sum())


def _encoded_rows():
    import pyarrow as pa

    from geoframe.testing import encoder as E
    n = 6
    batch = pa.RecordBatch.from_pydict({
        "a": pa.array([1, None, 3, 4, 5, 6], pa.int32()),
        "b": ["x", "yy", None, "zzz", "", "w" * 40],
        "xy": pa.array([[1.0, 2.0, 3.0, 4.0], [], None, [5.0, 6.0] * 5, [1.0, 1.0],
                        [2.0, 3.0, 4.0, 5.0]], pa.list_(pa.float64())),
        "parts": pa.array([[1, 1], [], None, [3, 2], [1], [2]], pa.list_(pa.int32())),
    })
    spec = E.TableSpec([E.FieldSpec("a", "int32"), E.FieldSpec("b", "string"),
                        E.ShapeSpec("Shape", "polyline", coords="xy", parts="parts",
                                    xy_scale=10.0)])
    lens, flat = E.encode_batch(spec, batch)
    fields = [FieldDesc("OBJECTID", "OBJECTID", OID, False), FieldDesc("a", "a", INT32, True),
              FieldDesc("b", "b", STRING, True),
              FieldDesc("Shape", "Shape", SHAPE, True, kind="polyline", xy_scale=10.0)]
    return n, lens, flat, fields


def test_encoded_rows_decode():
    n, lens, flat, fields = _encoded_rows()
    buf = np.concatenate([flat, np.zeros(D.PAD, np.uint8)])
    pos = (np.cumsum(lens) - lens).astype(np.int64)
    arrays, bad = D.decode_rows(buf, len(flat), pos, np.arange(1, n + 1), fields, [0, 1, 2, 3])
    assert not bad.any()
    assert arrays[1].to_pylist() == [1, None, 3, 4, 5, 6]
    assert arrays[2].to_pylist() == ["x", "yy", None, "zzz", "", "w" * 40]
    shapes = arrays[3].to_pylist()
    assert shapes[0]["xyNum"] == [1, 1] and shapes[0]["xyArr"] == [1.0, 2.0, 3.0, 4.0]
    assert shapes[1]["xyArr"] == [] and shapes[2] is None and shapes[3]["xyNum"] == [3, 2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=10_000),
                          st.integers(min_value=0, max_value=255)), min_size=1, max_size=8))
def test_corrupted_encoded_rows_do_not_crash(flips):
    n, lens, flat, fields = _encoded_rows()
    data = flat.copy()
    for where, value in flips:
        data[where % len(data)] = value
    buf = np.concatenate([data, np.zeros(D.PAD, np.uint8)])
    pos = (np.cumsum(lens) - lens).astype(np.int64)
    arrays, bad = D.decode_rows(buf, len(data), pos, np.arange(1, n + 1), fields, [0, 1, 2, 3])
    assert all(len(a) == n for a in arrays)
    D.null_rows(arrays, bad)
