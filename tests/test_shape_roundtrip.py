"""Shape blobs: test encoder -> batch decoder on random geometries
(multi-part, empty, curve flag, Z/M subtypes), no Spark involved."""

import math

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from geoframe.sources import decode as D
from geoframe.sources.layout import SHAPE, FieldDesc
from geoframe.testing import encoder as E

ORIG, SCALE, MORIG, MSCALE = -100.0, 1000.0, -50.0, 100.0
coord = st.floats(min_value=-99.0, max_value=99.0, allow_nan=False)
zm = st.floats(min_value=-49.0, max_value=99.0, allow_nan=False)


def _field(kind):
    return FieldDesc("Shape", "Shape", SHAPE, True, kind=kind, x_orig=ORIG, y_orig=ORIG,
                     xy_scale=SCALE, m_orig=MORIG, m_scale=MSCALE, z_orig=MORIG,
                     z_scale=MSCALE, has_m=True, has_z=True)


def _spec(kind, **kw):
    return E.ShapeSpec("Shape", kind, x_orig=ORIG, y_orig=ORIG, xy_scale=SCALE,
                       m_orig=MORIG, m_scale=MSCALE, z_orig=MORIG, z_scale=MSCALE, **kw)


def _decode(kind, lens, flat, valid):
    buf = np.concatenate([flat, np.zeros(D.PAD, np.uint8)])
    starts = np.cumsum(lens) - lens
    arr, bad = D.decode_shape(buf, starts.astype(np.int64), lens.astype(np.int64), valid,
                              _field(kind))
    return arr.to_pylist(), bad


def _q(v, orig, scale):
    return math.floor((v - orig) * scale)


geoms = st.lists(st.lists(st.tuples(coord, coord, zm), min_size=0, max_size=6),
                 min_size=0, max_size=4)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(geoms, st.booleans()), min_size=1, max_size=6),
       st.sampled_from(["polyline", "polylineM", "polygon"]))
def test_poly_roundtrip(rows, kind):
    stride = 3 if kind == "polylineM" else 2
    coords, parts, curve = [], [], []
    for g, c in rows:
        flat = []
        for part in g:
            for x, y, m in part:
                flat += [x, y, m][:stride]
        coords.append(flat)
        parts.append([len(p) for p in g])
        curve.append(c)
    batch = pa.RecordBatch.from_pydict({
        "coords": pa.array(coords, pa.list_(pa.float64())),
        "parts": pa.array(parts, pa.list_(pa.int32())),
        "curve": pa.array(curve)})
    valid = np.ones(len(rows), bool)
    sp = _spec(kind, coords="coords", parts="parts", curve="curve" if stride == 2 else None,
               trailing_m=kind == "polygon")
    lens, flat = E.shape_bytes(sp, batch, valid)
    got, bad = _decode(kind, lens, flat, valid)
    assert not bad.any()
    for (g, _), v in zip(rows, got):
        n = sum(len(p) for p in g)
        if n == 0:
            assert v == {"xmin": 0.0, "ymin": 0.0, "xmax": 0.0, "ymax": 0.0,
                         "xyNum": [], "xyArr": []}
            continue
        assert v["xyNum"] == [len(p) for p in g]
        pts = [pt for p in g for pt in p]
        qx = [_q(x, ORIG, SCALE) for x, _, _ in pts]
        qy = [_q(y, ORIG, SCALE) for _, y, _ in pts]
        want = []
        for i, (x, y, m) in enumerate(pts):
            want += [qx[i] / SCALE + ORIG, qy[i] / SCALE + ORIG]
            if stride == 3:
                want.append(_q(m, MORIG, MSCALE) / MSCALE + MORIG)
        assert v["xyArr"] == want
        assert v["xmin"] == min(qx) / SCALE + ORIG
        assert v["ymax"] == (max(qy) - min(qy)) / SCALE + (min(qy) / SCALE + ORIG)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(coord, coord, zm, zm, st.sampled_from([1, 9, 21, 11])),
                min_size=1, max_size=20))
def test_point_zm_roundtrip(rows):
    batch = pa.RecordBatch.from_pydict({
        "x": [r[0] for r in rows], "y": [r[1] for r in rows], "z": [r[2] for r in rows],
        "m": [r[3] for r in rows], "t": pa.array([r[4] for r in rows], pa.int32())})
    valid = np.ones(len(rows), bool)
    sp = _spec("pointZM", x="x", y="y", z="z", m="m", subtype="t")
    lens, flat = E.shape_bytes(sp, batch, valid)
    got, bad = _decode("pointZM", lens, flat, valid)
    assert not bad.any()
    for (x, y, z, m, t), v in zip(rows, got):
        assert v["x"] == (_q(x, ORIG, SCALE) + 1 - 1.0) / SCALE + ORIG
        assert v["y"] == (_q(y, ORIG, SCALE) + 1 - 1.0) / SCALE + ORIG
        want_z = (_q(z, MORIG, MSCALE) + 1 - 1.0) / MSCALE + MORIG if t in (9, 11) else 0.0
        want_m = (_q(m, MORIG, MSCALE) + 1 - 1.0) / MSCALE + MORIG if t in (21, 11) else 0.0
        assert v["z"] == want_z and v["m"] == want_m


def test_truncated_blob_is_malformed():
    batch = pa.RecordBatch.from_pydict({"coords": pa.array([[1.0, 2.0, 3.0, 4.0]]),
                                        "parts": pa.array([[2]], pa.list_(pa.int32()))})
    lens, flat = E.shape_bytes(_spec("polyline", coords="coords", parts="parts"), batch,
                               np.ones(1, bool))
    cut = flat[:-2]
    got, bad = _decode("polyline", np.array([len(cut)]), cut, np.ones(1, bool))
    assert bad.all() and got == [None]


def test_encoder_rejects_values_below_origin():
    import pytest
    batch = pa.RecordBatch.from_pydict({"x": [-200.0], "y": [0.0]})
    with pytest.raises(ValueError, match="below the layer origin"):
        E.shape_bytes(_spec("point", x="x", y="y"), batch, np.ones(1, bool))
