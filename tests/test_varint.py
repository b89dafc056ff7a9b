"""Varint / shape encodings pinned to hand-made byte vectors, and
encoder -> decoder round trips (hypothesis)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from geoframe.sources import decode as D
from geoframe.testing import encoder as E


def _buf(b: bytes):
    return np.frombuffer(b + b"\0" * D.PAD, np.uint8)


def test_varuint_vectors():
    # 300 = 0b10_0101100 -> 0xAC 0x02 ; 127 -> 0x7F ; 128 -> 0x80 0x01
    for value, raw in [(0, b"\x00"), (127, b"\x7f"), (128, b"\x80\x01"), (300, b"\xac\x02")]:
        n, flat = E.varuint(np.array([value]))
        assert bytes(flat) == raw and n[0] == len(raw)
        v, nb, bad = D.read_varuint(_buf(raw), np.array([0]))
        assert int(v[0]) == value and nb[0] == len(raw) and not bad[0]


def test_varint_vectors():
    # sign-magnitude: first byte carries 6 value bits and the sign bit (0x40)
    cases = [(0, b"\x00"), (1, b"\x01"), (-1, b"\x41"), (63, b"\x3f"), (-63, b"\x7f"),
             (64, b"\x80\x01"), (-64, b"\xc0\x01"), (200, b"\x88\x03")]
    for value, raw in cases:
        n, flat = E.varint(np.array([value]))
        assert bytes(flat) == raw, value
        uval, sval, first, count = D._varint_stream(_buf(raw), np.array([0]), np.array([len(raw)]))
        assert int(sval[0]) == value


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(min_value=-(2**50), max_value=2**50), min_size=1, max_size=40))
def test_varint_stream_roundtrip(values):
    n, flat = E.varint(np.array(values))
    uval, sval, first, count = D._varint_stream(_buf(bytes(flat)), np.array([0]),
                                                np.array([len(flat)]))
    assert list(sval) == values


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=2**62), min_size=1, max_size=40))
def test_varuint_roundtrip(values):
    n, flat = E.varuint(np.array(values, dtype=np.uint64))
    pos = np.concatenate([[0], np.cumsum(n)[:-1]])
    v, nb, bad = D.read_varuint(_buf(bytes(flat)), pos)
    assert [int(x) for x in v] == values and not bad.any()


def test_point_blob_vector():
    # point layer, origin 0, scale 10: x = 1.5 -> stored 16, y = 2.0 -> 21
    from geoframe.sources.layout import SHAPE, FieldDesc
    f = FieldDesc("Shape", "Shape", SHAPE, True, kind="point", xy_scale=10.0)
    blob = b"\x01\x10\x15"
    arr, bad = D.decode_points(_buf(blob), np.array([0]), np.array([3]), np.array([True]), f)
    assert arr.to_pylist() == [{"x": 1.5, "y": 2.0}] and not bad.any()


def test_two_part_polyline_vector():
    # geomType 3, 3 points, 2 parts, bbox (0,0)+(2,2) at scale 1, parts [2, (1)],
    # deltas (0,0) (1,1) (1,1): the running sum carries across parts
    from geoframe.sources.layout import SHAPE, FieldDesc
    f = FieldDesc("Shape", "Shape", SHAPE, True, kind="polyline", xy_scale=1.0)
    blob = bytes([3, 3, 2, 0, 0, 2, 2, 2, 0, 0, 1, 1, 1, 1])
    arr, bad = D.decode_polys(_buf(blob), np.array([0]), np.array([len(blob)]),
                              np.array([True]), f)
    v = arr.to_pylist()[0]
    assert v["xyNum"] == [2, 1] and v["xyArr"] == [0, 0, 1, 1, 2, 2]
    assert (v["xmin"], v["ymin"], v["xmax"], v["ymax"]) == (0, 0, 2, 2) and not bad.any()


def test_guid_vector():
    raw = bytes.fromhex("8DD5A72AF42B434983A8457B70DB1871")
    arr = D.guid_array(_buf(raw), np.array([0]), np.array([True]))
    assert arr.to_pylist() == ["{2AA7D58D-2BF4-4943-83A8-457B70DB1871}"]
    many = D.guid_array(_buf(raw * 5), np.arange(5) * 16, np.array([True, False] * 2 + [True]))
    assert many.to_pylist() == ["{2AA7D58D-2BF4-4943-83A8-457B70DB1871}", None] * 2 + \
        ["{2AA7D58D-2BF4-4943-83A8-457B70DB1871}"]


def test_date_vector():
    # 2016-01-01 07:24:32 UTC as a day number; ceil may add 1 ms of float noise
    days = np.array([42370.30870370370])
    ms = D.datetime_millis(days)[0]
    assert abs(ms - 1451633072000) <= 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(min_value=-(2**62), max_value=2**62), min_size=1, max_size=20),
       st.lists(st.integers(min_value=0, max_value=2**62), min_size=1, max_size=20))
def test_varint_stream_wide_values(signed_vals, unsigned_vals):
    """Long varints (9 bytes) take the slow path inside the stream decoder."""
    sn, sflat = E.varint(np.array(signed_vals))
    uvals = np.array(unsigned_vals, dtype=np.uint64)
    un, uflat = E.varuint(uvals)
    blob = bytes(sflat) + bytes(uflat)
    uval, sval, first, count = D._varint_stream(_buf(blob), np.array([0]), np.array([len(blob)]))
    assert count[0] == len(signed_vals) + len(unsigned_vals)
    assert list(sval[:len(signed_vals)]) == signed_vals
    assert [int(v) for v in uval[len(signed_vals):]] == unsigned_vals
