import struct

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cartoloom.geo.wkb import decode, encode, points_of

XY = st.tuples(st.floats(-180, 180), st.floats(-90, 90))
PATH = st.lists(XY, min_size=2, max_size=6)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(PATH, min_size=1, max_size=3), min_size=1, max_size=3))
def test_round_trip(parts):
    s = decode(encode("MULTIPOLYGON", parts))
    assert s.kind == "MULTIPOLYGON"
    assert [p.tolist() for p in s.paths] == [[list(q) for q in r] for part in parts for r in part]
    assert list(s.owners) == [i for i, part in enumerate(parts) for _ in part]
    line = decode(encode("LINESTRING", [[parts[0][0]]]))
    assert line.paths[0].tolist() == [list(q) for q in parts[0][0]]


def test_byte_orders_and_dimensions():
    big = struct.pack(">BI2d", 0, 1, 3.5, -2.25)
    z = struct.pack("<BI3d", 1, 1001, 3.5, -2.25, 9.0)
    flagged = struct.pack("<BI3d", 1, 0x80000001, 3.5, -2.25, 9.0)
    for b in (big, z, flagged):
        assert decode(b).paths[0].tolist() == [[3.5, -2.25]]


def test_malformed():
    good = encode("POINT", [[[(1.0, 2.0)]]])
    for b in (None, b"", b"\x01", good[:-1], b"\x01\x63\x00\x00\x00", struct.pack("<BI2d", 1, 1, np.nan, np.nan), struct.pack("<BII", 1, 2, 0)):
        assert decode(b) is None
    lon, lat = points_of([good, None, b"x", good[:-1], encode("LINESTRING", [[[(0.0, 0.0), (1.0, 1.0)]]])])
    assert lon[0] == 1 and lat[0] == 2 and np.isnan(lon[1:]).all()
