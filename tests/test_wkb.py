"""Round trips of polygons through well-known binary and GeoJSON."""

import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodeplane.functions.overlay import overlaid
from lodeplane.functions.wkb import decoded, encoded, from_geojson, from_wkb, parts, to_geojson, to_wkb


def box(x, y, n):
    return np.array([(x, y), (x + n, y), (x + n, y + n), (x, y + n)], float)


def shapes(rings):
    return sorted(sorted(map(tuple, r.tolist())) for r in rings)


corner = st.tuples(st.integers(0, 9), st.integers(0, 9))


@given(st.lists(st.lists(corner, min_size=3, max_size=8).map(lambda x: np.array(x, float)), min_size=1, max_size=3), st.booleans(), st.sampled_from([None, 3763, 4326]))
@settings(max_examples=200, deadline=None)
def test_valid_polygons_come_back(rings, big, srid):
    rings = overlaid(rings, [], "union")
    if rings:
        got = decoded(encoded(rings, srid, big))
        assert got[0] == srid and got[1] == ("Polygon" if len(parts(rings)) == 1 else "MultiPolygon") and shapes(got[2]) == shapes(rings)
        twice = lambda r: (r[:, 0] * np.roll(r[:, 1], -1) - np.roll(r[:, 0], -1) * r[:, 1]).sum()
        for outer, *holes in parts(rings):  # overlays turn outer rings left and holes right
            assert twice(outer) > 0 and all(twice(h) < 0 for h in holes)


def test_parts_of_nested_rings():
    found = parts([box(0, 0, 20), box(2, 2, 16), box(4, 4, 5), box(5, 5, 2), box(30, 0, 4)])
    assert sorted(len(p) for p in found) == [1, 2, 2] and parts([]) == []


def test_forms_of_the_bytes():
    point = struct.pack("<BIdd", 1, 1, 2.0, 3.0)
    assert decoded(point)[1:][0] == "Point" and decoded(point)[2][0].tolist() == [[2.0, 3.0]]
    for code, extra in ((1001, 1), (2001, 1), (3001, 2), (0x80000001, 1), (0xC0000001, 2)):
        assert decoded(struct.pack(f">BIdd{'d' * extra}", 0, code, 2.0, 3.0, *[9.0] * extra))[2][0].tolist() == [[2.0, 3.0]]
    for box_number, n in ((0, 0), (1, 4), (2, 6), (4, 8)):
        head = b"GP\0" + bytes([box_number << 1 | 1]) + struct.pack(f"<i{n}d", 3763, *range(n))
        assert decoded(head + encoded([box(0, 0, 2)], None, True)) [:2] == (3763, "Polygon")
    for bad in (b"", point[:-1], point + b"\0", struct.pack("<BI", 1, 99) + b"\0" * 8, b"GP"):
        with pytest.raises((ValueError, IndexError, KeyError, struct.error)):
            decoded(bad)


def test_columns(spark):
    kind = "id int, rings array<array<struct<x:double,y:double>>>, raw binary"
    ring = lambda *a: [tuple(p) for p in box(*a).tolist()]
    rows = [(1, [ring(0, 0, 9), ring(2, 2, 3), ring(20, 0, 4)], b"junk"), (2, None, None), (3, [ring(0, 0, 1) + ring(0, 0, 1)[:1]], encoded([box(1, 1, 2)], 4326)), (4, [], b"")]
    df = spark.createDataFrame(rows, kind)
    got = {r.id: r for r in df.select("id", from_wkb(to_wkb("rings", F.lit(3763))).alias("b"), from_wkb("raw").alias("raw"), from_geojson(to_geojson(F.col("rings"))).alias("j")).collect()}
    points = lambda rings: sorted(sorted((p.x, p.y) for p in r) for r in rings)
    for i in (1, 3):
        want = sorted(sorted(set(r)) for r in rows[i - 1][1])
        assert points(got[i].b.rings) == points(got[i].j) == want and got[i].b.srid == 3763
    assert got[1].b.type == "MultiPolygon" and got[3].b.type == "Polygon" and got[2].b is None and got[2].j is None
    assert got[4].b.rings == [] and got[4].j == []
    assert got[1].raw is None and got[2].raw is None and got[4].raw is None and got[3].raw.srid == 4326
    text = spark.createDataFrame([('{"type":"Polygon","coordinates":[[[0,0,5],[1,0,5],[1,1,5],[0,0,5]]]}',), ('{"type":"Point","coordinates":[0,1]}',), ("nonsense",), (None,)], "t string")
    assert [r.r and points(r.r) for r in text.select(from_geojson(F.col("t")).alias("r")).collect()] == [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]], None, None, None]
