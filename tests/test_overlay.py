"""Overlays of polygons against sampled points and known areas."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodeplane.functions.overlay import KEEP, made_valid, overlaid, overlay, rings_area


def area(rings):
    return sum((r[:, 0] * np.roll(r[:, 1], -1) - np.roll(r[:, 0], -1) * r[:, 1]).sum() / 2 for r in rings)


def odd(rings, x, y):
    n = 0
    for r in rings:
        for (x0, y0), (x1, y1) in zip(r, np.roll(r, -1, 0), strict=True):
            n += (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0
    return n % 2 == 1


def ring(*points):
    return np.array(points, float)


def simple(r):
    """No two sides that aren't neighbours meet."""
    n = len(r)
    turn = lambda p, q, s: np.sign((q[0] - p[0]) * (s[1] - p[1]) - (q[1] - p[1]) * (s[0] - p[0]))
    return not any(
        turn(r[i], r[(i + 1) % n], r[j]) * turn(r[i], r[(i + 1) % n], r[(j + 1) % n]) < 0 and turn(r[j], r[(j + 1) % n], r[i]) * turn(r[j], r[(j + 1) % n], r[(i + 1) % n]) < 0
        for i in range(n) for j in range(i + 2, n) if (i, j) != (0, n - 1)
    )


corner = st.tuples(st.integers(0, 8), st.integers(0, 8))
polygon = st.lists(st.lists(corner, min_size=3, max_size=7).map(lambda x: ring(*x)), min_size=1, max_size=2)


@given(polygon, polygon, st.sampled_from(sorted(KEEP)))
@settings(max_examples=300, deadline=None)
def test_points_of_any_rings(a, b, how):
    got = overlaid(a, b, how)
    assert all(simple(r) for r in got)
    rng = np.random.default_rng(1)
    for x, y in rng.uniform(-0.5, 8.5, (60, 2)):
        assert odd(got, x, y) == KEEP[how](np.bool_(odd(a, x, y)), np.bool_(odd(b, x, y)))
    assert area(got) >= 0


@given(polygon, polygon)
@settings(max_examples=150, deadline=None)
def test_areas_add_up(a, b):
    both, one, other = (area(overlaid(x, y, h)) for x, y, h in ((a, b, "intersection"), (a, b, "difference"), (b, a, "difference")))
    assert math.isclose(area(overlaid(a, b, "union")), both + one + other, abs_tol=1e-6)
    assert math.isclose(area(overlaid(a, [], "union")), both + one, abs_tol=1e-6)


def test_known_shapes():
    bow = [ring((0, 0), (4, 4), (4, 0), (0, 4))]
    parts = overlaid(bow, [], "union")
    assert len(parts) == 2 and area(parts) == 8 and all(len(p) == 3 for p in parts)
    spike = [ring((0, 0), (4, 0), (4, 4), (9, 4), (4, 4), (0, 4))]
    assert [len(p) for p in overlaid(spike, [], "union")] == [4] and area(overlaid(spike, [], "union")) == 16
    frame = [ring((0, 0), (12, 0), (12, 12), (0, 12)), ring((4, 4), (8, 4), (8, 8), (4, 8))]
    moved = [r + 4 for r in frame]
    assert area(overlaid(frame, moved, "intersection")) == 64 - 16 - 16
    assert area(overlaid(frame, frame, "intersection")) == 128 and overlaid(frame, frame, "difference") == []
    assert overlaid(frame, [r + 12 for r in frame], "intersection") == []
    hole = [r for r in overlaid(frame, [], "union") if area([r]) < 0]
    assert len(hole) == 1 and area(hole) == -16
    assert overlaid([], frame, "intersection") == [] and overlaid([ring((1, 1), (1, 1))], [], "union") == []


def test_many_sides():
    turns = np.linspace(0, 2 * np.pi, 1501)[:-1]
    star = [np.stack([np.cos(turns), np.sin(turns)], 1) * np.where(np.arange(1500) % 2, 1, 0.6)[:, None]]
    moved = [star[0] + [0.013, 0.007]]
    both = area(overlaid(star, moved, "intersection"))
    assert math.isclose(both + area(overlaid(star, moved, "symmetric_difference")), area(overlaid(star, moved, "union")), rel_tol=1e-7)


def test_columns(spark):
    box = lambda x, y, n: [{"x": float(x + i), "y": float(y + j)} for i, j in ((0, 0), (n, 0), (n, n), (0, n))]
    rows = [(1, [box(0, 0, 4), box(1, 1, 2)], [box(2, 2, 4)]), (2, None, [box(0, 0, 1)]), (3, [], [box(0, 0, 1)]), (4, [None, box(0, 0, 2)], [box(0, 0, 2) + box(0, 0, 2)[:1]])]
    df = spark.createDataFrame(rows, "id int, a array<array<struct<x:double,y:double>>>, b array<array<struct<x:double,y:double>>>")
    got = {r.id: (r.i, r.u, r.v) for r in df.select("id", rings_area(overlay(df.a, df.b)).alias("i"), rings_area(overlay(df.a, df.b, "union")).alias("u"), rings_area(made_valid(df.a)).alias("v")).collect()}
    assert got == {1: (3.0, 12 + 16 - 3.0, 12.0), 2: (None, None, None), 3: (0.0, 1.0, 0.0), 4: (4.0, 4.0, 4.0)}
    with pytest.raises(ValueError):
        overlay(df.a, df.b, "both")


def test_systems(spark):
    from lodeplane.functions.geo import DEGREES, GRID, same_system, transformed
    from pyspark.sql import functions as F

    rows = [(i, (DEGREES, -9.5 + i % 17 / 4.9, 36.9 + i / 60)) for i in range(300)] + [(999, None)]
    df = spark.createDataFrame(rows, "id int, p struct<srid:int,x:double,y:double>")
    back = transformed(transformed(df, "p", GRID), "p", DEGREES).collect()
    for (i, was), now in zip(rows, back, strict=True):
        assert now.id == i and (was is None) == (now.p is None)
        if was:  # a millimetre is about 1e-8 degrees
            assert now.p.srid == DEGREES and abs(now.p.x - was[1]) < 5e-9 and abs(now.p.y - was[2]) < 5e-9
    assert transformed(df, "p", DEGREES).collect() == df.collect()
    odd = spark.createDataFrame([((27700, 1.0, 2.0), (GRID, 1.0, 2.0))], "p struct<srid:int,x:double,y:double>, q struct<srid:int,x:double,y:double>")
    with pytest.raises(Exception, match="27700"):
        transformed(odd, "p", GRID).collect()
    with pytest.raises(Exception, match="27700, 3763"):
        odd.select(same_system(F.col("p"), F.col("q"))).collect()
    with pytest.raises(ValueError):
        transformed(odd, "p", 1)


def test_overlap_dedup_edges(spark):
    from lodeplane.operators.spatial import polygon_overlaps, without_polygon_overlaps

    kind = "id int, block string, rings array<array<struct<x:double,y:double>>>"
    box = lambda x, n: [[(float(x + i), float(j)) for i, j in ((0, 0), (n, 0), (n, n), (0, n))]]
    primary = spark.createDataFrame([(1, "a", box(0, 10)), (2, "b", box(0, 10)), (3, None, box(0, 10)), (4, "a", None)], kind)
    secondary = spark.createDataFrame([(10, "a", box(1, 2)), (11, "a", box(9, 4)), (12, "b", box(10, 3)), (13, "c", box(1, 2)), (14, None, box(1, 2)), (15, "a", []), (16, "a", None), (17, "a", [[(1.0, 1.0), (2.0, 2.0)]])], kind)
    assert sorted(r.id for r in without_polygon_overlaps(primary, secondary, "block", 3.0).collect()) == [1, 2, 3, 4, 11, 12, 13, 14, 15, 16, 17]
    assert sorted(map(tuple, polygon_overlaps(primary, secondary, "block", 3.0).collect())) == [(1, 10, 4.0, 4.0), (1, 11, 4.0, 16.0)]
    assert without_polygon_overlaps(primary.limit(0), secondary.limit(0), "block", 3.0).count() == 0


def test_shapes_that_lie_alike_are_overlaid_once():
    from lodeplane.functions import overlay as O

    ring = np.array([(0, 0), (8, 0), (8, 5.25), (3, 8), (0, 8)], float)
    O._held.clear()
    for dx, dy in ((0, 0), (7, 9), (-40, 1000)):
        a, b = [ring + (dx, dy)], [ring + (dx + 2.5, dy + 1)]
        for how in O.KEEP:
            assert [r.tolist() for r in O.overlaid_once(a, b, how)] == [r.tolist() for r in O.overlaid(a, b, how)]
    assert len(O._held) == len(O.KEEP)


@settings(max_examples=150, deadline=None)
@given(polygon, polygon, st.sampled_from([1.0, 0.1, 1 / 3]), st.sampled_from([0.0, 1000.3]))
def test_shared_areas_are_those_of_overlays(a, b, scale, off):
    from lodeplane.functions.overlay import ValidSides, shared_areas, to_arrow, valid_sides

    a, b = ([r * scale + off for r in rings] for rings in (a, b))
    held = [valid_sides(to_arrow([rings])) for rings in (a, b)]
    assert np.allclose([held[0][1][0], held[1][1][0]], [area(overlaid(a, [], "union")), area(overlaid(b, [], "union"))], atol=1e-6)
    if any(len(x[0].flatten()) == 0 for x in held):
        return
    sides = [ValidSides(x[0]) for x in held]
    want = area(overlaid(a, b, "intersection"))
    got = shared_areas(*sides, np.array([0]), np.array([0]))[0]
    assert abs(got - want) < 1e-8 * max(1, scale * 100) and (got > 0) == (want > 0)


def test_sides_of_rows_with_and_without_nulls():
    import pyarrow as pa

    from lodeplane.functions.overlay import to_arrow, valid_sides

    square = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (2, 0), (2, 2), (0, 2))]
    kind = to_arrow([]).type
    plain = pa.array([[square], [], [square, square], [[]], [square[:2]]], kind)
    odd_ones = pa.array([[square], None, [None, [square[0], None, *square[1:], {"x": None, "y": 1.0}]]], kind)
    assert valid_sides(plain)[1].tolist() == [4.0, 0.0, 0.0, 0.0, 0.0] and [len(x) for x in valid_sides(plain)[0]] == [4, 0, 0, 0, 0]
    assert valid_sides(odd_ones)[1].tolist() == [4.0, 0.0, 4.0] and valid_sides(odd_ones.slice(2))[1].tolist() == [4.0]


def test_overlaps_move_no_pairs(spark, monkeypatch):
    """Shapes that all meet in one place are looked at block by block; no pair is a row before it is written out."""
    from pyspark.sql import functions as F

    from lodeplane.operators import spatial

    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    k, n = F.col("id") % 7, F.lit(20)
    shapes = spark.range(600).select("id", F.lit("a").alias("block"), F.array(F.array(corner(k, k), corner(k + n, k), corner(k + n, k + n), corner(k, k + n))).alias("rings"))
    monkeypatch.setattr(spatial, "MET", 64)
    left, right = shapes.filter("id % 2 = 0"), shapes.filter("id % 2 = 1")
    found = spatial.polygon_overlaps(left, right, "block", 50.0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("FlatMapCoGroupsInArrow"), plan
    rows = found.collect()
    assert len({(r.l_id, r.r_id) for r in rows}) == len(rows) == 300 * 300
    assert all(r.shared == (20 - abs(r.l_id % 7 - r.r_id % 7)) ** 2 and r.own == 400 for r in rows)
    # of what is covered ids are written out, not pairs
    assert spatial._shapes_meeting(left, right, "block", 50.0, 0.5, True).count() <= 300 * 2 * 5
