"""Planar geometry as Column arithmetic; rings are arrays of struct<x, y>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the public registry for EPSG:3763: GRS80, transverse Mercator.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
ORIGIN_LAT, ORIGIN_LON = 39.66825833333333, -8.133108333333334

_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
)
_E = (FLATTENING * (2 - FLATTENING)) ** 0.5
#: Numbers of the reference systems that coordinates are turned between: degrees of longitude and latitude, and the national grid in metres.
DEGREES, GRID = 4326, 3763


def mercator_sql(lon: str, lat: str) -> tuple[str, str]:
    """SQL for easting and northing of the transverse Mercator projection (Krüger's series to the third order in n)."""
    conformal = f"asinh(tan(radians({lat}))) - {_E!r} * atanh({_E!r} * sin(radians({lat})))"
    dlon = f"radians({lon} - ({ORIGIN_LON!r}))"
    xi, eta = f"atan2(sinh({conformal}), cos({dlon}))", f"asinh(sin({dlon}) / sqrt(power(sinh({conformal}), 2) + power(cos({dlon}), 2)))"
    x = " + ".join([eta, *(f"{a!r} * cos({2 * (j + 1)} * {xi}) * sinh({2 * (j + 1)} * {eta})" for j, a in enumerate(_ALPHA))])
    y = " + ".join([xi, *(f"{a!r} * sin({2 * (j + 1)} * {xi}) * cosh({2 * (j + 1)} * {eta})" for j, a in enumerate(_ALPHA))])
    return f"{_RECTIFYING!r} * ({x})", f"{_RECTIFYING!r} * ({y}) - {_origin_northing()!r}"


def _origin_northing() -> float:
    import math

    lat = math.radians(ORIGIN_LAT)
    conformal = math.asinh(math.tan(lat)) - _E * math.atanh(_E * math.sin(lat))
    xi = math.atan(math.sinh(conformal))
    return _RECTIFYING * (xi + sum(a * math.sin(2 * (j + 1) * xi) for j, a in enumerate(_ALPHA)))


def projected(lon: str, lat: str) -> tuple[Column, Column]:
    x, y = mercator_sql(lon, lat)
    return F.expr(x), F.expr(y)


def degrees_sql(x: str, y: str) -> tuple[str, str]:
    """SQL for longitude and latitude of a place on the grid: the inverse series, to the third order too."""
    xi, eta = f"(({y} + {_origin_northing()!r}) / {_RECTIFYING!r})", f"(({x}) / {_RECTIFYING!r})"
    xi1 = " - ".join([xi, *(f"{b!r} * sin({2 * (j + 1)} * {xi}) * cosh({2 * (j + 1)} * {eta})" for j, b in enumerate(_BETA))])
    eta1 = " - ".join([eta, *(f"{b!r} * cos({2 * (j + 1)} * {xi}) * sinh({2 * (j + 1)} * {eta})" for j, b in enumerate(_BETA))])
    conformal = f"asin(sin({xi1}) / cosh({eta1}))"
    lat = " + ".join([conformal, *(f"{d!r} * sin({2 * (j + 1)} * {conformal})" for j, d in enumerate(_DELTA))])
    return f"{ORIGIN_LON!r} + degrees(atan2(sinh({eta1}), cos({xi1})))", f"degrees({lat})"


def unprojected(x: str, y: str) -> tuple[Column, Column]:
    lon, lat = degrees_sql(x, y)
    return F.expr(lon), F.expr(lat)


def same_system(*geometries: Column) -> Column:
    """The reference system that all geometries (with a field srid) have; reading it raises where they don't have one and the same."""
    first, *others = [g.srid for g in geometries]
    mixed = first.isNull()
    for other in others:
        mixed = mixed | ~first.eqNullSafe(other)
    said = F.concat_ws(", ", *[F.coalesce(g.srid.cast("string"), F.lit("none")) for g in geometries])
    return F.when(mixed, F.raise_error(F.concat(F.lit("geometries of different reference systems: "), said)).cast("int")).otherwise(first)


def transformed(df: DataFrame, column: str, srid: int) -> DataFrame:
    """df with a point column (struct<srid, x, y>) in another reference system. A point that is there already stays; a null stays null; any other system raises."""
    if srid not in (DEGREES, GRID):
        raise ValueError(f"only {DEGREES} and {GRID} are known")
    x, y = f"`{column}`.x", f"`{column}`.y"
    point, there = F.col(column), projected(x, y) if srid == GRID else unprojected(x, y)
    other = DEGREES if srid == GRID else GRID
    tag = F.lit(srid).cast(df.schema[column].dataType["srid"].dataType).alias("srid")
    moved = F.struct(tag, there[0].alias("x"), there[1].alias("y"))
    unknown = F.raise_error(F.concat(F.lit("unknown reference system: "), F.coalesce(point.srid.cast("string"), F.lit("none")))).cast("int")
    same = F.struct(tag, point.x.alias("x"), point.y.alias("y"))
    checked = F.when(point.srid.isin(DEGREES, GRID), point.srid).otherwise(unknown)
    return df.withColumn(column, F.when(point.isNotNull(), F.when(checked == other, moved).otherwise(same)))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def cell(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def around(size_x: Column, size_y: Column) -> Column:
    """The nine cells at and around a cell, as structs (cx, cy)."""
    return F.array(*[F.struct((size_x + i).alias("cx"), (size_y + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def edges(ring: Column) -> Column:
    """The sides of a ring, whether or not its first corner is repeated at its end."""
    return F.arrays_zip(ring.alias("p"), F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1))).alias("q"))


def crossings(x: Column, y: Column, ring: Column) -> Column:
    """How many sides of a ring a ray from a point to the right crosses."""
    crosses = lambda e: ((e["0"].y > y) != (e["1"].y > y)) & (x < (e["1"].x - e["0"].x) * (y - e["0"].y) / (e["1"].y - e["0"].y) + e["0"].x)
    return F.size(F.filter(F.filter(_sides(ring), lambda e: e["0"].y != e["1"].y), crosses))


def on_side(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies on a side of a ring."""

    def on(e: Column) -> Column:
        p, q = e["0"], e["1"]
        level = (q.x - p.x) * (y - p.y) == (q.y - p.y) * (x - p.x)
        return level & x.between(F.least(p.x, q.x), F.greatest(p.x, q.x)) & y.between(F.least(p.y, q.y), F.greatest(p.y, q.y))

    return F.exists(_sides(ring), on)


def inside(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies within a ring; points on its sides don't."""
    return (crosses_odd(x, y, F.array(ring))) & ~on_side(x, y, ring)


def crosses_odd(x: Column, y: Column, rings: Column) -> Column:
    return F.aggregate(rings, F.lit(0), lambda n, r: n + crossings(x, y, r)) % 2 == 1


def inside_rings(x: Column, y: Column, rings: Column) -> Column:
    """Whether a point lies within a polygon with holes or a multipolygon, given as all of its rings; points on a side of any don't."""
    return crosses_odd(x, y, rings) & ~F.exists(rings, lambda r: on_side(x, y, r))


def flat_sides(rings: Column) -> Column:
    """The sides of all rings as array<struct<x0, y0, x1, y1>>, worked out once for many points."""
    flat = lambda e: F.struct(e["0"].x.alias("x0"), e["0"].y.alias("y0"), e["1"].x.alias("x1"), e["1"].y.alias("y1"))
    return F.flatten(F.transform(rings, lambda r: F.transform(_sides(r), flat)))


def turn(p: Column, q: Column, r: Column) -> Column:
    """1 if the way from p by q to r turns left, -1 if right, 0 if it goes straight."""
    return F.signum((q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x))


def sides_meet(e: Column, f: Column) -> Column:
    """Whether two sides have a point in common."""
    p, q, r, s = e["0"], e["1"], f["0"], f["1"]
    within = lambda a, b, c: c.x.between(F.least(a.x, b.x), F.greatest(a.x, b.x)) & c.y.between(F.least(a.y, b.y), F.greatest(a.y, b.y))
    t1, t2, t3, t4 = turn(p, q, r), turn(p, q, s), turn(r, s, p), turn(r, s, q)
    apart = (t1 != t2) & (t3 != t4)
    return apart | ((t1 == 0) & within(p, q, r)) | ((t2 == 0) & within(p, q, s)) | ((t3 == 0) & within(r, s, p)) | ((t4 == 0) & within(r, s, q))


def rings_meet(a: Column, b: Column) -> Column:
    """Whether two simple rings' areas have a point in common, be it on their sides."""
    corner = lambda ring, other: crosses_odd(F.element_at(ring, 1).x, F.element_at(ring, 1).y, F.array(other))
    return F.exists(_sides(a), lambda e: F.exists(_sides(b), lambda f: sides_meet(e, f))) | corner(a, b) | corner(b, a)


def is_simple(ring: Column) -> Column:
    """Whether a ring has three corners or more, an area, and no sides that meet but at the corner that neighbours share."""

    def checked(sides: Column) -> Column:
        n = F.size(sides)
        far = lambda e, f: (F.abs(e.i - f.i) > 1) & (F.abs(e.i - f.i) < n - 1)
        return (n >= 3) & ~F.exists(sides, lambda e: F.exists(sides, lambda f: far(e, f) & sides_meet(e, f)))

    numbered = F.transform(_sides(repaired(ring)), lambda e, i: F.struct(e["0"].alias("0"), e["1"].alias("1"), i.alias("i")))
    return let(numbered, checked) & (area(ring) > 0)


def point_on_surface(ring: Column) -> Column:
    """A point within a simple ring: the middle of the longest stretch inside at a height between its corners; null without area."""

    def between(ys: Column) -> Column:
        middle = F.floor(F.size(ys) / 2).cast("int")
        return (F.get(ys, middle) + F.get(ys, middle - 1)) / 2  # no corner is at this height

    def widest(xs: Column) -> Column:
        places = F.sequence(F.lit(0), (F.size(xs) / 2).cast("int") - 1)
        return F.array_max(F.transform(places, lambda i: F.struct((F.get(xs, 2 * i + 1) - F.get(xs, 2 * i)).alias("w"), F.get(xs, 2 * i).alias("x"))))

    def at_height(y: Column) -> Column:
        cut = F.filter(_sides(ring), lambda e: (e["0"].y > y) != (e["1"].y > y))
        xs = F.array_sort(F.transform(cut, lambda e: e["0"].x + (y - e["0"].y) * (e["1"].x - e["0"].x) / (e["1"].y - e["0"].y)))
        return let(let(xs, widest), lambda s: F.struct((s.x + s.w / 2).alias("x"), y.alias("y")))

    ys = F.array_sort(F.array_distinct(F.transform(ring, lambda p: p.y)))
    return F.when(area(ring) > 0, let(let(ys, between), at_height))


def hull(points: Column) -> Column:
    """The corners of the least convex ring around an array of points, counter-clockwise; its ends for points on a line."""
    ordered = F.array_sort(F.array_distinct(points))
    none = F.array().cast("array<struct<x: double, y: double>>")

    def grown(chain: Column, p: Column) -> Column:
        # corners from the first one on that the new point doesn't see from the left drop out
        places = F.sequence(F.lit(1), F.size(chain) - 1)
        bad = lambda i: turn(F.element_at(chain, i), F.element_at(chain, i + 1), p) <= 0
        keep = F.when(F.size(chain) < 2, F.size(chain)).otherwise(F.coalesce(F.array_min(F.filter(places, bad)), F.size(chain)))
        return F.concat(F.slice(chain, F.lit(1), keep), F.array(p))

    lower = F.aggregate(ordered, none, grown)
    upper = F.aggregate(F.reverse(ordered), none, grown)
    open_end = lambda c: F.slice(c, F.lit(1), F.size(c) - 1)
    return F.when(F.size(ordered) < 2, ordered).otherwise(F.concat(open_end(lower), open_end(upper)))


def tagged(geometry: Column, srid: int, kind: str) -> Column:
    """A geometry with its reference system and its type."""
    return F.struct(F.lit(srid).alias("srid"), F.lit(kind).alias("type"), geometry.alias("geometry"))


def _sides(ring: Column) -> Column:
    after = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))
    return F.zip_with(ring, after, lambda p, q: F.struct(p.alias("0"), q.alias("1")))


def area(ring: Column) -> Column:
    """Of a simple ring, by the shoelace formula."""
    return F.abs(F.aggregate(_sides(ring), F.lit(0.0), lambda s, e: s + (e["0"].x * e["1"].y - e["1"].x * e["0"].y))) / 2


def repaired(ring: Column) -> Column:
    """A ring without repeated neighbours and without its first corner at its end."""
    open_ring = F.when((F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1)), F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)
    return F.filter(open_ring, lambda p, i: (i == 0) | (p != F.get(open_ring, i - 1)))


def centroid(ring: Column) -> Column:
    """Of a simple ring's area; null for a ring without area."""
    cross = lambda e: e["0"].x * e["1"].y - e["1"].x * e["0"].y
    total = lambda f: F.aggregate(_sides(ring), F.lit(0.0), f)
    twice = total(lambda s, e: s + cross(e))
    return F.when(
        twice != 0,
        F.struct(
            (total(lambda s, e: s + (e["0"].x + e["1"].x) * cross(e)) / (3 * twice)).alias("x"),
            (total(lambda s, e: s + (e["0"].y + e["1"].y) * cross(e)) / (3 * twice)).alias("y"),
        ),
    )


def clipped(subject: Column, window: Column) -> Column:
    """The part of a ring inside a convex counter-clockwise ring, side by side of the latter; empty if they don't meet."""

    def cut(ring: Column, e: Column) -> Column:
        side = lambda p: (e["1"].x - e["0"].x) * (p.y - e["0"].y) - (e["1"].y - e["0"].y) * (p.x - e["0"].x)

        def step(s: Column) -> Column:
            a, b = s["0"], s["1"]
            t = side(a) / F.nullif(side(a) - side(b), F.lit(0.0))
            meet = F.struct((a.x + t * (b.x - a.x)).alias("x"), (a.y + t * (b.y - a.y)).alias("y"))
            crossing = (side(a) >= 0) != (side(b) >= 0)
            none = F.array().cast("array<struct<x: double, y: double>>")
            return F.concat(F.when(crossing, F.array(meet)).otherwise(none), F.when(side(b) >= 0, F.array(F.struct(b.x.alias("x"), b.y.alias("y")))).otherwise(none))

        return F.flatten(F.transform(_sides(ring), step))

    return F.aggregate(_sides(window), subject.cast("array<struct<x: double, y: double>>"), cut)
