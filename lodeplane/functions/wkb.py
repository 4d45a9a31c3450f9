"""Polygons from and to well-known binary and GeoJSON: all rings of a geometry, holes and parts alike, first corners not repeated."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeplane.functions.overlay import RINGS, from_arrow

GEOMETRY = T.StructType([T.StructField("srid", T.IntegerType()), T.StructField("type", T.StringType()), T.StructField("rings", RINGS)])
#: Fixed values of the standard: numbers of the types that have coordinates.
TYPES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}
#: Fixed values of the extended form: marks of a type number for heights, measures and a reference system.
HAS_Z, HAS_M, HAS_SRID = 0x80000000, 0x40000000, 0x20000000
#: Bytes of the box in a GeoPackage header, by its number.
BOX_BYTES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}

_PART = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


class _Reader:
    def __init__(self, raw: bytes) -> None:
        self.raw, self.at, self.srid = raw, 0, None

    def take(self, order: str, kind: str) -> int:
        (value,) = struct.unpack_from(order + kind, self.raw, self.at)
        self.at += struct.calcsize(order + kind)
        return value

    def corners(self, order: str, n: int, dims: int) -> np.ndarray:
        """n corners, without heights and measures."""
        found = np.frombuffer(self.raw, f"{order}f8", n * dims, self.at).reshape(n, dims)[:, :2]
        self.at += n * dims * 8
        return found.astype(float)

    def geometry(self) -> tuple[int, list[np.ndarray]]:
        order = "<" if self.take("<", "B") else ">"
        code = self.take(order, "I")
        if code & HAS_SRID:
            self.srid = self.take(order, "i")
        plain = code & 0x0FFFFFFF
        dims = 2 + bool(code & HAS_Z) + bool(code & HAS_M) + (0, 1, 1, 2)[plain // 1000]
        kind = plain % 1000
        if kind == 1:
            return kind, [self.corners(order, 1, dims)]
        n = self.take(order, "I")
        if kind == 2:
            return kind, [self.corners(order, n, dims)]
        if kind == 3:
            return kind, [_open(self.corners(order, self.take(order, "I"), dims)) for _ in range(n)]
        if kind not in TYPES:
            raise ValueError(f"type {kind}")
        return kind, [r for _ in range(n) for r in self.geometry()[1]]


def _open(ring: np.ndarray) -> np.ndarray:
    return ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring


def decoded(raw: bytes) -> tuple[int | None, str, list[np.ndarray]]:
    """Reference system (if the bytes name one), type and rings. Raises for anything but a whole geometry of known type."""
    reader = _Reader(raw)
    if raw[:2] == b"GP":
        flags = raw[3]
        reader.at = 4
        reader.srid = reader.take("<" if flags & 1 else ">", "i")
        reader.at += BOX_BYTES[flags >> 1 & 7]
    kind, rings = reader.geometry()
    if reader.at != len(raw):
        raise ValueError("bytes are left")
    return reader.srid, TYPES[kind], rings


def parts(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons, each its outer ring and its holes, of rings that don't cross: a ring within an even number of others is an outer one."""

    def within(a: np.ndarray, b: np.ndarray) -> bool:
        """Whether ring a is in ring b, by a corner of a that isn't on a side of b, or else the middle of a side."""
        p, q = b, np.roll(b, -1, 0)
        for x, y in np.concatenate((a, (a + np.roll(a, -1, 0)) / 2)):
            cross = (q[:, 0] - p[:, 0]) * (y - p[:, 1]) - (q[:, 1] - p[:, 1]) * (x - p[:, 0])
            on = (cross == 0) & (np.minimum(p, q) <= (x, y)).all(1) & (np.maximum(p, q) >= (x, y)).all(1)
            if not on.any():
                rising = (p[:, 1] > y) != (q[:, 1] > y)
                left = rising & ((cross > 0) == (q[:, 1] > p[:, 1]))
                return bool(left.sum() % 2)
        return False

    around = [[j for j in range(len(rings)) if j != i and within(rings[i], rings[j])] for i in range(len(rings))]
    out = {i: [rings[i]] for i in range(len(rings)) if len(around[i]) % 2 == 0}
    for i, found in enumerate(around):
        if len(found) % 2:
            out[max(found, key=lambda j: len(around[j]))].append(rings[i])  # the innermost ring around a hole
    return list(out.values())


def encoded(rings: list[np.ndarray], srid: int | None = None, big_endian: bool = False) -> bytes:
    """A polygon, or a multipolygon if there is more than one part, in extended form where a reference system is given."""
    order, mark = (">", b"\0") if big_endian else ("<", b"\1")

    def polygon(part: list[np.ndarray], tag: bytes) -> bytes:
        closed = [np.concatenate((r, r[:1])) for r in part]
        body = b"".join(struct.pack(order + "I", len(r)) + r.astype(f"{order}f8").tobytes() for r in closed)
        return head(3, tag) + struct.pack(order + "I", len(part)) + body

    def head(kind: int, tag: bytes) -> bytes:
        return mark + struct.pack(order + "I", kind | (HAS_SRID if tag else 0)) + tag

    tag, found = b"" if srid is None else struct.pack(order + "i", srid), parts(rings)
    if len(found) == 1:
        return polygon(found[0], tag)
    return head(6, tag) + struct.pack(order + "I", len(found)) + b"".join(polygon(p, b"") for p in found)


@F.arrow_udf(GEOMETRY)
def from_wkb(raw: pa.Array) -> pa.Array:
    """struct<srid, type, rings> of well-known binary of either byte order, plain, extended or with a GeoPackage header; null where the bytes aren't one whole geometry.

    Points and lines are one ring of their corners each. Heights and measures are left out.
    """
    out = []
    for x in raw.to_pylist():
        try:
            srid, kind, rings = decoded(x) if x is not None else (None, None, None)
        except (ValueError, IndexError, KeyError, struct.error):
            kind = None
        out.append(None if kind is None else {"srid": srid, "type": kind, "rings": [[{"x": a, "y": b} for a, b in r.tolist()] for r in rings]})
    return pa.array(out, pa.struct([("srid", pa.int32()), ("type", pa.string()), ("rings", _PART)]))


@F.arrow_udf(T.BinaryType())
def _to_wkb(rings: pa.Array, srid: pa.Array, big_endian: pa.Array) -> pa.Array:
    rows = zip(rings.is_valid().to_pylist(), from_arrow(rings), srid.to_pylist(), big_endian.to_pylist(), strict=True)
    return pa.array([encoded([_open(r) for r in x], s, bool(b)) if there else None for there, x, s, b in rows], pa.binary())


def to_wkb(rings: Column, srid: Column | None = None, big_endian: Column | None = None) -> Column:
    """Well-known binary of a polygon's rings; null for null."""
    return _to_wkb(rings, F.lit(None).cast("int") if srid is None else srid, F.lit(False) if big_endian is None else big_endian)


@F.arrow_udf(T.ArrayType(RINGS))
def polygon_parts(rings: pa.Array) -> pa.Array:
    """The polygons of rings, each an array of its outer ring and its holes."""
    rows = [[[[{"x": a, "y": b} for a, b in r.tolist()] for r in part] for part in parts([_open(r) for r in x])] if there else None for there, x in zip(rings.is_valid().to_pylist(), from_arrow(rings), strict=True)]
    return pa.array(rows, pa.list_(_PART))


def from_geojson(geometry: Column) -> Column:
    """The rings of a GeoJSON geometry's text, a Polygon or a MultiPolygon; null for any other."""
    kind, text = F.get_json_object(geometry, "$.type"), F.get_json_object(geometry, "$.coordinates")
    one = F.from_json(text, "array<array<array<double>>>")
    many = F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    corner = lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
    opened = lambda r: F.when((F.size(r) > 1) & (F.element_at(r, 1) == F.element_at(r, -1)), F.slice(r, F.lit(1), F.size(r) - 1)).otherwise(r)
    rings = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many)
    return F.transform(rings, lambda r: opened(F.transform(r, corner)))


def to_geojson(rings: Column) -> Column:
    """A MultiPolygon's text, with holes behind the rings around them and first corners repeated."""
    closed = lambda r: F.concat(F.transform(r, lambda p: F.array(p.x, p.y)), F.array(F.array(F.get(r, F.lit(0)).x, F.get(r, F.lit(0)).y)))
    coordinates = F.transform(polygon_parts(rings), lambda part: F.transform(part, closed))
    return F.when(rings.isNotNull(), F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))))
