"""Areas that two polygons share, join or leave, and polygons that cross themselves, by the arrangement of their sides.

A polygon is all of its rings, holes and parts alike, and what an odd number of rings surround is inside. Sides are split where they meet; a
piece is kept where the result lies on one side of it alone, with the result on its left; pieces are tied into rings. So outer rings
of a result run counter-clockwise and holes clockwise, no ring meets itself, and the signed areas of its rings add up to its area.
Work and memory grow with the square of one pair's number of sides, in slices of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RINGS = T.ArrayType(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
#: Sides times sides that are compared at once.
COMPARED = 1 << 20
#: Corners nearer than the extent by so much are one: a power of two, so that corners on whole numbers stay exact.
FINENESS = 2.0**-36

KEEP = {
    "intersection": lambda a, b: a & b,
    "union": lambda a, b: a | b,
    "difference": lambda a, b: a & ~b,
    "symmetric_difference": lambda a, b: a ^ b,
}


def _sides(rings: list[np.ndarray]) -> np.ndarray:
    """Sides (x0, y0, x1, y1) of rings whether or not their first corner is repeated at their end."""
    found = [np.hstack((r, np.roll(r, -1, 0))) for r in rings if len(r)]
    sides = np.concatenate(found) if found else np.zeros((0, 4))
    return sides[(sides[:, :2] != sides[:, 2:]).any(1)]


def _pieces(sides: np.ndarray, grain: float) -> tuple[np.ndarray, np.ndarray]:
    """Sides split at each other's ends and where they cross, and the side of each piece."""
    p, d = sides[:, :2], sides[:, 2:] - sides[:, :2]
    corners = np.unique(np.concatenate((p, sides[:, 2:])), axis=0)
    length2, places = (d * d).sum(1), [[0.0, 1.0] for _ in sides]
    step = max(1, COMPARED // max(len(sides), len(corners)))
    for at in range(0, len(sides), step):
        own = slice(at, at + step)
        # corners on a side
        to = corners[None] - p[own, None]
        t = (to * d[own, None]).sum(2) / length2[own, None]
        off = np.abs(to[..., 0] * d[own, None, 1] - to[..., 1] * d[own, None, 0])
        for i, j in zip(*np.nonzero((off <= grain * np.sqrt(length2[own, None])) & (t > 0) & (t < 1)), strict=True):
            places[at + i].append(t[i, j])
        # sides that cross within both
        cross = d[own, None, 0] * d[None, :, 1] - d[own, None, 1] * d[None, :, 0]
        gap = p[None] - p[own, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (gap[..., 0] * d[None, :, 1] - gap[..., 1] * d[None, :, 0]) / cross
            u = (gap[..., 0] * d[own, None, 1] - gap[..., 1] * d[own, None, 0]) / cross
        for i, j in zip(*np.nonzero((cross != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)), strict=True):
            places[at + i].append(t[i, j])
    out, of = [], []
    for i, found in enumerate(places):
        x = p[i] + np.unique(found)[:, None] * d[i]
        x[0], x[-1] = sides[i, :2], sides[i, 2:]
        x = np.round(x / grain) * grain
        out.append(np.hstack((x[:-1], x[1:])))
        of += [i] * (len(x) - 1)
    pieces, of = np.concatenate(out), np.array(of)
    real = (pieces[:, :2] != pieces[:, 2:]).any(1)
    return pieces[real], of[real]


def _parities(pieces: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """For each piece and polygon, whether what lies above it (to the right of it, if it's upright) is inside. Pieces run up or right."""
    x0, y0, x1, y1 = pieces.T
    upright, middle = x0 == x1, ((x0 + x1) / 2, (y0 + y1) / 2)
    inside = np.zeros(odd.shape, bool)
    step = max(1, COMPARED // max(len(pieces), 1))
    low, high = np.minimum(y0, y1), np.maximum(y0, y1)
    for at in range(0, len(pieces), step):
        own = np.arange(at, min(at + step, len(pieces)))
        mx, my = middle[0][own, None], middle[1][own, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            above = (x0 <= mx) & (mx < x1) & (y0 + (mx - x0) * (y1 - y0) / (x1 - x0) > my)
            right = (low <= my) & (my < high) & (x0 + (my - y0) * (x1 - x0) / (y1 - y0) > mx)
        hit = np.where(upright[own, None], right, above)
        hit[np.arange(len(own)), own] = False
        inside[own] = (hit.astype(np.int64) @ odd.astype(np.int64)) % 2 == 1
    return inside


def _rings(pieces: np.ndarray) -> list[np.ndarray]:
    """Directed pieces tied into rings: the sharpest left turn at each corner, and a loop is cut off where a corner comes again."""
    leaving: dict[tuple[float, float], list[int]] = {}
    for i, piece in enumerate(pieces):
        leaving.setdefault((piece[0], piece[1]), []).append(i)
    angle = np.arctan2(pieces[:, 3] - pieces[:, 1], pieces[:, 2] - pieces[:, 0])
    used, out = np.zeros(len(pieces), bool), []
    for first in range(len(pieces)):
        way: list[tuple[float, float]] = []
        at = first
        while not used[at]:
            used[at] = True
            start, end = (pieces[at, 0], pieces[at, 1]), (pieces[at, 2], pieces[at, 3])
            way.append(start)
            if end in way:
                k = way.index(end)
                out.append(np.array(way[k:]))
                way = way[:k]
            open_ways = [i for i in leaving.get(end, ()) if not used[i]]
            if not open_ways:
                break
            at = max(open_ways, key=lambda i: (angle[i] - angle[at] + np.pi) % (2 * np.pi))
    return [r for r in out if len(r) > 2]


def _straightened(ring: np.ndarray) -> np.ndarray:
    """A ring without corners that its neighbours' line goes through."""
    before, after = ring - np.roll(ring, 1, 0), np.roll(ring, -1, 0) - ring
    return ring[before[:, 0] * after[:, 1] != before[:, 1] * after[:, 0]]


def overlaid(a: list[np.ndarray], b: list[np.ndarray], how: str) -> list[np.ndarray]:
    """The rings of the intersection, union, difference or symmetric difference of two polygons; how=valid only with an empty b."""
    return sides_overlaid(_sides(a), _sides(b), how)


def sides_overlaid(sides_a: np.ndarray, sides_b: np.ndarray, how: str) -> list[np.ndarray]:
    """`overlaid` of polygons given as their sides (x0, y0, x1, y1)."""
    sides = np.concatenate((sides_a, sides_b))
    if not len(sides):
        return []
    origin = np.round(sides.reshape(-1, 2).min(0))
    sides = sides - np.tile(origin, 2)
    grain = 2.0 ** np.ceil(np.log2(max(np.abs(sides).max(), 1e-300))) * FINENESS
    pieces, of = _pieces(sides, grain)
    back = (pieces[:, 0] > pieces[:, 2]) | ((pieces[:, 0] == pieces[:, 2]) & (pieces[:, 1] > pieces[:, 3]))
    pieces[back] = pieces[back][:, [2, 3, 0, 1]]
    pieces, at = np.unique(pieces, axis=0, return_inverse=True)
    odd = np.stack([np.bincount(at.ravel(), of < len(sides_a), len(pieces)), np.bincount(at.ravel(), of >= len(sides_a), len(pieces))], 1) % 2 == 1
    pieces, odd = pieces[odd.any(1)], odd[odd.any(1)]
    if not len(pieces):
        return []
    one = _parities(pieces, odd)
    keep = KEEP[how]
    here, there = keep(*one.T), keep(*(one ^ odd).T)
    upright = pieces[:, 0] == pieces[:, 2]
    forward = np.where(upright, there, here)  # what is on the left of a piece that runs up or right
    edge = here != there
    directed = np.where(forward[:, None], pieces, pieces[:, [2, 3, 0, 1]])[edge]
    return [x + origin for x in map(_straightened, _rings(directed)) if len(x) > 2]


#: Results that a worker remembers, of polygons with at most so many corners together.
HELD, HELD_CORNERS = 10_000, 200
_held: dict[tuple, list[np.ndarray]] = {}


def overlaid_once(a: list[np.ndarray], b: list[np.ndarray], how: str) -> list[np.ndarray]:
    """`overlaid`, worked out once for shapes that lie to each other in one way, wherever they are."""
    rings = [r for r in (*a, *b) if len(r)]
    if not rings or sum(map(len, rings)) > HELD_CORNERS:
        return overlaid(a, b, how)
    origin = np.round(np.concatenate(rings).min(0))
    a, b = [r - origin for r in a], [r - origin for r in b]
    key = how, tuple(r.tobytes() for r in a), tuple(r.tobytes() for r in b)
    if key not in _held:
        if len(_held) >= HELD:
            _held.clear()
        _held[key] = overlaid(a, b, how)
    return [r + origin for r in _held[key]]


#: Polygons whose valid sides a worker remembers, by their corners from a place of their own.
_valid: dict[tuple, tuple[np.ndarray, float]] = {}


def valid_sides(rings: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
    """The sides (x0, y0, x1, y1) of each row's rings made valid, in their direction, and their area: worked out once for shapes that differ in their place only."""
    if isinstance(rings, pa.ChunkedArray):
        rings = pa.concat_arrays(rings.chunks)
    of_rings, corners = rings.flatten(), rings.flatten().flatten()
    if rings.null_count or of_rings.null_count or corners.null_count or any(corners.field(c).null_count for c in (0, 1)):
        rows = from_arrow(rings)
    else:
        xy = np.stack([corners.field(c).to_numpy() for c in (0, 1)], 1)
        cuts = np.concatenate(([0], np.cumsum(pc.list_value_length(of_rings).to_numpy(zero_copy_only=False))))
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(rings).to_numpy(zero_copy_only=False))))
        rows = [[xy[i:j] for i, j in zip(cuts[a:b], cuts[a + 1 : b + 1], strict=True)] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    sides, areas = [], np.zeros(len(rows))
    for k, row in enumerate(rows):
        row = [r for r in row if len(r)]
        if not row:
            sides.append(np.zeros((0, 4)))
            continue
        flat = np.concatenate(row)
        origin = np.round(flat.min(0))
        flat = flat - origin
        key = *map(len, row), flat.tobytes()
        found = _valid.get(key)
        if found is None:
            valid = overlaid(np.split(flat, np.cumsum([len(r) for r in row])[:-1]), [], "union")
            found = _sides(valid), sides_area(valid)
            if len(flat) <= HELD_CORNERS:
                if len(_valid) >= HELD:
                    _valid.clear()
                _valid[key] = found
        sides.append(found[0] + np.tile(origin, 2))
        areas[k] = found[1]
    flat = np.concatenate([np.zeros((0, 4)), *sides])
    kind = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in flat.T], ["x0", "y0", "x1", "y1"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(x) for x in sides]))), pa.int32()), kind), areas


class ValidSides:
    """Polygons of a block as arrays: the sides, in their direction, of rings as `made_valid` gives them, given as lists of structs (x0, y0, x1, y1).

    Sides that aren't upright are also held as matrices, a row a polygon, by their number rounded up: `held[width]` has x0 < x1, y at x0, the slope and 1 for what has the inside below, -1 above.
    """

    def __init__(self, lists: pa.ListArray | pa.ChunkedArray) -> None:
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
        offsets = lists.offsets.to_numpy()
        self.offsets, rows = offsets - offsets[0], len(lists)
        flat = lists.flatten()
        self.sides = np.stack([pc.cast(flat.field(c), pa.float64()).to_numpy(zero_copy_only=False) for c in range(4)], 1)
        of = np.repeat(np.arange(rows), np.diff(self.offsets))
        x0, y0, x1, y1 = self.sides.T
        box = np.full((4, rows), np.nan)
        if len(of):
            starts, some = self.offsets[:-1][np.diff(self.offsets) > 0], np.diff(self.offsets) > 0
            for k, (f, c) in enumerate(((np.minimum, x0), (np.maximum, x0), (np.minimum, y0), (np.maximum, y0))):
                box[k, some] = f.reduceat(c, starts)
        self.box = box
        # products and sums of such coordinates are exact
        plain = ((x0 == x1) | (y0 == y1)) & (self.sides == np.round(self.sides)).all(1) & (np.abs(self.sides) < 1 << 24).all(1)
        self.exact = np.bincount(of, ~plain, rows) == 0
        lies = x0 != x1
        at = of[lies]
        n = np.bincount(at, minlength=rows)
        step = 2 ** np.maximum(np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64) - 3, 0)
        self.width = -(-n // step) * step
        self.place, self.held = np.zeros(rows, np.int64), {}
        back = x1[lies] < x0[lies]
        left_x, right_x = np.minimum(x0[lies], x1[lies]), np.maximum(x0[lies], x1[lies])
        left_y, right_y = np.where(back, y1[lies], y0[lies]), np.where(back, y0[lies], y1[lies])
        column = np.arange(len(at)) - (np.cumsum(n) - n)[at]
        for width in np.unique(self.width[n > 0]):
            own = np.flatnonzero((self.width == width) & (n > 0))
            self.place[own] = np.arange(len(own))
            here = self.width[at] == width
            cells = self.place[at[here]], column[here]
            held = np.zeros((5, len(own), width))
            for k, v in enumerate((left_x[here], right_x[here], left_y[here], (right_y - left_y)[here] / (right_x - left_x)[here], np.where(back[here], 1.0, -1.0))):
                held[k][cells] = v
            self.held[int(width)] = held

    def of(self, k: int) -> np.ndarray:
        return self.sides[self.offsets[k] : self.offsets[k + 1]]


def _below_both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row the signed sum, over each side of a and of b, of the area that lies below both: that of what is inside both polygons."""
    (ax0, ax1, ay, at, sa), (bx0, bx1, by, bt, sb) = (x[..., None] for x in a), (x[:, None] for x in b)
    start = np.maximum(ax0, bx0)
    wide = np.maximum(np.minimum(ax1, bx1) - start, 0.0)
    if not (a[3].any() or b[3].any()):
        low = np.minimum(ay, by)
    else:
        ya, yb = ay + (start - ax0) * at, by + (start - bx0) * bt
        first, last = ya - yb, ya - yb + wide * (at - bt)
        with np.errstate(divide="ignore", invalid="ignore"):
            apart = np.where((first < 0) != (last < 0), (first * first + last * last) / (2 * (np.abs(first) + np.abs(last))), np.abs(first + last) / 2)
        apart[(first == 0) & (last == 0)] = 0.0
        low = (ya + yb + wide * (at + bt) / 2 - apart) / 2
    return np.einsum("ni,nij,nj->n", a[4], wide * low, b[4]) if low.shape[1] * low.shape[2] > 64 else (wide * low * (sa * sb)).sum((1, 2))


def shared_areas(a: ValidSides, b: ValidSides, i: np.ndarray, j: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
    """The areas that polygons at places i of a and j of b share, whose boxes meet.

    Each is a sum over their sides. Where rounding could decide whether there is one, or whether it reaches `limit`, the two are overlaid.
    """
    out, width_a, width_b = np.zeros(len(i)), a.width[i], b.width[j]
    for wa, wb in {*zip(width_a.tolist(), width_b.tolist(), strict=True)} if len(a.held) * len(b.held) > 1 else {(w, v) for w in a.held for v in b.held}:
        if not (wa and wb):
            continue
        own = np.flatnonzero((width_a == wa) & (width_b == wb))
        step, part = max(1, (COMPARED >> 3) // (wa * wb)), max(1, COMPARED // wb)
        for at in range(0, len(own), step):
            k = own[at : at + step]
            x, y = a.held[wa][:, a.place[i[k]]], b.held[wb][:, b.place[j[k]]]
            base = a.box[2, i[k], None]  # heights are taken from here, so that they are small
            x[2] -= base
            y[2] -= base
            for first in range(0, wa, part):
                out[k] += _below_both(x[:, :, first : first + part], y)
    doubtful = np.flatnonzero(~(a.exact[i] & b.exact[j]))
    if len(doubtful):
        p, q = a.box[:, i[doubtful]], b.box[:, j[doubtful]]
        extent = np.maximum(np.maximum(p[1::2], q[1::2]) - np.minimum(p[::2], q[::2]), 0).max(0)
        grain = extent * FINENESS * 4 * (np.minimum(p[1::2], q[1::2]) - np.maximum(p[::2], q[::2])).max(0)
        near = out[doubtful] <= grain
        if limit is not None:
            near |= np.abs(out[doubtful] - limit[doubtful]) <= grain
        for k in doubtful[near]:
            out[k] = sides_area(sides_overlaid(a.of(i[k]), b.of(j[k]), "intersection"))
    return out


def sides_area(rings: list[np.ndarray]) -> float:
    """The area of rings as `overlaid` gives them."""
    return float(sum((r[:, 0] * np.roll(r[:, 1], -1) - np.roll(r[:, 0], -1) * r[:, 1]).sum() for r in (x - x[0] for x in rings)) / 2)


def from_arrow(rings: pa.Array) -> list[list[np.ndarray]]:
    """The rings of each row; null rows, rings and corners are left out."""
    return [[np.array([(p["x"], p["y"]) for p in ring if p is not None and p["x"] is not None and p["y"] is not None], float).reshape(-1, 2) for ring in row or () if ring] for row in rings.to_pylist()]


def to_arrow(rows: list[list[np.ndarray] | None]) -> pa.Array:
    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    return pa.array([None if row is None else [[{"x": x, "y": y} for x, y in ring.tolist()] for ring in row] for row in rows], kind)


@F.arrow_udf(RINGS)
def _overlay(a: pa.Array, b: pa.Array, how: pa.Array) -> pa.Array:
    none = [not (x and y) for x, y in zip(a.is_valid().to_pylist(), b.is_valid().to_pylist(), strict=True)]
    return to_arrow([None if gone else overlaid_once(x, y, h) for gone, x, y, h in zip(none, from_arrow(a), from_arrow(b), how.to_pylist(), strict=True)])


def overlay(a: Column, b: Column, how: str = "intersection") -> Column:
    """The rings of what two polygons (all their rings, arrays of struct<x, y>) share, or of their union, difference or symmetric difference.

    Null if either is null; empty if the result is. Touching polygons share no area, so their intersection is empty.
    """
    if how not in KEEP:
        raise ValueError(f"how must be one of {sorted(KEEP)}")
    return _overlay(a, b, F.lit(how))


def made_valid(rings: Column) -> Column:
    """The same even-odd area in rings that don't meet themselves or each other but in corners: bow-ties become parts, spikes and repeated corners go."""
    return _overlay(rings, F.array().cast(RINGS), F.lit("union"))


def rings_area(rings: Column) -> Column:
    """The area of rings as `overlay` and `made_valid` give them: counter-clockwise ones less clockwise ones."""
    cross = lambda r: F.aggregate(F.zip_with(r, F.concat(F.slice(r, F.lit(2), F.size(r)), F.slice(r, F.lit(1), F.lit(1))), lambda p, q: p.x * q.y - q.x * p.y), F.lit(0.0), lambda s, c: s + c)
    return F.aggregate(rings, F.lit(0.0), lambda s, r: s + cross(r)) / 2
