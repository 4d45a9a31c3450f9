"""What records pick of others by the scores of their names and then by distance, group by group, as arrays: no two records are a row."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeplane.operators.spatial import blocked
from lodeplane.session import dealt_keys

#: Records of a side that are a group, and about as many as keys are dealt together for.
CROWD, TOGETHER = 1 << 15, 1 << 14
#: Targets up to which all of a class are looked at, as many as a cell should hold beyond that, and pairs or targets that are looked at once.
FEW, IN_CELL, AT_ONCE = 64, 8, 1 << 20
#: Sides of tiles that near records are dealt by, in reaches.
TILE = 4


def _spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of n each, one after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - n), n)


def _slices(n: np.ndarray) -> Iterator[slice]:
    """Slices of about AT_ONCE in all; what has more alone is a slice of its own."""
    ends, at = np.cumsum(n), 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
        yield slice(at, to)
        at = to


def nearest_of_class(g: np.ndarray, x: np.ndarray, y: np.ndarray, tg: np.ndarray, tx: np.ndarray, ty: np.ndarray, t: np.ndarray, reach: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
    """For each point (class g, x, y) the t of the nearest target (tg, tx, ty, t) of its class and the distance, the least t of several; -1 without one at most `reach` away.

    Coordinates are finite. A class with more than FEW targets is cut into cells with IN_CELL each on average; points look at the cells around theirs, then twice as far.
    """
    best, away = np.full(len(g), -1, np.int64), np.full(len(g), np.inf)
    if not (len(g) and len(tg)):
        return best, away
    order = np.lexsort((t, ty, tx, tg))
    tg, tx, ty, t = tg[order], tx[order], ty[order], t[order]
    # of targets at one place the least is the nearest
    new = np.concatenate(([True], (np.diff(tg) != 0) | (np.diff(tx) != 0) | (np.diff(ty) != 0)))
    tg, tx, ty, t = tg[new], tx[new], ty[new], t[new]
    classes = int(max(g.max(), tg.max())) + 1
    n = np.bincount(tg, minlength=classes)
    some = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[some]
    sides = np.where(n > FEW, np.sqrt(n / IN_CELL).astype(np.int64), 1)

    def axis(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, step = np.zeros(classes), np.ones(classes)
        low[some] = np.minimum.reduceat(v, starts)
        step[some] = (np.maximum.reduceat(v, starts) - low[some]) / sides[some]
        return low, np.where(step > 0, step, 1.0)

    (low_x, step_x), (low_y, step_y) = axis(tx), axis(ty)
    at = lambda v, k, low, step: np.clip(np.floor((v - low[k]) / step[k]), 0, sides[k] - 1).astype(np.int64)
    base = np.cumsum(sides * sides) - sides * sides
    key = base[tg] + at(ty, tg, low_y, step_y) * sides[tg] + at(tx, tg, low_x, step_x)
    order = np.argsort(key, kind="stable")
    key, tx, ty, t = key[order], tx[order], ty[order], t[order]
    slack = 1e-9 * max(float(np.abs(v).max()) for v in (x, y, tx, ty))

    def look(p: np.ndarray, far: int) -> None:
        """Look at all cells at most `far` cells from those of the points p."""
        k, m = g[p], sides[g[p]]
        cx, cy = at(x[p], k, low_x, step_x), at(y[p], k, low_y, step_y)
        rows = np.minimum(cy + far, m - 1) - np.maximum(cy - far, 0) + 1
        row, own = _spans(np.maximum(cy - far, 0), rows), np.repeat(np.arange(len(p)), rows)
        line = base[k[own]] + row * m[own]
        first = np.searchsorted(key, line + np.maximum(cx - far, 0)[own])
        count = np.searchsorted(key, line + np.minimum(cx + far, m - 1)[own], "right") - first
        for part in _slices(count):
            i, j = p[np.repeat(own[part], count[part])], _spans(first[part], count[part])
            if not len(i):
                continue
            dx, dy = x[i] - tx[j], y[i] - ty[j]
            d = np.sqrt(dx * dx + dy * dy)
            begin = np.flatnonzero(np.diff(i, prepend=-1))
            near = np.minimum.reduceat(d, begin)
            ids = np.where(d == np.repeat(near, np.diff(begin, append=len(i))), t[j], np.iinfo(np.int64).max)
            least, q = np.minimum.reduceat(ids, begin), i[begin]
            better = (near < away[q]) | ((near == away[q]) & (least < best[q])) | (best[q] < 0)
            best[q[better]], away[q[better]] = least[better], near[better]

    pending, far = np.flatnonzero(n[g]), 1
    while len(pending):
        look(pending, far)
        k, m = g[pending], sides[g[pending]]
        margin = np.full(len(pending), np.inf)
        for v, low, step in ((x[pending], low_x[k], step_x[k]), (y[pending], low_y[k], step_y[k])):
            c = np.clip(np.floor((v - low) / step), 0, m - 1)
            margin = np.minimum(margin, np.where(c - far <= 0, np.inf, v - (low + (c - far) * step)))
            margin = np.minimum(margin, np.where(c + far >= m - 1, np.inf, low + (c + far + 1) * step - v))
        # a target that wasn't looked at is farther than the margin
        pending = pending[(away[pending] >= margin - slack) & (margin - slack <= reach) & np.isfinite(margin)]
        far *= 2
    beyond = away > reach
    best[beyond], away[beyond] = -1, np.inf
    return best, away


def _classes(key: np.ndarray, name: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of equal (key, name): their codes, each row's class, and rows by class: order, first and number."""
    codes, of, n = np.unique(key * names + name, return_inverse=True, return_counts=True)
    return codes, of, np.argsort(of, kind="stable"), np.cumsum(n) - n, n


def _unplaced_least(g: np.ndarray, t: np.ndarray, classes: int) -> np.ndarray:
    out = np.full(classes, np.iinfo(np.int64).max)
    np.minimum.at(out, g, t)
    return out


def _farthest(g: np.ndarray, x: np.ndarray, y: np.ndarray, tg: np.ndarray, tx: np.ndarray, ty: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of class where the point, or each target, isn't finite: distances are infinite, or no number, which is farther. One by one, as there are hardly any."""
    best, away = np.full(len(g), -1, np.int64), np.full(len(g), np.nan)
    for i in range(len(g)):
        own = np.flatnonzero(tg == g[i])
        if len(own):
            with np.errstate(invalid="ignore"):
                d = np.sqrt((x[i] - tx[own]) ** 2 + (y[i] - ty[own]) ** 2)
            at = np.lexsort((t[own], d))[0]  # what is no number comes last
            best[i], away[i] = t[own[at]], d[at]
    return best, away


def picks(left: pa.Table, right: pa.Table, scores: dict[str, tuple[np.ndarray, ...]], reach: float | None) -> pa.Table:
    """Rows (l, vote, r, s, d): what each of left (key, l, name, x, y) picks of those of right (key, r, name, x, y) that have its key, by each vote.

    The right names of a key are taken from the best score on, those of one score together; of their records the nearest is picked, then one without a place (d is null), then
    the least r. With `reach`, only records at most so far away count, and the next score's names are looked at by the records that haven't found any.
    """
    right = right.take(pc.sort_indices(right["r"]))  # places then order as ids
    kind = lambda t, c: t.schema.field(c).type
    keys = np.unique(np.concatenate((left["key"].to_numpy(), right["key"].to_numpy())))
    place = {}
    for s, table in (("l", left), ("r", right)):
        xy = [table[c].to_numpy().astype(np.float64) for c in "xy"]
        known = ~(pc.is_null(table["x"]).to_numpy() | pc.is_null(table["y"]).to_numpy())
        place[s] = (*xy, known, known & np.isfinite(xy[0]) & np.isfinite(xy[1]))
    (x, y, known, finite), (tx, ty, t_known, t_finite) = place["l"], place["r"]
    l_key, r_key = (np.searchsorted(keys, t["key"].to_numpy()) for t in (left, right))
    empty = np.zeros(0, np.int64)
    found: list[tuple[np.ndarray, str, np.ndarray, np.ndarray, np.ndarray]] = []
    for vote, (ln, rn, start, to, score) in scores.items():
        def named(table: pa.Table, names: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            name = table["name"].to_numpy()
            at = np.minimum(np.searchsorted(names, name), len(names) - 1)
            rows = np.flatnonzero((names[at] == name) & ok)
            return rows, at[rows]

        rows_l, name_l = named(left, ln, finite if reach is not None else np.ones(left.num_rows, bool))
        rows_r, name_r = named(right, rn, t_finite if reach is not None else np.ones(right.num_rows, bool))
        if not (len(rows_l) and len(rows_r)):
            continue
        codes_l, of_l, _, _, _ = _classes(l_key[rows_l], name_l, len(ln))
        codes_r, _, order_r, first_r, n_r = _classes(r_key[rows_r], name_r, len(rn))
        # the right classes that each left class can pick, from the best score on
        name, key = codes_l % len(ln), codes_l // len(ln)
        entries = []
        for part in _slices(start[name + 1] - start[name]):
            n = (start[name + 1] - start[name])[part]
            at, own = _spans(start[name[part]], n), np.repeat(np.arange(part.start, part.stop), n)
            code = key[own] * len(rn) + to[at]
            other = np.minimum(np.searchsorted(codes_r, code), len(codes_r) - 1)
            ok = codes_r[other] == code
            entries.append((own[ok], other[ok], score[at][ok]))
        own, other, s = (np.concatenate(e) for e in zip(*entries, strict=True))
        if not len(own):
            continue
        level = np.flatnonzero(np.concatenate(([True], (np.diff(own) != 0) | (np.diff(s) != 0))))
        n_entries, level_s = np.diff(level, append=len(own)), s[level]
        targets = np.add.reduceat(n_r[other], level)
        levels = np.bincount(own[level], minlength=len(codes_l))
        first_level = np.cumsum(levels) - levels

        def look(p: np.ndarray, g: np.ndarray, these: np.ndarray) -> np.ndarray:
            """Points p look at the levels these[g]; whether they found one."""
            e = _spans(level[these], n_entries[these])
            cls = other[e]
            t = rows_r[order_r[_spans(first_r[cls], n_r[cls])]]
            tg = np.repeat(np.repeat(np.arange(len(these)), n_entries[these]), n_r[cls])
            rows, fin = rows_l[p], t_finite[t]
            best, d = np.full(len(p), -1, np.int64), np.full(len(p), np.nan)
            q = np.flatnonzero(finite[rows])
            best[q], d[q] = nearest_of_class(g[q], x[rows[q]], y[rows[q]], tg[fin], tx[t[fin]], ty[t[fin]], t[fin], math.inf if reach is None else reach)
            if reach is None:
                q, far = np.flatnonzero((best < 0) & known[rows]), t_known[t]
                if len(q) and far.any():
                    best[q], d[q] = _farthest(g[q], x[rows[q]], y[rows[q]], tg[far], tx[t[far]], ty[t[far]], t[far])
                q = np.flatnonzero(best < 0)
                best[q], d[q] = _unplaced_least(tg, t, len(these))[g[q]], -1.0
            ok = best >= 0
            found.append((rows[ok], vote, best[ok], level_s[these][g[ok]], d[ok]))
            return ok

        pending, depth = np.flatnonzero(levels[of_l]), 0
        while len(pending):
            pending = pending[np.argsort(of_l[pending], kind="stable")]
            these, g = np.unique(first_level[of_l[pending]] + depth, return_inverse=True)
            left_over = []
            for part in _slices(targets[these]):
                a, b = np.searchsorted(g, [part.start, part.stop])
                ok = look(pending[a:b], g[a:b] - part.start, these[part])
                left_over.append(pending[a:b][~ok])
            depth += 1
            pending = np.concatenate(left_over)
            pending = pending[levels[of_l[pending]] > depth]
    rows, best, s, d = (np.concatenate([f[i] for f in found]) if found else empty for i in (0, 2, 3, 4))
    votes = pa.array(np.repeat([f[1] for f in found], [len(f[0]) for f in found]).tolist() if found else [], pa.string())
    columns = {"l": left["l"].take(pa.array(rows.astype(np.int64))), "vote": votes, "r": right["r"].take(pa.array(best.astype(np.int64)))}
    return pa.table(columns | {"s": pa.array(s.astype(np.float64)), "d": pa.array(d.astype(np.float64), mask=d == -1.0)}, schema=pa.schema([("l", kind(left, "l")), ("vote", pa.string()), ("r", kind(right, "r")), ("s", pa.float64()), ("d", pa.float64())]))


def _by_vote(scores: DataFrame) -> dict[str, tuple[np.ndarray, ...]]:
    """For each vote the left names, the right names, where a left name's scores start, and right names and scores, the best ones first."""
    table, out = scores.toArrow(), {}
    for vote in pc.unique(table["vote"]).to_pylist():
        part = table.filter(pc.equal(table["vote"], vote))
        (ln, a), (rn, b) = (np.unique(part[c].to_numpy(), return_inverse=True) for c in ("ln", "rn"))
        s = part["s"].to_numpy()
        order = np.lexsort((b, -s, a))
        out[vote] = (ln, rn, np.concatenate(([0], np.cumsum(np.bincount(a, minlength=len(ln))))), b[order].astype(np.int32), s[order])
    return out


def picks_by_names(left: DataFrame, right: DataFrame, scores: DataFrame, reach: float) -> DataFrame:
    """Rows (l, vote, r, s, d): what records of left (l, name, area, x, y) pick of right ones (r, name, area, x, y) of the same area, and of those at most `reach` away.

    scores (ln, rn, vote, s) has the pairs of names that pass a vote; it is sent to all tasks. Areas and tiles of TILE reaches are dealt to groups of about TOGETHER records;
    groups are cut into blocks of CROWD records a side, so that none grows with its area.
    """
    held = left.sparkSession.sparkContext.broadcast(_by_vote(scores))
    names = {c: df.schema[c].dataType.simpleString() for c, df in (("l", left), ("r", right))}

    def run(most: float | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
        return lambda a, b: picks(a.combine_chunks(), b.combine_chunks(), held.value, most)

    def picked(a: DataFrame, b: DataFrame, most: float | None) -> DataFrame:
        deals = dealt_keys(left.sparkSession, b.count() / TOGETHER)
        deal = F.pmod(F.xxhash64(F.lit("deal"), "key"), F.lit(deals)).alias("deal")
        groups = blocked(a.select(deal, "key", "l", "name", "x", "y"), "l", b.select(deal, "key", "r", "name", "x", "y"), "r", ["deal"], CROWD)
        return groups[0].cogroup(groups[1]).applyInArrow(run(most), f"l {names['l']}, vote string, r {names['r']}, s double, d double")

    of_area = lambda df: df.filter("area IS NOT NULL").withColumn("key", F.col("area"))
    tile = lambda v: F.floor(v / (TILE * reach))
    span = lambda c: F.explode(F.sequence(tile(F.col(c) - reach * 1.000001), tile(F.col(c) + reach * 1.000001)))
    key = F.xxhash64(F.lit("tile"), "cx", "cy")
    placed = "x IS NOT NULL AND y IS NOT NULL AND abs(x) < double('Infinity') AND abs(y) < double('Infinity')"
    near = left.filter(placed).withColumns({"cx": tile(F.col("x")), "cy": tile(F.col("y"))}).withColumn("key", key)
    others = right.filter(placed).withColumn("cx", span("x")).withColumn("cy", span("y")).withColumn("key", key)
    return picked(of_area(left), of_area(right), None).union(picked(near, others, reach))
