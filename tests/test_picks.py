"""Picks by names and then by distance, against points and records compared one by one."""

import math

import numpy as np
import pytest

from lodeplane.functions.phonetic import metaphone_key
from lodeplane.operators import linkage, picks
from lodeplane.operators.linkage import link_by_votes
from tests.test_linkage import SCHEMA, got, random, records, twin


def _small(monkeypatch):
    for name, value in (("FEW", 2), ("IN_CELL", 1), ("AT_ONCE", 16), ("CROWD", 16), ("TOGETHER", 8)):
        monkeypatch.setattr(picks, name, value)


@pytest.mark.parametrize("few", [2, 64])
@pytest.mark.parametrize(("spread", "reach"), [(12, math.inf), (12, 2.0), (5000, math.inf), (5000, 300.0), (0, math.inf)])
def test_nearest_of_class_is_that_of_all_pairs(monkeypatch, few, spread, reach):
    _small(monkeypatch)
    monkeypatch.setattr(picks, "FEW", few)
    rng = np.random.default_rng(few + spread)
    # half of the targets in one crowded place, some points far outside
    g, tg = rng.integers(0, 5, 300), np.sort(rng.integers(0, 4, 400))
    x, y = (rng.integers(-2 * spread, 3 * spread + 1, 300).astype(float) for _ in "xy")
    tx, ty = (np.where(rng.random(400) < 0.5, rng.integers(0, spread + 1, 400), rng.integers(0, 3, 400)).astype(float) for _ in "xy")
    t = rng.permutation(400)
    best, d = picks.nearest_of_class(g, x, y, tg, tx, ty, t, reach)
    for i in range(300):
        near = min(((math.sqrt((x[i] - tx[j]) ** 2 + (y[i] - ty[j]) ** 2), t[j]) for j in np.flatnonzero(tg == g[i])), default=(math.inf, -1))
        assert (d[i], best[i]) == (near if near[0] <= reach else (math.inf, -1))


@pytest.mark.parametrize("seed", [1, 2])
def test_links_are_those_of_all_pairs_however_groups_are_cut(spark, monkeypatch, seed):
    _small(monkeypatch)
    rng = random.Random(seed)
    left, right = records(rng, 90, 0), records(rng, 90, 1000)
    # few names, so that scores tie and the nearest decides
    left, right = ([(i, rng.choice(rows[:12])[1], *rest) for i, _, *rest in rows] for rows in (left, right))
    want = {k: (r, m, c, n, s and round(s, 9), d and round(d, 6)) for k, (r, m, c, n, s, d) in twin(left, right, 300.0).items()}
    linked = lambda: got(link_by_votes(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), 300.0, sound=metaphone_key))
    assert linked() == want
    monkeypatch.setattr(linkage, "BLOCK", 16)
    monkeypatch.setattr(linkage, "_scored_names", lambda *_: None)
    assert linked() == want


def test_places_that_are_no_number(spark, monkeypatch):
    rng = random.Random(4)
    odd = lambda rows: [(*r[:4], *(rng.choice([v, v, math.nan]) for v in r[4:])) for r in rows]
    left, right = odd(records(rng, 60, 0)), odd(records(rng, 60, 1000))
    linked = lambda: sorted(link_by_votes(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), 300.0).collect(), key=lambda r: r["l"])
    by_names = linked()
    monkeypatch.setattr(linkage, "_scored_names", lambda *_: None)
    assert repr(by_names) == repr(linked())


def test_records_of_few_names_dont_meet_in_pairs(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("40,000 x 40,000 pairs of one area")

    monkeypatch.setattr(linkage, "_meeting", refused)
    names = ["escola", "escolas", "centro", "smith"]
    side = lambda first: spark.range(first, first + 40_000).selectExpr("id", f"element_at(array{tuple(names)}, CAST(id % 4 + 1 AS int)) AS name", "'a' AS area", "CAST(NULL AS bigint) AS code", "CAST(id * 7919 % 4001 AS double) AS x", "CAST(id * 104729 % 4003 AS double) AS y")
    linked = link_by_votes(side(0), side(40_000), 50.0)
    assert linked.filter("method = 'votes_high' AND l % 4 = r % 4 AND score = 1").count() == linked.count() == 40_000
