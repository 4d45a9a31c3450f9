"""The epsilon grid order join against all pairs."""

import math

import numpy as np
import pytest

from lodeplane.llm.grid_join import near_vectors, op13_epsilon_grid_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, id long, size string, interval string"


def brute(rows, threshold=0.93):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        top = max(map(abs, v))
        v = np.array(v) / (top or 1)
        return v / np.sqrt(v @ v) if top else None

    units = [unit(v) if label is not None and i is not None else None for i, v, label in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(units):
        for j in range(i + 1, len(rows)):
            b = units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted(((r[0], links[i], least.get(find(i)), r[0] is not None and r[0] == least[find(i)]) for i, r in enumerate(rows)), key=str)


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame([(*r, 7, "s", "i") for r in rows], SCHEMA)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def random_rows(n, dims, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 6), dims))
    return [(int(i), [float(x) for x in centres[rng.integers(len(centres))] + rng.normal(size=dims) * spread], int(rng.integers(3))) for i in rng.permutation(n)]


@pytest.mark.parametrize("dims,spread", [(3, 0.1), (8, 0.25), (20, 0.3), (64, 0.3)])
def test_all_pairs(table, dims, spread):
    rows = random_rows(400, dims, dims, spread)
    assert got(near_vectors(table(rows), leaf=8, leaves=4, fanout=2)) == brute(rows)


def test_blocks_change_nothing(table):
    rows = random_rows(300, 6, 1, 0.2)
    assert got(near_vectors(table(rows))) == got(near_vectors(table(rows), leaf=3, leaves=1, fanout=3, leading=2)) == brute(rows)


def test_one_group_of_near_and_exact_copies(table):
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    rows = [(i, [float(x) for x in base + rng.normal(size=16) * 0.02], 1) for i in range(150)]
    rows += [(1000 + i, [float(x) for x in base], 1) for i in range(150)] + [(2000 + i, [float(x) for x in base], 2) for i in range(20)]
    assert got(near_vectors(table(rows), leaf=16, leaves=2)) == brute(rows)


def test_odd_vectors(table):
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1),
        (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0], 1), (12, [-1.0, 0.0], 1),
        (13, [1e300, 1e299], 1), (14, [1e-310, 0.0], 1), (None, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (8, [0.0, 1.0], 1), (3, [0.0, 5.0], 1), (15, [-0.0, 1.0], 1),
    ]
    assert got(near_vectors(table(rows))) == brute(rows)


def test_empty_and_single(table):
    assert near_vectors(table([])).count() == 0
    assert got(near_vectors(table([(4, [1.0, 2.0], 0)]))) == [(4, 0, 4, True)]
    with pytest.raises(ValueError):
        near_vectors(table([]), threshold=0.0)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(op13_epsilon_grid_vectors(spark, "/root/testdata/sf0.01")) == brute(rows)
