"""Fixtures and properties of the relational operators."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as S

from lodeplane.functions import text as T
from lodeplane.functions.geo import ORIGIN_LAT, ORIGIN_LON, area, hull, inside, inside_rings, is_simple, point_on_surface, projected, rings_meet
from lodeplane.operators import quality as Q
from lodeplane.operators.graph import connected_components, stars
from lodeplane.operators.history import incremental_merge, lifecycle, scd2_apply, stable_ids
from lodeplane.operators.linkage import edit_pairs, entities, jaccard_pairs
from lodeplane.operators.relational import filled_slots, any_join, latest_by, mode_by, newest_by, numbered, or_join, range_lookup, two_pass_lookup
from lodeplane.operators.series import change_rates, weighted_mean
from lodeplane.operators.spatial import density_clusters, nearest, points_in_polygons, within_distance, without_overlaps
from lodeplane.session import checkpoint_dir, release, stored
from lodeplane.sources.files import SchemaChanged, append_after, carried_forward, evolved, newest_file, newest_load, overwrite_slices, read_json_lines, read_landing, read_newest
from lodeplane.sources.sinks import row_gate, updated
from lodeplane.streaming.events import drain, event_stream, windowed_counts


def col(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("raw", "want"),
    [("2020", "2020-01-01"), ("2020-07", "2020-07-01"), ("2020-Q3", "2020-07-01"), ("4th Quarter 2019", "2019-10-01"), ("March 2021", "2021-03-01"), ("Smarch 2021", None), ("2020-13", None), ("", None), (None, None), ("x 2020", None)],
)
def test_periods(spark, raw, want):
    got = col(spark, T.parsed_period, raw)
    assert (got and got.isoformat()) == want


@pytest.mark.parametrize(("raw", "want"), [("1,5", 1.5), (" 12 ", 12.0), ("1 234,5", 1234.5), ("x", None), ("..", None), ("-", None), ("||", None), ("", None), (None, None), ("-3", -3.0), ("1.2.3", None)])
def test_numbers(spark, raw, want):
    assert col(spark, T.parsed_number, raw) == want


def test_names_and_similarity(spark):
    assert col(spark, T.folded, "  Édifício—SÃO João, nº 5 ") == "edificio sao joao n 5"
    assert col(spark, T.normal_name, "The House of Sun") == "house sun" and col(spark, T.normal_name, None) == ""
    assert col(spark, T.normal_address, "12, Harbour Street, apt 3b") == "12 harbour st"
    assert col(spark, T.trigrams, "ab cd") == ["abc", "bcd"] and col(spark, T.trigrams, "ab") == [] and col(spark, T.tokens, None) == []
    both = spark.createDataFrame([(["a", "b"], ["b", "c"]), (["b", "c"], ["a", "b"]), ([], [])], "a array<string>, b array<string>")
    assert [r[0] for r in both.select(T.jaccard(F.col("a"), F.col("b"))).collect()] == [1 / 3, 1 / 3, None]
    h = [r[0] for r in spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc")], "a string, b string").select(T.row_hash(F.col("a"), F.col("b"))).collect()]
    assert len(set(h)) == 4


def test_newest_latest_and_mode(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 3, "b"), (1, 1, "c"), (2, None, "d"), (None, 5, "e")], "k int, t int, v string")
    assert {(r.k, r.t, r.v) for r in newest_by(df, ["k"], "t").collect()} == {(1, 3, "b"), (2, None, "d"), (None, 5, "e")}
    assert {(r.k, r.v) for r in latest_by(df, ["k"], [F.col("t").desc_nulls_last(), F.col("v")], 2).collect()} == {(1, "a"), (1, "b"), (2, "d"), (None, "e")}
    modes = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, None), (2, None)], "k int, v string")
    assert [(r.k, r["mode"], r.n) for r in mode_by(modes, ["k"], "v").collect()] == [(1, "a", 2)]


def test_joins(spark):
    a = spark.createDataFrame([(1, 1, 9), (2, 2, 8), (3, None, 7)], "x int, p int, q int")
    b = spark.createDataFrame([(10, 1, 9), (20, 5, 8)], "y int, r int, s int")
    assert sorted(map(tuple, or_join(a, b, [a.p == b.r, a.q == b.s], ["x", "y"]).collect())) == [(1, 10), (2, 20)]
    rules = spark.createDataFrame([("r1", ["a", "b", "a"]), ("r2", []), ("r3", None)], "rule string, pattern array<string>")
    keys = spark.createDataFrame([("a",), ("c",)], "k string")
    assert [(r.k, r.rule) for r in any_join(keys, rules, "k", "pattern").collect()] == [("a", "r1")]
    dim = spark.createDataFrame([("t", "s", 1), ("t", None, 2)], "t string, s string, v int")
    facts = spark.createDataFrame([(1, "t", "s"), (2, "t", "z"), (3, "u", "s")], "i int, t string, s string")
    assert {r.i: r.v for r in two_pass_lookup(facts, dim, ["t", "s"], ["t"], "v").collect()} == {1: 1, 2: 2, 3: None}


def test_range_lookup_by_cells_equals_the_plain_one(spark, monkeypatch):
    from lodeplane.operators import relational

    facts = spark.createDataFrame([(i, i * 3.7) for i in range(100)], "i int, v double")
    brackets = spark.createDataFrame([(0.0, 50.0), (50.0, 51.0), (51.0, 300.0), (300.0, None)], "lo double, hi double")
    plain = sorted((r.i, r.lo) for r in range_lookup(facts, brackets, "v", "lo", "hi").collect())
    monkeypatch.setattr(relational, "SMALL_ROWS", 0)
    assert sorted((r.i, r.lo) for r in range_lookup(facts, brackets, "v", "lo", "hi", width=7.0).collect()) == plain and len(plain) == 100


def test_numbers_are_gapless(spark):
    df = spark.createDataFrame([(random.Random(i).randint(0, 50), i) for i in range(400)], "a int, b int").repartition(7)
    got = sorted((r.a, r.b, r.sk) for r in numbered(df, [F.col("a"), F.col("b")]).collect())
    assert [x[2] for x in got] == list(range(1, 401)) and numbered(df.limit(0), [F.col("a")]).count() == 0


def test_components_do_not_depend_on_order(spark):
    random.seed(1)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    tied = {x for a, b in edges if a != b for x in (a, b)}
    for order, kind in ((edges, "long"), (edges[::-1], "int"), (edges[::-1], "double")):
        got = {r.node: r.component for r in connected_components(spark.createDataFrame([*order, (None, 3)], "u long, v long").selectExpr(f"CAST(u AS {kind}) AS u", f"CAST(v AS {kind}) AS v")).collect()}
        assert got == {x: find(x) for x in tied}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_similar_names_merge_within_their_block(spark):
    """Two merges; names alike in two places stay apart, other names at one place too."""
    rows = [(1, "x", "sun park tower"), (2, "x", "tower sun park"), (3, "x", "sun park tower two"), (4, "y", "sun park tower"), (5, "x", "river side"), (6, "x", "hill side"), (7, "y", ""), (8, "y", None)]
    df = spark.createDataFrame(rows, "id int, place string, name string").withColumn("e", T.tokens(F.col("name")))
    pairs = jaccard_pairs(df, "id", "place", "e", 0.6)
    assert sorted((r.a, r.b) for r in pairs.collect()) == [(1, 2), (1, 3), (2, 3)]
    assert {r.id: r.entity for r in entities(df, pairs, "id").collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8}


def test_prefix_join_loses_no_pair(spark):
    random.seed(3)
    rows = [(i, "b", list({f"t{random.randint(0, 14)}" for _ in range(random.randint(1, 9))})) for i in range(150)]
    for threshold in (0.3, 0.6, 1.0):
        got = {(r.a, r.b) for r in jaccard_pairs(spark.createDataFrame(rows, "id int, block string, e array<string>"), "id", "block", "e", threshold).collect()}
        assert got == {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and len({*a[2]} & {*b[2]}) / len({*a[2]} | {*b[2]}) >= threshold}


HISTORY = "k int, h string, v string, valid_from date, valid_to date"


def test_scd2_is_idempotent_and_disjoint(spark):
    at = lambda d: F.lit(f"2024-01-{d:02}").cast("date")
    load = lambda rows: spark.createDataFrame(rows, "k int, h string, v string")
    history = spark.createDataFrame([], HISTORY)
    for day, rows in ((1, [(1, "a", "A"), (2, "b", "B")]), (5, [(1, "a", "A"), (2, "c", "C"), (3, "d", "D")]), (5, [(1, "a", "A"), (2, "c", "C"), (3, "d", "D")]), (9, [(2, "c", "C"), (1, None, "N")])):
        history = scd2_apply(history, load(rows), "k", "h", at(day))
    got = sorted((r.k, str(r.valid_from)[-2:], str(r.valid_to)[-2:], r.v) for r in history.collect())
    assert got == [(1, "01", "09", "A"), (1, "09", "ne", "N"), (2, "01", "05", "B"), (2, "05", "ne", "C"), (3, "05", "09", "D")]


def test_heartbeats_keep_absent_keys_open(spark):
    old = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], "k int, h string, v string").withColumn("valid_from", F.lit("2024-01-01").cast("date")).withColumn("valid_to", F.lit(None).cast("date"))
    seen = spark.createDataFrame([(1, "2024-01-30"), (2, "2024-01-02")], "k int, last_seen string").withColumn("last_seen", F.col("last_seen").cast("date"))
    out = scd2_apply(old, spark.createDataFrame([], "k int, h string, v string"), "k", "h", F.lit("2024-02-01").cast("date"), seen)
    assert {r.k: r.valid_to is None for r in out.collect()} == {1: True, 2: False}


def test_merge_twice_changes_nothing_more(spark):
    empty = spark.createDataFrame([], "k long, s string, price double, initial_price double, first_seen int, last_seen int, price_changes long")
    a = spark.createDataFrame([(1, "x", 10.0, 1), (2, "y", 20.0, 1)], "k long, s string, price double, seen int")
    b = spark.createDataFrame([(1, "z", 11.0, 2), (3, "w", None, 2)], "k long, s string, price double, seen int")
    once = incremental_merge(incremental_merge(empty, a, "k", ["s"], "price"), b, "k", ["s"], "price")
    want = {(1, "z", 11.0, 10.0, 1, 2, 1), (2, "y", 20.0, 20.0, 1, 1, 0), (3, "w", None, None, 2, 2, 0)}
    assert set(map(tuple, once.collect())) == set(map(tuple, incremental_merge(once, b, "k", ["s"], "price").collect())) == want


def test_lifecycle_and_stable_ids(spark):
    rows = spark.createDataFrame([(1, "2024-01-01", True), (1, "2024-01-02", False), (2, "2024-01-09", False)], "k int, d string, c boolean").withColumn("d", F.col("d").cast("date"))
    assert {r.k: (str(r.first_seen), r.active) for r in lifecycle(rows, "k", "d", F.col("c")).collect()} == {1: ("2024-01-02", False), 2: ("2024-01-09", True)}
    known = spark.createDataFrame([(1, 100), (4, 400)], "id long, uid long")
    members = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h"), (4, "g")], "id long, g string")
    assert {r.id: r.uid for r in stable_ids(known, members, "id", "g").collect()} == {1: 100, 2: 100, 3: 3, 4: 400}


def test_rates_skip_nulls_and_zero(spark):
    df = spark.createDataFrame([("s", 1, 10.0), ("s", 2, None), ("s", 3, 15.0), ("s", 4, 0.0), ("s", 5, 3.0)], "s string, t int, v double")
    assert {r.t: r.m for r in change_rates(df, ["s"], "t", "v", {"m": 1}).collect()} == {1: None, 3: 50.0, 4: -100.0, 5: None}
    mean = spark.createDataFrame([(1.0, 1), (3.0, 3), (None, 100)], "v double, w int").agg(weighted_mean(F.col("v"), F.col("w"))).first()[0]
    assert mean == 2.5


def points(spark, rows, names="id int, x double, y double"):
    return spark.createDataFrame(rows, names)


def test_projection(spark):
    df = spark.createDataFrame([(ORIGIN_LON, ORIGIN_LAT), (ORIGIN_LON + 1, 40.0), (ORIGIN_LON - 1, 40.0)], "lon double, lat double")
    o, e, w = [tuple(r) for r in df.select(*projected("lon", "lat")).collect()]
    assert abs(o[0]) < 1e-6 and abs(o[1]) < 1e-4
    assert abs(e[0] + w[0]) < 1e-6 and abs(e[1] - w[1]) < 1e-6 and 85_000 < e[0] < 86_000


def test_spatial_joins_against_all_pairs(spark):
    random.seed(4)
    a = [(i, random.uniform(-50, 50), random.uniform(-50, 50)) for i in range(150)]
    b = [(i, random.uniform(-50, 50), random.uniform(-50, 50)) for i in range(60)]
    dist = lambda p, q: ((p[1] - q[1]) ** 2 + (p[2] - q[2]) ** 2) ** 0.5
    got = {(r.a, r.b) for r in within_distance(points(spark, a), points(spark, b), 8.0).collect()}
    assert got == {(p[0], q[0]) for p in a for q in b if dist(p, q) <= 8}
    near = {r.id: r.d for r in nearest(points(spark, a), points(spark, b, "target int, x double, y double"), 1.5).collect()}
    assert all(abs(near[p[0]] - min(dist(p, q) for q in b)) < 1e-9 for p in a) and len(near) == len(a)
    root = {p[0]: p[0] for p in a}
    for _ in a:
        for p in a:
            for q in a:
                if dist(p, q) <= 4:
                    root[p[0]] = root[q[0]] = min(root[p[0]], root[q[0]])
    assert {r.id: r.cluster for r in density_clusters(points(spark, a), 4.0).collect()} == root


def test_three_points_make_two_buildings(spark):
    got = density_clusters(points(spark, [(1, 0.0, 0.0), (2, 20.0, 0.0), (3, 100.0, 0.0)]), 30.0).groupBy("cluster").count().collect()
    assert sorted(map(tuple, got)) == [(1, 2), (3, 1)]


def test_polygons_and_boxes(spark):
    ring = "ring array<struct<x: double, y: double>>"
    shape = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 5.0), (0.0, 10.0)]
    df = spark.createDataFrame([("p", shape)], f"polygon string, {ring}")
    assert df.select(area(F.col("ring"))).first()[0] == 75
    got = points_in_polygons(points(spark, [(1, 5.0, 2.0), (2, 5.0, 8.0), (3, 1.0, 8.0), (4, -1.0, 1.0)]), df, 3.0)
    assert sorted(r.id for r in got.collect()) == [1, 3]
    assert [r[0] for r in df.select(inside(F.lit(9.0), F.lit(8.5), F.col("ring"))).collect()] == [True]
    box = "id int, a string, x0 double, y0 double, x1 double, y1 double"
    first = spark.createDataFrame([(1, "m", 0.0, 0.0, 10.0, 10.0), (2, "n", 0.0, 0.0, 10.0, 10.0)], box)
    second = spark.createDataFrame([(3, "m", 5.0, 0.0, 15.0, 10.0), (4, "m", 6.0, 0.0, 16.0, 10.0), (5, "o", 0.0, 0.0, 10.0, 10.0)], box)
    assert sorted(r.id for r in without_overlaps(first, second, "a", 4.0).collect()) == [1, 2, 4, 5]


def test_checks_and_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "z")], "k int, v string")
    checks = [Q.not_null("v"), Q.accepted_values("v", ["a"]), Q.in_range("k", 0, 1), Q.matches("v", "^a")]
    assert {r["check"]: r.n_broken for r in Q.report(df, checks).collect()} == {"not_null:v": 1, "accepted_values:v": 1, "accepted_range:k": 2, "pattern:v": 1}
    assert Q.unique(df, ["k"]).first().n_broken == 1 and Q.relationship(df, "k", df.filter("k = 1"), "k").first().n_broken == 2
    assert [(r["column"], r.null_pct, r.n_distinct, r.top_values) for r in Q.profile(df, ["v"]).collect()] == [("v", 33.33, 2, "a=1|z=1")]


def test_landing_contract_slices_and_marks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "n int, day string")
    overwrite_slices(df, path, "day")
    overwrite_slices(spark.createDataFrame([(3, "2024-01-02")], "n int, day string"), path, "day")
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 3]
    wider = evolved(df.schema, spark.createDataFrame([(9, "x", 1.0)], "n int, day string, extra double"))
    assert wider.columns == ["n", "day", "extra"]
    with pytest.raises(SchemaChanged):
        evolved(df.schema, spark.createDataFrame([("9", "x")], "n string, day string"))
    marks = str(tmp_path / "m")
    df.select("n").write.parquet(marks)
    assert [r.n for r in append_after(spark.createDataFrame([(1,), (2,), (3,)], "n int"), marks, "n").collect()] == [2, 3]
    df.write.json(str(tmp_path / "j"))
    assert read_landing(spark, str(tmp_path / "j"), "json", "n int, day string").count() == 2
    with pytest.raises(ValueError):
        read_landing(spark, path, "shapefile", "n int")


def test_a_stream_in_batches_equals_one_batch(spark, tmp_path):
    rows = spark.range(2000).select(F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"), (F.col("id") % 3).cast("string").alias("event_type"), (F.col("id") * 0.5).alias("value"))
    rows.repartition(6).write.parquet(str(tmp_path / "in"))
    got = {}

    def keep(batch, _):
        got.update({(r.start, r.event_type): (r.n, r.total) for r in batch.collect()})

    drain(windowed_counts(event_stream(spark, str(tmp_path / "in"), "*.parquet", rows.schema, 2), late="10 days"), keep, str(tmp_path / "state"), "update")
    assert got == {(r.start, r.event_type): (r.n, r.total) for r in windowed_counts(rows).collect()}


def test_stars_keep_components():
    random.seed(6)
    for n in (1, 3, 30, 400):
        u, v = (np.array([random.randrange(n) * 10 for _ in range(n)]) for _ in range(2))
        root = {x: x for x in (*u.tolist(), *v.tolist())}
        for _ in range(n):
            for a, b in zip(u.tolist(), v.tolist(), strict=True):
                root[a] = root[b] = min(root[a], root[b])
        assert dict(zip(*(x.tolist() for x in stars(u, v)), strict=True)) == {x: r for x, r in root.items() if x != r}
    path = np.arange(5000)
    assert stars(path[1:], path[:-1])[1].max() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_edit_join_loses_no_pair(spark):
    random.seed(5)
    names = ["".join(random.choice("ab c") for _ in range(random.randint(0, 9))) for _ in range(120)]
    rows = [(i, "xy"[i % 2], n) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "id int, block string, name string")
    for least in (0.6, 0.75, 0.9):
        want = {(i, j) for i, p, a in rows for j, q, b in rows if i < j and p == q and a and b and 1 - edit_distance(a, b) / max(len(a), len(b)) >= least}
        assert {(r.a, r.b) for r in edit_pairs(df, "id", "block", "name", least).collect()} == want and want
    with pytest.raises(ValueError):
        edit_pairs(df, "id", "block", "name", 0.5)


RING = "array<struct<x: double, y: double>>"


def shapes(spark, rings):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rings)], f"id int, ring {RING}")


def test_hulls_against_brute_force(spark):
    random.seed(8)
    clouds = [[(float(random.randint(0, 6)), float(random.randint(0, 6))) for _ in range(n)] for n in (1, 2, 3, 5, 9, 20, 20, 20)] + [[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)], []]
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    for row in shapes(spark, clouds).select("id", hull(F.col("ring")).alias("h")).collect():
        points, got = sorted(set(clouds[row.id])), [(p.x, p.y) for p in row.h]
        between = lambda p, q, r: turn(p, q, r) == 0 and min(p, q) < r < max(p, q)
        corner = lambda p: len(points) < 3 or any(all(turn(p, q, r) >= 0 for r in points) and not any(between(x, q, p) for x in points) for q in points if q != p)
        assert len(set(got)) == len(got) and set(got) == {p for p in points if corner(p)}, points
        assert len(got) < 3 or all(turn(got[i - 2], got[i - 1], got[i]) > 0 for i in range(len(got)))


def test_rings_that_meet_and_points_on_sides(spark):
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    cases = [(square(0.0, 0.0, 4.0), square(4.0, 4.0, 1.0), True), (square(0.0, 0.0, 4.0), square(1.0, 1.0, 1.0), True), (square(1.0, 1.0, 1.0), square(0.0, 0.0, 4.0), True), (square(0.0, 0.0, 1.0), square(2.0, 0.0, 1.0), False)]
    df = spark.createDataFrame(cases, f"a {RING}, b {RING}, want boolean")
    assert df.filter(rings_meet(F.col("a"), F.col("b")) != F.col("want")).count() == 0
    point = lambda x, y: inside_rings(F.lit(x), F.lit(y), F.array("a", "b"))
    got = df.limit(2).select(*[point(x, y) for x, y in ((2.5, 2.5), (1.5, 1.5), (1.0, 1.5), (0.0, 2.0), (5.0, 5.0), (4.5, 4.5))]).collect()
    assert [list(r) for r in got] == [[True, True, True, False, False, True], [True, False, False, False, False, False]]


def test_validity_and_points_on_surfaces(spark):
    bow, line, repeated, bent = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)], [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)], [(0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)], [(0.0, 0.0), (9.0, 0.0), (9.0, 1.0), (1.0, 1.0), (1.0, 9.0), (0.0, 9.0)]
    df = shapes(spark, [bow, line, repeated, bent])
    assert [r[0] for r in df.orderBy("id").select(is_simple(F.col("ring"))).collect()] == [False, False, True, True]
    middle = df.filter("id = 3").select("ring", point_on_surface(F.col("ring")).alias("p"))
    assert middle.filter(inside(F.col("p.x"), F.col("p.y"), F.col("ring"))).count() == 1
    assert df.filter("id = 1").select(point_on_surface(F.col("ring"))).first()[0] is None


def test_addresses_and_lookups(spark):
    rules = ((r"\bavenida\b", "avenue"), (r"\bavenue\b", "av"))
    assert col(spark, lambda c: T.ruled_address(c, rules), "Avenida  Á, apt 3 door B") == "av a" and col(spark, lambda c: T.ruled_address(c, rules), None) is None
    look = lambda a, p: col(spark, lambda c: T.lookup_text(c, F.lit(p).cast("string")), a)
    assert (look("a b porto", "Porto"), look("a b", "Porto"), look(None, "Porto"), look("a", None), look("", None)) == ("a b porto", "a b, Porto", "Porto", "a", None)


def test_content_hashes(spark):
    one = spark.createDataFrame([(1, " a ", True, None)], "n int, t string, b boolean, x string")
    two = spark.createDataFrame([(1.0, "a", True)], "n double, t string, b boolean")
    first = one.select(T.content_hash(one, ["n", "t", "b", "x"])).first()[0]
    assert first == two.select(T.content_hash(two, ["b", "t", "n"])).first()[0]
    other = spark.createDataFrame([("1", "a", 1)], "n string, t string, b int")
    assert first != other.select(T.content_hash(other, ["n", "t", "b"])).first()[0]
    with pytest.raises(TypeError):
        T.content_hash(spark.createDataFrame([([1],)], "n array<int>"), ["n"])


def test_content_hashes_tell_all_values_apart(spark):
    def hash_of(rows, schema):
        df = spark.createDataFrame(rows, schema)
        # under one name, so that values alone make the difference
        df = df.toDF(*"abc"[: len(df.columns)])
        return [r[0] for r in df.select(T.content_hash(df, df.columns)).collect()]

    numbers = [1e-7, 2e-7, 0.1, 0.1 + 2**-54, 1 / 3, 1e300, -1e300, 1e22, 1e22 + 2**22, 5e-324, 0.0, 1.5, 150.0]
    assert len(set(hash_of([(x,) for x in numbers], "n double"))) == len(set(numbers))
    assert hash_of([(0.0,), (-0.0,)], "n double")[0] == hash_of([(-0.0,)], "n double")[0] == hash_of([(0,)], "n int")[0]
    assert hash_of([(Decimal("150.00"),)], "n decimal(10,2)") == hash_of([(150,)], "n long") == hash_of([(150.0,)], "n double")
    assert hash_of([("caf\u00e9",)], "t string") == hash_of([("cafe\u0301",)], "t string")
    assert hash_of([("x\u001fb=y", None)], "a string, b string") != hash_of([("x", "y")], "a string, b string")
    assert hash_of([("x\u001e\u001f",)], "a string") != hash_of([("x\u001f",)], "a string")


def test_a_load_of_several_files_is_read_whole(spark, tmp_path):
    for name, k in (("2024-01.json", 1), ("2024-02.part-0.json", 2), ("2024-02.part-1.json", 3), ("_SUCCESS", 9), (".x.json", 9)):
        (tmp_path / name).write_text(f'{{"k": {k}}}\n')
    assert sorted(r.k for r in read_newest(spark, str(tmp_path), "json", "k long").collect()) == [2, 3]
    assert len(newest_load(spark, str(tmp_path))) == 2
    loaded = spark.read.schema("k long").json([str(tmp_path / n) for n in ("2024-01.json", "2024-02.part-0.json", "2024-02.part-1.json")])
    assert sorted(r.k for r in newest_file(loaded).collect()) == [2, 3]
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        newest_load(spark, str(tmp_path / "empty"))


def test_sounds(spark):
    pairs = spark.createDataFrame([("smith jon", "smyth john", True), ("smith", "schmidt", False), ("", "", False), ("tab", "top", True)], "a string, b string, want boolean")
    assert pairs.filter(T.sounds_alike(F.col("a"), F.col("b")) != F.col("want")).count() == 0
    assert pairs.limit(1).select(T.trigram_similarity(F.col("a"), F.col("a")), T.trigram_similarity(F.lit(""), F.lit("a"))).first()[:] == (1.0, 0.0)


def test_landing_lines_newest_files_and_gates(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1, "v": "x"}\n{"k": 2, "v"\n\n{"k": "no number"}\n')
    (tmp_path / "b.json").write_text('{"k": 3}\n')
    schema = S.StructType([S.StructField("k", S.LongType()), S.StructField("v", S.StringType())])
    good, bad = read_json_lines(spark, str(tmp_path), schema)
    assert sorted((r.k, r.v) for r in good.collect()) == [(1, "x"), (3, None)] and bad.count() == 2
    assert [r.k for r in newest_file(spark.read.schema(schema).json(str(tmp_path))).collect()] == [3]
    gates = row_gate({"a": (spark.range(3), 3, None), "b": (spark.range(3), None, 2), "c": (spark.range(0), None, None)})
    assert {r.name: (r.n_rows, r.passes) for r in gates.collect()} == {"a": (3, True), "b": (3, False), "c": (0, True)}


def test_updates_and_details(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, 5)], "k int, v int").write.parquet(f"{tmp_path}/t")
    assert sorted(spark.read.parquet(updated(f"{tmp_path}/t", spark, F.col("v") > 3, {"v": F.lit(0)})).collect()) == [(1, None), (2, 0)]
    known, fresh = spark.createDataFrame([(1, 5), (2, 5), (3, 1)], "k int, seen int"), spark.createDataFrame([(1, 9)], "k int, seen int")
    assert sorted(map(tuple, carried_forward(known, fresh, ["k"], "seen", F.lit(2)).collect())) == [(1, 9, False), (2, 5, True)]


def test_stored_tables_are_released_and_a_cluster_needs_a_shared_folder(spark):
    df = stored(spark.range(3), "test")
    assert df.count() == 3 and release(spark) >= 1
    with pytest.raises(Exception):
        df.count()

    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "_jsc": type("J", (), {"sc": staticmethod(lambda: spark.sparkContext._jsc.sc().getClass() and _NoFolder())})})

    class _NoFolder:
        @staticmethod
        def getCheckpointDir():
            return type("None_", (), {"isDefined": staticmethod(lambda: False)})

    with pytest.raises(RuntimeError):
        checkpoint_dir(Cluster)


def test_slots_and_what_fills_them(spark):
    kind = "id int, items array<struct<tag:string,value:string>>, _x int"
    rows = [(1, [("b", "v1"), ("a", "v2"), ("c", "v3"), ("a", "v4"), (None, "v5")], 1), (2, [("c", "v1")], 1), (3, [], 1), (4, None, 1), (5, [("a", "v1"), ("a", "v2")], 1)]
    got = {r.id: (r.one, r.two, r.three) for r in filled_slots(spark.createDataFrame(rows, kind), "items", {"one": ["a", "b"], "two": ["x"], "three": ["b", "a"]}).collect()}
    assert got == {1: ("v2", "v3", "v1"), 2: ("v1", None, None), 3: (None,) * 3, 4: (None,) * 3, 5: ("v1", None, "v2")}


def test_letters_without_accents_and_first_matches(spark):
    df = spark.createDataFrame([("Çà et là, Ệ ǖ ñ Ω\u0301 ß ø", ["x", None, "a1", "b2"]), (None, None), ("", [])], "t string, a array<string>")
    got = df.select(T.unaccented(F.col("t")).alias("t"), T.first_matching(F.col("a"), "[0-9]").alias("a"), *T.flags(F.col("t"), {"la": " LÀ", "no": "zz"})).collect()
    assert [tuple(r) for r in got] == [("Ca et la, E u n Ω ß ø", "a1", True, False), (None, None, False, False), ("", None, False, False)]


def test_copies_of_polygons_are_looked_at_once_and_all_of_them_found(spark, monkeypatch):
    from lodeplane.operators import spatial

    monkeypatch.setattr(spatial, "BLOCK", 7)
    monkeypatch.setattr(spatial, "COMPARED", 20)
    ring = lambda x, y, n: [(float(x), float(y)), (float(x + n), float(y)), (float(x + n), float(y + n)), (float(x), float(y + n))]
    shapes = [(k, [ring(k % 3, 0, 9), ring(k % 3 + 2, 2, 3), ring(40, 40, 2)]) for k in range(40)]
    polygons = spark.createDataFrame(shapes, "polygon long, rings array<array<struct<x: double, y: double>>>")
    at = [(100 * x + y, float(x), float(y)) for x in range(14) for y in range(11)] + [(9000, 41.0, 41.0), (9001, None, 1.0)]
    points = spark.createDataFrame(at, "id long, x double, y double")
    box = lambda x, y, r: r[0][0] < x < r[2][0] and r[0][1] < y < r[2][1]
    shut = lambda x, y, r: r[0][0] <= x <= r[2][0] and r[0][1] <= y <= r[2][1]
    want = sorted((i, k) for i, x, y in at for k, (a, b, c) in shapes if x is not None and (box(x, y, a) and not shut(x, y, b) or box(x, y, c)))
    assert sorted(map(tuple, spatial.points_in_polygons(points, polygons, 4.0).collect())) == want
    found = {r.id: (r.n, r.first) for r in spatial.polygons_at(points, polygons, 4.0).collect()}
    assert found == {i: (len(ks), min(ks)) for i in {i for i, _ in want} if (ks := [k for j, k in want if j == i])}


def test_pairs_of_a_disjunction_come_once_without_being_compared(spark):
    from lodeplane.operators.relational import or_join

    def pairs(a, b):
        left, right = spark.createDataFrame(a, "i long, x int, y int"), spark.createDataFrame(b, "j long, u int, v int")
        return or_join(left, right, [left.x == right.u, left.y == right.v], ["i", "j"])

    a, b = [(1, 1, 1), (2, 1, None), (3, None, 2), (4, 5, 1)], [(1, 1, 1), (2, 1, 2), (3, None, 1)]
    found = pairs(a, b)
    assert sorted(map(tuple, found.collect())) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (3, 2), (4, 1), (4, 3)]
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, pairs([*a, (1, 9, 1)], b).collect())) == sorted(map(tuple, found.collect()))


def test_boxes_covered_by_any_share(spark):
    import random

    from lodeplane.operators import spatial

    draw = random.Random(5)
    boxes = lambda n, at: [(at + i, "k", x := float(draw.randint(0, 12)), y := float(draw.randint(0, 12)), x + draw.randint(1, 9), y + draw.randint(1, 9)) for i in range(n)]
    p, s, schema = boxes(9, 0), boxes(60, 100), "id long, block string, x0 double, y0 double, x1 double, y1 double"
    over = lambda a, b, i: max(0.0, min(a[i + 2], b[i + 2]) - max(a[i], b[i]))
    for share in (0.2, 1 / 3, 0.5, 0.75, 1.0):
        want = [b[0] for b in s if not any(over(a, b, 2) * over(a, b, 3) >= share * (b[4] - b[2]) * (b[5] - b[3]) for a in p)]
        out = spatial.without_overlaps(spark.createDataFrame(p, schema), spark.createDataFrame(s, schema), "block", 5.0, share)
        assert sorted(r.id for r in out.collect()) == sorted([a[0] for a in p] + want)
    # one that is covered is done with the first that covers it
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
