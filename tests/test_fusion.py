"""Layers under one contract, lists of places, rules of situations; most frequent values of several columns."""

import datetime

import pytest
from pyspark.sql import functions as F

from lodeplane.operators.fusion import fused, matched_rules, resolved_places, united
from lodeplane.operators.relational import mode_by, modes

LAYER = "feature long, code string, zone string, places string, day string"
PLACES = [(1, "Aveiro"), (2, "Ovar"), (3, "ovar "), (4, None), (5, "")]


def layer(spark, *rows):
    return spark.createDataFrame(list(rows), LAYER)


def places(spark):
    return spark.createDataFrame(PLACES, "place long, name string")


RULES = "rule long, place long, patterns array<string>, zones array<string>, article string, kind string"


def test_layers_keep_every_row_and_only_dates_that_are_some(spark):
    rows = [(1, "a", None, "x", "2020-02-30"), (1, "a", None, "x", "2020-02-28T10:00"), (2, None, "z", None, "28/02/2020"), (2, None, "z", None, None)]
    extra = layer(spark, rows[1]).withColumn("layer", F.lit("mine")).withColumn("more", F.lit(1))
    got = united({"one": layer(spark, *rows), "two": extra, "none": layer(spark)}).collect()
    assert sorted((r["layer"], r["feature"], str(r["day"])) for r in got) == [("one", 1, "2020-02-28"), ("one", 1, "None"), ("one", 2, "None"), ("one", 2, "None"), ("two", 1, "2020-02-28")]
    assert got[0].asDict().keys() == {"layer", "feature", "code", "zone", "places", "day"}
    with pytest.raises(ValueError, match="lacks zone"):
        united({"one": extra.drop("zone")})


def test_lists_of_places(spark):
    lists = ["AVEIRO, ovar,Nowhere", "ovar", " , ", None, "", "Aveiro,Aveiro"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(lists)], "id int, places string")
    got = {r["id"]: (r["place_ids"], r["place_labels"]) for r in resolved_places(df, places(spark)).collect()}
    assert got == {0: ([1, 2, 3], ["Aveiro", "Ovar", "ovar "]), 1: ([2, 3], ["Ovar", "ovar "]), 2: ([], []), 3: ([], []), 4: ([], []), 5: ([1], ["Aveiro"])}


def test_rules_of_situations_against_all_pairs(spark):
    rules = [(10, 1, ["a", "a", "b"], None, "art 2", "ban"), (9, 1, ["a"], ["z"], "art 1", "ban"), (8, 2, ["a"], ["y", None], "art 1", "limit"), (7, 2, None, None, "art 9", "ban"), (6, 3, [], None, None, None), (5, 2, ["a"], None, None, None)]
    rows = [(i, ids, code, zone) for i, (ids, code, zone) in enumerate((ids, code, zone) for ids in ([1], [1, 2], [], [2, 9]) for code in ("a", "b", None) for zone in ("z", "y", None))]
    rows += [(100 + r[0], *r[1:]) for r in rows]
    df = spark.createDataFrame(rows, "id int, place_ids array<long>, code string, zone string")
    got = {r["id"]: (r["rules"], r["n_rules"], r["articles"], r["kinds"]) for r in matched_rules(df, spark.createDataFrame(rules, RULES)).collect()}
    want = {}
    for i, ids, code, zone in rows:
        met = [r for r in rules if r[1] in ids and code is not None and code in (r[2] or []) and (r[3] is None or zone is not None and zone in r[3])]
        of = lambda k: sorted({r[k] for r in met if r[k] is not None})  # noqa: B023, E731
        want[i] = (of(0), len(met), of(4), of(5)) if met else (None, 0, None, None)
    assert got == want


def test_whole_fusion_and_severities(spark):
    one = layer(spark, (1, "a", "z", "Aveiro", "2021-01-01"), (2, "a", "q", "Ovar", "x"))
    severities = spark.createDataFrame([("a", "z", 3)], "code string, zone string, severity int")
    rules = spark.createDataFrame([(1, 1, ["a"], None, "art", "ban")], RULES)
    got = {r["feature"]: (r["day"], r["severity"], r["rules"], r["place_labels"]) for r in fused({"one": one}, places(spark), severities, rules).collect()}
    assert got == {1: (datetime.date(2021, 1, 1), 3, [1], ["Aveiro"]), 2: (None, None, None, ["Ovar", "ovar "])}
    assert fused({"one": layer(spark)}, places(spark), severities, rules).count() == 0
    with pytest.raises(ValueError, match="several rows"):
        fused({"one": one}, places(spark), severities.union(severities), rules)


def test_modes_are_those_of_each_column(spark):
    rows = [(1, "b", 10), (1, "a", 9), (1, None, 9), (1, "a", None), (1, "b", 10), (2, None, None), (None, "c", 1), (None, "c", 2), (3, "x", 100), (3, "y", 20)]
    df = spark.createDataFrame(rows, "k int, s string, n int")
    got = {r["k"]: (r["text"], r["number"]) for r in modes(df, ["k"], {"text": "s", "number": "n"}).collect()}
    assert got == {1: ("a", 9), 2: (None, None), 3: ("x", 20), None: ("c", 1)}
    single = {r["k"]: r["mode"] for r in mode_by(df, ["k"], "s").collect()}
    assert single == {k: v[0] for k, v in got.items() if v[0] is not None}
