"""Linkage by votes against all pairs compared one by one."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as S

from lodeplane.functions.phonetic import codes, metaphone_key
from lodeplane.operators import linkage
from lodeplane.operators.linkage import link_by_votes

SCHEMA = S.StructType([S.StructField("id", S.LongType()), S.StructField("name", S.StringType()), S.StructField("area", S.StringType()), S.StructField("code", S.LongType()), S.StructField("x", S.DoubleType()), S.StructField("y", S.DoubleType())])


def fold(name):
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in (name or "").lower().translate(str.maketrans("áéíóúãç", "aeiouac"))).split())


def grams(name):
    return {f"  {w} "[i : i + 3] for w in name.split() for i in range(len(w) + 1)}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def share(a, b):
    return len(a & b) / len(a | b) if a | b else None


def sound(name):
    return codes(" ".join(name.split()[:2]))[0]


def twin(left, right, reach):
    """What each left record is given, pair by pair."""
    out = {}
    for l, name, area, code, x, y in left:
        a, picks, direct = fold(name), {}, []
        for r, name_r, area_r, code_r, xr, yr in right:
            b = fold(name_r)
            d = math.hypot(x - xr, y - yr) if None not in (x, y, xr, yr) else None
            trigram = share(grams(a), grams(b)) or 0.0
            by = lambda s: (-s, d is None, d or 0.0, r)  # noqa: B023, E731
            if code is not None and code == code_r:
                direct.append((by(trigram), r, trigram, d))
            if not (area and area == area_r or d is not None and d <= reach):
                continue
            longer = max(len(a), len(b))
            scores = {"trigram": (trigram, 0.6), "edit": (1 - edits(a, b) / longer if longer else None, 0.5), "token": (share(set(a.split()), set(b.split())), 0.3), "sound": (1.0 if a and b and sound(a) and sound(a) == sound(b) else None, 1.0)}
            for vote, (s, least) in scores.items():
                if s is not None and s >= least:
                    picks[vote] = min(picks.get(vote, ((math.inf,),)), (by(s), r, s, d))
        if direct:
            _, r, s, d = min(direct)
            out[l] = (r, "code", "high", 4, s, d)
            continue
        chosen = [p[1] for p in picks.values()]
        n, r = min(((-chosen.count(r), r) for r in chosen), default=(0, None))
        _, _, s, d = picks.get("trigram", (None, None, None, None))
        ok = s is not None and s >= 0.7 and d is not None and d <= 3000
        confidence = {4: "high" if ok else "medium", 3: "high" if ok else "medium", 2: "medium" if ok else "low"}.get(-n)
        out[l] = (r, f"votes_{confidence}", confidence, -n, s, d) if confidence else (None, "unmatched", None, None, None, None)
    return out


def records(rng, n, first):
    words = ["escola", "básica", "secundária", "são", "joão", "pedro", "katherine", "catherine", "wright", "right", "smith", "centro"]
    out = []
    for i in range(n):
        name = " ".join(rng.choices(words, k=rng.randint(0, 4))) if rng.random() > 0.1 else None
        if name and rng.random() < 0.4:
            cut = rng.randrange(len(name))
            name = name[:cut] + name[cut + 1 :]
        at = (float(rng.randrange(3000)), float(rng.randrange(3000))) if rng.random() > 0.2 else (None, None)
        # one area holds most records, one is empty, some have none
        out.append((first + i, name, rng.choice(["a", "a", "a", "b", "", None]), rng.choice([None, None, None, rng.randrange(8)]), *at))
    return out


def got(df):
    return {r["l"]: (r["r"], r["method"], r["confidence"], r["votes"], r["score"] and round(r["score"], 9), r["d"] and round(r["d"], 6)) for r in df.collect()}


@pytest.mark.parametrize("block", [3, 1024])
def test_links_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(linkage, "BLOCK", block)
    rng = random.Random(block)
    left, right = records(rng, 70, 0), records(rng, 80, 1000)
    want = {k: (r, m, c, n, s and round(s, 9), d and round(d, 6)) for k, (r, m, c, n, s, d) in twin(left, right, 300.0).items()}
    linked = link_by_votes(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), 300.0, sound=metaphone_key)
    assert got(linked) == want
    assert len({v[1] for v in want.values()}) >= 4


def test_no_group_of_the_join_grows_with_its_area(spark, monkeypatch):
    monkeypatch.setattr(linkage, "BLOCK", 16)
    wide = spark.range(400).select(F.col("id").alias("l"), F.lit("a").alias("l_area"), F.lit(None).cast("double").alias("l_x"), F.lit(None).cast("double").alias("l_y"))
    other = wide.select(*[F.col(c).alias("r" + c[1:]) for c in wide.columns])
    plan = linkage._meeting(wide, other, 10.0)
    assert plan.select("l", "r").distinct().count() == plan.count() == 400 * 400
    blocks = wide.select(F.pmod(F.xxhash64(F.lit("block"), "l"), F.lit(25)).alias("b")).groupBy("b").count()
    assert blocks.agg(F.max("count")).first()[0] < 3 * 16


def test_records_without_partners_and_empty_tables(spark):
    one, none = spark.createDataFrame([(1, "smith", "a", 7, 0.0, 0.0), (2, None, None, None, None, None)], SCHEMA), spark.createDataFrame([], SCHEMA)
    unmatched = (None, "unmatched", None, None, None, None)
    assert got(link_by_votes(one, none, 10.0)) == {1: unmatched, 2: unmatched}
    assert got(link_by_votes(none, one, 10.0)) == {}
    # a record without a place isn't preferred to a near one
    right = spark.createDataFrame([(5, "smith", "a", None, None, None), (6, "smith", "a", None, 3.0, 4.0)], SCHEMA)
    assert got(link_by_votes(one, right, 10.0))[1] == (6, "votes_high", "high", 4, 1.0, 5.0)
