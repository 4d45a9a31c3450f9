"""Merges that commit at once, and look-ups that ask once."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeplane.sources.merge_table import Conflict, MergeTable, RepeatedKeys
from lodeplane.sources.resolver import cache_schema, pending, resolve

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def held(spark, tmp_path):
    t = MergeTable.create(spark, f"{tmp_path}/t", ["k"], SCHEMA, buckets=16)
    t.merge(spark.range(200).select(F.col("id").alias("k"), F.concat(F.lit("a"), "id").alias("v")))
    return t


def test_only_touched_buckets_are_rewritten(spark, held):
    before = held.version()
    after = held.merge(spark.createDataFrame([(7, "x")], SCHEMA))
    changed = [b for b in before.runs if before.runs[b] != after.runs[b]]
    assert len(changed) == 1 and len(before.runs) == 16
    assert dict(rows(held.read())) == {i: f"a{i}" for i in range(200)} | {7: "x"}
    assert dict(rows(held.read(before.number)))[7] == "a7"  # older versions stay readable
    share = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{held.path}/data/{after.runs[changed[0]]}") for f in fs if f.endswith("parquet"))
    assert share < sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{held.path}/data") for f in fs if f.endswith("parquet")) / 8


def test_a_writer_that_stops_before_its_commit_changes_nothing(spark, held, monkeypatch):
    was = rows(held.read())
    monkeypatch.setattr(MergeTable, "commit", lambda self, version: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        held.merge(spark.createDataFrame([(7, "lost")], SCHEMA))
    monkeypatch.undo()
    assert rows(MergeTable(spark, held.path).read()) == was
    held.merge(spark.createDataFrame([(7, "kept")], SCHEMA))
    assert dict(rows(held.read()))[7] == "kept"
    assert held.vacuum() == 1 and dict(rows(held.read()))[7] == "kept"  # the lost run; the first one still holds the other buckets


def test_of_two_writers_one_wins(spark, held, monkeypatch):
    plain, other = MergeTable.commit, MergeTable(spark, held.path)

    def late(self, version):
        monkeypatch.setattr(MergeTable, "commit", plain)
        other.merge(spark.createDataFrame([(1, "first")], SCHEMA))
        return plain(self, version)

    monkeypatch.setattr(MergeTable, "commit", late)
    with pytest.raises(Conflict):
        held.merge(spark.createDataFrame([(1, "second"), (2, "second")], SCHEMA))
    got = dict(rows(held.read()))
    assert got[1] == "first" and got[2] == "a2"
    held.merge(spark.createDataFrame([(1, "second")], SCHEMA))
    assert dict(rows(held.read()))[1] == "second"
    with pytest.raises(Conflict):
        MergeTable.create(spark, held.path, ["k"], SCHEMA)
    assert not [x for x in os.listdir(f"{held.path}/versions") if x.startswith(".") and not x.endswith(".crc")]


def test_deletes_new_columns_and_what_is_refused(spark, held):
    held.merge(spark.createDataFrame([(i, None, i % 2 == 0) for i in range(198)] + [(500, "n", None)], "k long, v string, gone boolean"), delete="gone")
    got = {r.k: (r.v, r.gone) for r in held.read().collect()}
    assert set(got) == {*range(1, 198, 2), 198, 199, 500} and got[1] == (None, False) and got[199] == ("a199", None) and got[500] == ("n", None)
    number = held.version().number
    assert held.merge(spark.createDataFrame([], SCHEMA)).number == number
    held.merge(spark.createDataFrame([(198, "no"), (600, "yes")], SCHEMA), matched="keep")
    assert {r.k: r.v for r in held.read().filter("k IN (198, 600)").collect()} == {198: "a198", 600: "yes"}
    held.merge(spark.createDataFrame([(198,)], "k int"))  # a column that isn't there stays
    assert held.read().filter("k = 198").first().v == "a198"
    for bad in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(RepeatedKeys):
            held.merge(spark.createDataFrame(bad, SCHEMA))
    held.merge(held.read().select("k"), delete="true")
    assert held.read().count() == 0 and held.version().runs == {}
    with pytest.raises(FileNotFoundError):
        MergeTable(spark, f"{held.path}/none").read()


ANSWER = T.StructType([T.StructField("n", T.LongType())])


def asking(path, knows):
    """A resolver that notes what it is asked."""

    def run(batch):
        keys = batch.column("k").to_pylist()
        with open(f"{path}/{os.getpid()}", "a") as f:
            f.write("".join(f"{k}\n" for k in keys))
        return pa.array([{"n": k * 10} if knows(k) else None for k in keys], pa.struct([("n", pa.int64())]))

    return run


def asked(path):
    return sorted(int(k) for f in os.listdir(path) for k in open(f"{path}/{f}").read().split())


def test_each_key_is_asked_once(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    cache = MergeTable.create(spark, f"{tmp_path}/c", ["k"], cache_schema(T.StructField("k", T.LongType()), ANSWER), buckets=4)
    tiers = [("one", asking(tmp_path / "one", lambda k: k % 3 == 0)), ("two", asking(tmp_path / "two", lambda k: k % 3 == 1))]
    wanted = spark.createDataFrame([(i % 30, f"p{i}") for i in range(60)] + [(None, "p")], "k long, place string")
    first = resolve(wanted, cache, "k", tiers, ceiling=20, batch=7)
    assert asked(tmp_path / "one") == list(range(20)) and asked(tmp_path / "two") == [k for k in range(20) if k % 3]
    assert sum(r.tier is not None for r in first.collect()) == 2 * 14 and first.count() == 61
    found = {r.k: (r.answer and r.answer.n, r.tier) for r in resolve(wanted, cache, "k", tiers, ceiling=20).collect()}
    assert found == {None: (None, None)} | {k: ((k * 10, "one"), (k * 10, "two"), (None, None))[k % 3] for k in range(30)}
    assert asked(tmp_path / "one") == list(range(30))
    assert pending(wanted, cache, "k").count() == 0
    resolve(wanted, cache, "k", tiers, ceiling=20)
    assert asked(tmp_path / "one") == list(range(30)) and cache.read().count() == 30


def test_a_task_that_fails_and_is_run_again_writes_no_key_twice(spark, tmp_path):
    """The first try of a task answers and then fails; a local master doesn't try again, so the run is begun anew, as a scheduler would."""
    cache = MergeTable.create(spark, f"{tmp_path}/c", ["k"], cache_schema(T.StructField("k", T.LongType()), ANSWER), buckets=4)
    once = tmp_path / "failed"

    def failing(batch):
        if 13 in batch.column("k").to_pylist() and not once.exists():
            once.write_text("x")
            raise RuntimeError("lost")
        return pa.array([{"n": k} for k in batch.column("k").to_pylist()], pa.struct([("n", pa.int64())]))

    wanted = spark.range(40).select(F.col("id").alias("k"))
    with pytest.raises(Exception, match="lost"):
        resolve(wanted, cache, "k", [("t", failing)], ceiling=100, batch=5)
    assert cache.read().count() == 0
    assert resolve(wanted, cache, "k", [("t", failing)], ceiling=100, batch=5).count() == 40
    assert cache.read().count() == cache.read().select("k").distinct().count() == 40
    with pytest.raises(ValueError):
        resolve(wanted, cache, "k", [], ceiling=1)
