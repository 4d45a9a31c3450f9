import hashlib
import random

from pyspark.sql import functions as F

from lodeplane.llm.decontam import clean_of_benchmark, find_windows, op8_benchmark_decontamination
from lodeplane.llm.queries import ORACLES
from tests.llm.brute import hits
from tests.oracle import SF, from_duckdb, from_spark


def against_brute(docs, items, found):
    for r in found.collect():
        n, places, ids = hits(dict(docs)[r.doc_id], items)
        got = {i for s in r.spans for i in range(s.a, s.b)}
        assert (r.n_words, got, set(r["items"])) == (n, places, {None if x is None else str(x) for x in ids}), r.doc_id
        assert all(x.b < y.a for x, y in zip(r.spans, r.spans[1:]))


def cases():
    random.seed(6)
    common = [f"c{i}" for i in range(6)]
    items = [(i, " ".join(random.choice(common) for _ in range(random.randint(0, 25)))) for i in range(12)]
    items += [(20, "Ünï two THREE"), (21, "a"), (22, ""), (23, None), (24, items[0][1]), (None, "no id but nine words one two three four")]
    docs = []
    for i in range(60):
        own = [random.choice([*common, "z"]) for _ in range(random.randint(0, 80))]
        for _ in range(random.randint(0, 2)):
            own.insert(random.randint(0, len(own)), random.choice(items[:14])[1] or "")
        docs.append((i, " ".join(own)))
    docs += [(100, None), (101, ""), (102, "A, a; b"), (103, "ünï two three. Ünï-TWO three"), (104, " ".join(["c1"] * 5000)), (105, "x no id, but nine words one two three four")]
    return docs, items


def test_against_brute_force_with_an_index_sent_and_joined(spark, make):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1_000_000, 0):
        against_brute(docs, items, find_windows(make(docs).repartition(3), bench, block_bytes=block_bytes))


def test_clean_documents_keep_their_columns(spark, make):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = clean_of_benchmark(make(docs), bench)
    assert kept.columns == make([]).columns
    assert {r.doc_id for r in kept.collect()} == {d for d, t in docs if not hits(t, items)[1]}
    assert {r.spans for r in kept.collect()} == {"s"}


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert clean_of_benchmark(make([(1, "a b"), (2, None)]), none).count() == 2
    assert clean_of_benchmark(make([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_query(spark):
    got = from_spark(op8_benchmark_decontamination(spark, SF))
    assert got == from_duckdb(ORACLES["op8_benchmark_decontamination"])
    assert any(hashlib.sha256(b"").hexdigest() not in r for r in got[1])


def test_rows_keep_their_hits_behind_a_shuffle_and_a_random_column(spark, make):
    """The parent is dealt anew, coalesced at run time and not deterministic; the benchmark is larger than the index that is sent."""
    docs, items = cases()
    bench = spark.createDataFrame(items * 50, "item_id long, text string")
    parent = make(docs).repartition(40, F.rand()).withColumn("n_chars", F.rand() * 100)
    against_brute(docs, items, find_windows(parent, bench, block_bytes=1000))


def test_whole_table_by_join(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "benchmark"))
    sent, joined = ({r.doc_id: (r.n_words, r.spans, r["items"]) for r in find_windows(docs, bench, block_bytes=n).collect()} for n in (10**9, 0))
    assert sent == joined and any(x[1] for x in sent.values())


def test_a_long_text(spark, make):
    docs = [(1, " ".join(f"v{i}" for i in range(1_500_000))), (2, "v7")]
    items = [(1, " ".join(f"v{i}" for i in range(900_000, 900_014))), (2, "v1499999")]
    found = {r.doc_id: ([tuple(s) for s in r.spans], r["items"]) for r in find_windows(make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found == {1: ([(900_000, 900_014), (1_499_999, 1_500_000)], ["1", "2"]), 2: ([], [])}


def test_clashing_names_with_a_benchmark_of_any_size(spark):
    """Columns named as those of the join keep their values whichever plan the benchmark's size asks for."""
    docs = spark.createDataFrame([(1, "one two three four", 5, "s", 7.5), (2, None, 6, None, None)], "doc_id long, text string, row int, _spans string, _items double")
    bench = spark.createDataFrame([("x", "two three"), ("y", "nine")], "item_id string, text string")
    want = [(1, "one two three four", 5, "s", 7.5, 4, ["x"]), (2, None, 6, None, None, 0, [])]
    for size in (1 << 21, 0):
        found = find_windows(docs, bench, block_bytes=size)
        assert found.columns == [*docs.columns, "n_words", "spans", "items"]
        assert sorted((r.doc_id, r.text, r.row, r._spans, r._items, r.n_words, r["items"]) for r in found.collect()) == want
