import collections

import numpy as np
import pytest
from lodeplane.llm.sharding import hypergeometric, matrix_row, shard_sizes, uniform_shuffle
from tests.oracle import SF


def test_the_matrix_has_exact_sums():
    counts = [5, 0, 17, 40, 1, 9]
    cum = np.cumsum([0, *counts])
    caps = shard_sizes(int(cum[-1]), 7)
    matrix = np.stack([matrix_row(cum, caps, b, 3) for b in range(len(counts))])
    assert (matrix.sum(axis=1) == counts).all() and (matrix.sum(axis=0) == caps).all() and (matrix >= 0).all()


def test_large_draws_have_the_right_mean():
    rng = np.random.default_rng(0)
    x = [hypergeometric(rng, 3 * 10**9, 6 * 10**9, 10**6) for _ in range(50)]
    assert abs(np.mean(x) - 10**6 / 3) < 300 and np.std(x) > 100


def test_counts_slots_and_rows(spark, make):
    rows = [(i, f"text {i % 9}") for i in range(500)] + [(None, None)] * 30 + [(7, "text 7")] * 40
    out = uniform_shuffle(make(rows).repartition(5), 8, slice_rows=20)
    got = out.collect()
    assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    sizes = [len(x) for x in by.values()]
    assert len(by) == 8 and max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert out.columns[-2:] == ["shard", "slot"] and "spans" in out.columns


def test_the_shuffle_is_uniform_and_repeatable(spark):
    df = spark.range(0, 4000, 1, 4)
    a = {r.id: r.shard for r in uniform_shuffle(df, 4, seed=1).collect()}
    assert a == {r.id: r.shard for r in uniform_shuffle(df, 4, seed=1).collect()}
    table = collections.Counter((i // 1000, s) for i, s in a.items())
    assert all(170 < n < 330 for n in table.values()) and len(table) == 16  # 250 each, over 5 deviations away


def test_empty_and_few(spark, make):
    assert uniform_shuffle(make([]), 5).count() == 0
    assert [(r.shard, r.slot) for r in uniform_shuffle(make([(1, "a")]), 5).collect()] == [(0, 0)]
    with pytest.raises(ValueError):
        uniform_shuffle(make([]), 0)


def test_query(spark):
    from lodeplane.llm.sharding import op6_hypergeometric_sharding
    import zlib

    got = {r.doc_id: r for r in op6_hypergeometric_sharding(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        raw = (d.text or "").encode()
        assert (got[d.doc_id]["size"], got[d.doc_id].text_crc32, got[d.doc_id].law, got[d.doc_id].grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


def test_long_texts_and_repeated_rows(spark, make):
    rows = [(i, "x" * 3_000_000) for i in range(4)] + [(9, "same")] * 8 + [(None, None)]
    out = uniform_shuffle(make(rows), 3).select("doc_id", "shard", "slot").collect()
    counts = collections.Counter(r.shard for r in out)
    assert len(out) == 13 and max(counts.values()) - min(counts.values()) <= 1 and len({(r.shard, r.slot) for r in out}) == 13
