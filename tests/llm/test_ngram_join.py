import collections
import random

import numpy as np
import pytest
from lodeplane.llm.ngram_join import LEAST_GRAMS, bands_for, forest, one_of_each, op3_minhash_ngram_join, tied_parts, with_groups
from tests.llm.brute import jaccard_groups
from tests.oracle import SF


def test_bands_reach_the_recall():
    bands, rows = bands_for(0.8, 0.9995, 160)
    assert bands * rows <= 160 and 1 - (1 - 0.8**rows) ** bands >= 0.9995
    with pytest.raises(ValueError):
        bands_for(0.1, 0.9999, 2)


def test_forest():
    assert forest(5, np.array([3, 4]), np.array([1, 3])).tolist() == [0, 1, 2, 1, 1]


def variants(n, words=60, seed=1):
    random.seed(seed)
    base = [f"w{random.randint(0, 10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        own[random.randrange(words)] = f"x{i}"
        out.append(" ".join(own))
    return out


def check(docs, got):
    group, links, copies = jaccard_groups(docs)
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {d: (group[d], links[d]) for d, _ in docs}


def test_against_all_pairs_with_blocks(spark, make):
    texts = variants(90) + variants(30, 40, 2) + ["same text here"] * 25 + ["a b", "a  B", "one", None, "", "!!", "..."]
    docs = list(enumerate(texts))
    check(docs, with_groups(make(docs).repartition(3), block_grams=16 * LEAST_GRAMS, broadcast_keys=0).collect())
    check(docs, with_groups(make(docs)).collect())


def test_one_of_each_keeps_columns_and_single_rows(spark, make):
    texts = variants(12) + ["same text here now ok"] * 5 + [None, "", "unlike all others, this one"]
    docs = list(enumerate(texts)) + [(0, texts[0]), (0, texts[0]), (None, "null id text is a text too"), (None, "null id text is a text too")]
    kept = one_of_each(make(docs))
    assert kept.columns == make([]).columns
    group, _, _ = jaccard_groups(list(enumerate(texts)))
    want = collections.Counter({i for i, t in enumerate(texts) if group[i] == i}) + collections.Counter([None])
    assert collections.Counter(r.doc_id for r in kept.collect()) == want


def test_empty(spark, make):
    assert with_groups(make([])).count() == 0 and one_of_each(make([])).count() == 0


def test_query(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(docs, op3_minhash_ngram_join(spark, SF).collect())


def test_one_large_group_of_different_texts_in_blocks(spark, make):
    """Each text is near all others; a block goes to every other one."""
    docs = list(enumerate(variants(700, 200, 5) + variants(40, 200, 6)))
    got = with_groups(make(docs), block_grams=128 * LEAST_GRAMS).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 699), (700, 39)}


def test_tied_parts_against_brute_force():
    random.seed(2)
    for n in (1, 2, 5, 40):
        keys = np.array([[random.randrange(3 * n) * 4 + j for j in range(4)] for _ in range(n)])
        part = list(range(n))
        for _ in range(n):
            for a in range(n):
                for b in range(n):
                    if (keys[a] == keys[b]).any():
                        part[a] = part[b] = min(part[a], part[b])
        want = collections.defaultdict(list)
        for i, x in enumerate(part):
            want[x].append(i)
        assert sorted(map(sorted, (x.tolist() for x in tied_parts(keys)))) == sorted(x for x in want.values() if len(x) > 1)


def test_recall_by_similarity(spark, make):
    """Of pairs by similarity, those from the threshold on are found, none below it."""
    random.seed(7)
    docs = []
    for i in range(60):
        base = [f"b{i}x{j}" for j in range(100)]
        start = random.randrange(2, 40)
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:-start] + [f"c{i}x{j}" for j in range(start)]))]
    check(docs, with_groups(make(docs)).collect())


def test_a_long_text(spark, make):
    long = " ".join(f"v{i * 7919 % 1000003}" for i in range(600_000))
    got = {r.doc_id: (r.class_id, r.n_links) for r in with_groups(make([(1, long), (2, long + " and more"), (3, "short one")])).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
