"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodeplane.llm.spelling import Walk, last_forms, op12_spelling_variants, shared_start, spelling_groups, with_paths
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, word string, n string, rank string, p string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def count(docs):
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            out[run] += 1
    return out


def deletions(w):
    return {w[:i] + w[i + 1 :] for i in range(len(w))}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return min(a, b, key=len) in deletions(max(a, b, key=len))


def brute(docs, least_chars=5, least_count=3):
    words = {w: n for w, n in count(docs).items() if len(w) >= least_chars and n >= least_count}
    gone, out = {}, {}
    for w in words:  # words that are near share the word itself or one with a deletion
        for v in {w} | deletions(w):
            gone.setdefault(v, set()).add(w)
    for w, n in words.items():
        found = {x for v in {w} | deletions(w) for x in gone.get(v, ()) if near(w, x)}
        best = min(found, key=lambda x: (-words[x], x)) if found else None
        form = best if best and words[best] >= 2 * n else None
        out[w] = [form, w, n, len(found), words[form] if form else None]
    for row in out.values():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return sorted((w, *row) for w, row in out.items())


def rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.fixture(scope="module")
def docs(spark):
    return lambda found: spark.createDataFrame([(*d, "w", "n", "r", "p") for d in found], SCHEMA)


LETTERS = "aabbé"
WORDS = ["".join(LETTERS[(i // 5**k + k) % 5] for k in range(3 + i % 5)) for i in range(700)]


def test_all_pairs_of_small_words(docs):
    texts = [(i, " ".join(WORDS[i % 40 :: 1 + i % 7]) + "; Aaaaab AAaaab aaab") for i in range(90)]
    found = rows(spelling_groups(docs(texts), least_chars=3))
    assert found == brute(texts, 3) and max(r[4] for r in found) > 10 and any(r[2] != r[1] and r[2] != r[0] for r in found)


def test_odd_rows(docs):
    texts = [(1, None), (2, ""), (None, "hellos hellos hello hello hello hello hello hello"), (3, "hellos " * 2 + "x" * 3000 + " " + "x" * 3001), (3, "x" * 3001), (4, "x" * 3001 + " " + "x" * 3000 + "-" + "x" * 3000), (5, "ÀÉÎÕÜ àéîõü ĀÀÉÎÕÜ ÀÉÎÕÜ")]
    assert rows(spelling_groups(docs(texts))) == brute(texts)
    assert spelling_groups(docs([])).count() == 0
    with pytest.raises(ValueError):
        spelling_groups(docs([]), ratio=1)


def test_long_text_and_repeated_rows(docs):
    texts = [(1, "gutes gute guten Wetter wetter wettre " * 40_000), (1, "gutes gute guten " * 3)] * 2
    assert rows(spelling_groups(docs(texts))) == brute(texts)


def test_node_numbers(spark):
    words = sorted({w[:n] for w in WORDS for n in range(1, 8)})
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        found = with_paths(spark.createDataFrame([(w,) for w in words], "word string").repartition(5), F.col("word"), "p", "rank").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    number = {}
    for r in found:
        assert len(r.p) == len(r.word) + 1
        for i, node in enumerate(r.p):
            assert number.setdefault(r.word[:i], node) == node
    assert len(set(number.values())) == len(number)
    assert [r.word for r in sorted(found, key=lambda r: r.rank)] == words and sorted(r.rank for r in found) == list(range(len(words)))


def test_long_ways(spark):
    ways = spark.createDataFrame([(i, i + 1) for i in range(37)], "rank long, up long")
    assert all(r.root == 37 for r in last_forms(ways).collect())


@given(st.lists(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_walk(words):
    walk, number = Walk(), {}
    for w in sorted(set(words)):
        for i, node in enumerate(walk.take(w)):
            assert number.setdefault(w[: i + 1], node) == node
    assert sorted(number.values()) == list(range(len(number)))
    assert all(shared_start(a, b) == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a in words for b in words)


def test_whole_table(spark):
    texts = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert rows(op12_spelling_variants(spark, "/root/testdata/sf0.01")) == brute(texts)
