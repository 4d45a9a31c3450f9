import hashlib
import random

import numpy as np
import pytest
from lodeplane.llm.fingerprint import K, S, anchors, fingerprints, likeness, op7_closed_syncmer_fingerprints, read, span_hashes, with_edits, written
from lodeplane.llm.words import powers
from lodeplane.llm import fingerprint as module
from tests.oracle import SF


def hash_of(text):
    """The hash of a short text, as of an s-mer."""
    cps = np.array([ord(c) for c in text], np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((cps + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) * powers(module._BASE, len(cps)))))
        return int(span_hashes(sums, powers(module._INVERSE, len(cps)), len(cps))[0]) >> 32


def test_anchors_are_the_closed_syncmers():
    random.seed(3)
    text = "".join(random.choice("abcdé 𝒳") for _ in range(400))
    chosen = 0
    for i in range(len(text) - K + 1):
        inner = [hash_of(text[j : j + S]) for j in range(i, i + K - S + 1)]
        chosen += min(inner) in (inner[0], inner[-1])
    (got,) = anchors([text])
    assert len(got) == chosen


def test_context_free():
    random.seed(4)
    a, b, c = ("".join(random.choice("abcdefgh ") for _ in range(n)) for n in (300, 500, 250))
    (own,), (inside,) = anchors([b]), anchors([a + b + c])
    places = [i for i in range(len(inside)) if inside[i : i + len(own)].tolist() == own.tolist()]
    assert places and anchors([a, b, c])[1].tolist() == own.tolist()


def test_short_empty_and_long():
    x = anchors(["", "a", "a", "b", "x" * (K - 1), "y" * K, "z" * 50_000])
    assert [len(v) > 0 for v in x] == [False, True, True, True, True, True, True]
    assert x[1].tolist() == x[2].tolist() != x[3].tolist() and written(x[0]) == "" and read(written(x[6])).tolist() == x[6].tolist()


@pytest.mark.parametrize(("a", "b", "want"), [([], [], 1), ([1], [], 0), ([1, 2, 3], [1, 2, 3], 1), ([1, 2, 3, 4], [1, 2, 9, 4], 0.75), ([1, 2], [2, 1], 0.5), ([5, 5, 5], [5, 5], 0.8), ([1, 7, 2, 8], [9, 2, 1, 8], 0.5)])
def test_likeness(a, b, want):
    assert likeness(np.array(a, "<u4"), np.array(b, "<u4")) == likeness(np.array(b, "<u4"), np.array(a, "<u4")) == want


def expected(docs):
    """Pairs of doc id and sha of the edited text: by descending id (nulls last), then the hash that orders equal ids."""
    out = []
    for (i, t), (_, n) in zip(docs, docs[1:] + docs[:1]):
        m = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[: len(t) - m] + n[:m]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_neighbours_over_partitions(spark, make):
    random.seed(5)
    docs = [(i * 3 - 200, "".join(random.choice("abc dé") for _ in range(random.randint(0, 90)))) for i in range(300)]
    got = with_edits(make(docs).select("doc_id", "text").repartition(7)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == expected(sorted(docs, reverse=True))


def test_repeated_and_null_ids(spark, make):
    """Every row comes back once; rows with one id follow each other, and a hot id is split."""
    docs = [(7, f"text number {i}") for i in range(1500)] + [(None, None), (None, "null id"), (1, "same"), (1, "same"), (9, "top text")]
    got = with_edits(make(docs).select("doc_id", "text")).collect()
    assert len(got) == len(docs)
    from pyspark.sql import functions as F

    order = [(r.doc_id, r.t) for r in make(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("t")).orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("t")).collect()]
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == expected(order)
    (one,) = with_edits(make([(1, "abcdef")]).select("doc_id", "text")).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1
    assert with_edits(make([]).select("doc_id", "text")).count() == 0


def test_columns(spark, make):
    out = fingerprints(make([(1, "abc"), (1, None)]))
    assert out.columns[-1] == "fingerprint" and out.columns.count("fingerprint") == 1 and [r.fingerprint == "" for r in out.collect()] == [False, True]


def test_query(spark):
    docs = sorted(((d.doc_id, d.text or "") for d in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    got = op7_closed_syncmer_fingerprints(spark, SF).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == expected(docs)
    by_text = {}
    text = dict(docs)
    for r in got:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and abs(r.near_edited - likeness(read(r.fingerprint), read(r.edited_fingerprint))) < 1e-12
    near = sorted(r.near_edited for r in got)
    assert near[len(near) // 2] > 0.6 and sum(r.near_next > 0.3 for r in got) < 0.1 * len(got)


def test_short_texts_are_like_their_edits():
    """Two thirds of a text of 60 code points hold an anchor; those of shorter ones mostly."""
    random.seed(12)
    text = lambda n: "".join(random.choice("etaoin shrdlu") for _ in range(n))
    near = {n: [likeness(*anchors([t, t[: n - n // 3] + text(n // 3)])) for t in (text(n) for _ in range(40))] for n in range(20, 121, 10)}
    assert all(min(x) > 0 for n, x in near.items() if n >= 60)
    assert all(sum(v > 0 for v in x) > 20 for n, x in near.items() if 50 <= n < 60)
    assert sum(near[120]) / 40 > 0.4
