import collections
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from lodeplane.llm.packing import best_fill, in_powers, op4_min_bin_slack_packing, pack, pack_items, tokenizer_file
from lodeplane.llm.wordtokens import WordTokenizer
from tests.oracle import SF


@pytest.fixture(scope="module")
def tok():
    return WordTokenizer(tokenizer_file(), 2)


def test_best_fill_against_all_subsets():
    random.seed(2)
    for _ in range(200):
        items = [random.randint(1, 30) for _ in range(random.randint(0, 8))]
        target = random.randint(0, 60)
        want = max(s for n in range(len(items) + 1) for c in itertools.combinations(items, n) if (s := sum(c)) <= target)
        counts = collections.Counter(items)
        got, used = best_fill(sorted(counts, reverse=True), counts, target)
        assert got == want == sum(n * m for n, m in used.items()) and all(m <= counts[n] for n, m in used.items())


def test_windows_are_full_and_whole():
    random.seed(3)
    for kind in (lambda: random.randint(1, 63), lambda: 40, lambda: random.choice([33, 48, 63])):
        items = [(i, 0, kind()) for i in range(300)]
        windows, left = pack_items(items, 64)
        assert all(sum(x[2] for x in w) == 64 for w in windows) and sum(x[2] for x in left) < 64
        pieces = collections.defaultdict(list)
        for x in itertools.chain(*windows, *in_powers(left)):
            pieces[x[0]].append(x[1:])
        for doc, _, n in items:
            at = 0
            for start, m in sorted(pieces[doc]):
                assert start == at
                at += m
            assert at == n
        assert all(sum(x[2] for x in s).bit_count() == 1 for s in in_powers(left))


def test_ids_equal_the_tokenizers(tok):
    random.seed(4)
    odd = ["don't stop ’tis — x y 3½ ² áb Ünïcödé ŒUVRE ΣΑΣ İstanbul 'sun it's ''ll €5 12,345.67 \x1cq\x1d z\x85w", "", "  \n", "<|endoftext|> x", "日本語 テスト", "a" * 3000, "×÷ Ã— ÃÃ ß ẞ ſ ﬁ"]
    odd += ["".join(random.choice("aB'9 é.×É́\n\x1f-") for _ in range(40)) for _ in range(500)]
    for _ in range(2):  # new, and remembered
        for text, got in zip(odd, tok.encode(pa.array(odd)), strict=True):
            assert got.tolist() == [*tok.tok.encode(text, add_special_tokens=False).ids, 2]
    tok.forget()
    assert tok.encode(pa.array(["a", None]))[1].tolist() == [2]


def held(rows, ids_of):
    """Every piece's place and ids are right; gives the tokens of each sequence."""
    by, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for doc_id, pieces in by.items():
        ids, at = ids_of[doc_id], 0
        for r in sorted(pieces, key=lambda r: r.start):
            raw = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert r.start == at and r.doc_tokens == len(ids) and (r.ids_crc32 == zlib.crc32(raw) if "ids_crc32" in r else bytes(r.ids) == raw)
            at += r.length
        assert at == len(ids)
    out = {}
    for s, pieces in seqs.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        out[s] = at
    return out


def test_pools_nulls_and_empty(spark, make, tok):
    rows = [(i, "word " * (i * 7 % 90)) for i in range(60)] + [(60, None), (61, ""), (62, "x " * 400)]
    out = pack(make(rows).coalesce(2), tokenizer_file(), 2, capacity=64, pool_tokens=500).collect()
    sizes = held(out, {i: [*tok.tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows})
    assert max(sizes.values()) == 64 and all(n.bit_count() == 1 for n in sizes.values())
    assert pack(make([]), tokenizer_file(), 2).count() == 0
    twice = pack(make([(None, "a b"), (None, "a b")]).coalesce(1), tokenizer_file(), 2).collect()
    assert sum(r.length for r in twice) == 6


def test_query(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sizes = held(op4_min_bin_slack_packing(spark, SF).collect(), {d.doc_id: [*tok.tok.encode(d.text or "", add_special_tokens=False).ids, 2] for d in docs})
    assert max(sizes.values()) == 4096 and all(n.bit_count() == 1 for n in sizes.values())


def test_a_long_text_and_ties(spark, make, tok):
    """A text of many windows, and equally long ones that fill the same room."""
    long = " ".join(f"word{i % 9973}" for i in range(900_000))
    rows = [(1, long), *((i, "one two three") for i in range(2, 40))]
    out = pack(make(rows).coalesce(1), tokenizer_file(), 2).collect()
    short = len(list(tok.encode(pa.array(["one two three"])))[0])
    by: dict = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.start, r.length))
    assert len(by) == len(rows)
    for i, pieces in by.items():
        pieces.sort()
        assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:]))
        assert i == 1 or sum(n for _, n in pieces) == short
    assert sum(n for _, n in by[1]) > 900_000
