"""Token alignment against whole-text encodings and every pair of tokens."""

import collections
import hashlib
import json

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lodeplane.llm import alignment
from lodeplane.llm.alignment import aligned, cross_tokenizer_alignment, op11_cross_tokenizer_alignment, stretches, tokenizer_files


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def ranges(found):
    out, at = [], 0
    for i, raw in found:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(docs, both):
    a_tok, b_tok = both
    letters = {c: b for b, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]), strict=True)}
    n = 0
    for b in range(256):
        if b not in letters.values():
            letters[chr(256 + n)] = b
            n += 1
    out, links, counts = [], [], collections.Counter()
    for doc, text in docs:
        a = b = []
        if text:
            a = [(i, bytes(letters[c] for c in a_tok.id_to_token(i))) for i in a_tok.encode(f" {text}", add_special_tokens=False).ids]
            b = [(i, bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()) for i in b_tok.encode(text)]
            if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == f" {text}".encode():
                a = b = []
        a, b = ranges(a), ranges(b)
        mine = [(x, y) for x, s, e in a for y, s2, e2 in b if s < e2 and s2 < e]
        counts.update(mine)
        links.append(mine)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        text, at = [], 0
        for end in ends:
            text.append(",".join(str(i) for i, s, e in a if at <= s and e <= end) + "|" + ",".join(str(i) for i, s, e in b if at <= s and e <= end))
            at = end
        out.append([doc, len(a), len(b), len(ends), len(mine), hashlib.sha256(";".join(text).encode()).hexdigest() if ends else ""])
    tops = collections.Counter()
    for (_, y), c in counts.items():
        tops[y] = max(tops[y], c)
    return sorted((*row[:5], sum(counts[p] == tops[p[1]] for p in mine), sum(counts[p] for p in mine), row[5]) for row, mine in zip(out, links, strict=True))


TEXTS = [
    (1, "The cat's hats are in Zürich, naïve café"),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "a ▁ text with the piece's own mark"),
    (6, "two  spaces,\ttabs\n\nlines  and 日本語 🎉 end "),
    (7, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (8, "aaaaaaaaaaaaaaaaaaaaaaaaaaa 1234567890 ... ---"),
    (9, "The cat's hats are in Zürich, naïve café"),
    (10, "\x00\x1f x \x85 y  z"),
    (11, "é ́ combining ﻿ mark"),
]


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_against_every_pair(make, both):
    found = rows(cross_tokenizer_alignment(make([*TEXTS, TEXTS[0]]), *tokenizer_files()))
    assert found == brute([*TEXTS, TEXTS[0]], both)
    assert [r for r in found if r[0] == 5] == [(5, 0, 0, 0, 0, 0, 0, "")]


def test_the_rare_pairs_meet_their_counts_in_a_join(make, both):
    for sent in (0, 5, 20):
        assert rows(cross_tokenizer_alignment(make(TEXTS), *tokenizer_files(), sent_pairs=sent)) == brute(TEXTS, both)


def test_stretches_and_few_units_held_change_nothing(make, both):
    docs = [(1, " ".join(t for _, t in TEXTS if t and "▁" not in t) * 3), (2, "x" * 300), (3, "one two ▁ " * 9)]
    found = aligned(make(docs), *tokenizer_files(), units_held=3, part_chars=50)
    assert rows(alignment.with_counts(found)) == brute(docs, both)


def test_stretches_give_the_text_back():
    text = "ab cd  ef \n gh " * 50
    assert " ".join(stretches(text, 20)) == text
    assert all(x for x in stretches(text, 20))


def test_white_space_at_the_ends_does_not_run_into_the_next_unit(make, both):
    docs = [(1, "one \xa0"), (2, "\n\ntwo"), (3, "three  "), (4, "  four\t"), (5, "\xa0\r five"), (6, "six\n"), (7, " "), (8, "\n \n"), (9, "nine  \n"), (10, " ten")]
    assert rows(cross_tokenizer_alignment(make(docs).coalesce(1), *tokenizer_files())) == brute(docs, both)


def test_a_long_text(make, both):
    text = "Ein langer Text mit vielen Wörtern. " * 60_000
    [row] = cross_tokenizer_alignment(make([(1, text)]), *tokenizer_files()).collect()
    assert row.n_a == len(both[0].encode(f" {text[:-1]}", add_special_tokens=False).ids) + 1
    assert row.n_links == row.n_a + row.n_b - row.n_groups


def test_empty_table_null_ids_and_whole_table(spark, make, both):
    assert cross_tokenizer_alignment(make([]), *tokenizer_files()).count() == 0
    [row] = cross_tokenizer_alignment(make([(None, "x")]), *tokenizer_files()).collect()
    assert row.doc_id is None and row.n_links == 1
    found = rows(op11_cross_tokenizer_alignment(spark, "/root/testdata/sf0.001"))
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    short = {d for d, t in docs if len(t or "") < 6000}
    by_id = {r[0]: r for r in brute(docs, both)} if len(short) == len(docs) else None
    assert len(found) == len(docs)
    plain = brute([x for x in docs if x[0] in short], both)
    for got, want in zip([r for r in found if r[0] in short], plain, strict=True):
        assert got[:5] == want[:5] and got[7] == want[7]
    if by_id:
        assert found == sorted(by_id.values())


def test_the_alphabet():
    vocabulary = json.load(open(public_tokenizers.path("byte_bpe_50k.json")))["model"]["vocab"]
    assert set("".join(vocabulary)) <= set(alignment.byte_level_alphabet())
    assert sorted(alignment.byte_level_alphabet().values()) == list(range(256))
