"""Packing token sequences by minimum bin slack.

Each task packs the documents of its partition in pools of bounded size; no shuffle, no state between tasks. Whole windows
are cut from long documents; what remains of each document is an item. For every window the longest item left is taken and
a subset-sum dynamic programme over the multiset of the other lengths (a bitset of reachable sums; counts in powers of
two) finds the set that leaves the least slack; backtracking gives its counts, and the set is used as often as the counts
allow. Where even the best set leaves slack, the next item is cut to fill it, so that only what is left at the end of a
partition isn't a whole window; it is dealt out in sequences of powers of two, which aren't padded.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import pieces, table
from lodeplane.llm.wordtokens import word_tokenizer

CAPACITY = 4096
#: Tokens that a task holds before it packs them.
POOL_TOKENS = 4_000_000

Piece = tuple[int, int, int]  # document, first token, tokens


def best_fill(lengths: Iterable[int], counts: dict[int, int], target: int) -> tuple[int, dict[int, int]]:
    """The largest sum of at most `target` that items of these lengths (longest first) and counts reach, and how many of each make it."""
    reach, goal, limit, steps = 1, 1 << target, (1 << (target + 1)) - 1, []
    for n in lengths:
        left, many = min(counts[n], target // n), 1
        while left > 0:
            m = min(many, left)
            left, many, grown = left - m, many * 2, (reach | (reach << (n * m))) & limit
            if grown != reach:
                steps.append((reach, n, m))
                reach = grown
        if reach & goal:
            break
    best = total = reach.bit_length() - 1
    used: dict[int, int] = defaultdict(int)
    for before, n, m in reversed(steps):
        if not before >> total & 1:
            used[n] += m
            total -= n * m
    return best, dict(used)


def pack_items(items: list[Piece], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows from items shorter than capacity, and the items left, which together don't fill one."""
    held: dict[int, list[Piece]] = defaultdict(list)
    for item in reversed(items):
        held[item[2]].append(item)
    counts, windows, total = defaultdict(int, {n: len(x) for n, x in held.items()}), [], sum(x[2] for x in items)
    lengths = sorted(counts)

    def take(n: int) -> Piece:
        counts[n] -= 1
        if not counts[n]:
            del lengths[bisect_left(lengths, n)]
        return held[n].pop()

    while total >= capacity:
        top = lengths[-1]
        counts[top] -= 1
        filled, used = best_fill(reversed(lengths), counts, capacity - top)
        counts[top] += 1
        used[top] = used.get(top, 0) + 1
        slack = capacity - top - filled
        times = 1 if slack else min(counts[n] // m for n, m in used.items())
        windows += [[take(n) for n, m in used.items() for _ in range(m)] for _ in range(times)]
        if slack:
            doc, start, n = take(lengths[-1])
            windows[-1].append((doc, start, slack))
            if not counts[n - slack]:
                insort(lengths, n - slack)
            counts[n - slack] += 1
            held[n - slack].append((doc, start + slack, n - slack))
        total -= capacity * times
    return windows, [x for n in reversed(lengths) for x in reversed(held[n])]


def in_powers(items: list[Piece]) -> list[list[Piece]]:
    """The items one after another, cut into sequences whose lengths are the powers of two in their sum."""
    out, total, queue = [], sum(x[2] for x in items), list(reversed(items))
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            room, seq = 1 << bit, []
            while room:
                doc, start, n = queue.pop()
                seq.append((doc, start, min(n, room)))
                if n > room:
                    queue.append((doc, start + room, n - room))
                room -= seq[-1][2]
            out.append(seq)
    return out


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, pool_tokens: int = POOL_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most `capacity` tokens.

    One row a piece: the document's id, start, length, ids (its tokens, little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset. A null or empty text is the end token alone; repeated rows and null ids are packed like any others; an
    empty table gives no rows. sequence_id holds the partition's number above bit 33 and counts within it below.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, task = word_tokenizer(tokenizer_path, end_id), TaskContext.get().partitionId()
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        items: list[Piece] = []
        whole: list[list[Piece]] = []
        size, sequence = 0, 0

        def rows(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequence
            cols: list[list] = [[] for _ in names]
            for window in windows:
                at = 0
                for doc, start, n in window:
                    for col, value in zip(cols, (ids[doc], start, n, tokens[doc][start : start + n].astype("<u4").tobytes(), len(tokens[doc]), (task << 33) + sequence, at), strict=True):
                        col.append(value)
                    at += n
                sequence += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        def emptied(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, tokens, items, whole, size
            windows, left = pack_items(items, capacity)
            windows = whole + windows + (in_powers(left) if last else [])
            for i in range(0, len(windows), 500):
                yield rows(windows[i : i + 500])
            if not last:  # what is left opens the next pool
                kept = sorted({x[0] for x in left})
                place = {doc: i for i, doc in enumerate(kept)}
                ids, tokens = [ids[d] for d in kept], [tokens[d] for d in kept]
                items, whole, size = [(place[d], s, n) for d, s, n in left], [], sum(x[2] for x in left)

        for batch in pieces(batches, 1, 512):
            for doc_id, x in zip(batch.column(0).to_pylist(), tok.encode(batch.column(1)), strict=True):
                doc = len(ids)
                ids.append(doc_id)
                tokens.append(x)
                cut = len(x) - len(x) % capacity
                whole += [[(doc, s, capacity)] for s in range(0, cut, capacity)]
                if cut < len(x):
                    items.append((doc, cut, len(x) - cut))
                size += len(x)
                if size >= pool_tokens:
                    yield from emptied(last=False)
        if ids:
            yield from emptied(last=True)

    return source.mapInArrow(run, schema)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_min_bin_slack_packing(spark: SparkSession, sf_dir: str, path: Callable[[], str] = tokenizer_file) -> DataFrame:
    """All documents in sequences of at most 4096 tokens, each document followed by id 2."""
    pieces = pack(table(spark, sf_dir, "documents"), path(), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
