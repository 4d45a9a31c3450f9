"""Ids of a word-level BPE tokenizer for whole Arrow batches.

The tokenizer lower-cases, drops white space, and encodes words, single digits and runs of other characters each by itself. Batches
are cut into those units on their bytes; a unit met before is looked up by a 64-bit hash, and only new units go through the
tokenizer. Whatever stands between white space and holds a character on which that cut could differ from the tokenizer's (an
apostrophe, or anything beyond ASCII but the letters U+00C0 to U+00FF) is one unit as it is.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from lodeplane.llm.common import utf8
from lodeplane.llm.words import hashes_of

#: Units that a worker remembers; then it starts anew. About 40 bytes each.
CACHE_UNITS = 2_000_000
SLOT_BITS = 22
SPACE, LETTER, DIGIT, OTHER, WHOLE = 0, 1, 2, 3, 4
_KIND = np.full(256, OTHER, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = SPACE
_KIND[48:58] = DIGIT
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = LETTER
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_HARD = np.zeros(256, bool)
_HARD[39] = _HARD[128:] = True


class WordTokenizer:
    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kind = np.uint16 if max(self.tok.get_vocab_size(), end_id) < 65_536 else np.uint32
        self.end_id = end_id
        self.last = np.zeros(max(self.tok.get_vocab().values()) + 1, bool)  # ids that end a unit
        self.last[[i for x, i in self.tok.get_vocab().items() if x.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.slots, self.n, self.used = np.zeros(1 << SLOT_BITS, np.int32), 1, 0  # slot -> number of the first unit there; 0: none
        self.others: dict[int, int] = {}  # hash -> number, of units whose slot was taken
        self.key, self.at, self.size = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 18, self.kind)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text with the end id; a null is an empty text."""
        raw, offsets = utf8(column)
        low, start, end = units(raw, offsets)
        key = hashes_of(low, start, end)
        number = self.numbers(key, low, start, end)
        size = self.size[number]
        first = np.concatenate(([0], np.cumsum(size)))
        flat = self.ids[np.repeat(self.at[number] - first[:-1], size) + np.arange(first[-1])]
        cuts = first[np.searchsorted(start, offsets)].tolist()
        closing = np.array([self.end_id], self.kind)
        return [np.concatenate((flat[a:b], closing)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def numbers(self, key: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        number = self.slots[key >> np.uint64(64 - SLOT_BITS)]
        odd = np.flatnonzero((self.key[number] != key) | (number == 0))
        if not len(odd):
            return number
        kinds, first, of = np.unique(key[odd], return_index=True, return_inverse=True)
        found = np.array([self.others.get(k, 0) for k in kinds.tolist()], np.int32)
        if len(new := np.flatnonzero(found == 0)):
            if self.n + len(new) > CACHE_UNITS and self.n > 1:
                self.forget()
                return self.numbers(key, low, start, end)
            place = odd[first[new]]
            found[new] = self.learn(kinds[new], [low[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(start[place].tolist(), end[place].tolist(), strict=True)])
        number[odd] = found[of]
        return number

    def learn(self, keys: np.ndarray, texts: list[str]) -> np.ndarray:
        sizes, ids = self.tokenized(texts)
        n, m = self.n, len(keys)
        while n + m > len(self.key):
            self.key, self.at, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.key, self.at, self.size))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        number = np.arange(n, n + m, dtype=np.int32)
        self.key[n : n + m], self.size[n : n + m] = keys, sizes
        self.at[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + len(ids)] = ids
        self.n, self.used = n + m, self.used + len(ids)
        slot = keys >> np.uint64(64 - SLOT_BITS)
        free = np.flatnonzero(self.slots[slot] == 0)
        self.slots[slot[free[::-1]]] = number[free[::-1]]  # of several, the first stays
        taken = np.flatnonzero(self.slots[slot] != number)
        self.others.update(zip(keys[taken].tolist(), number[taken].tolist(), strict=True))
        return number

    def tokenized(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each unit has, and all ids. Many units at once, joined by blanks, where each is one word of the tokenizer."""
        plain = np.array([x.isascii() and "'" not in x or x.isalpha() for x in texts])
        sizes, parts = np.zeros(len(texts), np.int32), [np.zeros(0, self.kind)] * len(texts)
        easy = np.flatnonzero(plain).tolist()
        for i in range(0, len(easy), 500):
            own = easy[i : i + 500]
            ids = np.array(self.tok.encode_batch_fast([" ".join([texts[j] for j in own])], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.flatnonzero(self.last[ids]) + 1
            if len(cuts) != len(own):
                plain[own] = False
                continue
            for j, x in zip(own, np.split(ids.astype(self.kind), cuts[:-1]), strict=True):
                parts[j] = x
        hard = np.flatnonzero(~plain).tolist()
        for j, e in zip(hard, self.tok.encode_batch_fast([texts[j] for j in hard], add_special_tokens=False), strict=True):
            parts[j] = np.array(e.ids, self.kind)
        sizes[:] = [len(x) for x in parts]
        return sizes, np.concatenate(parts) if parts else np.zeros(0, self.kind)


@functools.lru_cache(maxsize=1)
def word_tokenizer(path: str, end_id: int) -> WordTokenizer:
    """One a worker process, so that its memory of units serves all its tasks."""
    return WordTokenizer(path, end_id)


def units(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes in lower case, and where each unit starts and ends."""
    n = len(raw)
    if not n:
        return raw, np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, kind, hard = _LOW[raw], _KIND[raw], _HARD[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    after = raw[lead + 1]
    good = (after != 0x97) & (after != 0xB7)  # the signs for times and divided by
    lead, after = lead[good], after[good]
    hard[lead] = hard[lead + 1] = False
    low[lead + 1] = np.where(after <= 0x9E, after + 0x20, after)
    edges = offsets[(offsets > 0) & (offsets < n)]
    if hard.any():
        space = kind == SPACE
        chunk_start = ~space
        chunk_start[1:] &= space[:-1]
        chunk_start[edges] = ~space[edges]
        chunk = np.cumsum(chunk_start)
        bad = np.zeros(chunk[-1] + 1, bool)
        bad[chunk[hard]] = True
        kind[bad[chunk] & ~space] = WHOLE
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    first[edges] = True
    begins = np.flatnonzero(first)
    ends = np.concatenate((begins[1:], [n]))
    real = kind[begins] != SPACE
    return low, begins[real], ends[real]
