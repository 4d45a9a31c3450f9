"""License scans by patience alignment.

A notice is a template. Coverage counts matched words, and a word matches at most as often as it stands in the template and in the text: so only
documents, and only runs of words of at most one and a half times the template's length, that hold so many of its words, with repeats, are aligned with
it, and nothing that would be covered is left out. Words that occur once in both are anchors, the longest increasing
subsequence of their places is kept, and the gaps between anchors are aligned in the same way; equal words at the ends of
a gap match too. Coverage is the share of the template's words that match. What a match leaves before and behind it is searched again.

Words that tell licenses apart must agree: a notice's numbers, right after the word before them, and its telling words must match,
and no other telling word may stand in the run. Of a full text, each telling word must match once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import pieces, table
from lodeplane.llm.license_texts import NOTICES
from lodeplane.llm.words import Filter, in_sorted, words

#: Coverage that counts; templates of fewer than SHORT words must be covered whole.
COVERAGE, SHORT = 0.85, 12
#: Share of the words from the first match to the last that must match.
DENSITY = 0.8
#: Runs of a template, at their longest, in a stretch of a text that is searched at once.
SPAN = 16
#: Words that tell a license from others, those that do so behind `gnu`, and the words from which a template is a full text.
TELLING = frozenset("sharealike sa noncommercial nc noderivatives noderivs nd endorse".split())
TELLING_GNU = frozenset("affero lesser library".split())
FULL = 150


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Matching places of two sequences, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: j for j, x in enumerate(b[b0:b1], b0) if once_b[x] == 1}
        anchors = [(i, place[x]) for i, x in enumerate(a[a0:a1], a0) if once_a[x] == 1 and x in place]
        chain = increasing(anchors)
        if chain:
            out += chain
            ends = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends[:-1], ends[1:], strict=True)]
    return sorted(out)


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first numbers, whose second numbers increase."""
    tails: list[int] = []
    tops: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        before[i] = tops[at - 1] if at else -1
        tails[at : at + 1], tops[at : at + 1] = [j], [i]
    out, i = [], tops[-1] if tops else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def candidate_runs(places: list[int], kinds: list[int], counts: dict[int, int], need: int, length: int) -> list[tuple[int, int, int]]:
    """Runs (a, tight, b) of words [a, b) that hold `need` of the template's words, with repeats; the fullest first, then the shortest.

    places: where words of the template stand in the document; kinds: which; counts: how often each stands in the template. [tight, b) holds as many.
    A match is at most length / DENSITY words long, so that the run that ends with it holds it.
    """
    reach = length + length // 2 + 2
    held: Counter = Counter()
    inner: Counter = Counter()
    lo, tight, total, full = 0, 0, 0, []
    for hi, (p, k) in enumerate(zip(places, kinds, strict=True)):
        total += held[k] < counts[k]
        held[k] += 1
        inner[k] += 1
        while places[lo] <= p - reach:
            held[kinds[lo]] -= 1
            total -= held[kinds[lo]] < counts[kinds[lo]]
            lo += 1
        while tight < lo or tight < hi and inner[kinds[tight]] > counts[kinds[tight]]:
            inner[kinds[tight]] -= 1
            tight += 1
        if total >= need:
            full.append((-total, p - places[tight], places[lo], places[tight], p + 1))
    return [(a, t, b) for _, _, a, t, b in sorted(full)]


class Templates:
    def __init__(self, notices: Sequence[tuple[str, str]]) -> None:
        w = words(pa.array([text for _, text in notices], pa.large_string()))
        self.names = [name for name, _ in notices]
        self.keys = [w.key[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        self.all = np.unique(w.key)
        self.member = np.zeros((len(self.all), len(notices)), np.float32)
        self.need = [int(np.ceil((COVERAGE if len(own) >= SHORT else 1.0) * len(own) - 1e-9)) for own in self.keys]
        for t, own in enumerate(self.keys):
            np.add.at(self.member[:, t], np.searchsorted(self.all, np.array(own, np.uint64)), 1)
        self.counts = [{k: int(self.member[k, t]) for k in np.flatnonzero(self.member[:, t]).tolist()} for t in range(len(notices))]
        key = lambda x: words(pa.array([" ".join(sorted(x))], pa.large_string())).key.tolist()
        self.telling, self.telling_gnu, (self.gnu, self.affero) = set(key(TELLING)), set(key(TELLING_GNU)), (*key(["gnu"]), *key(["affero"]))
        self.numbers = [
            {i for i, (x, y) in enumerate(zip(w.start[a:b].tolist(), w.end[a:b].tolist(), strict=True)) if w.low[x:y].tobytes().lstrip(b"v").isdigit()} if b - a < FULL else set()
            for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)
        ]
        self.marks = [self.marked(own) for own in self.keys]

    def marked(self, keys: Sequence[int]) -> set[int]:
        """Places of telling words. Full texts of the same steward name each other's licenses: see `agrees`."""
        return {i for i, x in enumerate(keys) if x in self.telling or x in self.telling_gnu and i and keys[i - 1] == self.gnu}

    def agrees(self, t: int, run: Sequence[int], matched: list[tuple[int, int]]) -> bool:
        """Whether the words that tell licenses apart are the same in a run and in template t."""
        own, there = self.keys[t], {j: i for i, j in matched}
        lost = self.marks[t] - there.keys()
        extra = {i for i in self.marked(run) if matched[0][0] <= i <= matched[-1][0]} - {i for i, _ in matched}
        if len(own) >= FULL:  # `lesser` and `library` took each other's place in full texts that name both
            found = {own[j] for j in self.marks[t] & there.keys()}
            swapped = {x for x in self.telling_gnu if x != self.affero}
            return {own[j] for j in lost} - swapped <= found and {run[i] for i in extra} <= swapped
        follows = lambda j: j in there and (not j or there.get(j - 1) == there[j] - 1)
        return not lost and not extra and all(follows(j) for j in self.numbers[t])

    def matches(self, t: int, key: np.ndarray, place: np.ndarray, kind: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
        """Matches (first word, end, matched words) of template t in the words lo to hi - 1, in order; a stretch of SPAN runs at a time.

        A match is shorter than twice a run. One that ends so near a stretch's end that it may go on is left to the next stretch, which
        begins early enough to hold it.
        """
        reach = 2 * (len(self.keys[t]) + len(self.keys[t]) // 2 + 2)
        while lo < hi:
            i = int(np.searchsorted(place, lo))
            if i == len(place) or place[i] >= hi:
                return
            lo = max(lo, int(place[i]) - reach)  # nothing of the template stands before
            end = min(hi, lo + SPAN * reach)
            done = lo
            for match in sorted(self.matches_within(t, key, place, kind, lo, end)):
                if match[1] <= end - reach or end == hi:
                    yield match
                    done = match[1]
            lo = max(done, end - 2 * reach) if end < hi else hi

    def matches_within(self, t: int, key: np.ndarray, place: np.ndarray, kind: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
        """Matches of template t in the words lo to hi - 1; what each leaves is searched again.

        place, kind: where the template's words stand, and which. Words that cover the template but for its telling words are another
        license's: runs that lie in them by half aren't aligned any more.
        """
        own, todo = self.keys[t], [(lo, hi)]
        length, need = len(own), self.need[t]
        while todo:
            lo, hi = todo.pop()
            i, j = np.searchsorted(place, (lo, hi))
            others: list[tuple[int, int]] = []
            aligned: set[tuple[int, int]] = set()
            for loose, tight, end in candidate_runs(place[i:j].tolist(), kind[i:j].tolist(), self.counts[t], need, length):
                if any(2 * (min(y, end) - max(x, tight)) > end - tight for x, y in others):
                    continue
                found = None
                for start in dict.fromkeys((tight, loose)):
                    a, b = max(lo, start - length // 4), min(hi, end + length // 4)
                    if (a, b) in aligned:
                        continue
                    aligned.add((a, b))
                    run = key[a:b].tolist()
                    matched = patience(run, own)
                    if len(matched) < need or len(matched) < DENSITY * (matched[-1][0] + 1 - matched[0][0]):
                        continue
                    span = a + matched[0][0], a + matched[-1][0] + 1
                    if self.agrees(t, run, matched):
                        found = (*span, len(matched))
                        break
                    others.append(span)
                if found:
                    yield found
                    todo += [(lo, found[0]), (found[1], hi)]
                    break

    def scan(self, column: pa.Array) -> list[list[tuple[int, int, str, float]]]:
        """Of each text: (first word, end, license, coverage), disjoint, in order."""
        w, seen = words(column), Filter(self.all)
        place = seen.maybe(w.key)
        kind, there = in_sorted(w.key[place], self.all)
        place, kind = place[there], kind[there]
        row = np.searchsorted(w.first, place, side="right") - 1
        held = np.zeros((len(column), len(self.all)), bool)
        held[row, kind] = True
        need = np.array(self.need)
        enough = (held.astype(np.float32) @ self.member >= need) & (need > 0)  # a first look: whichever words there are could match as often as they may
        cuts = np.searchsorted(row, np.arange(len(column) + 1))
        out: list[list[tuple[int, int, str, float, int]]] = [[] for _ in range(len(column))]
        for r, t in np.argwhere(enough).tolist():
            mine = self.member[kind[cuts[r] : cuts[r + 1]], t] > 0
            first, length = int(w.first[r]), len(self.keys[t])
            for a, b, n in self.matches(t, w.key, place[cuts[r] : cuts[r + 1]][mine], kind[cuts[r] : cuts[r + 1]][mine], first, int(w.first[r + 1])):
                out[r].append((a - first, b - first, self.names[t], n / length, n))
        return [disjoint(x) for x in out]


def disjoint(found: list[tuple[int, int, str, float, int]]) -> list[tuple[int, int, str, float]]:
    """Of overlapping matches the one with the most matched words stays, then the shortest, then the first by name."""
    kept: list[tuple[int, int, str, float]] = []
    for x in sorted(found, key=lambda x: (-x[4], x[1] - x[0], x[2], x[0])):
        at = bisect_left(kept, x[:2])  # only the neighbours in order can overlap
        if (not at or kept[at - 1][1] <= x[0]) and (at == len(kept) or x[1] <= kept[at][0]):
            kept.insert(at, x[:4])
    return kept


def scan_licenses(docs: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """docs (with a string column text) plus licenses: array of (start, end: words; name, coverage), in order; empty for null texts.

    Each row depends on its text alone. A column licenses of docs is replaced. Templates without words match nothing.
    """
    docs = docs.drop("licenses")
    at_text = docs.columns.index("text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(notices)
        for batch in pieces(batches, at_text):
            found = [[{"start": a, "end": b, "name": n, "coverage": c} for a, b, n, c in x] for x in templates.scan(batch.column(at_text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, "licenses"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, licenses array<struct<start: long, end: long, name: string, coverage: double>>")


def op5_patience_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["name"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct("licenses.name")), ",").alias("licenses"),
        F.coalesce(F.array_max("licenses.coverage"), F.lit(0.0)).alias("coverage"),
        spans.alias("spans"),
    )
