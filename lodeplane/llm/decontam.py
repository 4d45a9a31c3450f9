"""Benchmark decontamination by a prefix-filtered set join.

Windows of `size` consecutive words of each benchmark item (a shorter item is one window) are sets of word shingles. A
document holds a window only if it holds all of its shingles, so that the necessary prefix is one token: the window's
rarest shingle, by counts over all documents. Documents are probed for those tokens only; a match at word i of a document for a
token at place p of a window is kept if p words stand before and enough after it in the same document (length and
positional bounds), and is verified on all words of the window, by their bytes.

One scan of the documents counts tokens and one probes for them, however large the benchmark. The index of a benchmark of at most
BLOCK_BYTES is sent to the tasks as a whole. A larger one's windows stay a table: tokens are counted and prefixes chosen by joins, documents
send the words around the tokens that pass a filter of fixed size, and these meet the index in a join by token.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import first_filter, passing, pieces, shield, stored, table
from lodeplane.llm.words import Filter, in_sorted, shingles, words

WINDOW = 10
#: Words of a shingle, the token of the join.
TOKEN = 3
#: UTF-8 bytes of benchmark texts whose index is sent as a whole: its windows, a few hundred bytes each, then take some tens of MB.
BLOCK_BYTES = 2_000_000

_SPANS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


@dataclass
class Block:
    """Windows of some items: their words' bytes, hashes, and the items they come from."""

    texts: list[bytes] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    grams: list[np.ndarray] = field(default_factory=list)  # shingles of each window, at places 0, 1, ...
    items: list[list[str | None]] = field(default_factory=list)

    def tokens(self, size: int) -> np.ndarray:
        found = [g for g, n in zip(self.grams, self.lengths, strict=True) if min(n, TOKEN) == size]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def block_of(items: list[tuple[str | None, str]], size: int) -> Block:
    block, seen = Block(), {}
    w = words(pa.array([text for _, text in items], pa.large_string()))
    for (item, _), a, b in zip(items, w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        n = min(size, b - a)
        for i in range(a, b - n + 1 if n else a):
            text = w.text(i, i + n)
            if text not in seen:
                seen[text] = len(block.texts)
                block.texts.append(text)
                block.lengths.append(n)
                block.grams.append(shingles(w.key[i : i + n], min(n, TOKEN)))
                block.items.append([])
            if item not in (own := block.items[seen[text]]):
                own.append(item)
    return block


def counted(docs: DataFrame, block: Block) -> dict[int, dict[int, int]]:
    """How often the block's shingles of each size occur in all documents; summed in each task before the shuffle."""
    tokens = {n: t for n in range(1, TOKEN + 1) if len(t := block.tokens(n))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {n: Filter(t) for n, t in tokens.items()}
        sums = {n: np.zeros(len(t), np.int64) for n, t in tokens.items()}
        for batch in pieces(batches):
            w = words(batch.column(0))
            for n, t in tokens.items():
                grams = shingles(w.key, n)
                place = filters[n].maybe(grams)
                at, there = in_sorted(grams[place], t)
                sums[n] += np.bincount(at[there], minlength=len(t))
        for n, s in sums.items():
            some = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), n, np.int32)), pa.array(tokens[n][some].view(np.int64)), pa.array(s[some])], names=["n", "token", "times"])

    out: dict[int, dict[int, int]] = {n: {} for n in tokens}
    for n, token, times in docs.select("text").mapInArrow(run, "n int, token long, times long").groupBy("n", "token").agg(F.sum("times")).collect():  # at most a row a token of the block
        out[n][token & ((1 << 64) - 1)] = times
    return out


def prefixes(block: Block, times: dict[int, dict[int, int]]) -> dict[int, tuple[np.ndarray, dict[int, list[tuple[int, int]]]]]:
    """By shingle size: the sorted prefix tokens, and for each the windows that it stands for with its place in them.

    Shingles are ordered by their counts, then by their values. A window one of whose shingles no document has can't occur.
    """
    found: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for i, (grams, n) in enumerate(zip(block.grams, block.lengths, strict=True)):
        of = times.get(min(n, TOKEN), {})
        count, token, place = min((of.get(g, 0), g, p) for p, g in enumerate(grams.tolist()))
        if count:
            found[min(n, TOKEN)][token].append((i, place))
    return {n: (np.array(sorted(x), np.uint64), dict(x)) for n, x in found.items()}


def probe(docs: DataFrame, block: Block, index: dict) -> DataFrame:
    """docs with n_words and hits: the spans (in words, end exclusive) in which windows of the block occur, with the windows' items."""
    out = docs.schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = {n: Filter(tokens) for n, (tokens, _) in index.items()}
        for batch in pieces(batches, "text"):
            w = words(batch.column(batch.schema.get_field_index("text")))
            spans: list[list[tuple[int, int]]] = [[] for _ in range(batch.num_rows)]
            items: list[set] = [set() for _ in range(batch.num_rows)]
            for n, (tokens, windows) in index.items():
                grams = shingles(w.key, n)
                place = filters[n].maybe(grams)
                place = place[in_sorted(grams[place], tokens)[1]]
                rows = np.searchsorted(w.first, place, side="right") - 1
                for i, row in zip(place.tolist(), rows.tolist(), strict=True):
                    for window, before in windows[int(grams[i])]:
                        a, b = i - before, i - before + block.lengths[window]
                        if w.first[row] <= a and b <= w.first[row + 1] and w.text(a, b) == block.texts[window]:
                            spans[row].append((a - int(w.first[row]), b - int(w.first[row])))
                            items[row].update(block.items[window])
            merged = [union(x) for x in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.diff(w.first)),
                    pa.array([[{"a": a, "b": b} for a, b in x] for x in merged], _SPANS),
                    pa.array([sorted(x, key=lambda y: (y is not None, y)) for x in items], pa.list_(pa.string())),
                ],
                names=[*out, "n_words", "spans", "items"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, n_words long, spans array<struct<a: long, b: long>>, items array<string>")


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def item_shingles(items: DataFrame, size: int) -> DataFrame:
    """Rows (row, place, token) of the shingles of items (row, text), of the size that their windows are indexed by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            w, ids = words(batch.column(1)), batch.column(0).to_numpy()
            parts = []
            for row, a, b in zip(ids.tolist(), w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
                own = shingles(w.key[a:b], min(size, b - a, TOKEN)) if b > a else np.zeros(0, np.uint64)
                parts.append((np.full(len(own), row), np.arange(len(own)), own.view(np.int64)))
            cols = [np.concatenate([x[i] for x in parts]) if parts else np.zeros(0, np.int64) for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["row", "place", "token"])

    return items.select("row", "text").mapInArrow(run, "row long, place long, token long")


def tokens_in(docs: DataFrame, seen: np.ndarray, sizes: Sequence[int]) -> DataFrame:
    """Rows (token, times): how often the shingles of these sizes that pass the filter occur in all documents; summed in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            w = words(batch.column(0))
            for n in sizes:
                grams = shingles(w.key, n)
                token, times = np.unique(grams[passing(seen, grams)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(times)], names=["token", "times"])

    return docs.select("text").mapInArrow(run, "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))


def window_index(items: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """Rows (token, before, n, window, item): each window of items (row, item, text) by its rarest shingle, `before` of its words before that.

    Windows one of whose shingles no document has are left out.
    """
    counted_shingles = item_shingles(items, size).join(counts, "token", "left")
    ordered = F.array_sort(F.collect_list(F.struct("place", F.coalesce("times", F.lit(0)).alias("times"), "token")))
    by_item = items.join(counted_shingles.groupBy("row").agg(ordered.alias("shingles")), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            w, rows = words(batch.column(1)), []
            for i, (item, own) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                a, b = int(w.first[i]), int(w.first[i + 1])
                n = min(size, b - a)
                ranked = [(x["times"], x["token"] & ((1 << 64) - 1), x["place"]) for x in own]
                for at in range(b - a - n + 1):
                    times, token, place = min(ranked[at : at + n - min(n, TOKEN) + 1])
                    if times:
                        rows.append((token - (token >> 63 << 64), place - at, n, w.text(a + at, a + at + n), item))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names=["token", "before", "n", "window", "item"])

    return by_item.select("item", "text", "shingles").mapInArrow(run, "token long, before int, n int, window binary, item string")


def around_tokens(docs: DataFrame, seen: np.ndarray, sizes: Sequence[int], reach: int) -> DataFrame:
    """Rows (row, token, at, lead, ends, around) of tokens of docs (row, text) that pass the filter: the words around word `at`, `lead` of
    them before it, lower-cased and joined by blanks, and where each ends in these bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            w, ids, rows = words(batch.column(1)), batch.column(0).to_pylist(), []
            for n in sizes:
                grams = shingles(w.key, n)
                place = passing(seen, grams)
                row = np.searchsorted(w.first, place, side="right") - 1
                for i, r, token in zip(place.tolist(), row.tolist(), grams[place].view(np.int64).tolist(), strict=True):
                    first, last = int(w.first[r]), int(w.first[r + 1])
                    a, b = max(first, i - reach), min(last, i + reach)
                    ends = np.cumsum(w.end[a:b] - w.start[a:b] + 1) - 1
                    rows.append((ids[r], token, i - first, i - a, ends.tolist(), w.text(a, b)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names=["row", "token", "at", "lead", "ends", "around"])

    return docs.select("row", "text").mapInArrow(run, "row long, token long, at long, lead int, ends array<int>, around binary")


def find_by_join(docs: DataFrame, benchmark: DataFrame, size: int) -> DataFrame:
    """find_windows for a benchmark (item, text) of any size."""
    items = stored(benchmark.withColumn("row", F.monotonically_increasing_id()), "items")
    sizes = list(range(1, min(size, TOKEN) + 1))
    counts = tokens_in(docs, first_filter(item_shingles(items, size), "token"), sizes)
    index = stored(window_index(items, counts, size), "windows")
    names = docs.columns
    keyed = stored(docs.withColumn("row", F.monotonically_increasing_id()), "documents")  # stored: numbers must not change
    near = around_tokens(keyed, first_filter(index, "token"), sizes, size)
    first, last = F.col("lead") - F.col("before"), F.col("lead") - F.col("before") + F.col("n")
    begin = F.when(first > 0, F.get("ends", first - 1) + 1).otherwise(0)
    there = (first >= 0) & (last <= F.size("ends"))
    same = F.substring("around", begin + 1, F.get("ends", last - 1) - begin) == F.col("window")
    a = F.col("at") - F.col("before")
    found = near.join(index, "token").filter(there).filter(same).select("row", F.struct(a.alias("a"), (a + F.col("n")).alias("b")).alias("span"), F.struct("item").alias("i"))
    by_row = found.groupBy("row").agg(F.collect_set("span").alias("_spans"), F.collect_set("i").alias("_items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            spans = [union([(x["a"], x["b"]) for x in s or ()]) for s in batch.column("_spans").to_pylist()]
            ids = [sorted((x["item"] for x in i or ()), key=lambda y: (y is not None, y)) for i in batch.column("_items").to_pylist()]
            out = [pa.array(np.diff(words(batch.column("text")).first)), pa.array([[{"a": a, "b": b} for a, b in x] for x in spans], _SPANS), pa.array(ids, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *out], names=[*names, "n_words", "spans", "items"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return keyed.join(by_row, "row", "left").mapInArrow(run, f"{fields}, n_words long, spans array<struct<a: long, b: long>>, items array<string>")


def find_windows(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs (with a string column `text`) plus n_words, spans (disjoint runs of words hit) and items (ids, as strings).

    Null texts have no words. Items without words have no window; a null item id is listed as null. Equal items or windows
    each count. docs' own columns n_words, spans and items are replaced, its other ones stay whatever their names. An empty benchmark hits nothing.
    """
    docs = docs.drop("n_words", "spans", "items")
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(item_text, F.lit("")).alias("text"))
    if (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > block_bytes:
        inner, restore = shield(docs, "text")  # the join's own columns must not meet those of docs
        found = find_by_join(inner, items, size)
        return restore(found, "n_words", "spans", "items")
    block = block_of([tuple(r) for r in items.collect()], size)  # at most block_bytes
    return probe(docs, block, prefixes(block, counted(docs, block)))


def clean_of_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with their own columns."""
    inner, restore = shield(docs, "text")
    return restore(find_windows(inner, benchmark, **options).filter(F.size("spans") == 0))


def items_digest(items: F.Column) -> F.Column:
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: F.coalesce(x, F.lit("")))), ",").cast("binary"), 256)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of the benchmark's ten-word windows in every document."""
    found = find_windows(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x.b - x.a)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), items_digest(F.col("items")).alias("items_sha256"), (hit > 0).alias("contaminated"))


_A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP8_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_A_TO_Z}', '{_A_TO_Z.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w, row_number() OVER () AS r FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_A_TO_Z}', '{_A_TO_Z.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS t
        FROM b, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS t FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS s(i) WHERE len(w) >= n),
hits AS (SELECT dw.r, dw.i, dw.n, win.item_id FROM dw JOIN win ON dw.n = win.n AND dw.t = win.t),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS s(p) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(places.n_hit, 0) AS n_hit, coalesce(items.n_items, 0) AS n_items,
       coalesce(items.h, sha256('')) AS items_sha256, coalesce(places.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places ON d.r = places.r LEFT JOIN items ON d.r = items.r
"""
