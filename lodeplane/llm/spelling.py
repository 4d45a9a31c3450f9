"""Spelling variants: words that differ by one code point, found by pairs of trie nodes.

Words are counted in the tasks that read the texts and added up by Spark. The nodes of the trie of all words, and of that of all reversed words,
are numbered: words are dealt by range and sorted, so that a word's new nodes are those beyond what it shares with the word before it; a
partition's first number follows from the counts of those before it, and what its first word shares with the last word before it keeps that one's
numbers. A prefix and a suffix are then two integers, and a word with a code point skipped, or cut in two, is a pair of them. Words that
skip a code point and meet in a pair differ by a replaced one; a word that skips one and a word that is cut meet where one
was inserted. Pairs of nodes are exact, so nothing is verified, and a pair holds at most a word for each letter and one more.

Forms are followed to the last by doubling the length of the way in each round; a form's count is at least twice its word's, so a few rounds do.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import pieces, stored, table
from lodeplane.session import cut_lineage

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: One run of a document in so many loses a code point, by the hash of both.
TYPO_ONE_IN = 97
#: Different words that a task counts before it passes them on, and characters beyond which a text's runs aren't listed at once.
WORDS_HELD, LONG_CHARS = 300_000, 1 << 20


def document_words(doc_id: int | None, text: str, least: int) -> Iterator[tuple[str, int]]:
    """A document's words of at least `least` code points with their counts; a word can come twice."""
    lower = text.encode().translate(_LOWER).decode()
    runs = Counter(RUN.findall(lower)) if len(lower) <= LONG_CHARS else Counter(m.group() for m in RUN.finditer(lower))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        if len(run) >= least:
            h = zlib.crc32(run.encode(), start)
            if h % TYPO_ONE_IN == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
                if len(run) < least:
                    continue
            yield run, n


def word_counts(docs: DataFrame, least_chars: int, least_count: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (word, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in pieces(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, n in document_words(doc_id, text or "", least_chars):
                    held[word] = held.get(word, 0) + n
            if len(held) > WORDS_HELD:
                yield passed_on()
                held = {}
        yield passed_on()

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def shared_start(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


class Walk:
    """The way from a trie's root to the last word taken, words being taken in order: the numbers of its nodes, in the order they came up."""

    def __init__(self) -> None:
        self.word, self.path, self.nodes = "", [], 0

    def take(self, word: str) -> list[int]:
        kept = shared_start(self.word, word)
        new = len(word) - kept
        self.path = self.path[:kept] + list(range(self.nodes, self.nodes + new))
        self.word, self.nodes = word, self.nodes + new
        return self.path


def with_paths(words: DataFrame, spelled: Column, name: str, rank: str | None = None) -> DataFrame:
    """words with the numbers of the trie nodes of all starts of `spelled`, the empty one (0) first, and with their place in its order."""
    dealt = words.withColumn("_spelled", spelled)
    fixed = cut_lineage(dealt.repartitionByRange("_spelled").sortWithinPartitions("_spelled").withColumn("_part", F.spark_partition_id()))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, part, first, n = Walk(), None, None, 0
        for batch in filter(len, batches):
            part = batch.column("_part")[0].as_py()
            n += batch.num_rows
            for word in batch.column("_spelled").to_pylist():
                first = word if first is None else first
                walk.take(word)
        if first is not None:
            kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((part, first, walk.word, n, walk.nodes, walk.path), kinds, strict=True)], names=["part", "first", "last", "n", "nodes", "path"])

    columns = words.columns
    starts: dict[int, tuple[int, int, list[int]]] = {}
    before, nodes, last, path = 0, 1, "", []
    for r in sorted(fixed.select("_part", "_spelled").mapInArrow(ends, "part int, first string, last string, n long, nodes long, path array<long>").collect()):  # a row a partition
        kept = path[: shared_start(last, r.first)]
        starts[r.part] = before, nodes, kept
        path = [kept[x] if x < len(kept) else nodes + x for x in r.path]
        before, nodes, last = before + r.n, nodes + r.nodes, r.last

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, at = Walk(), 0
        for batch in filter(len, batches):
            ranks, first, kept = starts[batch.column("_part")[0].as_py()]
            own, flat, offsets = np.array(kept, np.int64), [], [0]
            for word in batch.column("_spelled").to_pylist():
                flat.append(-1)
                flat += walk.take(word)
                offsets.append(len(flat))
            local = np.array(flat, np.int64)
            numbers = np.where(local < 0, 0, local + first)
            shared = (local >= 0) & (local < len(own))
            numbers[shared] = own[local[shared]]
            kept_columns = [batch.column(c) for c in columns]
            places = [pa.array(np.arange(ranks + at, ranks + at + batch.num_rows))] if rank else []
            yield pa.RecordBatch.from_arrays([*kept_columns, *places, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(numbers))], names=[*columns, *([rank] if rank else []), name])
            at += batch.num_rows

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields]
    return fixed.mapInArrow(numbered, ", ".join([*kinds, *([f"{rank} long"] if rank else []), f"{name} array<long>"]))


def node_pairs(paths: DataFrame) -> DataFrame:
    """Rows (p, s, who, n): the pairs of nodes that a word (rank, word, n, p, s) skips a code point at, or is cut at.

    who is the word's rank times 4, plus 1 for a cut, plus 2 for a skip that is the first of its run of equal code points: skipping another of the run gives the same word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(len, batches):
            p, s = (pc.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False) for c in "ps")
            size = pc.list_value_length(batch.column("p")).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(size)
            word = np.repeat(np.arange(len(size)), size)
            mirrored = (2 * ends - size)[word] - 1 - np.arange(len(p))  # place of the suffix that follows the prefix
            letters = np.frombuffer("".join(batch.column("word").to_pylist()).encode("utf-32-le"), np.uint32)
            skips = np.flatnonzero(np.arange(len(p)) != ends[word] - 1)
            first = np.ones(len(letters), bool)
            first[1:] = (letters[1:] != letters[:-1]) | (word[skips][1:] != word[skips][:-1])
            rank, n = batch.column("rank").to_numpy()[word] * 4, batch.column("n").to_numpy()[word]
            columns = [
                np.concatenate((p, p[skips])),
                np.concatenate((s[mirrored], s[mirrored[skips] - 1])),
                np.concatenate((rank + 1, rank[skips] + 2 * first)),
                np.concatenate((n, n[skips])),
            ]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["p", "s", "who", "n"])

    return paths.select("rank", "word", "n", "p", "s").mapInArrow(run, "p long, s long, who long, n long")


def meeting(p: np.ndarray, s: np.ndarray, who: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows (rank, near, best): for sorted pairs of nodes, each word's near words that it meets there, and (count, minus rank) of the first of them."""
    new = np.append(True, (p[1:] != p[:-1]) | (s[1:] != s[:-1]))
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(p)))
    group = np.repeat(np.arange(len(start)), size)
    rows = np.flatnonzero(size[group] > 1)
    times = size[group[rows]]
    a = np.repeat(rows, times)
    b = np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(start[group[rows]], times)
    cut_a, cut_b = who[a] & 1 == 1, who[b] & 1 == 1
    good = (a != b) & np.where(cut_a, who[b] & 2 == 2, np.where(cut_b, who[a] & 2 == 2, True))
    a, b = a[good], b[good]
    word, other, count = who[a] >> 2, who[b] >> 2, n[b]
    order = np.lexsort((other, -count, word))
    word, other, count = word[order], other[order], count[order]
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
    near = np.diff(np.append(first, len(word)))
    return pa.RecordBatch.from_arrays(list(map(pa.array, (word[first], near, count[first], -other[first]))), names=["rank", "near", "best_n", "best"])


def near_words(pairs: DataFrame) -> DataFrame:
    """Rows (rank, n_near, best_n, best_rank) of words with a near word."""
    spark = pairs.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            columns = [np.concatenate((x, c.to_numpy())) for x, c in zip(held, batch.columns, strict=True)]
            p, s = columns[:2]
            open_from = int(np.argmax((p == p[-1]) & (s == s[-1]))) if len(p) else 0  # the last pair may go on
            if open_from:
                yield meeting(*(c[:open_from] for c in columns))
            held = [c[open_from:] for c in columns]
        if len(held[0]):
            yield meeting(*held)

    met = pairs.repartition(tasks, "p", "s").sortWithinPartitions("p", "s").mapInArrow(run, "rank long, near long, best_n long, best long")
    best = met.groupBy("rank").agg(F.sum("near").alias("n_near"), F.max(F.struct("best_n", "best")).alias("top"))
    return best.select("rank", "n_near", F.col("top.best_n").alias("best_n"), (-F.col("top.best")).alias("best_rank"))


def last_forms(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Rows (rank, root) from rows (rank, up): where the way up ends. Ways mustn't be circles; each round doubles their length."""
    ways = stored(forms.select("rank", "up"), "forms")
    for _ in range(max_rounds):
        onward = ways.select(F.col("rank").alias("up"), F.col("up").alias("_next"))
        ways = stored(ways.join(onward, "up", "left").select("rank", F.coalesce("_next", "up").alias("up"), F.col("_next").isNotNull().alias("moved")), "forms")
        if ways.filter("moved").isEmpty():
            return ways.select("rank", F.col("up").alias("root"))
        ways = ways.drop("moved")
    raise RuntimeError(f"forms don't end after {max_rounds} rounds")


def spelling_groups(docs: DataFrame, least_chars: int = 5, least_count: int = 3, ratio: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words of docs with their near words, forms and roots.

    Words are maximal runs of letters up to U+00FF, A to Z lower-cased, of which one in 97, by its document and spelling, loses a code point; those of at least
    `least_chars` code points and `least_count` occurrences count. One row a word: word, n, n_near (words that differ by one inserted, deleted or replaced code point), form (the
    near word of largest count, the least of several, if that is at least `ratio` times n; else null), form_n, root (the last of the forms). A null or
    empty text has no words; a null id counts as the empty text in the hash; repeated rows count each time; an empty table gives no rows; other
    columns aren't read. A ratio of 1 or less is refused, as forms could go round in circles.
    """
    if ratio <= 1:
        raise ValueError("the ratio must be above 1")
    words = stored(word_counts(docs, least_chars, least_count, id_col, text_col), "words")
    forward = with_paths(words, F.col("word"), "p", "rank")
    paths = stored(with_paths(forward, F.reverse("word"), "s"), "paths")
    near = near_words(node_pairs(paths))
    known = paths.select("rank", "word", "n").join(near, "rank", "left")
    up = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_rank"))
    known = stored(known.select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), up.alias("up"), F.when(up.isNotNull(), F.col("best_n")).alias("form_n")), "near-words")
    roots = last_forms(known.filter("up is not null"))
    form = known.select(F.col("rank").alias("up"), F.col("word").alias("form"))
    root = known.select(F.col("rank").alias("root"), F.col("word").alias("last"))
    named = known.join(roots, "rank", "left").join(form, "up", "left").join(root, "root", "left")
    return named.select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling_groups(table(spark, sf_dir, "documents"))
