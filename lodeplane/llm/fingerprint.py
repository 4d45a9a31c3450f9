"""Document fingerprints of closed syncmers.

A k-mer of code points is an anchor if the least hash of its s-mers stands at its first or last place; that depends on
the k-mer alone, so that equal passages have the same anchors in any context. A fingerprint is the anchors' 32-bit hashes in text order
(base64 of little-endian numbers). A text shorter than k, or without an anchor, has its least k-mer or itself as its
only anchor; the empty text has an empty fingerprint.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import pieces, strings, table
from lodeplane.llm.words import mixed, powers

#: Of a shared passage, 2 K - S code points or more are sure to hold an anchor; about 2 in K - S + 1 places have one.
K, S = 24, 8
_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Code points that are worked on at once.
CHUNK = 200_000


def span_hashes(sums: np.ndarray, inverse: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n code points."""
    m = len(sums) - n
    return mixed((sums[n:] - sums[:m]) * inverse[:m] + np.uint64(n))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours."""
    have, span = x, 1
    while 2 * span <= w:
        have, span = np.minimum(have[:-span], have[span:]), 2 * span
    return np.minimum(have[: len(x) - w + 1], have[w - span :])


def anchors(texts: list[str], k: int = K, s: int = S) -> list[np.ndarray]:
    """The anchors' hashes of each text."""
    out: list[np.ndarray] = []
    held, size = [], 0
    for x in texts:
        held.append(x)
        size += len(x)
        if size >= CHUNK:
            out += _anchors(held, k, s)
            held, size = [], 0
    return out + _anchors(held, k, s)


def _anchors(texts: list[str], k: int, s: int) -> list[np.ndarray]:
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    start = np.cumsum([0, *map(len, texts)])
    n = len(cps)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((cps.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93) * powers(_BASE, n), out=sums[1:])
        inverse = powers(_INVERSE, n)
        chosen, kmers, found = np.zeros(0, np.int64), np.zeros(0, np.uint64), []
        if n >= k:
            inner = (span_hashes(sums, inverse, s) >> np.uint64(32)).astype(np.uint32)
            w = k - s + 1
            least = sliding_min(inner, w)
            edge = (inner[: len(least)] == least) | (inner[w - 1 :] == least)
            ends = np.repeat(start[1:], np.diff(start))[: len(least)]
            chosen = np.flatnonzero(edge & (np.arange(len(least)) + k <= ends))
            kmers = mixed((sums[chosen + k] - sums[chosen]) * inverse[chosen])
        cuts = np.searchsorted(chosen, start)
        for i, (a, b) in enumerate(zip(start[:-1].tolist(), start[1:].tolist(), strict=True)):
            own = kmers[cuts[i] : cuts[i + 1]]
            if not len(own) and b > a:
                m = max(b - a - k, 0) + 1
                span = min(k, b - a)
                own = mixed((sums[a + span : a + span + m] - sums[a : a + m]) * inverse[a : a + m]).min(keepdims=True)
            found.append((own >> np.uint64(32)).astype("<u4"))
    return found


def written(own: np.ndarray) -> str:
    return base64.b64encode(own.tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def _occurrences(x: np.ndarray) -> np.ndarray:
    """Each hash with the number of its equals before it, as one key."""
    order = np.argsort(x, kind="stable")
    same = np.concatenate(([0], np.cumsum(x[order][1:] != x[order][:-1]))) if len(x) else np.zeros(0, np.int64)
    nth = np.empty(len(x), np.uint64)
    nth[order] = np.arange(len(x)) - np.searchsorted(same, same)
    return x.astype(np.uint64) << np.uint64(32) | nth


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the number of anchors that match in the same order, by those of both texts; two empty texts are alike.

    Anchors are matched from both ends while they're equal; between, the n-th occurrence of a hash in one text is matched
    with the n-th in the other, and the longest increasing run of such matches counts.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    m = min(len(a), len(b))
    differ = np.flatnonzero(a[:m] != b[:m])
    front = int(differ[0]) if len(differ) else m
    differ = np.flatnonzero(a[::-1][: m - front] != b[::-1][: m - front])
    back = int(differ[0]) if len(differ) else m - front
    total, x, y = front + back, a[front : len(a) - back], b[front : len(b) - back]
    if len(x) and len(y):
        _, i, j = np.intersect1d(_occurrences(x), _occurrences(y), assume_unique=True, return_indices=True)
        tails: list[int] = []
        for v in j[np.argsort(i)].tolist():
            at = bisect_left(tails, v)
            tails[at : at + 1] = [v]
        total += len(tails)
    return 2 * total / (len(a) + len(b))


def fingerprints(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """docs (with a string column text) plus fingerprint; a null text counts as empty. A column fingerprint of docs is replaced."""
    docs = docs.drop("fingerprint")
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at_text):
            own = [written(x) for x in anchors(strings(batch.column(at_text)), k, s)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.string())], names=[*batch.schema.names, "fingerprint"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, fingerprint string")


def bounds_above(value: Column, bounds: list[int]) -> Column:
    """How many of the bounds are greater than value: over their blocks, then within one block."""
    down, step = sorted(bounds, reverse=True), max(1, int(len(bounds) ** 0.5))
    blocks = [down[i : i + step] for i in range(0, len(down), step)]
    if not blocks:
        return F.lit(0)
    whole = F.size(F.filter(F.array(*[F.lit(b[-1]) for b in blocks]), lambda x: x > value))
    within = F.get(F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks]), whole)
    return whole * step + F.coalesce(F.size(F.filter(within, lambda x: x > value)), F.lit(0))


def in_order(docs: DataFrame, parts_each: int = 4) -> DataFrame:
    """docs (doc_id long, text) dealt into runs of the order by descending doc_id (nulls last), then a hash of the text.

    Adds _run, _hash, and _next: false, but true for a copy of the row that follows the run's last one. Runs come whole and sorted
    in a partition. Bounds are quantiles of doc_id; an id with more rows than a run should have is split by the hash.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = parts_each * partitions
    docs = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    n, points = docs.agg(F.count("*"), F.percentile_approx("doc_id", [i / runs for i in range(1, runs)], 20 * runs)).first()
    heavy = [r[0] for r in docs.groupBy("doc_id").count().filter(F.col("count") > max(1000, n // runs)).collect()]  # at most `runs` ids
    bounds = sorted(set(points or []) | {x for x in heavy if x is not None} | {x + 1 for x in heavy if x is not None and x < (1 << 63) - 1})
    # an id x lies between the bounds x and x + 1: as many bounds are above x as above no other id if x is heavy
    rank = F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(bounds_above(F.col("doc_id"), bounds))
    is_heavy = F.lit(False)
    if heavy:
        is_heavy = F.col("doc_id").isin([x for x in heavy if x is not None]) | (F.col("doc_id").isNull() & F.lit(None in heavy))
    slice_of = F.when(is_heavy, F.shiftright("_hash", 52) + 2048).otherwise(0)  # 4096 ranges of the hash
    runs_of = docs.withColumn("_run", (rank.cast("long") * 4096 + slice_of).cast("long"))
    heads = sorted((r[0], r[1][0], ~r[1][1]) for r in runs_of.groupBy("_run").agg(F.max(F.struct("doc_id", F.bitwise_not("_hash").alias("h")))).collect())  # a row a run
    if not heads:
        return runs_of.withColumn("_next", F.lit(False))
    follow = spark.createDataFrame([(heads[i - 1][0], i, doc_id, h) for i, (_, doc_id, h) in enumerate(heads)], "_run long, _i int, _id long, _h long")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h"))
    extra = docs.join(F.broadcast(follow), same).dropDuplicates(["_i"]).select("doc_id", "text", "_hash", "_run", F.lit(True).alias("_next"))
    place = {run: i % partitions for i, (run, _, _) in enumerate(heads)}
    dealt = F.broadcast(spark.createDataFrame(list(place.items()), "_run long, _part int"))  # a row a run
    both = runs_of.withColumn("_next", F.lit(False)).union(extra.select("doc_id", "text", "_hash", "_run", "_next")).join(dealt, "_run")
    return both.repartitionById(partitions, F.col("_part")).sortWithinPartitions("_run", "_next", F.desc_nulls_last("doc_id"), "_hash")


def with_edits(docs: DataFrame, share: int = 3) -> DataFrame:
    """Each document with its fingerprint, and that of its edited text: its last 1/share replaced by the beginning of the document that follows."""
    ordered = in_order(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "_run", "_next")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple] = []  # the row before, with its anchors, if its run may go on
        for batch in pieces(batches, 1):
            ids, texts, runs, nexts = (batch.column(i).to_pylist() for i in range(4))
            rows = last + list(zip(ids, texts, runs, nexts, anchors(texts), strict=True))
            pairs = [(x, y) for x, y in zip(rows[:-1], rows[1:], strict=True) if x[2] == y[2] and not x[3]]
            last = rows[-1:]
            cuts = [len(x[1]) // share for x, _ in pairs]
            edited = [x[1][: len(x[1]) - c] + y[1][:c] for (x, y), c in zip(pairs, cuts, strict=True)]
            marks = anchors(edited)
            out = [
                (x[0], len(x[1]), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), written(x[4]), written(m), likeness(x[4], m), likeness(x[4], y[4]))
                for (x, y), e, m in zip(pairs, edited, marks, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op7_closed_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return with_edits(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
