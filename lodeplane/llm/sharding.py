"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

1. Rows get the number of their partition and their position in it; that table is stored, so that later jobs and
   repeated tasks see the same numbers.
2. Row b of the matrix says how many of partition b's rows go to each shard. The matrix is drawn by halving: of the
   rows that the partitions [lo, hi) send to the shards, the part that [lo, mid) sends is multivariate hypergeometric.
   Each node has its own seed, so that any task can draw the row of any partition in log2(partitions) steps from
   the partitions' counts alone; nothing but those counts (one number a partition) goes through the driver.
3. Local permutation: partition b's multiset of shard labels is permuted and dealt to its positions.
4. Exchange by (shard, slice of a random key), and permutation again: rows take the order of their random keys. A slice's
   first slot is the sum of the counts of the shard's earlier slices, so that no shard is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeplane.llm.common import stored, table

#: numpy draws hypergeometric numbers exactly up to so many objects.
NUMPY_LIMIT = 900_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` objects taken from good + bad are good, for any number of objects.

    Beyond numpy's limit: inversion over the window of 12 standard deviations about the mode, by ratios of neighbours.
    """
    if good + bad <= NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws)) if good + bad else 0
    low, high, total = max(0, draws - bad), min(good, draws), good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    spread = int(12 * (draws / total * good * (bad / total) * ((total - draws) / (total - 1))) ** 0.5) + 8
    k = np.arange(max(low, mode - spread), min(high, mode + spread) + 1, dtype=np.float64)
    step = np.log(good - k[:-1]) + np.log(draws - k[:-1]) - np.log(k[:-1] + 1) - np.log(bad - draws + k[:-1] + 1)
    log_p = np.concatenate(([0.0], np.cumsum(step)))
    p = np.exp(log_p - log_p.max())
    return int(k[np.searchsorted(np.cumsum(p), rng.random() * p.sum())])


def split_draw(seed: tuple[int, ...], caps: np.ndarray, draws: int) -> np.ndarray:
    """Of the objects of each colour (caps), how many are among `draws` objects taken at random."""
    rng = np.random.default_rng(seed)
    if caps.sum() <= NUMPY_LIMIT:
        return rng.multivariate_hypergeometric(caps, draws, method="marginals")
    out, left, rest = np.zeros_like(caps), draws, int(caps.sum())
    for i, cap in enumerate(caps.tolist()):
        rest -= cap
        out[i] = hypergeometric(rng, cap, rest, left)
        left -= int(out[i])
    return out


def matrix_row(cum: np.ndarray, caps: np.ndarray, b: int, seed: int) -> np.ndarray:
    """How many rows partition b sends to each shard. cum: sums of the partitions' counts, from 0 on."""
    lo, hi = 0, len(cum) - 1
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = split_draw((seed, lo, hi), caps, int(cum[mid] - cum[lo]))
        lo, hi, caps = (lo, mid, left) if b < mid else (mid, hi, caps - left)
    return caps


def shard_sizes(n: int, n_shards: int) -> np.ndarray:
    """Sizes at most one apart that sum to n."""
    return np.array([n // n_shards + (s < n % n_shards) for s in range(n_shards)], dtype=np.int64)


def uniform_shuffle(df: DataFrame, n_shards: int, seed: int = 17, slice_rows: int = 65_536) -> DataFrame:
    """df with `shard` (0 to n_shards - 1, sizes at most one apart) and `slot` (a uniform random order in the shard, gapless from 0).

    Any columns, nulls, repeated rows and an empty table are fine: rows are told apart by partition and position only.
    Columns of df named shard or slot are replaced. slice_rows: rows that one task sorts.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    own = {c: f"_in{i}" for i, c in enumerate(df.columns) if c.lower() not in ("shard", "slot")}
    rows = df.select(*[F.col(f"`{c}`").alias(a) for c, a in own.items()], F.monotonically_increasing_id().alias("_at"))
    rows = stored(rows, "shuffle").withColumns({"_block": F.shiftright("_at", 33), "_pos": F.col("_at").bitwiseAND((1 << 33) - 1)})
    counts = sorted((r[0], r[1]) for r in rows.groupBy("_block").agg(F.count("*")).collect())  # one row a partition
    blocks, cum = np.array([b for b, _ in counts], np.int64), np.cumsum([0, *(n for _, n in counts)])
    n = int(cum[-1])
    caps, slices = shard_sizes(n, n_shards), max(8, -(-n // (n_shards * slice_rows)))

    def labels(block: int) -> np.ndarray:
        b = int(np.searchsorted(blocks, block))
        dealt = np.repeat(np.arange(n_shards, dtype=np.int32), matrix_row(cum, caps, b, seed))
        np.random.default_rng((seed, 1, b)).shuffle(dealt)
        return dealt

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, np.ndarray] = {}
        for batch in batches:
            block, pos = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("_block", "_pos"))
            shard = np.empty(len(block), np.int32)
            for b in np.unique(block).tolist():
                if b not in drawn:
                    drawn = {b: labels(b)}  # batches come in order: one partition's labels at a time
                shard[block == b] = drawn[b][pos[block == b]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], names=[*batch.schema.names, "shard"])

    dealt = rows.mapInArrow(deal, T.StructType([*rows.schema.fields, T.StructField("shard", T.IntegerType())]))
    key = F.xxhash64(F.lit(seed), "_block", "_pos")
    dealt = dealt.withColumn("_key", key).withColumn("_slice", F.pmod(F.shiftright("_key", 20), F.lit(slices)).cast("int"))
    by_slice = dealt.groupBy("shard", "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    first = by_slice.select("shard", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    order = Window.partitionBy("shard", "_slice").orderBy("_key", "_block", "_pos")
    ranked = dealt.withColumn("_rank", F.row_number().over(order) - 1).join(first, ["shard", "_slice"])
    return ranked.select(*[F.col(a).alias(c) for c, a in own.items()], "shard", (F.col("_first") + F.col("_rank")).cast("long").alias("slot"))


def op6_hypergeometric_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards under the law `rows`. A null text has no bytes (size 16, crc of the empty text)."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return uniform_shuffle(docs, 40).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
