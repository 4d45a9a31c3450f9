"""What the operators of this package share: tables, Arrow batches, lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.session import bounded_batches
from lodeplane.session import stored as stored  # one way to fix a table

#: Rows, and bytes of text, that a worker takes up at once. A longer text is taken up alone.
PIECE_ROWS, PIECE_BYTES = 256, 1 << 20
#: Bits of a hash that a first filter looks at: a table of 4 MB.
FILTER_BITS = 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the ten queries, whose session gets a bound of its Arrow batches. The operators leave the session alone."""
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterable[pa.RecordBatch], text: int | str = 0, rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of few rows and bytes of a text column, so that a worker's arrays stay small; nothing is copied."""
    for batch in batches:
        column = batch.column(text)
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(ends):
            done = int(ends[at - 1]) if at else 0
            end = min(int(np.searchsorted(ends, done + PIECE_BYTES, "right")), at + rows)
            end = max(end, at + 1)
            yield batch.slice(at, end - at)
            at = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 offsets of its rows (nulls are empty), without copies where Arrow allows."""
    column = column.fill_null("") if column.null_count else column
    column = column if pa.types.is_large_string(column.type) else column.cast(pa.large_string())
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def strings(column: pa.Array) -> list[str]:
    """A string column as Python strings; null is the empty text."""
    return [x or "" for x in column.to_pylist()]


def shield(df: DataFrame, *keep: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """df with all columns but `keep` under names that no operator uses, and what gives a result df's columns back, with named ones of the result's own."""
    inner = {c: c if c in keep else f"_in{i}" for i, c in enumerate(df.columns)}
    return (
        df.select(*[F.col(f"`{c}`").alias(x) for c, x in inner.items()]),
        lambda out, *more: out.select(*[F.col(x).alias(c) for c, x in inner.items()], *more),
    )


def first_filter(hashes: DataFrame, column: str) -> np.ndarray:
    """A bit for each value of the upper FILTER_BITS bits of a 64-bit hash: whether one begins so. At most 2**FILTER_BITS rows come here."""
    rows = hashes.select(F.shiftrightunsigned(column, 64 - FILTER_BITS).cast("int").alias("x")).distinct().toPandas()
    out = np.zeros(1 << FILTER_BITS, bool)
    out[rows["x"].to_numpy()] = True
    return out


def passing(seen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the hashes that pass the filter."""
    return np.flatnonzero(seen[keys >> np.uint64(64 - FILTER_BITS)])
