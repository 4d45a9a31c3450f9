"""Declarative checks and profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    """A named condition that holds for good rows; null counts as broken."""

    name: str
    condition: Column


def not_null(column: str) -> Check:
    return Check(f"not_null:{column}", F.col(column).isNotNull())


def accepted_values(column: str, values: Sequence) -> Check:
    return Check(f"accepted_values:{column}", F.col(column).isNull() | F.col(column).isin(list(values)))


def in_range(column: str, low: float, high: float) -> Check:
    return Check(f"accepted_range:{column}", F.col(column).isNull() | F.col(column).between(low, high))


def matches(column: str, pattern: str) -> Check:
    return Check(f"pattern:{column}", F.col(column).isNull() | F.col(column).rlike(pattern))


def report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Rows (check, n_broken) of all row-wise checks from one pass."""
    counts = df.agg(*[F.count_if(~F.coalesce(c.condition, F.lit(False))).alias(f"_{i}") for i, c in enumerate(checks)])
    pairs = F.array(*[F.struct(F.lit(c.name).alias("check"), F.col(f"_{i}").alias("n_broken")) for i, c in enumerate(checks)])
    return counts.select(F.inline(pairs))


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many combinations stand in several rows. Long values are told apart by a 256-bit hash, so that they aren't shuffled."""
    short = [F.sha2(F.col(c), 256).alias(c) if isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType)) else F.col(c) for c in columns]
    twice = df.select(*short).groupBy(*columns).count().filter("count > 1")
    return twice.agg(F.lit(f"unique:{','.join(columns)}").alias("check"), F.count("*").alias("n_broken"))


def relationship(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """How many values have no row in the parent."""
    orphans = df.filter(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")
    return orphans.agg(F.lit(f"relationship:{column}").alias("check"), F.count("*").alias("n_broken"))


def profile(df: DataFrame, columns: Sequence[str], top: int = 3) -> DataFrame:
    """Of each column: rows, null share, distinct values, and the most frequent values (ties by value), from two passes."""
    stats = df.agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns], *[F.count_distinct(F.col(c)).alias(f"_distinct_{c}") for c in columns]
    ).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col("_n").alias("n_rows"), F.round(F.col(f"_null_{c}") * 100.0 / F.col("_n"), 2).alias("null_pct"), F.col(f"_distinct_{c}").alias("n_distinct")) for c in columns])))
    values = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
    counts = values.filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))
    # the constant limit on ranks holds in each task before the shuffle: a column's values aren't gathered
    first = counts.withColumn("rn", F.row_number().over(Window.partitionBy("column").orderBy(F.col("n").desc(), "value"))).filter(F.col("rn") <= top)
    tops = first.groupBy("column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "value", "n"))), lambda x: F.concat_ws("=", x["value"], x["n"])), "|").alias("top_values"))
    return stats.join(tops, "column", "left")


def all_of(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)
