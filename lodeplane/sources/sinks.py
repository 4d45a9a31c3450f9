"""One writer for every load mode, over folders of Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.sources.files import evolved, overwrite_slices

MODES = ("overwrite", "overwrite_slices", "append", "append_new", "upsert")


def merged(current: DataFrame, df: DataFrame, keys: Sequence[str], mode: str) -> DataFrame:
    """The table after a load. append_new adds unknown keys; upsert also replaces the rows of known ones."""
    df = evolved(current.schema, df)
    if mode == "append_new":
        new = df.join(current.select(*keys), list(keys), "left_anti").select(df.columns)
        return current.unionByName(new, allowMissingColumns=True)
    if mode == "upsert":
        kept = current.join(df.select(*keys), list(keys), "left_anti").select(current.columns)
        return kept.unionByName(df, allowMissingColumns=True)
    raise ValueError(f"{mode} doesn't merge")


def load(df: DataFrame, root: str, mode: str, keys: Sequence[str] = (), slice_by: str | None = None, at_least: int = 0) -> str:
    """Write a load and return the folder that holds the table now.

    Merging modes write a new version beside the old one, which readers may still use; a load of fewer than at_least rows raises
    before anything is written.
    """
    spark = df.sparkSession
    if mode not in MODES:
        raise ValueError(f"no load mode {mode}")
    if at_least and df.limit(at_least).count() < at_least:
        raise ValueError(f"fewer than {at_least} rows")
    if mode == "overwrite_slices":
        overwrite_slices(df, root, slice_by)
        return root
    if mode in ("overwrite", "append"):
        df.write.mode(mode).parquet(root)
        return root
    version = f"{root.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    merged(spark.read.parquet(root), df, keys, mode).write.parquet(version)
    return version


def observed(df: DataFrame, low: int, high: int) -> DataFrame:
    """One row that says how many rows df has, and whether that lies in a band."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("in_band", F.col("n_rows").between(low, high))


def updated(root: str, spark: SparkSession, where: Column, values: dict[str, Column]) -> str:
    """Set columns of the rows for which a condition holds, in a new version of the table; returns its folder."""
    table = spark.read.parquet(root)
    hit = F.coalesce(where, F.lit(False))
    changed = {c: F.when(hit, v.cast(table.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()}
    version = f"{root.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    table.withColumns(changed).write.parquet(version)
    return version


def row_gate(tables: dict[str, tuple[DataFrame, int | None, int | None]]) -> DataFrame:
    """A row a table with its number of rows, its floor and ceiling (null for none) and whether it passes."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("name"), "n_rows", F.lit(low).cast("long").alias("floor"), F.lit(high).cast("long").alias("ceiling")) for n, (df, low, high) in tables.items()]
    passes = (F.col("n_rows") >= F.coalesce("floor", F.lit(0))) & (F.col("ceiling").isNull() | (F.col("n_rows") <= F.col("ceiling")))
    return reduce(DataFrame.union, parts).withColumn("passes", passes)
