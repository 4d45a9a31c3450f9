"""Time series and weighted figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate(value: Column, before: Column, digits: int = 4) -> Column:
    """Percentage change by the size of the value before; null if that is zero or null."""
    return F.round((value - before) / F.nullif(F.abs(before), F.lit(0.0)) * 100, digits)


def change_rates(df: DataFrame, keys: Sequence[str], date: str, value: str, offsets: dict[str, int]) -> DataFrame:
    """df without null values, plus a rate for each name and its number of rows back."""
    w = Window.partitionBy(*keys).orderBy(date)
    rows = df.filter(F.col(value).isNotNull())
    return rows.withColumns({name: rate(F.col(value), F.lag(value, n).over(w)) for name, n in offsets.items()})


def change_by_frequency(df: DataFrame, keys: Sequence[str], date: str, value: str, frequency: str, offsets: dict[str, dict[str, int]]) -> DataFrame:
    """df without null values, plus a rate for each name; how many rows back depends on the row's frequency, null where it names none."""
    w = Window.partitionBy(*keys, frequency).orderBy(date)
    rows = df.filter(F.col(value).isNotNull())

    def before(by_frequency: dict[str, int]) -> Column:
        found = F.lit(None).cast("double")
        for code, n in by_frequency.items():
            found = F.when(F.col(frequency) == code, F.lag(value, n).over(w)).otherwise(found)
        return found

    return rows.withColumns({name: rate(F.col(value), before(by)) for name, by in offsets.items()})


def weighted_mean(value: Column, weight: Column) -> Column:
    """Rows with a null value count in neither sum; null if no weight is left."""
    return F.sum(value * weight) / F.nullif(F.sum(F.when(value.isNotNull(), weight)), F.lit(0))


def calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """Every day from first to last of a one-row table, with its calendar fields."""
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("day"))
    return days.select(
        "day", F.year("day").alias("year"), F.month("day").alias("month"), F.quarter("day").alias("quarter"), F.weekofyear("day").alias("iso_week"), (F.weekday("day") + 1).alias("iso_weekday"), F.concat(F.year("day"), F.lit("Q"), F.quarter("day")).alias("label"), (F.weekday("day") >= 5).alias("weekend")
    )
