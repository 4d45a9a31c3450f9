"""Versioned rows and incremental tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scd2_apply(history: DataFrame, load: DataFrame, key: str, row_hash: str, at: Column, heartbeat: DataFrame | None = None, grace_days: int = 21) -> DataFrame:
    """history (valid_from, valid_to) after a load at time `at`.

    A new hash closes the key's open row and opens another; the same hash changes nothing. A key absent from the load is closed at
    once, or with a heartbeat (key, last_seen) only when it was last seen over grace_days ago. Loads have one row a key;
    closed rows are kept as they are. One full outer join; the rest is a union.
    """
    values = [c for c in load.columns if c not in (key, row_hash)]
    closed = history.filter("valid_to IS NOT NULL")
    now, new = history.filter("valid_to IS NULL").alias("o"), load.withColumn("_new", F.lit(True)).alias("n")
    both = now.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    if heartbeat is not None:
        seen = heartbeat.select(F.col(key).alias("_seen_key"), "last_seen")
        both = both.join(seen, F.col(f"o.{key}") == F.col("_seen_key"), "left")
        absent = F.col("last_seen").isNull() | (F.date_diff(F.to_date(at), F.to_date("last_seen")) > grace_days)
    else:
        absent = F.lit(True)
    changed = ~F.col(f"o.{row_hash}").eqNullSafe(F.col(f"n.{row_hash}"))
    gone = F.when(F.col("n._new").isNull(), absent).otherwise(changed)
    old = both.filter(F.col(f"o.{key}").isNotNull()).select(*[F.col(f"o.{c}").alias(c) for c in (key, row_hash, *values)], F.col("o.valid_from").alias("valid_from"), F.when(gone, at).alias("valid_to"))
    opened = both.filter(F.col("n._new") & (F.col(f"o.{key}").isNull() | changed))
    opened = opened.select(*[F.col(f"n.{c}").alias(c) for c in (key, row_hash, *values)], at.alias("valid_from"), F.lit(None).cast(history.schema["valid_to"].dataType).alias("valid_to"))
    return closed.select(old.columns).union(old).union(opened)


def incremental_merge(previous: DataFrame, incoming: DataFrame, key: str, update: Sequence[str], price: str) -> DataFrame:
    """previous after a load: new keys are added, known ones change only in `update`, price and last_seen; untouched rows stay.

    first_seen and initial_price are kept; price_changes counts loads with another price (null-safe).
    """
    p, n = previous.alias("p"), incoming.withColumn("_new", F.lit(True)).alias("n")
    both = p.join(n, F.col(f"p.{key}") == F.col(f"n.{key}"), "full_outer")
    known, seen = F.col(f"p.{key}").isNotNull(), F.coalesce(F.col("n._new"), F.lit(False))
    changed = known & seen & ~F.col(f"p.{price}").eqNullSafe(F.col(f"n.{price}"))
    pick = lambda c: F.when(seen, F.col(f"n.{c}")).otherwise(F.col(f"p.{c}")).alias(c)
    return both.select(
        F.coalesce(f"p.{key}", f"n.{key}").alias(key),
        *[pick(c) for c in update],
        pick(price),
        F.when(known, F.col("p.initial_price")).otherwise(F.col(f"n.{price}")).alias("initial_price"),
        F.when(known, F.col("p.first_seen")).otherwise(F.col("n.seen")).alias("first_seen"),
        F.when(seen, F.col("n.seen")).otherwise(F.col("p.last_seen")).alias("last_seen"),
        (F.coalesce("p.price_changes", F.lit(0)) + changed.cast("int")).cast("long").alias("price_changes"),
    )


def lifecycle(rows: DataFrame, key: str, seen: str, carried: Column) -> DataFrame:
    """First day over rows not carried forward, last day over all, and whether the key was seen in the last 3 days of the table."""
    newest = F.broadcast(rows.agg(F.max(seen).alias("_newest")))
    spans = rows.groupBy(key).agg(F.min(F.when(~carried, F.col(seen))).alias("first_seen"), F.max(seen).alias("last_seen"))
    return spans.join(newest).withColumn("active", F.expr("last_seen >= _newest - INTERVAL 3 DAY")).drop("_newest")


def stable_ids(known: DataFrame, members: DataFrame, key: str, group: str) -> DataFrame:
    """An append-only map key → uid: a group's new keys take the least uid its known keys have, else the least new key."""
    joined = members.join(known, key, "left")
    least = joined.groupBy(group).agg(F.min("uid").alias("_least"), F.min(key).alias("_new"))
    return joined.join(least, group).select(key, F.coalesce("uid", "_least", "_new").alias("uid"))
