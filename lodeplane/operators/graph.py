"""Connected components of edge tables of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeplane.session import cut_lineage

#: Edges that a task ties together at once.
HELD_EDGES = 1 << 20


def _distinct_edges(u: Column, v: Column, df: DataFrame) -> DataFrame:
    return df.select(u.alias("u"), v.alias("v")).filter("u <> v").distinct()


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, least node of its component) with the same components as the given ones, without those to oneself."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        for end in (a, b, root[a], root[b]):
            np.minimum.at(after, end, low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (long u > v) tied together within each task, up to HELD_EDGES at once: fewer edges, shorter ways, the same components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def tied() -> pa.RecordBatch:
            found = stars(*(np.concatenate([x[i] for x in held]) for i in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["u", "v"])

        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
            if size >= HELD_EDGES:
                yield tied()
                held, size = [], 0
        if size:
            yield tied()

    return edges.mapInArrow(run, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above u is tied to the least of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # rebalanced: the join then has two plain shuffles, of which a hot node's can be split at run time
    return _distinct_edges(F.col("v"), F.col("m"), both.join(least.hint("rebalance"), "u").filter("v > u"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its neighbours below it are tied to the least of these. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select("v", "m").union(least.select(F.col("u").alias("v"), "m"))
    return _distinct_edges(F.col("v"), F.col("m"), tied)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (node, component) of all nodes that have an edge in edges (u, v); the component is its least node.

    Alternates the two star contractions until nothing changes; each round is a few joins and aggregations on the nodes, partly
    summed before their shuffles, and is checkpointed. Edges of integers are first tied together within each task. Edges to oneself or
    with a null are left out; repeated edges are fine. Raises if max_rounds don't suffice.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u") != F.col("v")).alias("real")).filter("real").drop("real")
    kind = edges.schema["u"].dataType
    if kind.typeName() in ("byte", "short", "integer", "long"):
        edges = _contracted(edges.select(F.col("u").cast("long"), F.col("v").cast("long")))
    edges, before = cut_lineage(edges.distinct()), None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            edges = edges.select(F.col("u").cast(kind), F.col("v").cast(kind))
            roots = edges.select(F.col("v").alias("node")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
        before = state
        edges = cut_lineage(_small_star(_large_star(edges)))
    raise RuntimeError(f"no components after {max_rounds} rounds")


def chain_ends(ways: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (node, end) from ways (node, up), at most one up a node and no circles: where each node's way ends. Each round doubles the ways' length."""
    ways = ways.select("node", F.col("up").alias("end"))
    for _ in range(max_rounds):
        onward = ways.select(F.col("node").alias("end"), F.col("end").alias("_next"))
        after = cut_lineage(ways.join(onward, "end", "left").select("node", F.coalesce("_next", "end").alias("end"), F.col("_next").isNotNull().alias("moved")))
        if after.filter("moved").isEmpty():
            return after.drop("moved")
        ways = after.drop("moved")
    raise RuntimeError(f"ways don't end after {max_rounds} rounds")
