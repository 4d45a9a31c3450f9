"""Near duplicates among embeddings by an epsilon grid order join.

Equal vectors of a label are one class. Classes are sorted by label, number of components and the cells of an epsilon-wide grid on the
leading principal dimensions, and numbered; neighbouring numbers make leaves, and leaves make intervals of a bounded number of
vectors. An interval's box has the least and greatest label and coordinate of each leading dimension. From the whole sequence
down, pairs of intervals are split into pairs of their parts, and a pair goes no further when no label is in both or when their boxes are
more than epsilon apart: an orthogonal projection never lengthens a distance, so nothing that is skipped can link. Pairs that
are left go on being halved within a task, down to leaves, which are compared as matrices of cosines in double precision.

A task compares two intervals of bounded size. It gives a row a vector that has links, with their number and the least vector of its
component among the two, never the pairs themselves; numbers are added up and components tied together in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import stored, table
from lodeplane.operators.graph import connected_components, stars
from lodeplane.operators.relational import numbered

THRESHOLD = 0.93
#: What a task needs to know of vectors.
VECTORS = ("id", "size", "label", "dims", "embedding")
#: Leading principal dimensions that order and bound vectors.
LEADING = 12
#: Vectors of a leaf, leaves of an interval, and intervals that make one of the next level.
LEAF, LEAVES, FANOUT = 256, 32, 8
#: Components up to which principal axes are computed (their covariances are summed as one matrix); longer vectors are ordered by their first components.
AXES_DIMS = 1024
#: Added to epsilon against rounding: coordinates near 1 carry errors of some 1e-15.
SLACK = 1e-9


def principal_axes(vectors: DataFrame, column: str, dims: int, leading: int = LEADING) -> np.ndarray:
    """An orthonormal matrix whose columns are the leading principal axes of vectors with `dims` components, summed on the executors."""
    unit = vectors.filter(F.size(column) == dims).select(array_to_vector(F.col(column)).alias("v"))
    axes = PCA(k=min(leading, dims), inputCol="v", outputCol="p").fit(unit).pc.toArray()
    return np.linalg.qr(axes)[0]


def coordinates(unit: np.ndarray, axes: dict[int, np.ndarray], leading: int) -> np.ndarray:
    """Leading coordinates of unit vectors of one length: on the principal axes known for it, else the first components."""
    found = unit @ axes[unit.shape[1]] if unit.shape[1] in axes else unit[:, :leading]
    return np.pad(found, ((0, 0), (0, leading - found.shape[1])))


class Sequence:
    """An interval's vectors in grid order: ids, class sizes, labels, lengths, unit vectors of each length, boxes of all halves."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, labels: np.ndarray, dims: np.ndarray, values: np.ndarray, axes: dict[int, np.ndarray], leading: int, leaf: int) -> None:
        self.ids, self.sizes, self.labels, self.dims, self.leaf = ids, sizes, labels, dims, leaf
        starts = np.concatenate(([0], np.cumsum(dims)))
        self.units: list[np.ndarray | None] = [None] * -(-len(ids) // leaf)
        self.low, self.high = (np.zeros((len(self.units), leading)) for _ in range(2))
        self.values, self.starts = values, starts
        for i in range(len(self.units)):
            found = [coordinates(u, axes, leading) for _, u in self.leaf_units(i)]
            self.low[i], self.high[i] = (f([f(x, 0) for x in found], 0) for f in (np.min, np.max))

    def leaf_units(self, i: int) -> list[tuple[slice, np.ndarray]]:
        """A leaf's vectors by number of components; vectors of one length are neighbours unless the label changes."""
        if self.units[i] is None:
            at, end, out = i * self.leaf, min((i + 1) * self.leaf, len(self.ids)), []
            while at < end:
                d = self.dims[at]
                stop = at + int(np.argmax(self.dims[at:end] != d)) if (self.dims[at:end] != d).any() else end
                out.append((slice(at, stop), self.values[self.starts[at] : self.starts[stop]].reshape(-1, d)))
                at = stop
            self.units[i] = out
        return self.units[i]

    def box(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        return self.low[first:last].min(0), self.high[first:last].max(0)

    def label_range(self, first: int, last: int) -> tuple[int, int]:
        return self.labels[first * self.leaf], self.labels[min(last * self.leaf, len(self.labels)) - 1]


def near_leaves(a: Sequence, b: Sequence, epsilon: float, same: bool) -> Iterator[tuple[int, int]]:
    """Pairs of leaves that may hold a link, by halving intervals and skipping those that are provably apart."""
    todo = [(0, len(a.units), 0, len(b.units))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and b1 <= a0:
            continue  # the mirror image of another pair
        (l0, l1), (r0, r1) = a.label_range(a0, a1), b.label_range(b0, b1)
        if l1 < r0 or r1 < l0:
            continue
        (low_a, high_a), (low_b, high_b) = a.box(a0, a1), b.box(b0, b1)
        gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
        if gap @ gap > epsilon * epsilon:
            continue
        if a1 - a0 == 1 and b1 - b0 == 1:
            if not same or a0 <= b0:
                yield a0, b0
            continue
        ways_a = [(a0, a1)] if a1 - a0 == 1 else [(a0, (a0 + a1) // 2), ((a0 + a1) // 2, a1)]
        ways_b = [(b0, b1)] if b1 - b0 == 1 else [(b0, (b0 + b1) // 2), ((b0 + b1) // 2, b1)]
        todo += [(*x, *y) for x in ways_a for y in ways_b]


class Found:
    """Links of two intervals: a number a vector, and ties (vector, least vector) that connect what the links connect."""

    def __init__(self, a: Sequence, b: Sequence) -> None:
        self.a, self.b, self.shift = a, b, 0 if a is b else len(a.ids)
        n = self.shift + len(b.ids)
        self.links = np.zeros(n, np.int64)
        self.ids = a.ids if a is b else np.concatenate((a.ids, b.ids))
        self.root = np.arange(n)

    def add(self, threshold: float, i: int, j: int) -> None:
        for at, x in self.a.leaf_units(i):
            for to, y in self.b.leaf_units(j):
                if x.shape[1] != y.shape[1] or self.a.labels[at.start] > self.b.labels[to.stop - 1] or self.b.labels[to.start] > self.a.labels[at.stop - 1]:
                    continue
                near = x @ y.T >= threshold
                if not near.any():
                    continue
                near &= self.a.labels[at][:, None] == self.b.labels[to][None]
                if self.a is self.b and i == j:
                    if at.start > to.start:
                        continue
                    if at == to:
                        near = np.triu(near, 1)
                row, col = np.nonzero(near)
                row, col = row + at.start, col + to.start
                np.add.at(self.links, row, self.b.sizes[col])
                np.add.at(self.links, col + self.shift, self.a.sizes[row])
                self.tie(row, col + self.shift)

    def tie(self, u: np.ndarray, v: np.ndarray) -> None:
        """Components by least place, kept flat."""
        u, v = self.root[u], self.root[v]
        apart = u != v
        if apart.any():
            node, least = stars(u[apart], v[apart])
            moved = np.arange(len(self.root))
            moved[node] = least
            self.root = moved[self.root]

    def rows(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.links)
        least = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(least, self.root, self.ids)
        return pa.RecordBatch.from_arrays([pa.array(self.ids[at]), pa.array(self.links[at]), pa.array(least[self.root[at]])], names=["id", "links", "tied"])


def _intervals(leaves: DataFrame, level: int, fanout: int) -> DataFrame:
    """The boxes of intervals at a level above `leaves` (columns at, first_label, last_label, low, high)."""
    up = F.floor(F.col("at") / F.lit(fanout**level)).cast("long")
    size = len(leaves.schema["low"].dataType.names)
    box = [f(f"{side}.c{i}").alias(f"c{i}") for side, f in (("low", F.min), ("high", F.max)) for i in range(size)]
    flat = leaves.groupBy(up.alias("at")).agg(F.min("first_label").alias("first_label"), F.max("last_label").alias("last_label"), *[b.alias(f"{'low' if k < size else 'high'}{k % size}") for k, b in enumerate(box)])
    return flat.select("at", "first_label", "last_label", *[F.struct(*[F.col(f"{side}{i}").alias(f"c{i}") for i in range(size)]).alias(side) for side in ("low", "high")])


def _near_intervals(leaves: DataFrame, n: int, epsilon: float, fanout: int) -> DataFrame:
    """Pairs (left <= right) of the n intervals in `leaves` that may hold a link, from the whole sequence down."""
    level = 0
    while fanout**level < n:
        level += 1
    pairs = leaves.sparkSession.createDataFrame([(0, 0)], "left long, right long")
    for at in range(level - 1, -1, -1):
        parts = _intervals(leaves, at, fanout)
        up = F.floor(F.col("at") / fanout).cast("long")
        left = parts.select(up.alias("left"), *[F.col(c).alias(f"l_{c}") for c in parts.columns])
        right = parts.select(up.alias("right"), *[F.col(c).alias(f"r_{c}") for c in parts.columns])
        gaps = [F.greatest(F.lit(0.0), F.col(f"l_low.c{i}") - F.col(f"r_high.c{i}"), F.col(f"r_low.c{i}") - F.col(f"l_high.c{i}")) for i in range(len(leaves.schema["low"].dataType.names))]
        apart = sum((g * g for g in gaps), F.lit(0.0)) > epsilon * epsilon
        # a parent has at most `fanout` parts, so a pair becomes at most fanout**2 pairs
        pairs = (
            pairs.join(left, "left").join(right, "right")
            .filter((F.col("l_at") <= F.col("r_at")) & (F.col("l_first_label") <= F.col("r_last_label")) & (F.col("r_first_label") <= F.col("l_last_label")) & ~apart)
            .select(F.col("l_at").alias("left"), F.col("r_at").alias("right"))
        )
    return pairs if level else pairs.join(leaves.select(F.col("at").alias("left")), "left")


def linked_vectors(classes: DataFrame, threshold: float = THRESHOLD, leading: int = LEADING, leaf: int = LEAF, leaves: int = LEAVES, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame]:
    """Links among different vectors: rows (id, links) and components (node, component).

    classes has id long, size long (rows it stands for), label long, embedding array<double> of length 1; one row a different vector of a label.
    """
    spark, epsilon = classes.sparkSession, float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    common = classes.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    axes = {} if common is None or common["count"] < 2 or common.d > AXES_DIMS else {common.d: principal_axes(classes, "embedding", common.d, leading)}

    def leading_of(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [coordinates(np.asarray(v)[None], axes, leading)[0] for v in batch.column("embedding").to_pylist()]

    def in_grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = pa.array([np.floor(c / epsilon).astype(np.int32) for c in leading_of(batch)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells, pc.list_value_length(batch.column("embedding"))], names=[*batch.schema.names, "cells", "dims"])

    placed = classes.mapInArrow(in_grid, "id long, size long, label long, embedding array<double>, cells array<int>, dims int")
    ordered = numbered(placed, [F.col("label"), F.col("dims"), F.col("cells"), F.col("id")], "place")
    ordered = ordered.withColumn("interval", F.floor((F.col("place") - 1) / (leaf * leaves)).cast("long")).select("interval", "place", "id", "size", "label", "dims", "embedding")
    ordered = stored(ordered, "grid-order")
    names = [f"c{i}" for i in range(leading)]

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The box of each stretch of an interval that a batch has."""
        for batch in filter(len, batches):
            interval, label, found = batch.column("interval").to_numpy(), batch.column("label").to_numpy(), np.stack(leading_of(batch))
            for at in np.unique(interval):
                of = interval == at
                low, high = found[of].min(0), found[of].max(0)
                sides = [pa.StructArray.from_arrays([pa.array([x]) for x in side], names) for side in (low, high)]
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([label[of].min()]), pa.array([label[of].max()]), *sides], names=["at", "first_label", "last_label", "low", "high"])

    side = "struct<" + ",".join(f"{c}:double" for c in names) + ">"
    shapes = stored(_intervals(ordered.select("interval", "label", "embedding").mapInArrow(boxes, f"at long, first_label long, last_label long, low {side}, high {side}"), 0, fanout), "grid-boxes")
    pairs = _near_intervals(shapes, shapes.count(), epsilon, fanout)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Neighbouring vectors of an interval as one row."""
        for batch in filter(len, batches):
            interval, place = batch.column("interval").to_numpy(), batch.column("place").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(interval) != 0) | (np.diff(place) != 1)) + 1).tolist(), batch.num_rows]
            for at, end in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(at, end - at)
                lists = [pc.list_flatten(part.column(c)) if c == "embedding" else part.column(c) for c in VECTORS]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
                yield pa.RecordBatch.from_arrays([part.column("interval").slice(0, 1), part.column("place").slice(0, 1), *lists], names=["interval", "place", *VECTORS])

    rows = ordered.mapInArrow(packed, "interval long, place long, id array<long>, size array<long>, label array<long>, dims array<int>, embedding array<double>")
    pairs = stored(pairs, "grid-pairs")
    sent = pairs.select(F.col("left").alias("interval"), "left", "right").union(pairs.filter("left < right").select(F.col("right").alias("interval"), "left", "right"))
    sent = sent.join(rows, "interval")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = sent.repartition(tasks, "left", "right").sortWithinPartitions("left", "right", "interval", "place")

    def sequence(parts: list[dict]) -> Sequence:
        return Sequence(*(np.concatenate([p[c] for p in parts]) for c in VECTORS), axes, leading, leaf)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = None, {}

        def compared() -> pa.RecordBatch:
            a = sequence(held[pair[0]])
            b = a if pair[0] == pair[1] else sequence(held[pair[1]])
            found = Found(a, b)
            for i, j in near_leaves(a, b, epsilon, a is b):
                found.add(threshold, i, j)
            return found.rows()

        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                now = row["left"].as_py(), row["right"].as_py()
                if pair is not None and now != pair:
                    yield compared()
                    held = {}
                pair = now
                held.setdefault(row["interval"].as_py(), []).append({c: row[c].values.to_numpy(zero_copy_only=False) for c in VECTORS})
        if pair is not None:
            yield compared()

    found = stored(sent.mapInArrow(compare, "id long, links long, tied long"), "grid-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    return links, connected_components(found.select(F.col("id").alias("u"), F.col("tied").alias("v")))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **sizes: int) -> DataFrame:
    """Direct links and components of vectors of equal labels by cosine.

    One row a vector: vec_id, n_links (other rows linked directly), component_id (least vec_id reachable), kept (it is that one). Links need
    equal labels, not null, and equally many components. Vectors that are null, empty, zero or hold a null or a component that isn't finite, and
    rows without an id, link with nothing. Repeated rows are vectors of their own, each linked with the others; ids then repeat in the result. An empty
    table gives no rows; other columns aren't read. A cosine of exactly the threshold links. A negative threshold is refused.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
    marked = source.withColumn("fit", F.coalesce(fit, F.lit(False)))
    usable = marked.filter("fit")
    # scaled by the greatest component first, so that no square overflows or vanishes
    scaled = F.transform("embedding", lambda x: x / F.array_max(F.transform("embedding", F.abs)))
    unit = F.transform("scaled", lambda x: x / F.col("norm"))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x))
    classes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
    classes = stored(classes.withColumn("scaled", scaled).withColumn("norm", norm).select(F.monotonically_increasing_id().alias("id"), "least", "size", "label", "embedding", unit.alias("unit")), "vector-classes")
    links, components = linked_vectors(classes.select("id", "size", "label", F.col("unit").alias("embedding")), threshold, **sizes)
    linked = classes.select("id", "least").join(components.withColumnRenamed("node", "id"), "id").join(links, "id")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    members = classes.join(linked.join(least, "component").select("id", "links", "component_id"), "id", "left")
    members = members.select("label", "embedding", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    joined = usable.join(members, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = marked.filter("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op13_epsilon_grid_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, linked within labels at a cosine of 0.93."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
