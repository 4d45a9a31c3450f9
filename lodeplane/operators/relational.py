"""Relational composites: newest row a key, disjunctive and membership joins, look-ups, numbering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeplane.session import cut_lineage, dealt

#: Rows up to which a dimension is broadcast without asking the optimizer.
SMALL_ROWS = 100_000


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the given order. Name a full order: ties are broken arbitrarily otherwise.

    The constant limit on ranks also holds in each task before the shuffle, so that a hot key's rows aren't gathered.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def newest_by(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row of each key that is greatest by the order columns, then by its other columns; summed before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order, *(c for c in rest if c not in order)]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ordered)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns])


def mode_by(df: DataFrame, keys: Sequence[str], value: str, name: str = "mode") -> DataFrame:
    """The most frequent value of each key, the least one of several; null values don't count."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    least = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias("_best")
    return counts.groupBy(*keys).agg(least).select(*keys, F.col("_best.v").alias(name), (-F.col("_best.n")).alias("n"))


def modes(df: DataFrame, keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """Of each key the most frequent value of several columns (new name: column), the least one of several; null where a key has only nulls.

    All columns are counted in one pass: a row becomes a row for each of its values that isn't null.
    """
    kinds = {name: df.schema[column].dataType for name, column in values.items()}
    slot = lambda i, name: F.struct(F.lit(i).alias("_slot"), *[(F.col(values[n]) if n == name else F.lit(None).cast(kinds[n])).alias(f"_{n}") for n in values])
    given = [F.when(F.col(column).isNotNull(), slot(i, name)) for i, (name, column) in enumerate(values.items())]
    given.append(slot(-1, None))  # so that every key stays
    counts = df.select(*keys, F.inline(F.array_compact(F.array(*given)))).groupBy(*keys, "_slot", *[f"_{n}" for n in values]).agg(F.count("*").alias("_n"))
    best = [F.min(F.when(F.col("_slot") == i, F.struct((-F.col("_n")).alias("n"), F.col(f"_{name}").alias("v")))).alias(name) for i, name in enumerate(values)]
    return counts.groupBy(*keys).agg(*best).select(*keys, *[F.col(f"{name}.v").alias(name) for name in values])


def or_join(left: DataFrame, right: DataFrame, conditions: Sequence[Column], pair: Sequence[str]) -> DataFrame:
    """Pairs for which any of several equality conditions holds: a union of equi-joins without repeats, instead of a nested loop.

    A pair is left to the first condition that it meets. Where the pair's columns tell the rows of each side apart, which is counted first, no pair comes twice
    then, and the pairs needn't be compared with each other.
    """
    parts, before = [], None
    left = dealt(left)  # a table in one file would be one task with all pairs
    for c in conditions:
        parts.append(left.join(right, c if before is None else c & ~before).select(*pair))
        held = F.coalesce(c, F.lit(False))
        before = held if before is None else before | held
    pairs = reduce(DataFrame.union, parts)
    keys = [[c for c in pair if c in side.columns] for side in (left, right)]
    alone = all(own and side.groupBy(*own).count().filter("count > 1").isEmpty() for side, own in zip((left, right), keys, strict=True))
    return pairs if alone else pairs.distinct()


def any_join(left: DataFrame, right: DataFrame, key: str, array: str, how: str = "inner") -> DataFrame:
    """left joined with the rows of right whose array holds left's key; each row of right once however often it holds it."""
    exploded = right.withColumn(key, F.explode(F.array_distinct(array)))
    return left.join(exploded, key, how)


def two_pass_lookup(facts: DataFrame, dim: DataFrame, exact: Sequence[str], fallback: Sequence[str], value: str) -> DataFrame:
    """facts plus value: from the dimension's row equal in `exact`, else from its row equal in `fallback` with null elsewhere."""
    others = [c for c in exact if c not in fallback]
    full = dim.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in exact])).select(*exact, F.col(value).alias("_exact"))
    part = dim.filter(reduce(lambda a, b: a & b, [F.col(c).isNull() for c in others])).select(*fallback, F.col(value).alias("_part"))
    return facts.join(full, list(exact), "left").join(part, list(fallback), "left").withColumn(value, F.coalesce("_exact", "_part")).drop("_exact", "_part")


def range_lookup(facts: DataFrame, brackets: DataFrame, value: str, low: str, high: str, width: float | None = None) -> DataFrame:
    """facts joined with the brackets [low, high) that hold value; a null high is open.

    A few brackets are broadcast after a count; many are cut into cells of `width` and joined on the cell.
    """
    holds = (F.col(value) >= F.col(low)) & (F.col(high).isNull() | (F.col(value) < F.col(high)))
    if width is None or brackets.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return facts.join(F.broadcast(brackets), holds)
    cell = F.floor(F.col(value) / width)
    top = F.coalesce(F.col(high), F.lit(facts.agg(F.max(value)).first()[0] or 0.0))
    cut = brackets.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(low) / width), F.greatest(F.floor(F.col(low) / width), F.floor(top / width)))))
    return facts.withColumn("_cell", cell).join(cut, "_cell").filter(holds).drop("_cell")


def numbered(df: DataFrame, order: Sequence[Column], name: str = "sk") -> DataFrame:
    """df with gapless numbers from 1 in the given order, without a window over all rows.

    Rows are dealt by range, sorted and checkpointed; a partition's first number follows from the counts of those before it.
    """
    fixed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    fixed = fixed.withColumns({"_part": F.shiftright("_at", 33), "_pos": F.col("_at").bitwiseAND((1 << 33) - 1)})
    before, total = {}, 0
    for part, n in sorted(map(tuple, fixed.groupBy("_part").count().collect())):  # a row a partition
        before[part], total = total, total + n
    if not before:
        return fixed.drop("_at", "_part", "_pos").withColumn(name, F.lit(None).cast("long"))
    starts = fixed.sparkSession.createDataFrame(list(before.items()), "_part long, _before long")
    return fixed.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_pos") + 1).drop("_at", "_part", "_pos", "_before")


def stratified_top(df: DataFrame, area: str, stratum: str, order: Sequence[Column], n: int, strata: int) -> DataFrame:
    """The first n rows of each stratum of an area; where strata fall short of n * strata together, the area's next rows of any stratum.

    A gap is at most n * strata rows, so that no stratum's later rows are needed; a constant limit on ranks also holds before the shuffle.
    """
    w = Window.partitionBy(area, stratum).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n * (strata + 1))
    first = ranked.filter(F.col("_rn") <= n)
    gaps = first.groupBy(area).agg((F.lit(n * strata) - F.count("*")).alias("_gap"))
    rest = ranked.filter(F.col("_rn") > n).join(gaps, area)
    fill = rest.withColumn("_more", F.row_number().over(Window.partitionBy(area).orderBy(*order))).filter("_more <= _gap")
    return first.drop("_rn").withColumn("backfilled", F.lit(False)).unionByName(fill.drop("_rn", "_gap", "_more").withColumn("backfilled", F.lit(True)))


def filled_slots(df: DataFrame, items: str, slots: Mapping[str, Sequence[str]]) -> DataFrame:
    """df with a column a slot, from an array of struct<tag, value> with different values.

    Slots are filled in order, each with the value of the first element not taken yet that has one of its tags, earlier tags before later ones. Slots that stay
    empty then take the elements left over, in their order, whatever their tags; without enough of them they are null.
    """
    names = list(slots)
    own = {s: f"_slot{i}" for i, s in enumerate(names)}
    for i, (slot, tags) in enumerate(slots.items()):
        taken = [F.col(own[s]) for s in names[:i]]
        free = F.filter(items, lambda x: F.coalesce(~F.array_contains(F.array_compact(F.array(*taken)), x.value), F.lit(True))) if taken else F.col(items)
        df = df.withColumn(own[slot], F.coalesce(*[_first_tagged(free, tag) for tag in tags]))
    taken = F.array_compact(F.array(*[F.col(own[s]) for s in names]))
    df = df.withColumn("_rest", F.transform(F.filter(items, lambda x: ~F.array_contains(taken, x.value)), lambda x: x.value))
    empty = F.lit(0)
    for slot in names:
        df = df.withColumn(slot, F.coalesce(F.col(own[slot]), F.get("_rest", empty)))
        empty = empty + F.col(own[slot]).isNull().cast("int")
    return df.drop("_rest", *own.values())


def _first_tagged(items: Column, tag: str) -> Column:
    return F.get(F.filter(items, lambda x: x.tag == tag), F.lit(0)).value
