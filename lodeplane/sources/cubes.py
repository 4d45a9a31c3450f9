"""Statistical cubes and nested documents as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUBE = "struct<id: array<string>, size: array<int>, categories: array<array<string>>, value: map<string, double>>"


def json_stat_rows(df: DataFrame, document: str, keys: list[str]) -> DataFrame:
    """Rows of cubes in JSON (id, size, categories, sparse value): keys, one array of category codes, value.

    A value's place in its dimensions follows from its row-major index by the strides, all inside expressions.
    """
    cube = df.select(*keys, F.from_json(document, CUBE).alias("c"))
    flat = cube.select(*keys, "c.size", "c.categories", F.explode("c.value").alias("_at", "value")).withColumn("_at", F.col("_at").cast("long"))
    dims = F.sequence(F.lit(1), F.size("size"))
    stride = lambda d: F.aggregate(F.slice("size", d + 1, F.size("size") - d), F.lit(1).cast("long"), lambda a, x: a * x)
    place = F.transform(dims, lambda d: F.element_at(F.element_at("categories", d), (F.floor(F.col("_at") / stride(d)) % F.element_at("size", d)).cast("int") + 1))
    return flat.select(*keys, place.alias("codes"), "value")


def dense_cube_rows(df: DataFrame, document: str, keys: list[str]) -> DataFrame:
    """Rows of cubes whose values are a whole row-major array (null where there is none): keys, codes, value."""
    kind = CUBE.replace("map<string, double>", "array<double>")
    cube = df.select(*keys, F.from_json(document, kind).alias("c"))
    flat = cube.select(*keys, "c.size", "c.categories", F.posexplode("c.value").alias("_at", "value")).filter("value IS NOT NULL")
    dims = F.sequence(F.lit(1), F.size("size"))
    stride = lambda d: F.aggregate(F.slice("size", d + 1, F.size("size") - d), F.lit(1).cast("long"), lambda a, x: a * x)
    place = F.transform(dims, lambda d: F.element_at(F.element_at("categories", d), (F.floor(F.col("_at") / stride(d)) % F.element_at("size", d)).cast("int") + 1))
    return flat.select(*keys, place.alias("codes"), "value")


def attribute_values(attributes: Column, observation: Column) -> Column:
    """The codes that an observation's attribute places (null for none) stand for, by the tables of each attribute."""
    return F.zip_with(attributes, observation, lambda table, at: F.get(table, at.cast("int")))


def sdmx_rows(df: DataFrame, document: str, keys: list[str]) -> DataFrame:
    """Rows of series documents {"periods": [...], "observations": {"place": [value, ...]}}: keys, period, value."""
    parsed = df.select(*keys, F.from_json(document, "struct<periods: array<string>, observations: map<string, array<double>>>").alias("d"))
    rows = parsed.select(*keys, F.col("d.periods").alias("periods"), F.explode("d.observations").alias("_at", "_values"))
    return rows.select(*keys, F.get("periods", F.col("_at").cast("int")).alias("period"), F.get("_values", F.lit(0)).alias("value"))


def key_drift(df: DataFrame, document: str, expected: list[str]) -> DataFrame:
    """Rows whose JSON object's keys differ from the expected ones: missing and unknown keys, and how many rows are so."""
    found = F.array_sort(F.json_object_keys(document))
    want = F.array(*[F.lit(k) for k in sorted(expected)])
    gaps = df.select(F.array_join(F.array_except(want, found), ",").alias("missing"), F.array_join(F.array_except(found, want), ",").alias("unknown"))
    return gaps.filter("missing <> '' OR unknown <> ''").groupBy("missing", "unknown").agg(F.count("*").alias("n"))


def image_slots(tags: Column, urls: Column, wanted: list[list[str]]) -> Column:
    """For each list of tags the first url with one of them, in their order; null where none is."""
    pairs = F.arrays_zip(tags.alias("tag"), urls.alias("url"))
    pick = lambda t: F.get(F.transform(F.filter(pairs, lambda x: x.tag == t), lambda x: x.url), F.lit(0))
    return F.array(*[F.coalesce(*[pick(t) for t in slot]) for slot in wanted])
