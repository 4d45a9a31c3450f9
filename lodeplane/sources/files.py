"""Landing files and layered tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaChanged(Exception):
    """A column's type differs from the contract."""


def evolved(current: T.StructType, incoming: DataFrame) -> DataFrame:
    """incoming with the contract's columns first and in its types' order; new columns are let in, changed types raise."""
    have = {f.name: f.dataType for f in incoming.schema}
    wrong = [f"{f.name}: {f.dataType.simpleString()} became {have[f.name].simpleString()}" for f in current if f.name in have and have[f.name] != f.dataType]
    if wrong:
        raise SchemaChanged("; ".join(wrong))
    empty = incoming.sparkSession.createDataFrame([], current)
    return empty.unionByName(incoming, allowMissingColumns=True)


def read_landing(spark: SparkSession, path: str | list[str], kind: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """Files of a stated schema: parquet, orc, json, csv or xml. Nothing is inferred."""
    if kind not in ("parquet", "orc", "json", "csv", "xml", "text"):
        raise ValueError(f"no reader for {kind}")
    return spark.read.format(kind).schema(schema).options(**options).load(path)


def overwrite_slices(df: DataFrame, path: str, by: str) -> None:
    """Write df so that only the slices it holds are replaced: a reload of a day leaves the other days alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def append_after(df: DataFrame, path: str, order: str) -> DataFrame:
    """The rows of df from the stored high-water mark on; the mark's own rows are read again."""
    mark = df.sparkSession.read.parquet(path).agg({order: "max"}).first()[0]
    return df if mark is None else df.filter(df[order] >= mark)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The good lines of JSON files as rows of a stated schema, and the bad ones (line, file): skipped, and kept for a count or a look."""
    held = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    lines = spark.read.text(path).filter("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("file"))
    rows = lines.select("file", F.from_json("value", held, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    bad = rows.filter("r._bad IS NOT NULL").select(F.col("r._bad").alias("line"), "file")
    return rows.filter("r._bad IS NULL").select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields]), bad


#: What names a load in a file's or folder's name: all before a part's number and the suffixes.
LOAD_NAME = r"^(.*?)(?:[-_.]?part[-_]?[0-9].*|[.][^/]*)?$"


def newest_load(spark: SparkSession, folder: str, named: str = LOAD_NAME) -> list[str]:
    """The paths in a folder that belong to the load that is last by name: one file, all of its parts, or a folder; only names are listed.

    named: a pattern whose first group is a load's name. Names that begin with a dot or an underscore are no loads. Raises without any.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = [x.getPath() for x in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    loads: dict[str, list[str]] = {}
    for x in found:
        name = x.getName()
        if name[0] not in "._" and (m := re.search(named, name)):
            loads.setdefault(m[1], []).append(x.toString())
    if not loads:
        raise FileNotFoundError(f"no load in {folder}")
    return sorted(loads[max(loads)])


def read_newest(spark: SparkSession, folder: str, kind: str, schema: T.StructType | str, named: str = LOAD_NAME, **options: str) -> DataFrame:
    """The newest load of a landing folder, all of its files and no others."""
    return read_landing(spark, newest_load(spark, folder, named), kind, schema, **options)


def newest_file(df: DataFrame, named: str = LOAD_NAME) -> DataFrame:
    """The rows of the load that is last by name, of a table that is read from files named by their time already; `read_newest` reads nothing else."""
    load = F.regexp_extract(F.regexp_extract(F.col("_metadata.file_path"), "([^/]*)$", 1), named, 1)
    known = df.select("*", load.alias("_load"))
    return known.join(F.broadcast(known.agg(F.max("_load").alias("_load"))), "_load").drop("_load")  # one row


def carried_forward(known: DataFrame, fresh: DataFrame, keys: list[str], seen: str, stale_before: Column) -> DataFrame:
    """fresh rows, and the known ones of other keys that were seen late enough; each with `carried`."""
    old = known.join(fresh.select(*keys), keys, "left_anti").filter(F.col(seen) >= stale_before)
    return fresh.withColumn("carried", F.lit(False)).unionByName(old.withColumn("carried", F.lit(True)))
