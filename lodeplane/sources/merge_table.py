"""A table of Parquet files in hash buckets whose merges rewrite only the buckets they touch and become visible at once.

    path/data/<run>/_bucket=<b>/*.parquet     what a merge wrote; never changed after
    path/versions/<number>.json               which run holds each bucket in that version

A version is committed by renaming its file into place, which fails where that number exists: of two writers that began at the same version one
wins, the other one raises and can begin anew. A writer that stops before that has changed nothing that a reader sees.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeplane.operators.relational import newest_by
from lodeplane.session import stored
from lodeplane.sources.versions import Conflict as Conflict
from lodeplane.sources.versions import Versions, delete, names

BUCKET = "_bucket"


class RepeatedKeys(ValueError):
    """Updates hold a key twice, or a null in one."""


@dataclass(frozen=True)
class Version:
    """A committed state: its number, the run of each bucket that has rows, and the columns."""

    number: int
    keys: list[str]
    buckets: int
    schema: str
    runs: dict[str, str] = field(default_factory=dict)

    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class MergeTable:
    """`MergeTable.create` makes one, `MergeTable(spark, path)` opens it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(spark, self.path)

    @classmethod
    def create(cls, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType, buckets: int = 64) -> MergeTable:
        """An empty table. A bucket is what a merge rewrites at least: choose so many that one is a few hundred megabytes."""
        missing = [k for k in keys if k not in schema.names]
        if missing or not keys or BUCKET in schema.names:
            raise ValueError(f"keys must be columns, and no column may be named {BUCKET}: {missing}")
        table = cls(spark, path)
        table.commit(Version(0, list(keys), buckets, schema.json()))
        return table

    def commit(self, version: Version) -> Version:
        self.versions.commit(version.number, version.__dict__)
        return version

    # reading

    def version(self, number: int | None = None) -> Version:
        """The state of that number, else the newest."""
        return Version(**self.versions.load(number))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version; readers keep theirs whatever is committed meanwhile."""
        version = self.version(number)
        return self._rows(version, version.runs).drop(BUCKET)

    def _rows(self, version: Version, buckets: Sequence[str] | dict[str, str]) -> DataFrame:
        """The rows of some buckets, with their numbers."""
        runs: dict[str, list[str]] = {}
        for b in buckets:
            if b in version.runs:
                runs.setdefault(version.runs[b], []).append(f"{self.path}/data/{version.runs[b]}/{BUCKET}={b}")
        schema = version.columns().add(BUCKET, T.IntegerType())
        out = self.spark.createDataFrame([], schema)
        for run, paths in sorted(runs.items()):
            out = out.unionByName(self.spark.read.schema(schema).option("basePath", f"{self.path}/data/{run}").parquet(*paths))
        return out

    # writing

    def merge(self, updates: DataFrame, order: str | None = None, delete: str | None = None, matched: str = "update") -> Version:
        """Bring updates in by key: new rows are added, those of known keys replaced (or with matched='keep' left as they are), those for which the condition `delete` holds go.

        With an order column the newest update of a key counts, otherwise a key that comes twice raises; so does a null key. A column that
        the table lacks is added, null in rows that aren't touched; a column that updates lack is null in new rows and stays in known ones. Buckets without an
        update are neither read nor written. Returns the version after it, which is the one before if there was nothing to do.
        """
        if matched not in ("update", "keep"):
            raise ValueError("matched must be update or keep")
        before = self.version()
        keys, known = before.keys, before.columns()
        gone = F.expr(delete) if delete else F.lit(False)
        fresh = updates.withColumn("_gone", F.coalesce(gone, F.lit(False)))
        if order is not None:
            fresh = newest_by(fresh, keys, order)
        bucket = F.pmod(F.xxhash64(*[F.col(k).cast(known[k].dataType) for k in keys]), F.lit(before.buckets)).cast("int")
        fresh = stored(fresh.withColumn(BUCKET, bucket), "updates")  # worked out once, whatever it is made of
        checked = fresh.agg(F.count("*").alias("n"), F.count_if(F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys))).alias("nulls")).first()
        if checked.nulls:
            raise RepeatedKeys(f"{checked.nulls} updates have a null key")
        if order is None and (twice := fresh.groupBy(*keys).count().filter("count > 1").limit(3).collect()):
            raise RepeatedKeys(f"keys that come more than once, such as {[tuple(r)[:-1] for r in twice]}")
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # a row a bucket at most
        if not touched:
            return before
        added = [f for f in fresh.schema if f.name not in (*known.names, BUCKET, "_gone")]
        columns = T.StructType([*known.fields, *(T.StructField(f.name, f.dataType) for f in added)])
        rest = [f for f in columns if f.name not in keys]
        old = self._rows(before, [str(b) for b in touched])
        old = old.select(*keys, BUCKET, F.struct(F.lit(True).alias("there"), *[(F.col(f.name) if f.name in known.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in rest]).alias("old"))
        new = fresh.select(*[F.col(k).cast(known[k].dataType).alias(k) for k in keys], BUCKET, F.struct("_gone", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in rest if f.name in fresh.columns]).alias("new"))
        both = old.join(new, [*keys, BUCKET], "full").filter("new IS NULL OR NOT new._gone")
        use_new = F.col("new").isNotNull() if matched == "update" else F.col("old").isNull()
        value = lambda f: F.when(use_new, F.col(f"new.{f.name}")).otherwise(F.col(f"old.{f.name}")) if f.name in fresh.columns else F.col(f"old.{f.name}")
        merged = both.select(*[F.col(f.name) if f.name in keys else value(f).alias(f.name) for f in columns], BUCKET)
        run = uuid.uuid4().hex
        merged.repartition(BUCKET, F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(4))).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{run}")
        written = {x.removeprefix(f"{BUCKET}=") for x in names(self.spark, f"{self.path}/data/{run}") if x.startswith(f"{BUCKET}=")}
        runs = {b: r for b, r in before.runs.items() if int(b) not in set(touched)} | {b: run for b in sorted(written)}
        return self.commit(Version(before.number + 1, keys, before.buckets, columns.json(), runs))

    def vacuum(self, keep: int = 1) -> int:
        """Delete all but the newest `keep` versions, and the runs that none of those holds; how many runs went. Not while others read older versions or write."""
        numbers = self.versions.numbers()
        held = {r for n in numbers[-keep:] for r in self.version(n).runs.values()}
        for n in numbers[:-keep]:
            self.versions.drop(n)
        gone = [r for r in names(self.spark, f"{self.path}/data") if r not in held]
        for r in gone:
            delete(self.spark, f"{self.path}/data/{r}")
        return len(gone)

