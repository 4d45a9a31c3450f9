"""Keys looked up by a costly service, each once: batches through resolvers in tiers, a ceiling of calls, and a cache that only grows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeplane.session import stored
from lodeplane.sources.merge_table import MergeTable

#: From a batch of keys (and what else is known of them) to a struct array of the same length: null where it finds nothing.
Resolver = Callable[[pa.RecordBatch], pa.Array]


def cache_schema(key: T.StructField, answer: T.StructType) -> T.StructType:
    """Columns of a cache: the key, the answer, and the tier that gave it; without a tier none of them found it."""
    return T.StructType([key, T.StructField("answer", answer), T.StructField("tier", T.StringType())])


def pending(wanted: DataFrame, cache: MergeTable, key: str) -> DataFrame:
    """The rows of wanted, one a key, whose keys the cache doesn't know yet; null keys aren't looked up."""
    rest = [F.min_by(c, F.struct(*[x for x in wanted.columns if x != key])).alias(c) for c in wanted.columns if c != key]
    one = wanted.filter(F.col(key).isNotNull()).groupBy(key).agg(*rest) if rest else wanted.filter(F.col(key).isNotNull()).select(key).distinct()
    return one.join(cache.read().select(key), key, "left_anti")


def resolve(wanted: DataFrame, cache: MergeTable, key: str, tiers: Sequence[tuple[str, Resolver]], ceiling: int, batch: int = 1000) -> DataFrame:
    """wanted with answer and tier. Keys that the cache lacks go through the tiers, at most `ceiling` of them a run (the least first); the others have none yet.

    A tier sees what those before it left. A tier's answers are written to a stored table before anything reads them and then merged by key, known
    keys staying as they are: a task that is run again, or a run that is stopped and begun anew, puts no key into the cache twice. A key that no tier finds is
    remembered too, so that a second run asks nothing. wanted: one key column and what resolvers need; rows of one key share an answer.
    """
    spark = wanted.sparkSession
    names = [n for n, _ in tiers]
    if len(set(names)) < len(names) or not names:
        raise ValueError("tiers need names of their own")
    answer = cache.version().columns()["answer"].dataType
    rest = stored(pending(wanted, cache, key).orderBy(key).limit(ceiling), "pending")
    kind = rest.schema
    for name, resolver in tiers:
        size = str(batch)

        def run(batches: Iterator[pa.RecordBatch], resolver: Resolver = resolver) -> Iterator[pa.RecordBatch]:
            for found in batches:
                for at in range(0, found.num_rows, batch):
                    part = found.slice(at, batch)
                    answers = resolver(part)
                    if len(answers) != part.num_rows:
                        raise ValueError("a resolver must give an answer or a null for each row")
                    yield pa.RecordBatch.from_arrays([*part.columns, answers], names=[*part.schema.names, "answer"])

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
        cores = min(spark.sparkContext.defaultParallelism, max(1, -(-ceiling // int(size))))
        asked = stored(rest.repartition(cores, key).mapInArrow(run, f"{fields}, answer {answer.simpleString()}"), "answers")
        cache.merge(asked.filter("answer IS NOT NULL").select(key, "answer", F.lit(name).alias("tier")), matched="keep")
        rest = asked.filter("answer IS NULL").drop("answer")
    cache.merge(rest.select(key, F.lit(None).cast(answer).alias("answer"), F.lit(None).cast("string").alias("tier")), matched="keep")
    return wanted.join(cache.read(), key, "left")
