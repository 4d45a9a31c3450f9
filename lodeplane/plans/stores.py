"""Tables that are merged bucket by bucket with a commit, and look-ups through resolvers with a cache."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeplane.plans.base import query, table
from lodeplane.session import checkpoint_dir
from lodeplane.sources.merge_table import MergeTable
from lodeplane.sources.resolver import cache_schema, resolve


def _folder(spark: SparkSession, what: str) -> str:
    return f"{checkpoint_dir(spark)}/lodeplane-{what}-{uuid.uuid4().hex}"


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 50 = 7 THEN 'seen' END AS note FROM orders WHERE o_orderkey % 50 <> 9
UNION ALL SELECT -o_orderkey, o_totalprice, 'new' FROM orders WHERE o_orderkey % 50 = 7
""")
def bounded_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded, then a load that changes some, adds some and a column, and then one that deletes some; each rewrites the buckets it touches."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    held = MergeTable.create(spark, _folder(spark, "merged"), ["o_orderkey"], orders.schema, buckets=16)
    held.merge(orders)
    some = orders.filter("o_orderkey % 50 = 7")
    held.merge(some.select("o_orderkey", (F.col("price") + 1).alias("price"), F.lit("seen").alias("note")).union(some.select(-F.col("o_orderkey"), "price", F.lit("new"))))
    held.merge(orders.filter("o_orderkey % 50 = 9").select("o_orderkey"), delete="true")
    return held.read()


@query("""
SELECT o_orderkey, arg_max(o_totalprice, v) AS price, arg_max(v, v) AS version FROM (
  SELECT o_orderkey, o_totalprice, 1 AS v FROM orders UNION ALL SELECT o_orderkey, o_totalprice * 2, 2 FROM orders WHERE o_orderkey % 8 = 1 UNION ALL SELECT o_orderkey, o_totalprice * 4, 4 FROM orders WHERE o_orderkey % 16 = 1
  UNION ALL SELECT o_orderkey, o_totalprice * 3, 3 FROM orders WHERE o_orderkey % 16 = 1) GROUP BY 1
""")
def merge_of_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update that holds a key several times: the newest counts."""
    rows = lambda v, where="true": table(spark, sf_dir, "orders").filter(where).select("o_orderkey", (F.col("o_totalprice") * v).alias("price"), F.lit(v).alias("version"))
    held = MergeTable.create(spark, _folder(spark, "merged"), ["o_orderkey"], rows(1).schema, buckets=8)
    held.merge(rows(1))
    held.merge(rows(2, "o_orderkey % 8 = 1").union(rows(4, "o_orderkey % 16 = 1")).union(rows(3, "o_orderkey % 16 = 1")), order="version")
    return held.read()


def _by_register(batch: pa.RecordBatch) -> pa.Array:
    """A stand-in for an exact register: it knows customers of a few segments."""
    key = batch.column("c_custkey")
    known = pc.is_in(batch.column("c_mktsegment"), pa.array(["BUILDING", "MACHINERY"]))
    x, y = pc.cast(pc.multiply(key, 3), pa.float64()), pc.cast(pc.add(key, 7), pa.float64())
    return pa.StructArray.from_arrays([x, y], ["x", "y"], mask=pc.invert(known))


def _by_area(batch: pa.RecordBatch) -> pa.Array:
    """A stand-in for a coarse look-up by area: it knows even nations."""
    nation = pc.cast(batch.column("c_nationkey"), pa.float64())
    odd = pc.equal(pc.bit_wise_and(pc.cast(batch.column("c_nationkey"), pa.int64()), 1), 1)
    return pa.StructArray.from_arrays([nation, pc.negate(nation)], ["x", "y"], mask=odd)


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_custkey * 3.0 WHEN c_nationkey % 2 = 0 THEN c_nationkey * 1.0 END::DOUBLE AS x,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_custkey + 7.0 WHEN c_nationkey % 2 = 0 THEN c_nationkey * -1.0 END::DOUBLE AS y,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'register' WHEN c_nationkey % 2 = 0 THEN 'area' END AS tier FROM customer
""")
def resolved_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of customers through two tiers with a cache: half of the table first, then all of it, of which the known half asks nothing."""
    wanted = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    place = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    cache = MergeTable.create(spark, _folder(spark, "places"), ["c_custkey"], cache_schema(wanted.schema["c_custkey"], place), buckets=8)
    tiers = [("register", _by_register), ("area", _by_area)]
    resolve(wanted.filter("c_custkey % 2 = 0"), cache, "c_custkey", tiers, 10_000_000)
    found = resolve(wanted, cache, "c_custkey", tiers, 10_000_000)
    return found.select("c_custkey", "answer.x", "answer.y", "tier")
