"""Composites of several operators, as the layers above use them."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.functions.geo import area, centroid, clipped, repaired
from lodeplane.operators.relational import mode_by, newest_by
from lodeplane.operators.spatial import density_clusters, polygons_at
from lodeplane.plans.base import query, table
from lodeplane.session import checkpoint_dir, evened
from lodeplane.sources.sinks import load

_CUSTOMERS = "(SELECT c_custkey AS id, CAST(c_custkey * 7919 % 4000 AS DOUBLE) AS x, CAST(c_custkey * 104729 % 4001 AS DOUBLE) AS y, c_mktsegment, c_nationkey FROM customer)"


@query(f"""
WITH RECURSIVE p AS {_CUSTOMERS}, e AS MATERIALIZED (SELECT a.id AS u, b.id AS v FROM p a, p b WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 60 * 60),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u), c AS (SELECT u AS id, min(v) AS cluster FROM r GROUP BY 1),
o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
m AS (SELECT cluster, c_mktsegment AS address, p.id, x, y, o_orderstatus AS status, substring(o_orderpriority, 1, 1) AS class FROM c JOIN p ON c.id = p.id LEFT JOIN o ON o_custkey = p.id AND rn = 1),
h AS (SELECT cluster, address, string_agg(class || '=' || n, ',' ORDER BY class) AS classes FROM (SELECT cluster, address, class, count(*) AS n FROM m WHERE class IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2),
s AS (SELECT cluster, address, status, row_number() OVER (PARTITION BY cluster, address ORDER BY count(*) DESC, status) AS rn FROM m WHERE status IS NOT NULL GROUP BY 1, 2, 3)
SELECT m.cluster, m.address, count(*) AS n_units, round(avg(x), 3) AS x, round(avg(y), 3) AS y, max(h.classes) AS classes, max(s.status) AS main_status
FROM m LEFT JOIN h ON m.cluster = h.cluster AND m.address = h.address LEFT JOIN s ON m.cluster = s.cluster AND m.address = s.address AND s.rn = 1 GROUP BY 1, 2
""")
def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units within steps of 60 of each other and at one address are a building: latest record a unit, histogram, most frequent status, centre."""
    k = F.col("c_custkey")
    units = table(spark, sf_dir, "customer").select(k.alias("id"), (k * 7919 % 4000).cast("double").alias("x"), (k * 104729 % 4001).cast("double").alias("y"), F.col("c_mktsegment").alias("address"))
    latest = newest_by(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderdate", "o_orderkey", F.col("o_orderstatus").alias("status"), F.substring("o_orderpriority", 1, 1).alias("class")), ["id"], "o_orderdate", "o_orderkey")
    members = density_clusters(units, 60.0).join(latest.select("id", "status", "class"), "id", "left")
    keys = ["cluster", "address"]
    base = members.groupBy(*keys).agg(F.count("*").alias("n_units"), F.round(F.avg("x"), 3).alias("x"), F.round(F.avg("y"), 3).alias("y"))
    counts = members.filter("class IS NOT NULL").groupBy(*keys, "class").agg(F.count("*").alias("n"))
    histogram = counts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("class", "n"))), lambda v: F.concat_ws("=", v["class"], v["n"])), ",").alias("classes"))
    main = mode_by(members, keys, "status", "main_status").drop("n")
    return base.join(histogram, keys, "left").join(main, keys, "left")


@query("""
WITH layers AS (
  SELECT 'orders' AS layer, o_orderkey AS feature, o_orderpriority AS zone, CASE WHEN o_totalprice > 300000 THEN 3 WHEN o_totalprice > 100000 THEN 2 ELSE 1 END AS severity, o_custkey % 25 AS area FROM orders
  UNION ALL SELECT 'parts', p_partkey, p_type, CASE WHEN p_size > 40 THEN 3 ELSE 0 END, p_partkey % 25 FROM part
  UNION ALL SELECT 'customers', c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 2 ELSE 0 END, c_nationkey FROM customer
  UNION ALL SELECT 'suppliers', s_suppkey, 'SUPPLIER', CASE WHEN s_acctbal < 0 THEN 3 WHEN s_acctbal < 1000 THEN 1 ELSE 0 END, s_nationkey FROM supplier
  UNION ALL SELECT 'events', event_id, event_type, CASE WHEN event_type = 'error' THEN 2 ELSE 0 END, user_id % 25 FROM events
  UNION ALL SELECT 'pages', page_id, split_part(split_part(url, '://', 1), ':', 1), 1, page_id % 25 FROM pages),
rules AS (SELECT p_partkey AS rule, p_partkey % 25 AS area, unnest([p_type, CASE WHEN p_size > 25 THEN '1-URGENT' ELSE '5-LOW' END, CASE WHEN p_size > 40 THEN 'error' ELSE 'SUPPLIER' END]) AS zone FROM part),
r AS (SELECT area, zone, count(DISTINCT rule) AS n_rules, min(rule) AS first_rule FROM rules GROUP BY 1, 2)
SELECT layer, feature, severity, CASE severity WHEN 3 THEN 'prohibited' WHEN 2 THEN 'conditional' WHEN 1 THEN 'notice' ELSE 'none' END AS label, coalesce(n_rules, 0) AS n_rules, first_rule
FROM layers LEFT JOIN r ON layers.area = r.area AND layers.zone = r.zone
""")
def constraint_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers united under one contract, with a severity label and the rules of their area whose zones hold theirs: their number and the
    first. Rules are counted by area and zone before they meet the features."""
    ladder = lambda c, steps: reduce(lambda e, s: e.when(c < s[0], s[1]), steps[1:], F.when(c < steps[0][0], steps[0][1]))
    above = lambda c, a, b: F.when(c > b, 3).when(c > a, 2).otherwise(1)
    sources = {
        "orders": ("o_orderkey", F.col("o_orderpriority"), above(F.col("o_totalprice"), 100_000, 300_000), F.col("o_custkey") % 25),
        "parts": ("p_partkey", F.col("p_type"), F.when(F.col("p_size") > 40, 3).otherwise(0), F.col("p_partkey") % 25),
        "customers": ("c_custkey", F.col("c_mktsegment"), ladder(F.col("c_acctbal"), [(0, 2)]).otherwise(0), F.col("c_nationkey")),
        "suppliers": ("s_suppkey", F.lit("SUPPLIER"), ladder(F.col("s_acctbal"), [(0, 3), (1000, 1)]).otherwise(0), F.col("s_nationkey")),
        "events": ("event_id", F.col("event_type"), F.when(F.col("event_type") == "error", 2).otherwise(0), F.col("user_id") % 25),
        "pages": ("page_id", F.split_part(F.split_part("url", F.lit("://"), F.lit(1)), F.lit(":"), F.lit(1)), F.lit(1), F.col("page_id") % 25),
    }

    def layer(name: str) -> DataFrame:
        key, zone, severity, area = sources[name]
        of = name if name in ("orders", "events", "pages") else name[:-1]
        return table(spark, sf_dir, of).select(F.lit(name).alias("layer"), F.col(key).alias("feature"), zone.alias("zone"), severity.alias("severity"), area.cast("long").alias("area"))

    layers = reduce(DataFrame.unionByName, map(layer, sources))
    size = F.col("p_size")
    zones = F.array("p_type", F.when(size > 25, "1-URGENT").otherwise("5-LOW"), F.when(size > 40, "error").otherwise("SUPPLIER"))
    rules = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("rule"), (F.col("p_partkey") % 25).alias("area"), F.explode(F.array_distinct(zones)).alias("zone"))
    by_zone = rules.groupBy("area", "zone").agg(F.count("*").alias("n_rules"), F.min("rule").alias("first_rule"))
    label = F.element_at(F.array(*map(F.lit, ("none", "notice", "conditional", "prohibited"))), F.col("severity") + 1)
    joined = layers.join(by_zone, ["area", "zone"], "left")
    return joined.select("layer", "feature", "severity", label.alias("label"), F.coalesce("n_rules", F.lit(0)).alias("n_rules"), "first_rule")


@query(f"""
WITH c AS {_CUSTOMERS}, z AS (SELECT p_partkey AS polygon, CAST(p_partkey * 7919 % 4000 AS DOUBLE) AS cx, CAST(p_partkey * 31 % 4000 AS DOUBLE) AS cy, 20.5 + p_size AS r FROM part),
f AS (SELECT id, min(polygon) AS area FROM c, z WHERE abs(x - cx) + abs(y - cy) < r GROUP BY 1)
SELECT c.id, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'home' WHEN c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'works' ELSE 'other' END AS category, f.area FROM c LEFT JOIN f ON c.id = f.id
""")
def located_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with a category and the area that they lie in, if any."""
    k, p = F.col("c_custkey"), F.col("p_partkey")
    points = table(spark, sf_dir, "customer").select(k.alias("id"), (k * 7919 % 4000).cast("double").alias("x"), (k * 104729 % 4001).cast("double").alias("y"), F.col("c_mktsegment").alias("kind"))
    cx, cy, r = (p * 7919 % 4000).cast("double"), (p * 31 % 4000).cast("double"), F.col("p_size") + 20.5
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    areas = table(spark, sf_dir, "part").select(p.alias("polygon"), F.array(corner(cx - r, cy), corner(cx, cy - r), corner(cx + r, cy), corner(cx, cy + r)).alias("ring"))
    inside = polygons_at(points.select("id", "x", "y"), areas, 64.0).select("id", F.col("first").alias("area"))
    category = F.when(F.col("kind").isin("BUILDING", "FURNITURE"), "home").when(F.col("kind").isin("MACHINERY", "AUTOMOBILE"), "works").otherwise("other")
    return points.join(inside, "id", "left").select("id", category.alias("category"), "area")


@query("""
WITH s AS (SELECT p_partkey, 1.0 + p_size AS a, 3.0 + p_partkey % 11 AS b FROM part)
SELECT p_partkey, round(least(a, 20.0) * least(b, 8.0), 6) AS overlap, round(a * b, 6) AS area, round(a / 2, 6) AS cx, round(b / 2, 6) AS cy FROM s
""")
def polygon_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings repaired, measured and clipped to a window."""
    corner = lambda x, y: F.struct(F.lit(x).cast("double").alias("x"), F.lit(y).cast("double").alias("y"))
    a, b = F.col("p_size") + F.lit(1.0), (F.col("p_partkey") % 11 + 3).cast("double")
    ring = repaired(F.array(corner(0, 0), corner(a, 0), corner(a, 0), corner(a, b), corner(0, b), corner(0, 0)))
    window = F.array(corner(0, 0), corner(20, 0), corner(20, 8), corner(0, 8))
    shapes = evened(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select("p_partkey", ring.alias("ring"))
    middle = centroid(F.col("ring"))
    return shapes.select("p_partkey", F.round(area(clipped(F.col("ring"), window)), 6).alias("overlap"), F.round(area(F.col("ring")), 6).alias("area"), F.round(middle.x, 6).alias("cx"), F.round(middle.y, 6).alias("cy"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'served' WHEN c_nationkey < 20 THEN 'by nation' ELSE 'none' END AS method, CASE WHEN o_orderstatus = 'F' THEN 0.9::DOUBLE WHEN c_nationkey < 20 THEN 0.2::DOUBLE END AS confidence
FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def pending_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What no cache holds yet, resolved by a service, else by its area with little confidence, else not at all."""
    cached = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    pending = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("c_custkey")).join(cached, "o_orderkey", "left_anti")
    known = pending.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey", "left")
    served, area_known = F.col("o_orderstatus") == "F", F.col("c_nationkey") < 20
    return known.select("o_orderkey", F.when(served, "served").when(area_known, "by nation").otherwise("none").alias("method"), F.when(served, 0.9).when(area_known, 0.2).alias("confidence"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'old' END AS segment, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS version FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0
UNION ALL SELECT c_custkey, 'new', 3 FROM customer WHERE NOT (c_custkey % 3 = 0 OR c_custkey % 2 = 0)
""")
def load_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load, an upsert, and an append of keys not known before."""
    root = f"{checkpoint_dir(spark)}/lodeplane-modes-{uuid.uuid4().hex}"
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    first = load(customers.filter("c_custkey % 2 = 0").select("c_custkey", F.lit("old").alias("segment"), F.lit(1).alias("version")), root, "overwrite")
    second = load(customers.filter("c_custkey % 3 = 0").withColumn("version", F.lit(2)), first, "upsert", ["c_custkey"])
    third = load(customers.select("c_custkey", F.lit("new").alias("segment"), F.lit(3).alias("version")), second, "append_new", ["c_custkey"])
    return spark.read.parquet(third)


@query("""
SELECT p_partkey, p_type AS layer, CAST(p_size AS VARCHAR) AS label, CAST(p_partkey % 90 AS DOUBLE) AS lon, CAST(p_partkey % 40 AS DOUBLE) AS lat FROM part WHERE p_partkey % 90 BETWEEN 10 AND 50
""")
def feature_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections of features in JSON, one a layer and page of at most a thousand, exploded and filtered by a box."""
    k = F.col("p_partkey")
    feature = F.struct(F.struct(F.array((k % 90).cast("double"), (k % 40).cast("double")).alias("coordinates")).alias("geometry"), F.struct(k.alias("id"), F.col("p_size").cast("string").alias("label")).alias("properties"))
    pages = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("layer"), F.floor(k / 1000).alias("page")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("document"))
    kind = "struct<features: array<struct<geometry: struct<coordinates: array<double>>, properties: map<string, string>>>>"
    rows = pages.select("layer", F.explode(F.from_json("document", kind).features).alias("f"))
    at = F.col("f.geometry.coordinates")
    out = rows.select(F.col("f.properties")["id"].cast("long").alias("p_partkey"), "layer", F.col("f.properties")["label"].alias("label"), F.get(at, F.lit(0)).alias("lon"), F.get(at, F.lit(1)).alias("lat"))
    return out.filter(F.col("lon").between(10, 50))


@query("""
WITH f AS (SELECT c_custkey AS k, 'spend' AS kind, year(o_orderdate) AS year, max(o_totalprice) AS value, 0.9::DOUBLE AS confidence FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 3
  UNION ALL SELECT o_custkey, 'spend', year(o_orderdate), min(o_totalprice), CASE WHEN min(o_orderstatus) = 'F' THEN 0.95::DOUBLE ELSE 0.5::DOUBLE END FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 3)
SELECT k, kind, CAST(year AS BIGINT) AS year, value, confidence FROM (SELECT *, row_number() OVER (PARTITION BY k, kind, year ORDER BY confidence DESC, value DESC) AS rn FROM f) WHERE rn = 1
""")
def best_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of several kinds united; of one key, kind and year the most confident stays."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").cast("long").alias("year"), "o_totalprice", "o_orderstatus", "o_orderpriority")
    known = orders.join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), "k")
    a = known.groupBy("k", "year").agg(F.max("o_totalprice").alias("value")).withColumn("confidence", F.lit(0.9))
    b = orders.filter("o_orderpriority = '1-URGENT'").groupBy("k", "year").agg(F.min("o_totalprice").alias("value"), F.when(F.min("o_orderstatus") == "F", 0.95).otherwise(0.5).alias("confidence"))
    both = a.unionByName(b).withColumn("kind", F.lit("spend"))
    return newest_by(both, ["k", "kind", "year"], "confidence", "value").select("k", "kind", "year", "value", "confidence")
