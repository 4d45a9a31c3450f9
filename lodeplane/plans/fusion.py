"""Layers of constraints with severities and the rules of their places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.operators.fusion import fused
from lodeplane.plans.base import query, table

_SEVERITIES = (
    ("ORD1", "F", 3, "prohibited", True), ("ORD1", "O", 2, "conditional", False), ("ORD2", "F", 2, "conditional", False), ("ORD5", "P", 1, "notice", False),
    ("M1", "big", 3, "prohibited", True), ("M1", "small", 1, "notice", False), ("M4", "big", 2, "conditional", False), ("SEG-A", "debt", 3, "prohibited", True), ("SEG-B", "plain", 1, "notice", False),
)
_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(f"""
WITH f AS (
  SELECT 'orders ' || substring(o_orderpriority, 1, 1) AS layer, o_orderkey AS feature, 'ORD' || substring(o_orderpriority, 1, 1) AS code, o_orderstatus AS zone,
    CASE WHEN o_custkey % 11 > 0 THEN 'Nation ' || o_custkey % 25 || ', nation ' || o_custkey % 7 || ',Atlantis' END AS places, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderpriority IN {_PRIORITIES}
  UNION ALL SELECT 'parts ' || make, p_partkey, 'M' || make, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END, ' NATION ' || p_partkey % 25 || ' ', p_size || '-01-01' FROM (SELECT *, CASE WHEN substring(p_brand, 7, 1) IN ('1', '2', '3', '4') THEN substring(p_brand, 7, 1) ELSE '5' END AS make FROM part)
  UNION ALL SELECT lower(c_mktsegment), c_custkey, 'SEG-' || left(c_mktsegment, 1), CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'plain' END, 'nation ' || c_nationkey, NULL FROM customer WHERE c_mktsegment IN {_SEGMENTS}),
u AS (SELECT *, CASE WHEN regexp_matches(day, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST(day[1:10] AS DATE) END AS dated FROM f),
g AS (SELECT n_nationkey AS place, 'Nation ' || n_nationkey AS name FROM nation),
x AS (SELECT DISTINCT places, place, name FROM (SELECT DISTINCT places, upper(trim(unnest(string_split(places, ',')))) AS n FROM u) JOIN g ON upper(name) = n),
z AS (SELECT places, list(place ORDER BY place) AS ids, string_agg(name, ',' ORDER BY place) AS place_names FROM x GROUP BY 1),
r AS (SELECT s_suppkey AS rule, s_nationkey AS place, ['ORD' || (s_suppkey % 5 + 1), 'M' || (s_suppkey % 3 + 1), CASE WHEN s_acctbal > 5000 THEN 'SEG-A' ELSE 'SEG-B' END] AS patterns,
  CASE s_suppkey % 3 WHEN 1 THEN ['F', 'big', 'debt'] WHEN 2 THEN ['O', 'small', 'plain'] END AS zones, 'Art. ' || s_suppkey % 9 AS article, CASE WHEN s_acctbal < 0 THEN 'ban' ELSE 'limit' END AS kind FROM supplier),
v(code, zone, severity, label, is_gate) AS (VALUES {", ".join(map(str, _SEVERITIES))}),
s AS (SELECT DISTINCT u.places, code, zone FROM u),
m AS (SELECT s.places, s.code, s.zone, string_agg(CAST(rule AS VARCHAR), ',' ORDER BY rule) AS rules, count(*) AS n_rules, list_sort(list_distinct(list(article))) AS articles, list_sort(list_distinct(list(kind))) AS kinds
  FROM s JOIN z ON s.places = z.places JOIN r ON list_contains(z.ids, r.place) AND list_contains(r.patterns, s.code) AND (r.zones IS NULL OR list_contains(r.zones, s.zone)) GROUP BY 1, 2, 3)
SELECT u.layer, u.feature, u.code, u.zone, u.dated AS day, coalesce(array_to_string(z.ids, ','), '') AS place_ids, coalesce(z.place_names, '') AS place_names, m.rules, coalesce(m.n_rules, 0) AS n_rules,
  array_to_string(m.articles, ',') AS articles, array_to_string(m.kinds, ',') AS kinds, v.severity, v.label, v.is_gate
FROM u LEFT JOIN z ON u.places = z.places LEFT JOIN m ON u.places = m.places AND u.code = m.code AND u.zone = m.zone LEFT JOIN v ON u.code = v.code AND u.zone = v.zone
""")
def fused_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen layers under one contract: lists of places resolved, severities by code and zone, and lists of the rules of any of their places."""
    orders, part, customer = (table(spark, sf_dir, name) for name in ("orders", "part", "customer"))
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    k = F.col("o_custkey")
    listed = F.when(k % 11 > 0, say("Nation ", k % 25, ", nation ", k % 7, ",Atlantis"))
    layers = {}
    for name in _PRIORITIES:
        rows = orders.filter(F.col("o_orderpriority") == name)
        layers[f"orders {name[0]}"] = rows.select(F.col("o_orderkey").alias("feature"), F.lit(f"ORD{name[0]}").alias("code"), F.col("o_orderstatus").alias("zone"), listed.alias("places"), F.to_date("o_orderdate").alias("day"))
    for i in "12345":
        make = F.substring("p_brand", 7, 1)
        rows = part.filter(F.when(make.isin("1", "2", "3", "4"), make).otherwise("5") == i)
        zone, place = F.when(F.col("p_size") > 25, "big").otherwise("small"), say(" NATION ", F.col("p_partkey") % 25, " ")
        layers[f"parts {i}"] = rows.select(F.col("p_partkey").alias("feature"), F.lit(f"M{i}").alias("code"), zone.alias("zone"), place.alias("places"), say(F.col("p_size"), "-01-01").alias("day"))
    for name in _SEGMENTS:
        rows = customer.filter(F.col("c_mktsegment") == name)
        zone = F.when(F.col("c_acctbal") < 0, "debt").otherwise("plain")
        layers[name.lower()] = rows.select(F.col("c_custkey").alias("feature"), F.lit(f"SEG-{name[0]}").alias("code"), zone.alias("zone"), say("nation ", F.col("c_nationkey")).alias("places"), F.lit(None).cast("string").alias("day"))
    places = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("place"), say("Nation ", F.col("n_nationkey")).alias("name"))
    s, balance = F.col("s_suppkey"), F.col("s_acctbal")
    patterns = F.array(say("ORD", s % 5 + 1), say("M", s % 3 + 1), F.when(balance > 5000, "SEG-A").otherwise("SEG-B"))
    zones = F.when(s % 3 == 1, F.array(*map(F.lit, ("F", "big", "debt")))).when(s % 3 == 2, F.array(*map(F.lit, ("O", "small", "plain"))))
    rules = table(spark, sf_dir, "supplier").select(s.alias("rule"), F.col("s_nationkey").alias("place"), patterns.alias("patterns"), zones.alias("zones"), say("Art. ", s % 9).alias("article"), F.when(balance < 0, "ban").otherwise("limit").alias("kind"))
    severities = spark.createDataFrame(_SEVERITIES, "code string, zone string, severity int, label string, is_gate boolean")
    out = fused(layers, places, severities, rules)
    line = lambda c: F.array_join(c, ",").alias(c)
    names = F.array_join("place_labels", ",").alias("place_names")
    return out.select("layer", "feature", "code", "zone", "day", line("place_ids"), names, line("rules"), "n_rules", line("articles"), line("kinds"), "severity", "label", "is_gate")
