"""Spatial joins. Points and shapes follow from keys by fixed arithmetic, which the oracles repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.functions.geo import area, mercator_sql, projected
from lodeplane.operators.spatial import density_clusters, nearest, points_in_polygons, polygons_at, slopes, within_distance, without_overlaps
from lodeplane.plans.base import query, table


def _points(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    k = F.col(key)
    return table(spark, sf_dir, name).select(k.alias("id"), (k * 7919 % 4000).cast("double").alias("x"), (k * 104729 % 4001).cast("double").alias("y"))


_SQL_POINTS = "(SELECT {key} AS id, CAST({key} * 7919 % 4000 AS DOUBLE) AS x, CAST({key} * 104729 % 4001 AS DOUBLE) AS y FROM {name})"
_CUSTOMERS, _SUPPLIERS = _SQL_POINTS.format(key="c_custkey", name="customer"), _SQL_POINTS.format(key="s_suppkey", name="supplier")


@query(f"SELECT a.id AS a, b.id AS b, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 3) AS d FROM {_CUSTOMERS} a, {_SUPPLIERS} b WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 150 * 150")
def within_distance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = within_distance(_points(spark, sf_dir, "customer", "c_custkey"), _points(spark, sf_dir, "supplier", "s_suppkey"), 150.0)
    return near.withColumn("d", F.round("d", 3))


@query(f"""
WITH RECURSIVE p AS {_CUSTOMERS}, e AS MATERIALIZED (SELECT a.id AS u, b.id AS v FROM p a, p b WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 40 * 40),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT u AS id, min(v) AS cluster FROM r GROUP BY 1
""")
def dbscan_eps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density clusters of customers' points, one point being enough for a cluster."""
    return density_clusters(_points(spark, sf_dir, "customer", "c_custkey"), 40.0).select("id", "cluster")


@query(f"""
WITH c AS {_CUSTOMERS}, z AS (SELECT p_partkey AS polygon, CAST(p_partkey * 7919 % 4000 AS DOUBLE) AS cx, CAST(p_partkey * 31 % 4000 AS DOUBLE) AS cy, 20.5 + p_size AS r FROM part)
SELECT id, polygon FROM c, z WHERE abs(x - cx) + abs(y - cy) < r
""")
def points_in_diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points inside four-cornered rings."""
    return points_in_polygons(_points(spark, sf_dir, "customer", "c_custkey"), _diamonds(spark, sf_dir), 64.0)


def _diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    cx, cy, r = (k * 7919 % 4000).cast("double"), (k * 31 % 4000).cast("double"), F.col("p_size") + 20.5
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return table(spark, sf_dir, "part").select(k.alias("polygon"), F.array(corner(cx - r, cy), corner(cx, cy - r), corner(cx + r, cy), corner(cx, cy + r)).alias("ring"))


def zones_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each point within `points_in_diamonds` how many it lies in and the first: rows (id, n, first)."""
    return polygons_at(_points(spark, sf_dir, "customer", "c_custkey"), _diamonds(spark, sf_dir), 64.0)


@query("SELECT p_partkey, round((p_size + 1.0) * (p_partkey % 7 + 1) / 2, 3) AS area FROM part")
def ring_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of right triangles by the shoelace formula."""
    k, a, b = F.col("p_partkey"), F.col("p_size") + F.lit(1.0), (F.col("p_partkey") % 7 + 1).cast("double")
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x0 = (k % 100).cast("double")
    return table(spark, sf_dir, "part").select("p_partkey", F.round(area(F.array(corner(x0, x0), corner(x0 + a, x0), corner(x0, x0 + b))), 3).alias("area"))


#: For each mode its weight and the metres in which its worth falls to a third.
DECAYS = ((0.5, 800.0), (0.3, 350.0), (0.2, 5000.0))


@query(f"""
WITH c AS {_CUSTOMERS}, s AS {_SUPPLIERS}, n AS (SELECT c.id, s.id % 3 AS mode, min(sqrt((c.x - s.x) ** 2 + (c.y - s.y) ** 2)) AS d FROM c, s GROUP BY 1, 2)
SELECT id, round(sum(CASE mode WHEN 0 THEN 0.5 * exp(-d / 800) WHEN 1 THEN 0.3 * exp(-d / 350) ELSE 0.2 * exp(-d / 5000) END), 6) AS score FROM n GROUP BY 1
""")
def knn_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest target of each of three modes, with decaying weights."""
    points = _points(spark, sf_dir, "customer", "c_custkey")
    targets = _points(spark, sf_dir, "supplier", "s_suppkey").withColumnRenamed("id", "target").withColumn("mode", F.col("target") % 3)
    near = nearest(points, targets, 300.0, by="mode")
    of = lambda m, w, reach: F.sum(F.when(F.col("mode") == m, F.exp(-F.coalesce("d", F.lit(99_999.0)) / reach) * w)).alias(f"m{m}")
    by_mode = near.groupBy("id").agg(*[of(m, *x) for m, x in enumerate(DECAYS)])
    return by_mode.select("id", F.round(F.col("m0") + F.col("m1") + F.col("m2"), 6).alias("score"))


_BOX = "CAST(p_partkey * 37 % 400 AS DOUBLE) AS x0, CAST(p_partkey * 91 % 401 AS DOUBLE) AS y0, CAST(p_partkey * 37 % 400 + 12 + p_partkey % 9 AS DOUBLE) AS x1, CAST(p_partkey * 91 % 401 + 14 + p_partkey % 6 AS DOUBLE) AS y1"


@query(f"""
WITH b AS (SELECT p_partkey AS id, p_type AS area, {_BOX} FROM part), p AS (SELECT * FROM b WHERE id % 2 = 0), s AS (SELECT * FROM b WHERE id % 2 = 1)
SELECT id, area FROM p UNION ALL SELECT id, area FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.area = s.area AND
  greatest(least(p.x1, s.x1) - greatest(p.x0, s.x0), 0) * greatest(least(p.y1, s.y1) - greatest(p.y0, s.y0), 0) >= 0.5 * (s.x1 - s.x0) * (s.y1 - s.y0))
""")
def overlap_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secondary boxes that a primary one of the same area covers by half go."""
    boxes = table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_type AS area", *_BOX.split(", "))
    return without_overlaps(boxes.filter("id % 2 = 0"), boxes.filter("id % 2 = 1"), "area", 20.0).select("id", "area")


_LON, _LAT = "(-9.5 + c_custkey % 300 / 100.0)", "(37.0 + c_custkey % 500 / 100.0)"


@query(f"SELECT c_custkey, round({mercator_sql(_LON, _LAT)[0]}, 2) AS x, round({mercator_sql(_LON, _LAT)[1]}, 2) AS y FROM customer")
def projected_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longitude and latitude to the national grid."""
    x, y = projected("CAST((-9.5 + c_custkey % 300 / 100.0) AS DOUBLE)", "CAST((37.0 + c_custkey % 500 / 100.0) AS DOUBLE)")
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(x, 2).alias("x"), F.round(y, 2).alias("y"))


@query(f"""
WITH c AS {_CUSTOMERS}, s AS {_SUPPLIERS}, z AS (SELECT p_partkey AS polygon, CAST(p_partkey * 7919 % 4000 AS DOUBLE) AS cx, CAST(p_partkey * 31 % 4000 AS DOUBLE) AS cy, 20.5 + p_size AS r FROM part),
i AS (SELECT id, count(*) AS n_zones, min(polygon) AS first_zone FROM c, z WHERE abs(x - cx) + abs(y - cy) < r GROUP BY 1), n AS (SELECT c.id, count(*) AS n_near, min(s.id) AS first_near FROM c, s WHERE (c.x - s.x) ** 2 + (c.y - s.y) ** 2 <= 150 * 150 GROUP BY 1)
SELECT c.id, coalesce(n_zones, 0) AS n_zones, first_zone, coalesce(n_near, 0) AS n_near, first_near FROM c LEFT JOIN i ON c.id = i.id LEFT JOIN n ON c.id = n.id
""")
def site_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What zones a site lies in and what is near it, in one row."""
    zones = zones_of(spark, sf_dir).select("id", F.col("n").alias("n_zones"), F.col("first").alias("first_zone"))
    near = within_distance_pairs(spark, sf_dir).groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n_near"), F.min("b").alias("first_near"))
    sites = _points(spark, sf_dir, "customer", "c_custkey").select("id")
    return sites.join(zones, "id", "left").join(near, "id", "left").fillna(0, ["n_zones", "n_near"])


@query(f"""
WITH c AS {_CUSTOMERS}, z AS (SELECT p_partkey AS polygon, CAST(p_partkey * 7919 % 4000 AS DOUBLE) AS cx, CAST(p_partkey * 31 % 4000 AS DOUBLE) AS cy, 20.5 + p_size AS r FROM part)
SELECT id, min(polygon) AS polygon FROM c, z WHERE abs(x - cx) + abs(y - cy) < r GROUP BY 1
""")
def first_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lateral look-up with a limit of one, with a stated order."""
    return zones_of(spark, sf_dir).select("id", F.col("first").alias("polygon"))


@query("""
WITH g AS (SELECT p_partkey // 100 AS tile, p_partkey % 100 // 10 AS r, p_partkey % 10 AS c, p_size AS z FROM part),
n AS (SELECT a.tile, a.r, a.c, count(*) AS n, sum((a.c - b.c) * CASE WHEN a.r = b.r THEN 2 ELSE 1 END * b.z) AS gx, sum((a.r - b.r) * CASE WHEN a.c = b.c THEN 2 ELSE 1 END * b.z) AS gy
  FROM g a JOIN g b ON a.tile = b.tile AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND (a.r <> b.r OR a.c <> b.c) GROUP BY 1, 2, 3)
SELECT tile, r AS row, c AS col, CASE WHEN n = 8 THEN round(degrees(atan(sqrt(CAST(gx * gx + gy * gy AS DOUBLE)) / 16)), 6) END AS slope FROM n
""")
def terrain_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slopes of tiles of a raster that are kept as rows."""
    k = F.col("p_partkey")
    grid = table(spark, sf_dir, "part").select(F.floor(k / 100).cast("long").alias("tile"), F.floor(k % 100 / 10).cast("long").alias("row"), (k % 10).alias("col"), F.col("p_size").alias("z"))
    return slopes(grid, 2.0).select("tile", "row", "col", F.round("slope", 6).alias("slope"))
