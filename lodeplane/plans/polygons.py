"""Overlays and repair of concave polygons with holes, and coordinates turned between reference systems and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.functions.geo import DEGREES, GRID, degrees_sql, is_simple, mercator_sql, same_system, transformed
from lodeplane.functions.overlay import made_valid, overlay, rings_area
from lodeplane.operators.spatial import polygon_overlaps, without_polygon_overlaps
from lodeplane.plans.base import query, table
from lodeplane.session import spread


def _ring(*corners: tuple[Column | float, Column | float]) -> Column:
    number = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("double")
    return F.array(*[F.struct(number(x).alias("x"), number(y).alias("y")) for x, y in corners])


def _notched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares without their upper right corner and with a hole."""
    k = F.col("p_partkey")
    x, y, s = k * 37 % 400, k * 91 % 401, 12 + k % 9
    outer = _ring((x, y), (x + s, y), (x + s, y + s - 4), (x + s - 4, y + s - 4), (x + s - 4, y + s), (x, y + s))
    hole = _ring((x + 3, y + 3), (x + 7, y + 3), (x + 7, y + 7), (x + 3, y + 7))
    return spread(table(spark, sf_dir, "part")).select(k.alias("id"), F.col("p_type").alias("area"), F.array(outer, hole).alias("rings"))


#: The same as signed boxes: the square, less its hole, less its corner. They nest or are apart, so that their overlaps' signed sum is the shapes' overlap.
_SHARED = """
k AS (SELECT p_partkey AS id, p_type AS area, p_partkey * 37 % 400 AS x, p_partkey * 91 % 401 AS y, 12 + p_partkey % 9 AS s FROM part),
b AS (SELECT id, area, 1 AS g, x AS x0, y AS y0, x + s AS x1, y + s AS y1 FROM k UNION ALL SELECT id, area, -1, x + 3, y + 3, x + 7, y + 7 FROM k
  UNION ALL SELECT id, area, -1, x + s - 4, y + s - 4, x + s, y + s FROM k),
o AS (SELECT p.id AS l_id, s.id AS r_id, sum(p.g * s.g * greatest(least(p.x1, s.x1) - greatest(p.x0, s.x0), 0) * greatest(least(p.y1, s.y1) - greatest(p.y0, s.y0), 0)) AS shared
  FROM b p JOIN b s ON p.area = s.area AND p.id % 2 = 0 AND s.id % 2 = 1 GROUP BY 1, 2)
"""


@query(f"WITH {_SHARED} SELECT l_id, r_id, shared::DOUBLE AS shared, (s * s - 32)::DOUBLE AS own FROM o JOIN k ON k.id = r_id WHERE shared > 0")
def polygon_overlap_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each odd shape each even one of its area covers."""
    shapes = _notched(spark, sf_dir)
    found = polygon_overlaps(shapes.filter("id % 2 = 0"), shapes.filter("id % 2 = 1"), "area", 24.0)
    return found.select("l_id", "r_id", F.round("shared", 6).alias("shared"), F.round("own", 6).alias("own"))


@query(f"""
WITH {_SHARED} SELECT id, area FROM k WHERE id % 2 = 0 UNION ALL
SELECT id, area FROM k WHERE id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM o WHERE r_id = k.id AND shared >= 0.25 * (s * s - 32))
""")
def polygon_overlap_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd shapes that a single even one of the same area covers by a quarter go; concave shapes with holes, overlaid exactly."""
    shapes = _notched(spark, sf_dir)
    return without_polygon_overlaps(shapes.filter("id % 2 = 0"), shapes.filter("id % 2 = 1"), "area", 24.0, 0.25).select("id", "area")


@query(f"""
WITH {_SHARED}, t AS (SELECT l.id AS l_id, r.id AS r_id, l.s * l.s - 32 AS own_l, r.s * r.s - 32 AS own_r FROM k l JOIN k r ON r.id = l.id + 1 WHERE l.id % 2 = 0),
m AS (SELECT p.id AS l_id, s.id AS r_id, sum(p.g * s.g * greatest(least(p.x1, s.x1 + d) - greatest(p.x0, s.x0 + d), 0) * greatest(least(p.y1, s.y1 + e) - greatest(p.y0, s.y0 + e), 0)) AS shared
  FROM b p JOIN b s ON s.id = p.id + 1 AND p.id % 2 = 0 JOIN (SELECT l.id AS i, l.x - r.x + l.id % 5 AS d, l.y - r.y + l.id % 3 AS e FROM k l JOIN k r ON r.id = l.id + 1) z ON z.i = p.id GROUP BY 1, 2)
SELECT l_id, shared::DOUBLE AS shared, (own_l + own_r - shared)::DOUBLE AS joined, (own_l - shared)::DOUBLE AS left_over, (own_l + own_r - 2 * shared)::DOUBLE AS either FROM t JOIN m USING (l_id, r_id)
""")
def polygon_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection, union, difference and symmetric difference of each even shape and the next one moved onto it."""
    shapes = _notched(spark, sf_dir)
    corner = lambda c: F.element_at(F.element_at(c, 1), 1)
    left = shapes.filter("id % 2 = 0").select(F.col("id").alias("l_id"), F.col("rings").alias("l"))
    right = shapes.select((F.col("id") - 1).alias("l_id"), F.col("rings").alias("r"))
    both = left.join(right, "l_id")
    dx, dy = corner(F.col("l")).x - corner(F.col("r")).x + F.col("l_id") % 5, corner(F.col("l")).y - corner(F.col("r")).y + F.col("l_id") % 3
    moved = F.transform("r", lambda ring: F.transform(ring, lambda p: F.struct((p.x + dx).alias("x"), (p.y + dy).alias("y"))))
    both = both.withColumn("r", moved)
    of = lambda how: F.round(rings_area(overlay(F.col("l"), F.col("r"), how)), 6)
    return both.select("l_id", of("intersection").alias("shared"), of("union").alias("joined"), of("difference").alias("left_over"), of("symmetric_difference").alias("either"))


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 2 ELSE 1 END AS n_rings, TRUE AS all_simple,
  CASE p_partkey % 4 WHEN 0 THEN a * b / 2 WHEN 1 THEN a * b WHEN 2 THEN a * b ELSE a * b * 0.75 END AS area FROM (SELECT p_partkey, (p_size + 1) * 4.0 AS a, (p_partkey % 7 + 2) * 4.0 AS b FROM part)
""")
def repaired_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bow-ties, spikes, sides that run back over each other and a part that is counted twice, made valid with the same even-odd area."""
    k = F.col("p_partkey")
    a, b, none = (F.col("p_size") + 1) * 4, (k % 7 + 2) * 4, F.lit(0)
    bow = F.array(_ring((none, none), (a, b), (a, none), (none, b)))
    spike = F.array(_ring((none, none), (a, none), (a, b), (a * 2, b), (a, b), (none, b), (none, none)))
    back = F.array(_ring((none, none), (none, none), (a / 2, none), (a, none), (a / 4, none), (a, none), (a, b), (none, b)))
    twice = F.array(_ring((none, none), (a, none), (a, b), (none, b)), _ring((a / 2, b / 2), (a, b / 2), (a, b), (a / 2, b)))
    shapes = spread(table(spark, sf_dir, "part")).select("p_partkey", made_valid(F.when(k % 4 == 0, bow).when(k % 4 == 1, spike).when(k % 4 == 2, back).otherwise(twice)).alias("rings"))
    return shapes.select("p_partkey", F.size("rings").alias("n_rings"), F.forall("rings", is_simple).alias("all_simple"), F.round(rings_area(F.col("rings")), 6).alias("area"))


_LON, _LAT = "(-9.5 + c_custkey % 300 / 100.0)", "(37.0 + c_custkey % 500 / 100.0)"
_X, _Y = "CAST(c_custkey * 7919 % 300000 - 150000 AS DOUBLE)", "CAST(c_custkey * 104729 % 550000 - 300000 AS DOUBLE)"


@query(f"""
SELECT c_custkey, 4326 AS srid, round({degrees_sql(_X, _Y)[0]}, 8) AS lon, round({degrees_sql(_X, _Y)[1]}, 8) AS lat,
  round({mercator_sql(_LON, _LAT)[0]}, 2) AS x, round({mercator_sql(_LON, _LAT)[1]}, 2) AS y, TRUE AS there_and_back FROM customer
""")
def reprojected_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid places to degrees, degrees to grid places, and whether what goes there and back is less than a millimetre off. All points know their system."""
    point = lambda srid, x, y: F.struct(F.lit(srid).alias("srid"), F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", point(GRID, _X, _Y).alias("a"), point(DEGREES, _LON, _LAT).alias("b"), point(GRID, _X, _Y).alias("start"))
    rows = transformed(transformed(rows, "a", DEGREES), "b", GRID).withColumn("back", F.col("a"))
    rows = transformed(rows, "back", GRID)
    off = F.hypot(F.col("back.x") - F.col("start.x"), F.col("back.y") - F.col("start.y"))
    checked = F.when(same_system(F.col("back"), F.col("start"), F.col("b")) == GRID, off < 0.001)
    return rows.select(
        "c_custkey", F.col("a.srid").alias("srid"), F.round("a.x", 8).alias("lon"), F.round("a.y", 8).alias("lat"), F.round("b.x", 2).alias("x"), F.round("b.y", 2).alias("y"), checked.alias("there_and_back")
    )
