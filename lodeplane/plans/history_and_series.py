"""Versioned history, merges, life cycles; time series and weighted figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.operators.history import incremental_merge, lifecycle, scd2_apply, stable_ids
from lodeplane.operators.series import calendar, change_rates, weighted_mean
from lodeplane.plans.base import query, table

_START, _FIRST, _END = "1900-01-01", "2024-01-30", "2100-01-01"
_SECOND = "2024-02-01"


def _load(spark: SparkSession, sf_dir: str, low: str, high: str) -> DataFrame:
    """What each user last did before a day, or from it on: a load of one row a key."""
    events = table(spark, sf_dir, "events").filter(f"ts >= TIMESTAMP_NTZ '{low}' AND ts < TIMESTAMP_NTZ '{high}'")
    last = events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("x"))
    return last.select("user_id", F.md5(F.col("x.event_type").cast("binary")).alias("h"), F.col("x.event_type").alias("state"))


_LOAD = "(SELECT user_id, md5(event_type) AS h, event_type AS state FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE ts >= TIMESTAMP '%s' AND ts < TIMESTAMP '%s') WHERE rn = 1)"


@query(f"""
WITH a AS {_LOAD % (_START, _FIRST)}, b AS {_LOAD % (_FIRST, _END)}
SELECT a.user_id, a.state, DATE '{_FIRST}' AS valid_from, CASE WHEN b.user_id IS NULL OR a.h <> b.h THEN DATE '{_SECOND}' END AS valid_to FROM a LEFT JOIN b ON a.user_id = b.user_id
UNION ALL SELECT b.user_id, b.state, DATE '{_SECOND}', NULL FROM b LEFT JOIN a ON a.user_id = b.user_id WHERE a.user_id IS NULL OR a.h <> b.h
""")
def scd2_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads applied to an empty history; absent keys close."""
    empty = spark.createDataFrame([], "user_id long, h string, state string, valid_from date, valid_to date")
    day = lambda x: F.lit(x).cast("date")
    first = scd2_apply(empty, _load(spark, sf_dir, _START, _FIRST), "user_id", "h", day(_FIRST))
    return scd2_apply(first, _load(spark, sf_dir, _FIRST, _END), "user_id", "h", day(_SECOND)).drop("h")


@query(f"""
WITH a AS {_LOAD % (_START, _FIRST)}, b AS {_LOAD % (_FIRST, _END)}, s AS (SELECT user_id, max(ts) AS last_seen FROM events WHERE ts < TIMESTAMP '{_SECOND}' GROUP BY 1)
SELECT a.user_id, a.state, DATE '{_FIRST}' AS valid_from, CASE WHEN b.user_id IS NULL AND date_diff('day', CAST(last_seen AS DATE), DATE '{_SECOND}') > 3 OR a.h <> b.h THEN DATE '{_SECOND}' END AS valid_to
FROM a LEFT JOIN b ON a.user_id = b.user_id LEFT JOIN s ON a.user_id = s.user_id
UNION ALL SELECT b.user_id, b.state, DATE '{_SECOND}', NULL FROM b LEFT JOIN a ON a.user_id = b.user_id WHERE a.user_id IS NULL OR a.h <> b.h
""")
def scd2_heartbeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, but absent keys close only when their heartbeat is old."""
    empty = spark.createDataFrame([], "user_id long, h string, state string, valid_from date, valid_to date")
    day = lambda x: F.lit(x).cast("date")
    first = scd2_apply(empty, _load(spark, sf_dir, _START, _FIRST), "user_id", "h", day(_FIRST))
    seen = table(spark, sf_dir, "events").filter(f"ts < TIMESTAMP_NTZ '{_SECOND}'").groupBy("user_id").agg(F.max("ts").alias("last_seen"))
    return scd2_apply(first, _load(spark, sf_dir, _FIRST, _END), "user_id", "h", day(_SECOND), seen, 3).drop("h")


@query("""
WITH a AS (SELECT o_custkey AS k, min(o_orderstatus) AS status, max(o_totalprice) AS price, CAST(max(o_orderdate) AS DATE) AS seen FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
b AS (SELECT o_custkey AS k, min(o_orderstatus) AS status, max(o_totalprice) AS price, CAST(max(o_orderdate) AS DATE) AS seen FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(b.status, a.status) AS status, coalesce(b.price, a.price) AS price, coalesce(a.price, b.price) AS initial_price, coalesce(a.seen, b.seen) AS first_seen, coalesce(b.seen, a.seen) AS last_seen,
  CAST(CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL AND a.price <> b.price THEN 1 ELSE 0 END AS BIGINT) AS price_changes FROM a FULL OUTER JOIN b ON a.k = b.k
""")
def merge_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")

    def load(where: str) -> DataFrame:
        return orders.filter(where).groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderstatus").alias("status"), F.max("o_totalprice").alias("price"), F.to_date(F.max("o_orderdate")).alias("seen"))

    empty = spark.createDataFrame([], "k long, status string, price double, initial_price double, first_seen date, last_seen date, price_changes long")
    first = incremental_merge(empty, load("o_orderdate < TIMESTAMP_NTZ '1998-01-01'"), "k", ["status"], "price")
    return incremental_merge(first, load("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'"), "k", ["status"], "price")


@query("""
SELECT user_id, CAST(min(ts) FILTER (WHERE event_type <> 'error') AS TIMESTAMP) AS first_seen, max(ts) AS last_seen, max(ts) >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY AS active FROM events GROUP BY 1
""")
def lifecycle_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle(table(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type") == "error")


@query("""
WITH k AS (SELECT p_partkey AS id, p_partkey * 10 AS uid FROM part WHERE p_partkey % 7 = 0), m AS (SELECT p_partkey AS id, p_name AS grp FROM part),
l AS (SELECT grp, min(uid) AS u, min(id) AS i FROM m LEFT JOIN k USING (id) GROUP BY 1)
SELECT m.id, coalesce(k.uid, l.u, l.i) AS uid FROM m LEFT JOIN k ON m.id = k.id JOIN l ON m.grp = l.grp
""")
def stable_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("grp"))
    return stable_ids(part.filter("id % 7 = 0").select("id", (F.col("id") * 10).alias("uid")), part, "id", "grp")


@query("""
WITH m AS (SELECT o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2)
SELECT series, month, value, round((value - lag(value, 1) OVER w) / nullif(abs(lag(value, 1) OVER w), 0) * 100, 4) AS mom, round((value - lag(value, 3) OVER w) / nullif(abs(lag(value, 3) OVER w), 0) * 100, 4) AS qoq,
  round((value - lag(value, 12) OVER w) / nullif(abs(lag(value, 12) OVER w), 0) * 100, 4) AS yoy FROM m WINDOW w AS (PARTITION BY series ORDER BY month)
""")
def monthly_change_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes over 1, 3 and 12 rows of each series."""
    month = F.to_date(F.date_trunc("month", "o_orderdate"))
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("series"), month.alias("month")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
    return change_rates(rows, ["series"], "month", "value", {"mom": 1, "qoq": 3, "yoy": 12})


@query("""
SELECT CAST(d AS DATE) AS day, year(d) AS year, month(d) AS month, quarter(d) AS quarter, weekofyear(d) AS iso_week, isodow(d) AS iso_weekday, year(d) || 'Q' || quarter(d) AS label, isodow(d) >= 6 AS weekend
FROM (SELECT unnest(generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS d)
""")
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the span that the orders cover."""
    bounds = table(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    out = calendar(bounds, "a", "b")
    return out.select("day", *[F.col(c).cast("long").alias(c) for c in ("year", "month", "quarter", "iso_week", "iso_weekday")], "label", "weekend")


@query("""
SELECT l_suppkey, round(CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER) END) AS DOUBLE) /
  nullif(CAST(sum(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END) AS DOUBLE), 0), 4) AS mean_price, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_parts,
  round(CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / count(*) * 100, 2) AS return_rate FROM lineitem GROUP BY 1
""")
def weighted_and_ratio_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weighted mean that leaves nulls out of both sums, a conditional distinct count, a guarded ratio."""
    back = F.col("l_returnflag") == "R"
    value, weight = F.when(~back, F.col("l_extendedprice").cast("decimal(18,2)")), F.col("l_quantity").cast("int")
    mean = F.sum(value * weight).cast("double") / F.nullif(F.sum(F.when(value.isNotNull(), weight)).cast("double"), F.lit(0.0))
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.round(mean, 4).alias("mean_price"), F.count_distinct(F.when(back, F.col("l_partkey"))).alias("returned_parts"), F.round(F.count_if(back).cast("double") / F.count("*") * 100, 2).alias("return_rate")
    )


@query("""
SELECT n_name, CAST(sum(w * m) / nullif(sum(CASE WHEN m IS NOT NULL THEN w END), 0) AS DOUBLE) AS mean_mid FROM (
  SELECT n_name, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN 500.0::DOUBLE WHEN c_acctbal < 5000 THEN 3000.0::DOUBLE ELSE 7500.0::DOUBLE END AS m, 1 + c_custkey % 3 AS w FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1
""")
def band_midpoint_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mean from the midpoints of bands."""
    b = F.col("c_acctbal")
    mid = F.when(b < 0, F.lit(None)).when(b < 1000, 500.0).when(b < 5000, 3000.0).otherwise(7500.0)
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy("n_name").agg(weighted_mean(mid, 1 + F.col("c_custkey") % 3).alias("mean_mid"))
