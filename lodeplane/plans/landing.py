"""Landing files: bad lines, the newest file, reads from a high-water mark, gates of row counts, updates after a load, details carried on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeplane.functions.text import snake_columns
from lodeplane.plans.base import query, table
from lodeplane.session import checkpoint_dir
from lodeplane.sources.drifting import read_drifting
from lodeplane.sources.files import append_after, carried_forward, read_json_lines, read_newest
from lodeplane.sources.sinks import load, row_gate, updated


def _folder(spark: SparkSession, what: str) -> str:
    return f"{checkpoint_dir(spark)}/lodeplane-{what}-{uuid.uuid4().hex}"


@query("""
SELECT event_type, count(*) FILTER (WHERE event_id % 7 <> 0) AS n_good, CAST(sum(event_id) FILTER (WHERE event_id % 7 <> 0) AS BIGINT) AS ids, (SELECT count(*) FROM events WHERE event_id % 7 = 0) AS n_bad FROM events GROUP BY 1
""")
def json_lines_with_bad_ones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as lines of JSON, some of them cut off; those are skipped and counted."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    line = F.to_json(F.struct("event_id", "event_type"))
    path = _folder(spark, "lines")
    events.select(F.when(F.col("event_id") % 7 == 0, F.left(line, F.length(line) - 3)).otherwise(line).alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    good, bad = read_json_lines(spark, path, schema)
    counts = good.groupBy("event_type").agg(F.count("*").alias("n_good"), F.sum("event_id").alias("ids"))
    return counts.crossJoin(F.broadcast(bad.agg(F.count("*").alias("n_bad"))))  # one row


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def newest_landing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of loads named by year the last one, in as many files as it has."""
    path = _folder(spark, "years")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    orders.write.option("maxRecordsPerFile", 500).partitionBy("year").parquet(path)
    return read_newest(spark, path, "parquet", "o_orderkey long, o_totalprice double")


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')
""")
def high_water_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What came since the stored rows, the last stored day again."""
    path = _folder(spark, "water")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    load(orders.filter("day < DATE '1999-01-01'"), path, "overwrite")
    return append_after(orders, path, "day")


@query("""
SELECT 'events' AS name, (SELECT count(*) FROM events) AS n_rows, 1::BIGINT AS floor, NULL::BIGINT AS ceiling, TRUE AS passes UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), 25, 25, TRUE
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), NULL, 10, (SELECT count(*) FROM orders) <= 10 UNION ALL SELECT 'region', (SELECT count(*) FROM region), 6, NULL, FALSE
""")
def row_count_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of rows held against floors and ceilings."""
    bands = {"events": (1, None), "nation": (25, 25), "orders": (None, 10), "region": (6, None)}
    return row_gate({n: (table(spark, sf_dir, n), low, high) for n, (low, high) in bands.items()})


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'overdrawn' ELSE c_mktsegment END AS segment, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS balance FROM customer")
def update_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, then columns set where a condition holds."""
    root = load(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")), _folder(spark, "update"), "overwrite")
    return spark.read.parquet(updated(root, spark, F.col("balance") < 0, {"segment": F.lit("overdrawn"), "balance": F.lit(0.0)}))


@query("""
WITH k AS (SELECT o_custkey AS k, max(o_orderdate) AS seen, max(o_totalprice) AS price FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1),
f AS (SELECT o_custkey AS k, max(o_orderdate) AS seen, max(o_totalprice) AS price FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1)
SELECT k, price, FALSE AS carried FROM f UNION ALL SELECT k, price, TRUE FROM k WHERE k NOT IN (SELECT k FROM f) AND seen >= TIMESTAMP '2000-01-01'
""")
def details_carried_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details read again, and those of other keys carried on while they aren't too old."""
    orders = table(spark, sf_dir, "orders")

    def details(where: str) -> DataFrame:
        return orders.filter(where).groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderdate").alias("seen"), F.max("o_totalprice").alias("price"))

    known, fresh = details("o_orderdate < TIMESTAMP_NTZ '2001-01-01'"), details("o_orderdate >= TIMESTAMP_NTZ '2001-01-01'")
    return carried_forward(known, fresh, ["k"], "seen", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")).select("k", "price", "carried")


@query("SELECT event_id, user_id AS app_user_id, event_type AS kind_of_event FROM events")
def snake_named_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in camel case as columns in snake case."""
    return snake_columns(table(spark, sf_dir, "events").select(F.col("event_id").alias("eventId"), F.col("user_id").alias("appUserId"), F.col("event_type").alias("Kind ofEvent")))


@query("""
SELECT p_partkey AS code, p_name AS title, CASE WHEN p_size % 3 = 2 THEN NULL ELSE p_size END AS places, p_retailprice AS price, p_size % 3 AS year FROM part
""")
def drifting_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that came in files of three layouts: headers in other rows, columns shifted, renamed, missing or in another order, notes between rows."""
    path = _folder(spark, "drift")
    k, part = F.col("p_partkey"), table(spark, sf_dir, "part")
    price = F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(","))
    layouts = [
        ("Report of the year;;;\n\nCode;Title;Places;Price\n(1);(2);(3);(4)\n", F.concat_ws(";", k, "p_name", "p_size", price)),
        (";Notes\n;Code of part;Price;Remark;Title;No. of places\n", F.concat_ws(";", F.lit(""), k, price, F.lit('"a; b"'), "p_name", "p_size")),
        (";;Part  code;Title;Price;\n", F.concat_ws(";", F.lit(""), F.lit("x"), k, "p_name", price)),
    ]
    for year, (head, line) in enumerate(layouts):  # files of at most a few thousand lines, as they would come
        lines = part.filter(F.col("p_size") % 3 == year).groupBy(F.floor(k / 2000).alias("page")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
        lines.select(F.concat(F.lit(head), F.array_join("lines", "\n"), F.lit("\nTotal;;;")).alias("value"), F.lit(year).alias("year"), "page").write.mode("append").partitionBy("year", "page").text(path)
    columns = {"code": T.LongType(), "title": T.StringType(), "places": T.IntegerType(), "price": T.DoubleType()}
    names = {"Code": "code", "Code of part": "code", "Part code": "code", "Title": "title", "Places": "places", "No. of places": "places", "Price": "price"}
    found = []
    for year in range(3):
        read, _ = read_drifting(spark, f"{path}/year={year}/*", ("Code", "Code of part", "Part code"), columns, names, "[0-9]+")
        found.append(read.withColumn("year", F.lit(year)).drop("file"))
    return found[0].union(found[1]).union(found[2])
