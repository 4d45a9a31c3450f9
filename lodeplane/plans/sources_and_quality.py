"""Nested documents, landing files, streams, checks and profiles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.operators import quality as Q
from lodeplane.plans.base import query, table
from lodeplane.session import checkpoint_dir
from lodeplane.sources.cubes import image_slots, json_stat_rows, key_drift, sdmx_rows
from lodeplane.sources.files import evolved, overwrite_slices
from lodeplane.streaming.events import drain, event_stream, windowed_counts


@query("""
SELECT o_orderpriority AS priority, o_orderstatus AS status, CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2, 3
""")
def cube_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cube in JSON by priority, of status by year, and back to rows."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
    counts = orders.groupBy("priority", "status", "year").agg(F.count("*").cast("double").alias("value"))
    dims = orders.agg(F.array_sort(F.collect_set("status")).alias("statuses"), F.array_sort(F.collect_set("year")).alias("years"))
    at = (F.array_position("statuses", F.col("status")) - 1) * F.size("years") + F.array_position("years", F.col("year")) - 1
    cubes = counts.join(F.broadcast(dims)).groupBy("priority", "statuses", "years").agg(F.map_from_entries(F.collect_list(F.struct(at.cast("string"), "value"))).alias("value"))
    names = F.array(F.lit("status"), F.lit("year"))
    sizes, categories = F.array(F.size("statuses"), F.size("years")), F.array(F.col("statuses"), F.transform("years", lambda y: y.cast("string")))
    documents = cubes.select("priority", F.to_json(F.struct(names.alias("id"), sizes.alias("size"), categories.alias("categories"), "value")).alias("document"))
    return json_stat_rows(documents, "document", ["priority"]).select("priority", F.col("codes")[0].alias("status"), F.col("codes")[1].alias("year"), "value")


@query("""
SELECT event_type AS series, strftime(ts, '%Y-%m-%d') AS period, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY 1, 2
""")
def series_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series documents with observations by place, and back to rows."""
    counts = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("series"), F.date_format("ts", "yyyy-MM-dd").alias("period")).agg(F.count("*").cast("double").alias("value"))
    listed = counts.groupBy("series").agg(F.array_sort(F.collect_list(F.struct("period", "value"))).alias("x"))
    entries = F.map_from_entries(F.transform("x", lambda x, i: F.struct(i.cast("string"), F.array(x.value))))
    documents = listed.select("series", F.to_json(F.struct(F.col("x.period").alias("periods"), entries.alias("observations"))).alias("document"))
    return sdmx_rows(documents, "document", ["series"])


@query("""
SELECT CASE WHEN event_type = 'error' THEN 'k' ELSE '' END AS missing, CASE WHEN event_type = 'error' THEN 'code' ELSE 'extra' END AS unknown, count(*) AS n FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1, 2
""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON keys held against a contract; two kinds of events break it here."""
    changed = F.when(F.col("event_type") == "error", F.regexp_replace("props", '"k"', '"code"')).when(F.col("event_type") == "signup", F.regexp_replace("props", "[}]", ', "extra": 1}')).otherwise(F.col("props"))
    return key_drift(table(spark, sf_dir, "events").select(changed.alias("props")), "props", ["k"])


@query("""
SELECT conv_id, min(turn) FILTER (WHERE role = 'system') AS system_turn, coalesce(min(turn) FILTER (WHERE role = 'assistant'), min(turn) FILTER (WHERE role = 'user')) AS reply_turn FROM conversations GROUP BY 1
""")
def slot_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first element of parallel arrays for each slot, by the priority of its tags."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("x"))
    slots = image_slots(F.col("x.role"), F.col("x.turn"), [["system"], ["assistant", "user"]])
    return turns.select("conv_id", slots[0].alias("system_turn"), slots[1].alias("reply_turn"))


@query("""
SELECT * FROM (SELECT 'not_null:lang' AS "check", count(*) FILTER (WHERE lang IS NULL) AS n_broken FROM documents UNION ALL
SELECT 'accepted_values:lang', count(*) FILTER (WHERE lang NOT IN ('de', 'en', 'fr')) FROM documents UNION ALL
SELECT 'accepted_range:n_chars', count(*) FILTER (WHERE n_chars NOT BETWEEN 100 AND 10000) FROM documents UNION ALL
SELECT 'pattern:source', count(*) FILTER (WHERE NOT regexp_matches(source, '^src[0-9]$')) FROM documents UNION ALL
SELECT 'unique:text', count(*) FROM (SELECT text FROM documents GROUP BY 1 HAVING count(*) > 1) UNION ALL
SELECT 'relationship:doc_id', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    checks = [Q.not_null("lang"), Q.accepted_values("lang", ["de", "en", "fr"]), Q.in_range("n_chars", 100, 10_000), Q.matches("source", "^src[0-9]$")]
    return Q.all_of([Q.report(docs, checks), Q.unique(docs, ["text"]), Q.relationship(docs, "doc_id", table(spark, sf_dir, "labels"), "doc_id")])


def _profile_sql(name: str, columns: list[str]) -> str:
    one = """SELECT '{c}' AS "column", count(*) AS n_rows, round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2)::DOUBLE AS null_pct, count(DISTINCT {c}) AS n_distinct,
      (SELECT string_agg(v || '=' || n, '|' ORDER BY n DESC, v) FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)) AS top_values FROM {t}"""
    return " UNION ALL ".join(one.format(c=c, t=name) for c in columns)


@query(_profile_sql("orders", ["o_orderstatus", "o_orderpriority", "o_custkey"]))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.profile(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("""
SELECT source, count(*) AS n_docs, count(l.doc_id) AS n_labelled, count(*) FILTER (WHERE toxic = 1) AS n_toxic, round(avg(n_chars) FILTER (WHERE quality = 1), 3) AS mean_good_chars
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1
""")
def star_counts_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A coverage report: filtered counts and means over a left join."""
    both = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(table(spark, sf_dir, "labels").withColumn("labelled", F.lit(1)), "doc_id", "left")
    return both.groupBy("source").agg(F.count("*").alias("n_docs"), F.count("labelled").alias("n_labelled"), F.count_if(F.col("toxic") == 1).alias("n_toxic"), F.round(F.avg(F.when(F.col("quality") == 1, F.col("n_chars"))), 3).alias("mean_good_chars"))


@query("""
SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE NOT (CAST(ts AS DATE) = DATE '2024-01-05' AND event_type = 'error') GROUP BY 1, 2
""")
def slice_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by day, of which one day is loaded again without its errors; other days stay."""
    path = f"{checkpoint_dir(spark)}/lodeplane-slices-{uuid.uuid4().hex}"
    counts = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    overwrite_slices(counts, path, "day")
    overwrite_slices(evolved(counts.schema, counts.filter("day = DATE '2024-01-05' AND event_type <> 'error'")), path, "day")
    return spark.read.parquet(path).select("event_type", "day", "n")


@query("""
SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2
""")
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of the events read as a stream; each batch's changed windows replace the ones before."""
    root = f"{checkpoint_dir(spark)}/lodeplane-stream-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    stream = event_stream(spark, sf_dir, "events.parquet", schema)

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    drain(windowed_counts(stream), keep, f"{root}/state", mode="update")
    newest = spark.read.option("basePath", f"{root}/out").parquet(f"{root}/out").groupBy("start", "event_type").agg(F.max(F.struct("batch", "n", "total")).alias("x"))
    return newest.select("start", "event_type", "x.n", "x.total")
