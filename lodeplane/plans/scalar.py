"""Scalar functions: parsing, folding, classification, arrays, maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.functions import text as T
from lodeplane.plans.base import query, table

_FOLD = f"trim(regexp_replace(lower(translate(%s, '{T.ACCENTED}', '{T.PLAIN}')), '[^a-z0-9]+', ' ', 'g'))"


@query("""
WITH p AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m')
  WHEN 2 THEN strftime(o_orderdate, '%Y') || '-Q' || quarter(o_orderdate) WHEN 3 THEN CASE quarter(o_orderdate) WHEN 1 THEN '1st' WHEN 2 THEN '2nd' WHEN 3 THEN '3rd' ELSE '4th' END || ' Quarter ' || strftime(o_orderdate, '%Y')
  WHEN 4 THEN strftime(o_orderdate, '%B %Y') ELSE 'week ' || strftime(o_orderdate, '%Y') END AS period, o_orderdate FROM orders)
SELECT o_orderkey, period, CASE o_orderkey % 6 WHEN 0 THEN CAST(date_trunc('year', o_orderdate) AS DATE) WHEN 1 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
  WHEN 2 THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) WHEN 3 THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) WHEN 4 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS first_day FROM p
""")
def period_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five ways to write a period, and one that isn't one."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    nth = F.element_at(F.array(*map(F.lit, ("1st", "2nd", "3rd", "4th"))), F.quarter(d))
    period = (
        F.when(k == 0, F.date_format(d, "yyyy")).when(k == 1, F.date_format(d, "yyyy-MM")).when(k == 2, F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), F.quarter(d)))
        .when(k == 3, F.concat(nth, F.lit(" Quarter "), F.date_format(d, "yyyy"))).when(k == 4, F.date_format(d, "MMMM yyyy")).otherwise(F.concat(F.lit("week "), F.date_format(d, "yyyy")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", period.alias("period")).withColumn("first_day", T.parsed_period(F.col("period")))


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'x' WHEN 1 THEN ' ' || replace(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ',5', '.', ',') WHEN 2 THEN '..' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS raw, l_quantity FROM lineitem)
SELECT l_orderkey, l_linenumber, raw, CASE l_linenumber % 4 WHEN 1 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) + 0.5 WHEN 3 THEN CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) END AS value FROM v
""")
def number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with decimal commas, and marks for missing ones."""
    k, q = F.col("l_linenumber") % 4, F.col("l_quantity").cast("int").cast("string")
    raw = F.when(k == 0, "x").when(k == 1, F.concat(F.lit(" "), q, F.lit(",5"))).when(k == 2, "..").otherwise(q)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw")).withColumn("value", T.parsed_number(F.col("raw")))


@query(f"""
SELECT doc_id, {_FOLD % "text"} AS folded, len(list_distinct(list_filter(string_split({_FOLD % "text"}, ' '), lambda x: x <> ''))) AS n_tokens FROM documents
""")
def folded_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accents, case and punctuation folded in each document."""
    title = T.folded(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", title.alias("folded"), F.size(T.tokens(title)).cast("long").alias("n_tokens"))


@query("""
SELECT p_partkey, CASE WHEN p_name LIKE '%ring' OR p_name LIKE '%bolt' THEN 'fastener' WHEN p_type IN ('PROMO', 'ECONOMY') AND p_size < 20 THEN 'bargain'
  WHEN regexp_matches(p_brand, '^Brand#(1|2)[0-9]$') THEN 'brand-tens' WHEN p_size BETWEEN 30 AND 40 THEN 'mid' ELSE 'other' END AS category,
  least(p_size, 30) AS capped, nullif(p_type, 'PROMO') AS type_or_null, p_type IS DISTINCT FROM 'PROMO' AS not_promo FROM part
""")
def category_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first arm that fits: LIKE, IN, regex, BETWEEN."""
    name, kind, size = F.col("p_name"), F.col("p_type"), F.col("p_size")
    ladder = (
        F.when(name.like("%ring") | name.like("%bolt"), "fastener").when(kind.isin("PROMO", "ECONOMY") & (size < 20), "bargain")
        .when(F.col("p_brand").rlike("^Brand#(1|2)[0-9]$"), "brand-tens").when(size.between(30, 40), "mid").otherwise("other")
    )
    return table(spark, sf_dir, "part").select("p_partkey", ladder.alias("category"), F.least(size, F.lit(30)).alias("capped"), F.nullif(kind, F.lit("PROMO")).alias("type_or_null"), (~kind.eqNullSafe("PROMO")).alias("not_promo"))


@query("""
WITH c AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 4, '0') WHEN 1 THEN lpad(CAST(c_nationkey AS VARCHAR), 4, '0') || '01' WHEN 2 THEN '1' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') || '03' ELSE 'PT7' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') || '05' END AS code FROM customer)
SELECT c_custkey, code, CASE length(code) WHEN 6 THEN code WHEN 7 THEN substring(code, 2, 6) WHEN 9 THEN substring(code, 4, 6) END AS area,
  CASE length(code) WHEN 4 THEN code WHEN 6 THEN left(code, 4) WHEN 7 THEN substring(code, 2, 4) WHEN 9 THEN substring(code, 4, 4) END AS region FROM c
""")
def code_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of four lengths brought to an area and a region."""
    n, k = F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), F.col("c_custkey") % 4
    code = F.when(k == 0, n).when(k == 1, F.concat(n, F.lit("01"))).when(k == 2, F.concat(F.lit("1"), n, F.lit("03"))).otherwise(F.concat(F.lit("PT7"), n, F.lit("05")))
    c, size = F.col("code"), F.length("code")
    area = F.when(size == 6, c).when(size == 7, F.substring(c, 2, 6)).when(size == 9, F.substring(c, 4, 6))
    region = F.when(size == 4, c).when(size == 6, F.left(c, F.lit(4))).when(size == 7, F.substring(c, 2, 4)).when(size == 9, F.substring(c, 4, 4))
    return table(spark, sf_dir, "customer").select("c_custkey", code.alias("code")).select("c_custkey", "code", area.alias("area"), region.alias("region"))


@query("""
SELECT user_id, m.k AS bucket, m.n AS n, CASE WHEN regexp_matches(m.k, '^(view|click)') THEN 'interest' WHEN m.k = 'purchase' THEN 'sale' ELSE 'other' END AS category
FROM (SELECT user_id, unnest(list({'k': event_type, 'n': n})) AS m FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1)
""")
def map_explode_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A histogram as a map, exploded again and classified by its keys."""
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    maps = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    rows = maps.select("user_id", F.explode("m").alias("bucket", "n"))
    return rows.withColumn("category", F.when(F.col("bucket").rlike("^(view|click)"), "interest").when(F.col("bucket") == "purchase", "sale").otherwise("other"))


@query("""
WITH g AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS parts, list(l_returnflag ORDER BY l_linenumber, l_partkey) AS flags FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_transform(list_filter(list_zip(parts, flags), lambda x: x[2] = 'R'), lambda x: x[1]), ',') AS returned FROM g WHERE list_contains(flags, 'R')
""")
def parallel_array_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of one array the elements at whose places the other says so, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag")))
    arrays = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(ordered.alias("x")).select("l_orderkey", F.col("x.l_partkey").alias("parts"), F.col("x.l_returnflag").alias("flags"))
    chosen = F.transform(F.filter(F.arrays_zip("parts", "flags"), lambda x: x.flags == "R"), lambda x: x.parts)
    return arrays.filter(F.array_contains("flags", "R")).select("l_orderkey", F.array_join(chosen, ",").alias("returned"))


@query("""
SELECT o_orderkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END) AS BIGINT) AS returned_qty, count(*) AS n_lines
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1
""")
def nested_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sum over structs in an array, by a tag in them."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(F.col("l_returnflag").alias("tag"), F.col("l_quantity").cast("int").alias("n"))).alias("lines"))
    total = F.aggregate(F.filter("lines", lambda x: x.tag == "R"), F.lit(0).cast("long"), lambda s, x: s + x.n)
    return table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey").select("o_orderkey", total.alias("returned_qty"), F.size("lines").cast("long").alias("n_lines"))


@query("""
WITH l AS (SELECT n_nationkey, s_suppkey // 100 AS page, string_agg(CASE WHEN s_suppkey % 2 = 0 THEN upper(s_name) ELSE lower(s_name) END, ', ' ORDER BY s_suppkey) AS names
  FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2),
x AS (SELECT n_nationkey, page, trim(unnest(string_split(names, ','))) AS name FROM l)
SELECT n_nationkey, page, array_to_string(list(s_suppkey ORDER BY s_suppkey), ',') AS suppliers, min(s_suppkey) AS first_supplier FROM x JOIN supplier ON lower(s_name) = lower(name) GROUP BY 1, 2
""")
def multi_value_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list in one text, of at most a hundred names, split, folded and resolved to keys."""
    supplier = table(spark, sf_dir, "supplier")
    odd = F.when(F.col("s_suppkey") % 2 == 0, F.upper("s_name")).otherwise(F.lower("s_name"))
    lists = supplier.groupBy(F.col("s_nationkey").alias("n_nationkey"), F.floor(F.col("s_suppkey") / 100).alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", odd.alias("name")))), lambda x: x["name"]), ", ").alias("names"))
    names = lists.select("n_nationkey", "page", F.explode(F.transform(F.split("names", ","), lambda x: F.lower(F.trim(x)))).alias("name"))
    found = names.join(supplier.select(F.lower("s_name").alias("name"), "s_suppkey"), "name")
    return found.groupBy("n_nationkey", "page").agg(F.array_join(F.array_sort(F.collect_list("s_suppkey")), ",").alias("suppliers"), F.min("s_suppkey").alias("first_supplier"))


@query("""
SELECT c_custkey, sha256(length(c_name) || ':' || c_name || length(CAST(c_nationkey AS VARCHAR)) || ':' || CAST(c_nationkey AS VARCHAR) || CASE WHEN c_mktsegment = 'BUILDING' THEN '-' ELSE length(c_mktsegment) || ':' || c_mktsegment END) AS h FROM customer
""")
def row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hash of a row's values that tells null from text."""
    return table(spark, sf_dir, "customer").select("c_custkey", T.row_hash(F.col("c_name"), F.col("c_nationkey"), F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("h"))


@query(r"""
SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title, nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS lang,
  CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT) AS n_paragraphs, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages
""")
def html_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields out of pages by patterns; no match is null."""
    first = lambda p: F.nullif(F.regexp_extract("html", p, 1), F.lit(""))
    return table(spark, sf_dir, "pages").select(
        "page_id", first("<title>([^<]*)</title>").alias("title"), first('<html lang="([a-z]+)"').alias("lang"), F.regexp_count("html", F.lit("<p>")).cast("long").alias("n_paragraphs"), F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)).alias("host")
    )


@query("""
SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('week', ts) AS DATE) AS week, isodow(ts) AS weekday, hour(ts) AS hour, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS age_days,
  CAST(last_day(CAST(ts AS DATE)) AS DATE) AS month_end FROM events
""")
def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", F.to_date(ts).alias("day"), F.to_date(F.date_trunc("week", ts)).alias("week"), (F.weekday(ts) + 1).cast("long").alias("weekday"), F.hour(ts).cast("long").alias("hour"), F.date_diff(F.to_date(ts), F.lit("2024-01-01").cast("date")).alias("age_days"), F.last_day(ts).alias("month_end")
    )


_ADDRESS = "(CASE c_custkey % 3 WHEN 0 THEN c_nationkey || ', Harbour Street, apt ' || c_custkey % 9 WHEN 1 THEN 'Avenida São João — Building ' || c_nationkey ELSE ' Old  ROAD ' || c_custkey END)"
_SHORT = "trim(regexp_replace(lower(translate({a}, '" + T.ACCENTED + "', '" + T.PLAIN + "')), '[^a-z0-9]+', ' ', 'g'))"
for _word, _abbreviation in T.STREET_WORDS:
    _SHORT = f"regexp_replace({_SHORT}, '\\b{_word}\\b', '{_abbreviation}', 'g')"


@query(f"SELECT c_custkey, trim(regexp_replace({_SHORT.format(a=_ADDRESS)}, '\\b(apt|fl|unit) [0-9a-z]+$', '')) AS address FROM customer")
def normal_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses folded, shortened, and without their units."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    raw = F.when(k % 3 == 0, F.concat(n, F.lit(", Harbour Street, apt "), k % 9)).when(k % 3 == 1, F.concat(F.lit("Avenida São João — Building "), n)).otherwise(F.concat(F.lit(" Old  ROAD "), k))
    return table(spark, sf_dir, "customer").select("c_custkey", T.normal_address(raw).alias("address"))


@query("""
SELECT o_orderkey, pos - 1 AS place, CAST(json_extract_string(j, '$.part') AS BIGINT) AS part, json_type(json_extract(j, '$.part')) = 'UBIGINT' AS is_number, len(json_keys(j)) = 3 AS has_note
FROM (SELECT o_orderkey, unnest(d) AS j, generate_subscripts(d, 1) AS pos FROM (SELECT l_orderkey AS o_orderkey, list(to_json({'part': l_partkey, 'qty': l_quantity}) ORDER BY l_linenumber, l_partkey) AS d FROM lineitem GROUP BY 1))
""")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with arrays, unnested with their places, under guards of kind and of keys."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    built = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))), lambda x: F.struct(x.l_partkey.alias("part"), x.l_quantity.alias("qty")))
    documents = lines.agg(F.to_json(built).alias("document"))
    rows = documents.select("o_orderkey", F.posexplode(F.from_json("document", "array<string>")).alias("place", "j")).withColumn("v", F.parse_json("j"))
    kind = F.schema_of_variant(F.variant_get("v", "$.part", "variant"))
    return rows.select("o_orderkey", F.col("place").cast("long").alias("place"), F.variant_get("v", "$.part", "bigint").alias("part"), (kind == "BIGINT").alias("is_number"), (F.size(F.json_object_keys("j")) == 3).alias("has_note"))


@query(r"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '[0-9]+')) AS BIGINT) AS n_numbers, nullif(regexp_extract(text, '([0-9]+)', 1), '') AS first_number,
  CASE WHEN length(text) < 500 THEN 'short' WHEN length(text) < 3000 THEN 'medium' ELSE 'long' END AS bucket, regexp_matches(text, '(?i)licen[cs]e') AS licensed FROM documents
""")
def text_heuristics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in texts, a bucket of length, and a flag that ignores case."""
    text, size = F.col("text"), F.length("text")
    bucket = F.when(size < 500, "short").when(size < 3000, "medium").otherwise("long")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(F.regexp_extract_all("text", F.lit("[0-9]+"), 0)).cast("long").alias("n_numbers"), F.nullif(F.regexp_extract("text", "([0-9]+)", 1), F.lit("")).alias("first_number"), bucket.alias("bucket"), text.rlike("(?i)licen[cs]e").alias("licensed")
    )
