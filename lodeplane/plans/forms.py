"""Predicates, arrays, dates at a stated time, canonical hashes, addresses by rules, pivots; series of several frequencies; dense cubes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.functions import text as T
from lodeplane.operators.series import change_by_frequency
from lodeplane.plans.base import query, table
from lodeplane.sources.cubes import attribute_values, dense_cube_rows


@query("""
SELECT o_orderkey, NOT regexp_matches(o_orderpriority, '^[12]-') AS not_high, NOT regexp_matches(o_orderpriority, '(?i)^[0-9]-urg') AS not_urgent,
  coalesce(nullif(o_orderstatus, 'P') = 'F', FALSE) AS is_true, NOT coalesce(nullif(o_orderstatus, 'P') = 'F', FALSE) AS is_not_true,
  position('-' IN o_orderpriority) AS dash, array_to_string(list_filter([o_orderstatus, 'O', nullif(o_orderstatus, 'F')], lambda x: x IS NOT NULL AND x <> 'O'), ',') AS kept,
  json_array_length('[1,' || o_custkey || CASE WHEN o_orderstatus = 'F' THEN ',3' ELSE '' END || ']') AS n_json, greatest(o_totalprice, 200000.0) AS at_least FROM orders
""")
def predicate_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negated patterns, truth of conditions that may be null, places in texts, arrays without a value, lengths of JSON arrays."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    maybe = F.nullif(status, F.lit("P")) == "F"
    values = F.array_remove(F.array_compact(F.array(status, F.lit("O"), F.nullif(status, F.lit("F")))), "O")
    document = F.concat(F.lit("[1,"), "o_custkey", F.when(status == "F", ",3").otherwise(""), F.lit("]"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (~priority.rlike("^[12]-")).alias("not_high"), (~priority.rlike("(?i)^[0-9]-urg")).alias("not_urgent"),
        maybe.eqNullSafe(True).alias("is_true"), (~maybe.eqNullSafe(True)).alias("is_not_true"), F.position(F.lit("-"), priority).cast("long").alias("dash"),
        F.array_join(values, ",").alias("kept"), F.json_array_length(document).cast("long").alias("n_json"), F.greatest("o_totalprice", F.lit(200_000.0)).alias("at_least"),
    )


_AS_OF = "2001-09-15 12:00:00"


@query(f"""
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), CAST(TIMESTAMP '{_AS_OF}' AS DATE)) AS age_days, o_orderdate >= TIMESTAMP '{_AS_OF}' - INTERVAL 90 DAY AS recent,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders
""")
def as_of_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ages and windows at a stated time instead of now, so that a run can be repeated; dates from text, null where it holds none."""
    now, day = F.lit(_AS_OF).cast("timestamp_ntz"), F.col("o_orderdate")
    raw = F.when(F.col("o_orderkey") % 5 == 0, "soon").otherwise(F.date_format(day, "dd/MM/yyyy"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_diff(F.to_date(now), F.to_date(day)).cast("long").alias("age_days"), (day >= now - F.expr("INTERVAL 90 DAYS")).alias("recent"),
        F.to_date(F.try_to_timestamp(raw, F.lit("dd/MM/yyyy"))).alias("parsed"),
    )


#: Six decimals where they give the number back exactly, else the fewest digits that do; no negative zero.
_NUMBER = """CASE WHEN c_acctbal = 0 THEN '0' WHEN CAST(printf('%.6f', c_acctbal) AS DOUBLE) = c_acctbal
  THEN regexp_replace(regexp_replace(printf('%.6f', c_acctbal), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') ELSE CAST(c_acctbal AS VARCHAR) END"""
_TEXT = "trim(nfc_normalize(replace(replace(' ' || c_name || ' ', chr(30), chr(30) || chr(30)), chr(31), chr(30) || chr(31))))"


@query(f"""
SELECT c_custkey, sha256(concat_ws(chr(31), 'c_acctbal=' || {_NUMBER}, 'c_custkey=' || c_custkey, 'c_name=' || {_TEXT},
  'flag=' || CASE WHEN c_custkey % 4 = 0 THEN 'true' WHEN c_custkey % 2 = 0 THEN 'false' END)) AS h FROM customer
""")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes that don't change with a number's type, blanks around a text or a missing column."""
    k = F.col("c_custkey")
    name = F.concat(F.lit(" "), "c_name", F.lit(" "))
    rows = table(spark, sf_dir, "customer").select(k.cast("double").alias("c_custkey"), name.alias("c_name"), "c_acctbal", F.when(k % 2 == 0, k % 4 == 0).alias("flag"), k.alias("id"))
    return rows.select(F.col("id").alias("c_custkey"), T.content_hash(rows, ["c_custkey", "c_name", "c_acctbal", "flag"]).alias("h"))


#: Rules of addresses, in order: the later ones see what the earlier ones made.
ADDRESS_RULES = (
    (r"\bapartment\b", "apt"), (r"\b(av|avenida|avenue)\b", "avenue"), (r"\b(r|rua|str|street)\b", "street"), (r"\b(sao|saint|st)\b", "saint"),
    (r"\bno ([0-9]+)", "$1"), (r"\bbuilding ([0-9]+)\b", "bldg $1"), (r"\b([0-9]+) (th|nd|rd) floor\b", "fl $1"), (r"\bkm [0-9]+\b", ""),
)
_RAW = """CASE c_custkey % 4 WHEN 0 THEN 'Rua São João, no ' || c_nationkey || ', Apartment ' || c_custkey % 9 || ' door B' WHEN 1 THEN 'Av. Saint Paul — Building ' || c_nationkey || ' km 7'
  WHEN 2 THEN n_name || ' Street ' || c_custkey % 100 ELSE NULL END"""
_RULED = f"trim(regexp_replace(lower(translate({_RAW}, '{T.ACCENTED}', '{T.PLAIN}')), '[^a-z0-9]+', ' ', 'g'))"
for _pattern, _text in ADDRESS_RULES:
    _RULED = f"regexp_replace({_RULED}, '{_pattern}', '{_text.replace('$1', chr(92) + '1')}', 'g')"
_RULED = f"trim(regexp_replace(regexp_replace({_RULED}, '({T.UNIT_PATTERN})+$', ''), ' +', ' ', 'g'))"


@query(f"""
WITH a AS (SELECT c_custkey, {_RULED} AS address, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
b AS (SELECT *, CASE WHEN contains(' ' || coalesce(address, '') || ' ', ' ' || trim(regexp_replace(lower(n_name), '[^a-z0-9]+', ' ', 'g')) || ' ') THEN address ELSE concat_ws(', ', address, n_name) END AS q FROM a)
SELECT c_custkey, address, CASE WHEN contains(' ' || trim(regexp_replace(lower(q), '[^a-z0-9]+', ' ', 'g')) || ' ', ' ' || trim(regexp_replace(lower(r_name), '[^a-z0-9]+', ' ', 'g')) || ' ') THEN q ELSE concat_ws(', ', q, r_name) END AS lookup FROM b
""")
def address_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses by ordered rules, and the text that each is looked up by: with the places that it doesn't name."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    raw = (
        F.when(k % 4 == 0, F.concat(F.lit("Rua São João, no "), n, F.lit(", Apartment "), k % 9, F.lit(" door B")))
        .when(k % 4 == 1, F.concat(F.lit("Av. Saint Paul — Building "), n, F.lit(" km 7")))
        .when(k % 4 == 2, F.concat("n_name", F.lit(" Street "), k % 100))
    )
    ruled = rows.select("c_custkey", T.ruled_address(raw, ADDRESS_RULES).alias("address"), "n_name", "r_name")
    return ruled.select("c_custkey", "address", T.lookup_text(F.col("address"), F.col("n_name"), F.col("r_name")).alias("lookup"))


@query("""
WITH f AS (SELECT l_orderkey, l_returnflag, CAST(l_quantity AS INTEGER) AS q, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_partkey, l_quantity) AS rn FROM lineitem)
SELECT l_orderkey, max(q) FILTER (WHERE l_returnflag = 'A') AS accepted, max(q) FILTER (WHERE l_returnflag = 'R') AS returned, max(q) FILTER (WHERE l_returnflag = 'N') AS open FROM f WHERE rn = 1 GROUP BY 1
""")
def characteristics_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of name and value turned into typed columns: of each name the first value."""
    value = F.struct("l_linenumber", "l_partkey", F.col("l_quantity").alias("q"))
    named = {"accepted": "A", "returned": "R", "open": "N"}
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.min(F.when(F.col("l_returnflag") == code, value)).alias(n) for n, code in named.items()])
    return lines.select("l_orderkey", *[F.col(f"{n}.q").cast("int").alias(n) for n in named])


@query("""
WITH p AS (SELECT 'M' AS freq, o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders GROUP BY 1, 2, 3
  UNION ALL SELECT 'Q', o_orderpriority, CAST(date_trunc('quarter', o_orderdate) AS DATE), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders GROUP BY 1, 2, 3
  UNION ALL SELECT 'A', o_orderpriority, CAST(date_trunc('year', o_orderdate) AS DATE), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders GROUP BY 1, 2, 3),
l AS (SELECT *, lag(value, 1) OVER w AS l1, lag(value, 3) OVER w AS l3, lag(value, 4) OVER w AS l4, lag(value, 12) OVER w AS l12 FROM p WINDOW w AS (PARTITION BY series, freq ORDER BY period)),
b AS (SELECT *, CASE freq WHEN 'M' THEN l12 WHEN 'Q' THEN l4 WHEN 'A' THEN l1 END AS y, CASE freq WHEN 'M' THEN l3 WHEN 'Q' THEN l1 END AS q, CASE freq WHEN 'M' THEN l1 END AS m FROM l)
SELECT series, freq, period, value, round((value - m) / nullif(abs(m), 0) * 100, 4) AS mom, round((value - q) / nullif(abs(q), 0) * 100, 4) AS qoq, round((value - y) / nullif(abs(y), 0) * 100, 4) AS yoy FROM b
""")
def mixed_frequency_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly, quarterly and yearly series in one table; a year back is 12, 4 or 1 rows."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series"), "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    steps = F.array(*[F.struct(F.lit(c).alias("freq"), F.to_date(F.date_trunc(unit, "o_orderdate")).alias("period")) for c, unit in (("M", "month"), ("Q", "quarter"), ("A", "year"))])
    rows = orders.select("series", "v", F.inline(steps)).groupBy("series", "freq", "period").agg(F.sum("v").cast("double").alias("value"))
    offsets = {"mom": {"M": 1}, "qoq": {"M": 3, "Q": 1}, "yoy": {"M": 12, "Q": 4, "A": 1}}
    return change_by_frequency(rows, ["series"], "period", "value", "freq", offsets)


@query("""
SELECT o_orderpriority AS priority, o_orderstatus AS status, CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(count(*) AS DOUBLE) AS value,
  CASE WHEN count(*) % 3 = 0 THEN 'estimated' WHEN count(*) % 3 = 1 THEN 'final' END AS quality FROM orders GROUP BY 1, 2, 3
""")
def dense_cube_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cube whose values are a whole array with gaps, back to rows; each value's attribute is a place in a table of codes."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"))
    counts = orders.groupBy("priority", "status", "year").agg(F.count("*").cast("double").alias("value"))
    dims = orders.agg(F.array_sort(F.collect_set("status")).alias("statuses"), F.array_sort(F.collect_set("year")).alias("years"))  # one row
    at = (F.array_position("statuses", F.col("status")) - 1) * F.size("years") + F.array_position("years", F.col("year")) - 1
    sparse = counts.join(F.broadcast(dims)).groupBy("priority", "statuses", "years").agg(F.map_from_entries(F.collect_list(F.struct(at.cast("int"), "value"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.size("statuses") * F.size("years") - 1), lambda i: F.get(F.array(F.element_at("m", i)), F.lit(0)))
    sizes, categories = F.array(F.size("statuses"), F.size("years")), F.array(F.col("statuses"), F.transform("years", lambda y: y.cast("string")))
    document = F.to_json(F.struct(F.array(F.lit("status"), F.lit("year")).alias("id"), sizes.alias("size"), categories.alias("categories"), dense.alias("value")), {"ignoreNullFields": "false"})
    rows = dense_cube_rows(sparse.select("priority", document.alias("document")), "document", ["priority"])
    place = F.when(F.col("value") % 3 < 2, F.col("value") % 3)
    codes = attribute_values(F.array(F.array(F.lit("estimated"), F.lit("final"))), F.array(place))
    return rows.select("priority", F.col("codes")[0].alias("status"), F.col("codes")[1].alias("year"), "value", codes[0].alias("quality"))
