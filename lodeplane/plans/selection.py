"""Choices from arrays and texts: slots by tags with what fills the empty ones, first elements that match, flags, letters without accents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.functions.text import first_matching, flags, unaccented
from lodeplane.operators.relational import filled_slots
from lodeplane.plans.base import query, table


@query("SELECT doc_id, md5(strip_accents(text)) AS plain, length(strip_accents(text)) AS n_chars, strip_accents(text) = text AS was_plain FROM documents")
def unaccented_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts without any accents: letters are decomposed, whatever they are, and lose their marks."""
    plain = table(spark, sf_dir, "documents").select("doc_id", "text", unaccented(F.col("text")).alias("plain"))
    return plain.select("doc_id", F.md5(F.col("plain").cast("binary")).alias("plain"), F.length("plain").cast("long").alias("n_chars"), (F.col("plain") == F.col("text")).alias("was_plain"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's turns in order: bounded by the conversation."""
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("x"))


@query("""
SELECT conv_id, arg_min(text, turn) FILTER (WHERE regexp_matches(text, '[0-9]{2}')) AS numbered, arg_min(text, turn) FILTER (WHERE regexp_matches(text, '(?i)^(what|how|why|can)')) AS question FROM conversations GROUP BY 1
""")
def first_matching_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of an array the first element that a pattern is found in; null without one."""
    texts = F.col("x.text")
    return _turns(spark, sf_dir).select("conv_id", first_matching(texts, "[0-9]{2}").alias("numbered"), first_matching(texts, "(?i)^(what|how|why|can)").alias("question"))


#: The articles as whole words: beside letters, digits, marks or underscores of any script they are parts of others.
_ARTICLES = r"(^|[^\p{L}\p{N}\p{M}_])(the|der|le)($|[^\p{L}\p{N}\p{M}_])"


@query(f"""
SELECT conv_id, coalesce(bool_or(regexp_matches(v, '(?i)please')), FALSE) AS polite, coalesce(bool_or(regexp_matches(v, '(?i)[0-9]{{3}}')), FALSE) AS numbers,
  coalesce(bool_or(regexp_matches(v, '(?i){_ARTICLES}')), FALSE) AS articles, coalesce(bool_or(lower(role) = 'system'), FALSE) AS has_system
FROM (SELECT conv_id, role, concat_ws(chr(10), CAST(turn AS VARCHAR), role, text) AS v FROM conversations) GROUP BY 1
""")
def json_text_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags over a document's JSON text, whichever of its fields a pattern is found in, upper or lower case. Words are looked for in the fields' values, not in the marks that JSON writes them with."""
    documents = _turns(spark, sf_dir).select("conv_id", F.to_json("x").alias("document"))
    read = F.from_json("document", "array<struct<turn: string, role: string, text: string>>")
    values = F.array_join(F.transform(read, lambda v: F.concat_ws("\n", v.turn, v.role, v.text)), "\n")
    held = documents.select("conv_id", "document", values.alias("values"))
    found = flags(F.col("values"), {"polite": "please", "numbers": "[0-9]{3}", "articles": _ARTICLES})
    return held.select("conv_id", *found, *flags(F.col("document"), {"has_system": '"role":"SYSTEM"'}))


@query("""
WITH x AS (SELECT conv_id, list({'turn': turn, 'role': role} ORDER BY turn) AS l FROM conversations GROUP BY 1),
s AS (SELECT conv_id, list_transform(l, lambda v: v.turn) AS turns, list_filter(l, lambda v: v.role = 'system')[1].turn AS a, list_filter(l, lambda v: v.role = 'assistant')[1].turn AS b,
  list_filter(l, lambda v: v.role = 'user')[1].turn AS c, coalesce(list_filter(l, lambda v: v.role = 'user' AND v.turn NOT IN (coalesce(list_filter(l, lambda w: w.role = 'assistant')[1].turn, -1), coalesce(list_filter(l, lambda w: w.role = 'user')[1].turn, -1)))[1].turn,
  list_filter(l, lambda v: v.role = 'assistant' AND v.turn NOT IN (coalesce(list_filter(l, lambda w: w.role = 'assistant')[1].turn, -1), coalesce(list_filter(l, lambda w: w.role = 'user')[1].turn, -1)))[1].turn) AS d FROM x),
r AS (SELECT *, list_filter(turns, lambda t: t IS DISTINCT FROM a AND t IS DISTINCT FROM b AND t IS DISTINCT FROM c AND t IS DISTINCT FROM d) AS rest FROM s)
SELECT conv_id, coalesce(a, rest[1]) AS system_turn, coalesce(b, rest[1 + (a IS NULL)::INT]) AS assistant_turn, coalesce(c, rest[1 + (a IS NULL)::INT + (b IS NULL)::INT]) AS user_turn,
  coalesce(d, rest[1 + (a IS NULL)::INT + (b IS NULL)::INT + (c IS NULL)::INT]) AS next_turn FROM r
""")
def slots_with_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four slots by tags in order, none twice; what no tag fills takes the elements left over, in their order."""
    slots = {"system_turn": ["system"], "assistant_turn": ["assistant"], "user_turn": ["user"], "next_turn": ["user", "assistant"]}
    turns = _turns(spark, sf_dir).select("conv_id", F.transform("x", lambda v: F.struct(v.role.alias("tag"), v.turn.alias("value"))).alias("items"))
    return filled_slots(turns, "items", slots).select("conv_id", *slots)
