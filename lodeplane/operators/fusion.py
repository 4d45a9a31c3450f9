"""Layers of features under one contract, with the severity of what they are and the rules of the places that they touch."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What each layer must have; other columns of layers are left out.
CONTRACT = ("feature", "code", "zone", "places", "day")


def united(layers: Mapping[str, DataFrame]) -> DataFrame:
    """All layers' rows as `layer` and the columns of CONTRACT. Texts of days that begin with a date become it, others null; a layer without a column of the contract raises."""
    if not layers:
        raise ValueError("no layers")
    for name, df in layers.items():
        if lacking := [c for c in CONTRACT if c not in df.columns]:
            raise ValueError(f"layer {name} lacks {', '.join(lacking)}")
    day = F.col("day").cast("string")
    dated = F.when(day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.left(day, F.lit(10)).try_cast("date"))
    parts = [df.select(F.lit(name).alias("layer"), *CONTRACT[:-1], dated.alias("day")) for name, df in layers.items()]
    return reduce(DataFrame.unionByName, parts)


def place_names(c: Column) -> Column:
    """Names of a list of places between commas: trimmed, upper case, each once; none for null or the empty text."""
    names = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda n: F.upper(F.trim(n)))
    return F.array_distinct(F.filter(names, lambda n: n != ""))


def resolved_places(df: DataFrame, places: DataFrame) -> DataFrame:
    """df plus place_ids, place_labels: the ids and names of the places that df's `places` lists, by id; empty where none is known.

    places: (place, name). Lists repeat: each different one is resolved once, and the result meets the rows by the list. Of places with
    one name (whatever its case) all are meant.
    """
    known = places.select(F.upper(F.trim("name")).alias("_name"), "place", "name").filter("_name <> ''").distinct()
    lists = df.select("places").filter("places IS NOT NULL").distinct()
    found = lists.select("places", F.explode(place_names(F.col("places"))).alias("_name")).join(known, "_name")
    by_list = found.groupBy("places").agg(F.array_sort(F.collect_set(F.struct("place", F.col("name").alias("label")))).alias("_p"))
    kind = places.schema["place"].dataType.simpleString()
    ids = F.coalesce(F.array_distinct(F.transform("_p", lambda p: p["place"])), F.array().cast(f"array<{kind}>"))
    labels = F.coalesce(F.transform("_p", lambda p: p["label"]), F.array().cast("array<string>"))
    return df.join(by_list, "places", "left").select(*df.columns, ids.alias("place_ids"), labels.alias("place_labels"))


def matched_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """df plus rules, n_rules, articles and kinds: of the rules of a place among place_ids whose patterns hold the row's code, and whose zones are null or hold its zone.

    rules: (rule, place, patterns: array, zones: array or null, article, kind). Rows that are in one situation (places, code, zone) have the same
    rules: situations meet the rules by (place, code), are summed up, and meet their rows again. Arrays are sorted, articles and kinds
    each once; without a rule they are null and n_rules is 0.
    """
    key = ["place_ids", "code", "zone"]
    situations = df.select(*key).filter(F.size("place_ids") > 0).distinct()
    # a situation's number names it through the join of rules; nulls of zones count as a zone
    hashed = F.sha2(F.to_json(F.struct(*key), {"ignoreNullFields": "false"}), 256)
    at = situations.select(hashed.alias("_at"), "code", "zone", F.explode("place_ids").alias("place"))
    open_rules = rules.select("rule", "place", "zones", "article", "kind", F.explode(F.array_distinct("patterns")).alias("code"))
    fits = F.col("zones").isNull() | F.coalesce(F.array_contains("zones", F.col("zone")), F.lit(False))
    met = at.join(open_rules, ["place", "code"]).filter(fits)
    listed = lambda c: F.array_sort(F.collect_set(c))
    summed = met.groupBy("_at").agg(listed("rule").alias("rules"), listed("article").alias("articles"), listed("kind").alias("kinds"))
    joined = df.withColumn("_at", hashed).join(summed, "_at", "left")
    return joined.select(*df.columns, "rules", F.when(F.col("rules").isNotNull(), F.size("rules")).otherwise(0).alias("n_rules"), "articles", "kinds")


def fused(layers: Mapping[str, DataFrame], places: DataFrame, severities: DataFrame, rules: DataFrame) -> DataFrame:
    """The layers' features with their places, severity and rules; every feature stays once.

    severities: (code, zone, and what else is to be carried), one row for each code and zone: more raise, as features would be doubled.
    """
    if severities.groupBy("code", "zone").count().filter("count > 1").limit(1).count():
        raise ValueError("severities has several rows of one code and zone")
    return matched_rules(resolved_places(united(layers), places), rules).join(severities, ["code", "zone"], "left")
