"""Text as Column expressions: folding, names, tokens, similarity."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Accented letters and their plain forms, place by place.
ACCENTED = "áàâãäåçéèêëíìîïñóòôõöúùûüýÿÁÀÂÃÄÅÇÉÈÊËÍÌÎÏÑÓÒÔÕÖÚÙÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"
#: Street words and their short forms.
STREET_WORDS = (("avenue", "av"), ("boulevard", "bd"), ("street", "st"), ("road", "rd"), ("square", "sq"), ("lane", "ln"), ("number", "no"), ("building", "bldg"), ("floor", "fl"), ("apartment", "apt"))

#: Letters and the classes of their sounds, those that don't count last.
SOUND_CLASSES = ("bfpvcgjkqsxzdtlmnraeiouhwy", "111122222222334556")

#: A unit at the end of a folded address.
UNIT_PATTERN = r" ?\b(apt|fl|unit|door|no) [0-9a-z]{1,4}"


def deaccent(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def folded(c: Column) -> Column:
    """Lower case, no accents, runs of anything but letters and digits as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(deaccent(c)), "[^a-z0-9]+", " "))


def normal_name(c: Column, drop: str = "the|and|of") -> Column:
    """A folded name without the given words; null becomes the empty name."""
    kept = F.regexp_replace(folded(F.coalesce(c, F.lit(""))), rf"\b({drop})\b", " ")
    return F.trim(F.regexp_replace(kept, " +", " "))


def normal_address(c: Column) -> Column:
    """A folded address with street words shortened and a trailing unit left out."""
    out = folded(c)
    for word, short in STREET_WORDS:
        out = F.regexp_replace(out, rf"\b{word}\b", short)
    return F.trim(F.regexp_replace(out, r"\b(apt|fl|unit) [0-9a-z]+$", ""))


def ruled_address(c: Column, rules: Sequence[tuple[str, str]], units: str = UNIT_PATTERN) -> Column:
    """A folded address after the rules (pattern, replacement) in their order, without units at its end however many there are."""
    out = folded(c)
    for pattern, text in rules:
        out = F.regexp_replace(out, pattern, text)
    return F.trim(F.regexp_replace(F.regexp_replace(out, f"({units})+$", ""), " +", " "))


def lookup_text(address: Column, *places: Column) -> Column:
    """What an address is looked up by: the address, then each place that it doesn't name yet, joined by commas; null without any part."""
    out = F.nullif(F.trim(address), F.lit(""))
    for place in places:
        folded_place = F.nullif(folded(place), F.lit(""))
        named = F.coalesce(F.contains(F.concat(F.lit(" "), folded(out), F.lit(" ")), F.concat(F.lit(" "), folded_place, F.lit(" "))), F.lit(False))
        out = F.when(named, out).otherwise(F.nullif(F.concat_ws(", ", out, F.trim(place)), F.lit("")))
    return out


@F.arrow_udf(StringType())
def composed(texts: pa.Array) -> pa.Array:
    """Texts in Unicode's composed form: a letter and its accent are one character wherever there is one."""
    # Arrow's own NFC leaves letters and their accents apart; texts of plain letters need no look
    plain = pc.string_is_ascii(texts).to_pylist()
    return pa.array([x if x is None or same else unicodedata.normalize("NFC", x) for x, same in zip(texts.to_pylist(), plain, strict=True)], pa.string())


@F.arrow_udf(StringType())
def _decomposed(texts: pa.Array) -> pa.Array:
    return pc.utf8_normalize(texts, "NFD")


def unaccented(c: Column) -> Column:
    """A text without accents: every letter that has marks loses them, in any script; letters that are no others with a mark stay."""
    return composed(F.regexp_replace(_decomposed(c), r"\p{M}+", ""))


def first_matching(array: Column, pattern: str) -> Column:
    """The first element of an array of texts that the pattern is found in; null without one."""
    return F.get(F.filter(array, lambda x: x.rlike(pattern)), F.lit(0))


def flags(c: Column, patterns: Mapping[str, str]) -> list[Column]:
    """For each name whether its pattern is found in a text, upper or lower case; false for null."""
    return [F.coalesce(c.rlike(f"(?iu){p}"), F.lit(False)).alias(name) for name, p in patterns.items()]


def _plain_number(digits: Column) -> Column:
    """Digits behind a point without zeros at their end."""
    return F.regexp_replace(F.regexp_replace(digits, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def canonical(value: Column, kind: str) -> Column:
    """A value as text of which equal ones are equal and no others: numbers without trailing zeros, texts composed and trimmed, booleans as words.

    A double that six decimals give back exactly is written so, any other one in the fewest digits that do; whole numbers and decimals in full.
    """
    if kind in ("byte", "short", "integer", "long"):
        return value.cast("string")
    if kind.startswith("decimal"):
        return F.when(value == F.floor(value), value.cast("decimal(38,0)").cast("string")).otherwise(_plain_number(value.cast("string")))
    if kind in ("float", "double"):
        number = value.cast("double") + F.lit(0.0)  # no negative zero
        short = F.format_string("%.6f", number)
        return F.when(value.isNull(), F.lit(None).cast("string")).when(short.try_cast("double") == number, _plain_number(short)).otherwise(number.cast("string"))
    if kind == "boolean":
        return F.when(value, "true").when(~value, "false")
    # a text's own separators are marked, so that it can't look like two columns
    marked = F.replace(F.replace(value.cast("string"), F.lit("\u001e"), F.lit("\u001e\u001e")), F.lit("\u001f"), F.lit("\u001e\u001f"))
    return F.trim(composed(marked))


def content_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """sha256 of a row's columns in canonical form, each behind its name; nulls count as absent. Nested columns raise."""
    parts = []
    for name in sorted(columns):
        kind = df.schema[name].dataType.typeName()
        if kind in ("array", "map", "struct", "variant"):
            raise TypeError(f"{name} is nested: flatten it before it's hashed")
        parts.append(F.concat(F.lit(f"{name}="), canonical(F.col(f"`{name}`"), kind)))
    return F.sha2(F.concat_ws("\u001f", *parts).cast("binary"), 256)


def tokens(c: Column) -> Column:
    """Distinct words of a folded text; none for the empty text or null."""
    return F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), " "), lambda x: x != ""))


def trigrams(c: Column) -> Column:
    """Distinct runs of three characters of a text without blanks; none if it's shorter."""
    packed = F.regexp_replace(F.coalesce(c, F.lit("")), " ", "")
    starts = F.when(F.length(packed) >= 3, F.sequence(F.lit(1), F.length(packed) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(packed, i, F.lit(3))))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays without repeats; null if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return shared / F.nullif(F.size(a) + F.size(b) - shared, F.lit(0))


def edit_ratio(a: Column, b: Column) -> Column:
    """1 less the edit distance by the longer length; 1 for two empty texts."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


def parsed_number(c: Column) -> Column:
    """A number from text with decimal commas, blanks and sentinels for missing values; null where there is none."""
    clean = F.regexp_replace(F.regexp_replace(F.trim(c), "[\\u00a0 ]", ""), ",", ".")
    return F.when(clean.rlike(r"^[-+]?[0-9]+(\.[0-9]+)?$"), clean.try_cast("double"))


def parsed_period(c: Column) -> Column:
    """First day of YYYY, YYYY-MM, YYYY-Qn, `nth Quarter YYYY` or `Month YYYY`; null for anything else."""
    year = F.regexp_extract(c, r"([0-9]{4})", 1).try_cast("int")
    months = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
    named = F.array_position(F.array(*[F.lit(m) for m in months]), F.regexp_extract(c, r"^([A-Z][a-z]+) [0-9]{4}$", 1)).cast("int")
    quarter = F.coalesce(F.regexp_extract(c, r"^[0-9]{4}-Q([1-4])$", 1).try_cast("int"), F.regexp_extract(c, r"^([1-4])(st|nd|rd|th) Quarter [0-9]{4}$", 1).try_cast("int"))
    month = (
        F.when(c.rlike(r"^[0-9]{4}$"), 1)
        .when(c.rlike(r"^[0-9]{4}-(0[1-9]|1[0-2])$"), F.right(c, F.lit(2)).try_cast("int"))
        .when(quarter.isNotNull(), quarter * 3 - 2)
        .when(c.rlike(r"^[A-Z][a-z]+ [0-9]{4}$") & (named > 0), named)
    )
    return F.when(month.isNotNull(), F.make_date(year, month, F.lit(1)))


def row_hash(*columns: Column) -> Column:
    """sha256 of the values as text, each behind its length; null differs from any text."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]).cast("binary"), 256)


def padded_trigrams(c: Column) -> Column:
    """Distinct runs of three characters of each folded word behind two blanks and before one."""
    per_word = F.transform(tokens(folded(c)), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(per_word, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Share of padded trigrams in common; 0 where neither text has one."""
    return F.coalesce(jaccard(padded_trigrams(a), padded_trigrams(b)), F.lit(0.0))


def sound_key(c: Column) -> Column:
    """How a folded text of two words at most sounds, roughly: each word's first letter and the classes of its later consonants without repeats."""
    key = F.array_join(F.transform(F.slice(F.split(c, " "), 1, 2), lambda w: F.concat(F.left(w, F.lit(1)), F.translate(F.substring(w, 2, 1_000_000), *SOUND_CLASSES))), " ")
    for digit in "123456":
        key = F.regexp_replace(key, f"{digit}+", digit)
    return key


def sounds_alike(a: Column, b: Column) -> Column:
    """Whether the first two words of two folded names sound alike; empty names don't."""
    return (a != "") & (b != "") & (sound_key(a) == sound_key(b))


def snake_name(name: str) -> str:
    """A column name in lower case with underscores before inner capitals and for anything else."""
    import re

    return re.sub(r"[^a-z0-9]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()).strip("_")


def snake_columns(df: DataFrame) -> DataFrame:
    """df with its columns' names in snake case; raises if two become one."""
    names = [snake_name(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("names clash")
    return df.toDF(*names)
