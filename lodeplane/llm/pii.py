"""Personal data: fixed patterns, and terms that corpus co-occurrence shows to give protected entities away.

Protected entities are the values that the patterns find, unguessable values (keys, tokens), and the groups that values belong to:
their kind, an email's domain, an address's networks, a card's issuer digits, a phone's country and area digits. A name that stands by
one address in many texts discloses that address; a company's name its domain; the word before a key the class of keys.

From all documents it's counted how many hold an entity, how many a term, and how many have the term near the entity. A term discloses an
entity if its pointwise mutual information with it, log p(e|t)/p(e), is at least `threshold` of the entity's information -log p(e), where
p(e|t) is the share of the documents with the term that have it near the entity. Terms are words of any kind, numbers too. They need
`support` different contexts, in one document or in several (copies of a context count once), and these must be beyond chance: contexts
times the logarithm of p(e|t) over the entity's share of all word places must reach SIGNIFICANCE nats.

A disclosing term is generalised wherever it stands, or removed from `remove_at` on. An unguessable value counts as a secret, and is
generalised, where a term that discloses the class of secrets stands within CUE_WORDS words before it; others stay as they are.
Terms and secrets that overlap a pattern's span, or a secret, aren't marked; of two equal rows each is marked.

Counting is by keys, summed in tasks first and joined in Spark. The driver holds a filter of fixed size, and disclosing terms up to
BROADCAST_TERMS; beyond those, the terms of each document come to it by a join.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import FILTER_BITS, first_filter, passing, pieces, shield, stored, strings, table, utf8
from lodeplane.llm.words import Words, in_sorted, shingles, words

#: Kinds of spans by number; the first four are the base patterns.
KINDS = ("email", "ip", "card", "phone", "secret", "term")
BASE, SECRET, TERM = 4, 4, 5
#: Words before and after an entity that count as near it.
NEAR_WORDS = 8
SUPPORT = 3
THRESHOLD = 0.9
REMOVE_AT = 0.999
SIGNIFICANCE = 9.0
#: Words before an unguessable value among which a cue must stand.
CUE_WORDS = 3
#: An unguessable value: its least length, bits a character, and changes between letter and digit a character.
SECRET_CHARS, SECRET_BITS, SECRET_CHANGES = 20, 3.0, 1 / 8
#: Disclosing terms (16 bytes each) that are sent to the tasks as a whole.
BROADCAST_TERMS = 1_000_000
#: Rows that a task holds before it passes them on.
HELD_ROWS = 1 << 20

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, found from their @: all that stands before it must come right before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that don't overlap within the kind, without those that fail its test."""
    out = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NO_DIGITS.sub("", m[0]) if len(m[0]) < 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NO_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


_IN_SECRET = np.zeros(256, bool)
_IN_SECRET[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True


def unguessable(value: str) -> bool:
    """Whether the value's characters are spread and mixed as in a random key, and not as in words with a date."""
    n = len(value)
    changes = sum(a.isdigit() and b.isalpha() or a.isalpha() and b.isdigit() for a, b in zip(value, value[1:], strict=False))
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value.lower()).values())
    return n >= SECRET_CHARS and changes >= SECRET_CHANGES * n and bits >= SECRET_BITS


def unguessable_places(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, first byte, end) of the unguessable values of a batch, in order."""
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[:-1] = _IN_SECRET[raw]
    cuts = np.diff(inside, prepend=np.int8(0))
    start, end = np.flatnonzero(cuts == 1), np.flatnonzero(cuts == -1)
    # a run over the edge of rows is one for each row
    edges = offsets[1:-1]
    edges = np.unique(edges[(edges > 0) & (edges < len(raw))])
    edges = edges[(inside[edges - 1] == 1) & (inside[edges] == 1)]
    start, end = np.sort(np.concatenate((start, edges))), np.sort(np.concatenate((end, edges)))
    long = end - start >= SECRET_CHARS
    start, end = start[long], end[long]
    row = np.searchsorted(offsets, start, side="right") - 1
    places = zip(row.tolist(), start.tolist(), end.tolist(), strict=True)
    return [(r, a, b) for r, a, b in places if unguessable(raw[a:b].tobytes().decode("ascii"))]


class Characters:
    """Code points of places in a batch of UTF-8 texts."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray) -> None:
        self.before = np.zeros(len(raw) + 1, np.int32 if len(raw) < 1 << 31 else np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=self.before[1:])
        self.offsets = offsets

    def of(self, row: int, place: int) -> int:
        return int(self.before[place] - self.before[self.offsets[row]])


def spans_of(column: pa.Array) -> tuple[list[str], list[list[Span]], list[list[Span]]]:
    """The texts of a batch, the patterns' spans of each, and its unguessable values that overlap none of these."""
    texts = strings(column)
    base = [base_spans(x) for x in texts]
    raw, offsets = utf8(column)
    found: list[list[Span]] = [[] for _ in texts]
    if places := unguessable_places(raw, offsets):
        at = Characters(raw, offsets)
        for row, a, b in places:
            a, b = at.of(row, a), at.of(row, b)
            if all(b <= s or e <= a for s, _, e in base[row]):
                found[row].append((a, SECRET, b))
    return texts, base, found


def entity(name: str) -> int:
    """The number of an entity; 0 and 1 are never one."""
    return xxhash.xxh3_64_intdigest(name) | 2


def entities_of(kind: int, value: str) -> list[int]:
    """The entities that a value of a kind stands for: itself, its groups, its class."""
    name, value = KINDS[kind], value.lower()
    groups = [f"={value}"]
    digits = _NO_DIGITS.sub("", value)
    if name == "email":
        groups.append("@" + value.rpartition("@")[2])
    elif name == "ip":
        parts = value.split(".")
        groups += [":" + ".".join(parts[:2]), ":" + ".".join(parts[:3])]
    elif name == "card":
        groups.append(":" + digits[:6])
    elif name == "phone":
        groups.append(":" + digits[:-7])
    return [entity(name + x) for x in [*groups, ""]]


#: The class of unguessable values: what discloses it is a cue.
SECRETS = np.uint64(entity("secret")).view(np.int64).item()


def entity_contexts(docs: DataFrame, near: int = NEAR_WORDS) -> DataFrame:
    """Rows (entity, term, context, n): the term stands near the entity in this context; the sum of n is the number of such documents.

    A document counts in the first of its contexts. Term 0 counts documents with the entity.
    """
    names = ["entity", "term", "context", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            before, after, owners = [], [], []
            for row, (text, *spans) in enumerate(zip(*spans_of(batch.column(0)), strict=True)):
                for a, kind, b in (*spans[0], *spans[1]):
                    before.append(words_around(text, a, near, -1))
                    after.append(words_around(text, b, near, 1))
                    owners.append((row, entities_of(kind, text[a:b])))
            front, back = words(pa.array(before, pa.large_string())), words(pa.array(after, pa.large_string()))
            found: dict[tuple[int, int], dict[tuple[int, int], None]] = {}
            for i, (row, own) in enumerate(owners):
                terms = np.concatenate((front.key[front.first[i] : front.first[i + 1]][-near:], back.key[back.first[i] : back.first[i + 1]][:near]))
                context = int(shingles(terms, len(terms))[0]) if len(terms) else 0
                pairs = dict.fromkeys((t, context) for t in terms.tolist())
                for e in own:
                    found.setdefault((row, e), {(0, 0): None}).update(pairs)
            rows = []
            for (_, e), pairs in found.items():
                seen: set[int] = set()
                for term, context in pairs:
                    rows.append((e, term, context, int(term not in seen)))
                    seen.add(term)
            table = np.array(rows, np.uint64).reshape(len(rows), 4).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, j]) for j in range(4)], names=names)

    pairs = docs.select("text").mapInArrow(run, "entity long, term long, context long, n long")
    return pairs.groupBy("entity", "term", "context").agg(F.sum("n").alias("n"))


def words_around(text: str, at: int, near: int, step: int) -> str:
    """What stands before (step -1) or after a place: more than `near` words, so that the nearest are whole, or all there is."""
    reach = 24 * near
    while True:
        part = text[max(0, at - reach) : at] if step < 0 else text[at : at + reach]
        if len(part) < reach or sum(1 for _ in _WORD.finditer(part)) > near:
            return part
        reach *= 2


def documents_with(docs: DataFrame, seen: np.ndarray) -> DataFrame:
    """Rows (term, n_t): how many documents hold each term that passes the filter. Term 0 counts all documents, term 1 all words."""

    def rows(terms: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], names=["term", "n"])

    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        terms, at = np.unique(np.concatenate([t for t, _ in held]), return_inverse=True)
        return terms, np.bincount(at, np.concatenate([n for _, n in held]), len(terms)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n_docs, n_words = [], 0, 0, 0
        for batch in pieces(batches):
            w = words(batch.column(0))
            n_docs, n_words = n_docs + batch.num_rows, n_words + len(w.key)
            place = passing(seen, w.key)
            row = np.searchsorted(w.first, place, side="right") - 1
            order = np.lexsort((row, w.key[place]))
            key, row = w.key[place][order], row[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            held.append(np.unique(key[new], return_counts=True))
            size += len(held[-1][0])
            if size > HELD_ROWS:
                held = [summed(held)]
                size = len(held[0][0])
                if size > HELD_ROWS // 2:
                    yield rows(*held[0])
                    held, size = [], 0
        if held:
            yield rows(*summed(held))
        yield rows(np.array([0, 1], np.uint64), np.array([n_docs, n_words]))

    return docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_t"))


def disclosing_terms(docs: DataFrame, support: int = SUPPORT, threshold: float = THRESHOLD, near: int = NEAR_WORDS, significance: float = SIGNIFICANCE) -> DataFrame:
    """Rows (term, disclosure, cue): hashes of the terms that disclose some entity, with the highest share of its information; cue: the class of secrets."""
    contexts = stored(entity_contexts(docs, near), "contexts")
    by_pair = contexts.groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("n").alias("n_et"))
    held, beside = F.col("term") == 0, F.col("term") != 0
    entities = by_pair.groupBy("entity").agg(F.sum(F.when(held, F.col("n_et"))).alias("n_e"), F.coalesce(F.sum(F.when(beside, F.col("n_et"))), F.lit(0)).alias("places"))
    pairs = stored(by_pair.filter(beside & (F.col("contexts") >= support)), "pairs")
    counts = stored(documents_with(docs, first_filter(pairs, "term")), "counts")
    totals = {r["term"]: r["n_t"] for r in counts.filter("term IN (0, 1)").collect()}
    n_docs, n_words = max(1, totals.get(0, 0)), max(1, totals.get(1, 0))
    # no entity has more information than log n_docs: most pairs need none
    possible = pairs.join(counts, "term").withColumn("p", F.col("n_et") / F.col("n_t")).filter(F.col("p") >= n_docs ** (threshold - 1) * (1 - 1e-9))
    surprise = -F.log(F.col("n_e") / F.lit(float(n_docs)))
    share = F.when(surprise > 0, (F.log("p") + surprise) / surprise)
    beyond_chance = F.col("contexts") * F.log(F.col("p") / F.least(F.lit(1.0), F.col("places") / F.lit(float(n_words))))
    known = possible.join(entities, "entity").withColumn("disclosure", share).filter((F.col("disclosure") >= threshold) & (beyond_chance >= significance))
    return known.groupBy("term").agg(F.max("disclosure").alias("disclosure"), F.max(F.col("entity") == SECRETS).alias("cue"))


Terms = tuple[np.ndarray, np.ndarray, np.ndarray]  # sorted hashes, disclosure, cue


def sorted_terms(rows: list[tuple[int, float, bool]]) -> Terms:
    rows = sorted((t & ((1 << 64) - 1), d, c) for t, d, c in set(rows))
    return np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows], bool)


def terms_of_documents(docs: DataFrame, terms: DataFrame, row: str) -> DataFrame:
    """Rows (row, _terms): of the documents (numbered by the column row) that hold terms, these with disclosure and cue."""
    seen = first_filter(terms, "term")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            w = words(batch.column(1))
            place = passing(seen, w.key)
            own = np.searchsorted(w.first, place, side="right") - 1
            pairs = np.unique(np.stack([batch.column(0).to_numpy()[own].view(np.uint64), w.key[place]]), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=[row, "term"])

    held = docs.select(row, "text").mapInArrow(run, f"`{row}` long, term long")
    return held.join(terms, "term").groupBy(row).agg(F.collect_list(F.struct("term", "disclosure", "cue")).alias("_terms"))


def mark(docs: DataFrame, terms: Terms | None, rewrite: bool, remove_at: float = REMOVE_AT) -> DataFrame:
    """docs (with a string column text) plus spans. Without terms, docs has those of each document in a column _terms. rewrite: text is sanitised."""
    names = [c for c in docs.columns if c != "_terms"]
    kinds = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            column = batch.column("text")
            of = terms
            if of is None:  # a term discloses in every document: those of all rows of the batch
                of = sorted_terms([(t["term"], t["disclosure"], t["cue"]) for x in batch.column("_terms").to_pylist() for t in x or ()])
            texts, spans, removed = marked(column, of, remove_at)
            own = [batch.column(c) for c in names]
            if rewrite:
                clean = [sanitised(t, x, removed[i]) if x else t for i, (t, x) in enumerate(zip(texts, spans, strict=True))]
                own[names.index("text")] = pa.array(clean, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))
            out = pa.array([[{"start": a, "kind": k, "end": b} for a, k, b in x] for x in spans], kinds)
            yield pa.RecordBatch.from_arrays([*own, out], names=[*names, "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    return docs.mapInArrow(run, f"{fields}, spans array<struct<start: int, kind: int, end: int>>")


def marked(column: pa.Array, terms: Terms, remove_at: float) -> tuple[list[str], list[list[Span]], list[set[int]]]:
    """The texts of a batch, all spans of each in order, and the places of those to remove."""
    keys, disclosure, cue = terms
    texts, spans, secrets = spans_of(column)
    removed: list[set[int]] = [set() for _ in texts]
    if len(keys):
        w = words(column)
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[keys >> np.uint64(64 - FILTER_BITS)] = True
        place = passing(seen, w.key)
        at, there = in_sorted(w.key[place], keys)
        place, at = place[there], at[there]
        row = np.searchsorted(w.first, place, side="right") - 1
        chars = Characters(w.low, w.offsets)
        begin = chars.before[w.start[place]] - chars.before[w.offsets[row]]
        end = chars.before[w.end[place]] - chars.before[w.offsets[row]]
        hits: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        for r, a, b, word, term in zip(row.tolist(), begin.tolist(), end.tolist(), place.tolist(), at.tolist(), strict=True):
            hits[r].append((a, b, word, term))
        for r, found in enumerate(hits):
            if not found:
                continue
            cues = [(a, word) for a, _, word, term in found if cue[term]]
            spans[r] = sorted(spans[r] + [x for x in secrets[r] if has_cue(x[0], cues, w, chars, r)])
            spans[r], removed[r] = with_terms(spans[r], [(a, b, disclosure[term] >= remove_at) for a, b, _, term in found])
    return texts, spans, removed


def has_cue(at: int, cues: list[tuple[int, int]], w: Words, chars: Characters, row: int) -> bool:
    """Whether one of the cues (place, number of the word) is among the CUE_WORDS words before a place."""
    near = [word for a, word in cues if a < at]
    if not near:
        return False
    last = min(int(w.first[row + 1]), near[-1] + CUE_WORDS + 1)
    starts = chars.before[w.start[near[-1] : last]] - chars.before[w.offsets[row]]
    return int(np.searchsorted(starts, at)) <= CUE_WORDS


def with_terms(spans: list[Span], terms: list[tuple[int, int, bool]]) -> tuple[list[Span], set[int]]:
    """Sorted spans with the terms (place, end, whether to remove; in order) that overlap none, and the places of those to remove."""
    added, removed, i, reach = [], set(), 0, 0
    for a, b, gone in terms:
        while i < len(spans) and spans[i][0] < b:
            reach = max(reach, spans[i][2])
            i += 1
        if reach <= a:
            added.append((a, TERM, b))
            if gone:
                removed.add(a)
    return sorted(spans + added), removed


def sanitised(text: str, spans: list[Span], removed: set[int]) -> str:
    """The text with each run of overlapping spans replaced by the first one's class, or by nothing where its start is in `removed`."""
    out, done = [], 0
    for a, kind, b in spans:
        if a >= done:
            out += [text[done:a], "" if a in removed else f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def find_personal_data(docs: DataFrame, rewrite: bool = False, broadcast_terms: int = BROADCAST_TERMS, remove_at: float = REMOVE_AT, **options) -> DataFrame:
    """docs (with a string column text) plus spans (start, kind as a number in KINDS, end; code points, end exclusive) in order.

    rewrite: text is sanitised: matches of the patterns and generalised terms become their class in brackets, removed terms nothing.
    A null text has no spans and stays null. Repeated rows count as often as they stand there. A column spans of docs is replaced.
    """
    docs = docs.drop("spans")
    terms = stored(disclosing_terms(docs, **options), "terms")
    if terms.count() <= broadcast_terms:
        return mark(docs, sorted_terms([tuple(r) for r in terms.collect()]), rewrite, remove_at)
    keyed = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "documents")  # stored: numbers must not change
    with_terms = keyed.join(terms_of_documents(keyed, terms, "_row"), "_row", "left")
    return mark(with_terms.drop("_row"), None, rewrite, remove_at)


def without_personal_data(docs: DataFrame, **options) -> DataFrame:
    """docs with text sanitised and, where docs has it, n_chars counted again."""
    inner, restore = shield(docs, "text", *(["n_chars"] if "n_chars" in docs.columns else []))
    found = find_personal_data(inner, rewrite=True, **options)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return restore(found)


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x.kind + 1), x.start, x.end)), ",")


def op10_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    base = F.filter("spans", lambda x: x.kind < BASE)
    digest = F.sha2(written(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *[count(k) for k in range(BASE)], digest, written(F.col("spans")).alias("spans"), count(SECRET), count(TERM))
