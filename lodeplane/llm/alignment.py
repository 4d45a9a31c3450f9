"""Aligning the tokens of two tokenizers by the bytes that they cover.

Workers run an Arrow pipeline over slices of texts. Both tokenizers end a token before every space that follows a character
other than white space, so a text is cut there into units, each different unit is encoded once (a bounded memory keeps them) and
a document's tokens are its units' token lists, taken and flattened. Parent indices of the flattened lists and cumulative sums of
token bytes, less the sum before the document, give each token's end in its document. A full outer Acero hash join of both
sides' (document, end) keys has a row for each stretch between neighbouring ends: sorted and filled backwards it names the one token
of each side that covers the stretch, so its rows are the links, and the rows that both sides share cut groups. Table.group_by
counts id pairs a document; these rows are stored, counted again across documents in each task, and merged by Spark.

Corpus counts come back to the documents in two ways that together cover every pair: the most frequent pairs, up to a stated
number, are sent to the tasks; the others, which are rare by then, meet their counts in a join.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import pieces, stored, table

#: Different units that a worker remembers, and characters of text that it aligns at once.
UNITS_HELD, PART_CHARS = 300_000, 1 << 20
#: New units that are encoded as one text.
UNITS_JOINED = 256
#: Id pairs whose counts are sent to the tasks (16 bytes each), and rows that a task holds while it counts pairs.
SENT_PAIRS, COUNTED_ROWS = 2_000_000, 1_000_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

DOCUMENT = "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Growing:
    """An int32 array that values are put at the end of."""

    def __init__(self, *first: int) -> None:
        self.held, self.size = np.zeros(1 << 16, np.int32), 0
        self.add(np.array(first, np.int32))

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.held):
            self.held = np.concatenate((self.held[: self.size], np.zeros(2 * end - self.size, np.int32)))
        self.held[self.size : end] = values
        self.size = end

    def values(self) -> np.ndarray:
        return self.held[: self.size]


class Side:
    """One tokenizer: the bytes of its ids, the lists of the units met so far, and its texts of ids with what may follow one."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], vocabulary: list[bytes], after: str) -> None:
        self.encode, self.vocabulary, self.spelling = encode, vocabulary, pa.array(vocabulary, pa.binary())
        self.lengths = pa.array([len(x) for x in vocabulary], pa.int64())
        # an id's text with a comma after it, with what ends its side of a group, and with nothing
        self.texts = [f"{i}{end}" for end in (",", after, "") for i in range(len(vocabulary))]
        self.forget()

    def forget(self) -> None:
        self.ids, self.ends = Growing(), Growing(0)

    def learn(self, units: list[str]) -> list[bool]:
        """Keep the units' tokens; whether each unit's bytes are those of a space and the unit.

        Units are encoded a few hundred at once, joined by spaces, as tokens end before each; their tokens are told apart by their bytes.
        A unit with white space at an end, which would run on into its neighbour's, is encoded alone.
        """
        spelled: list[bool] = []
        groups: list[list[str]] = []
        joinable = False
        for unit in units:
            alone = unit[0].isspace() or unit[-1].isspace()
            if alone or not joinable or len(groups[-1]) == UNITS_JOINED:
                groups.append([])
            groups[-1].append(unit)
            joinable = not alone
        for group, found in zip(groups, self.encode([" ".join(g) for g in groups]), strict=True):
            ids = pa.array(found, pa.int32())
            spelling, raw = self.spelling.take(ids), f" {' '.join(group)}".encode()
            ends = np.frombuffer(spelling.buffers()[1], np.int32, len(ids) + 1)[1:] if len(ids) else np.zeros(1, np.int32)
            bounds = np.cumsum(pc.binary_length(pa.array(group)).to_numpy() + 1)
            if ends[-1] == len(raw) and spelling.buffers()[2].slice(0, len(raw)).to_pybytes() == raw and np.isin(bounds, ends).all():
                self.keep(ids.to_numpy(), np.searchsorted(ends, bounds) + 1)
                spelled += [True] * len(group)
            else:
                for unit, ids in zip(group, self.encode(group), strict=True):
                    self.keep(np.array(ids, np.int32), np.array([len(ids)]))
                    spelled.append(b"".join([self.vocabulary[i] for i in ids]) == b" " + unit.encode())
        return spelled

    def keep(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self.ends.add(self.ids.size + ends)
        self.ids.add(ids)

    def tokens(self, units: pa.Array) -> pa.ListArray:
        """The token lists of units, by their numbers."""
        return pa.ListArray.from_arrays(pa.array(self.ends.values()), pa.array(self.ids.values())).take(units)


class Tokenizers(NamedTuple):
    """Both sides and the texts of their ids, the first side's before the second's."""

    a: Side
    b: Side
    texts: pa.Array


@functools.lru_cache(1)
def tokenizers(byte_level_path: str, pieces_path: str) -> Tokenizers:
    """Both tokenizers of a worker; the second one puts a space before what it encodes itself."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(byte_level_path)
    first.encode_special_tokens = True
    with open(byte_level_path) as f:
        ids = json.load(f)
    letters, names = byte_level_alphabet(), [""] * (max([*ids["model"]["vocab"].values(), *(x["id"] for x in ids["added_tokens"])]) + 1)
    for name, i in ids["model"]["vocab"].items():
        names[i] = name
    vocabulary = [bytes(letters[c] for c in name) for name in names]
    second = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
    spelled = [second.id_to_piece(i) for i in range(len(second))]
    spelled_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) and second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(spelled)]
    a = Side(lambda units: [x.ids for x in first.encode_batch_fast([f" {u}" for u in units], add_special_tokens=False)], vocabulary, "|")
    b = Side(lambda units: second.encode(units, num_threads=1), spelled_bytes, ";")
    return Tokenizers(a, b, pa.array(a.texts + b.texts, pa.large_string()))


class Units:
    """Numbers of the units met so far; forgets all of them when there are too many."""

    def __init__(self, both: Tokenizers, most: int) -> None:
        self.both, self.most = both, most
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        #: Units whose tokens don't spell them.
        self.odd = np.zeros(0, np.int32)
        self.both.a.forget()
        self.both.b.forget()

    def of(self, found: list[str]) -> np.ndarray:
        if len(self.numbers) > self.most:
            self.forget()
        if new := [u for u in dict.fromkeys(found) if u not in self.numbers]:
            first = len(self.numbers)
            self.numbers |= {u: first + i for i, u in enumerate(new)}
            spelled = np.array(self.both.a.learn(new)) & np.array(self.both.b.learn(new))
            self.odd = np.append(self.odd, first + np.flatnonzero(~spelled)).astype(np.int32)
        return np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found))


def ends_of(lists: pa.ListArray, side: Side) -> pa.Table:
    """A row a token: its document (the list's index), the byte after it in the document, its id."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    sums = pc.cumulative_sum(side.lengths.take(ids))
    starts = lists.offsets.slice(0, len(lists))
    before = pa.concat_arrays([pa.array([0], pa.int64()), sums]).take(starts)
    return pa.table({"doc": doc, "end": pc.subtract(sums, before.take(doc)), "id": ids})


def links_of(a: pa.Table, b: pa.Table) -> pa.Table:
    """Rows (doc, end, a, b, cut) in order, one a link; cut where a group ends."""
    joined = a.rename_columns(["doc", "end", "a"]).join(b.rename_columns(["doc", "end", "b"]), ["doc", "end"], join_type="full outer", use_threads=False)
    joined = joined.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()
    cut = pc.and_(pc.is_valid(joined["a"]), pc.is_valid(joined["b"]))
    # documents end with both a token of a and one of b, so nothing is filled across documents
    return pa.table({"doc": joined["doc"], "a": pc.fill_null_backward(joined["a"]), "b": pc.fill_null_backward(joined["b"]), "cut": cut, "in_a": pc.is_valid(joined["a"]), "in_b": pc.is_valid(joined["b"])})


def _flag(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64)


def group_texts(links: pa.Table, both: Tokenizers) -> tuple[pa.Array, np.ndarray]:
    """The texts of all ids in the order of groups, each with what follows it, and the document of each."""
    doc, cut = links["doc"].to_numpy(), _flag(links["cut"])
    group = np.cumsum(cut) - cut
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
    codes, keys, docs = [], [], []
    for order, (side, name, ids) in enumerate(((both.a, "in_a", "a"), (both.b, "in_b", "b"))):
        at = np.flatnonzero(links[name].to_numpy())
        ends_group = cut[at] == 1
        kind = np.where(ends_group & (last[at] & (order == 1)), 2, np.where(ends_group, 1, 0))
        codes.append(links[ids].to_numpy()[at].astype(np.int64) + kind * len(side.vocabulary) + order * len(both.a.texts))
        keys.append(group[at] * 2 + order)
        docs.append(doc[at])
    place = np.argsort(np.concatenate(keys), kind="stable")
    return both.texts.take(pa.array(np.concatenate(codes)[place])), np.concatenate(docs)[place]


class Part:
    """What one document has so far: sums, the hash of its groups, and pairs with their counts."""

    def __init__(self) -> None:
        self.sums, self.hash, self.pairs = np.zeros(4, np.int64), None, []

    def add(self, sums: np.ndarray, text: memoryview, pairs: list[np.ndarray]) -> None:
        if self.hash is None:
            self.hash = hashlib.sha256(text)
        else:
            self.hash.update(b";")
            self.hash.update(text)
        self.sums += sums
        self.pairs.append(pairs)

    def counted(self) -> list[np.ndarray]:
        if len(self.pairs) < 2:
            return self.pairs[0] if self.pairs else [np.zeros(0, np.int32)] * 3
        t = pa.table({n: np.concatenate([p[i] for p in self.pairs]) for i, n in enumerate("abn")}).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
        return [t[c].to_numpy() for c in ("a", "b", "n_sum")]


def align(found: list[np.ndarray], both: Tokenizers, parts: list[Part]) -> None:
    """Add the tokens of each list of units, none of them empty, to its part."""
    units, sizes = pa.array(np.concatenate(found)), np.cumsum([0, *map(len, found)])

    def of_documents(side: Side) -> pa.ListArray:
        lists = side.tokens(units)
        return pa.ListArray.from_arrays(lists.offsets.take(pa.array(sizes)), lists.values)

    links = links_of(*(ends_of(of_documents(x), x) for x in (both.a, both.b)))
    n = len(parts)
    doc = links["doc"].to_numpy()
    sums = np.stack([np.bincount(doc, w, n) for w in (_flag(links["in_a"]), _flag(links["in_b"]), _flag(links["cut"]), np.ones(len(doc)))], 1).astype(np.int64)
    texts, of = group_texts(links, both)
    raw, at = memoryview(texts.buffers()[2]), np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    bounds = at[np.searchsorted(of, np.arange(n + 1))]
    pairs = links.select(["doc", "a", "b"]).group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc")
    of_pair, columns = pairs["doc"].to_numpy(), [pairs[c].to_numpy() for c in ("a", "b", "count_all")]
    where = np.searchsorted(of_pair, np.arange(n + 1))
    for i, part in enumerate(parts):
        part.add(sums[i], raw[bounds[i] : bounds[i + 1]], [c[where[i] : where[i + 1]] for c in columns])


def stretches(text: str, most: int) -> Iterator[str]:
    """A text in stretches of about `most` characters, cut where units are cut."""
    at = 0
    while len(text) - at > most:
        cut = _CUT.search(text, at + most)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def aligned(docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", units_held: int = UNITS_HELD, part_chars: int = PART_CHARS) -> DataFrame:
    """A stored table with a row a document: rid (a number of the row), its id, sums, hash of its groups, and its id pairs with counts in lists a, b, n."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def rows(ids: list, numbers: Iterable[int], parts: list[Part]) -> pa.RecordBatch:
        pairs = [p.counted() for p in parts]
        offsets = pa.array(np.cumsum([0, *(len(x[0]) for x in pairs)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[i] for x in pairs]), kind)) for i, kind in enumerate((pa.int32(), pa.int32(), pa.int64()))]
        sums = np.stack([p.sums for p in parts])
        sha = [p.hash.hexdigest() if p.hash else "" for p in parts]
        columns = [pa.array(numbers, pa.int64()), pa.array(ids, pa.int64()), *(pa.array(sums[:, i]) for i in range(4)), pa.array(sha), *lists]
        return pa.RecordBatch.from_arrays(columns, names=["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(byte_level_path, pieces_path)
        units, at = Units(both, units_held), TaskContext.get().partitionId() << 33

        def numbered(text: str) -> np.ndarray | None:
            """The text's units; none if one of them isn't what its tokens spell."""
            found = units.of(_CUT.split(text))
            return None if np.isin(found, units.odd).any() else found

        for batch in pieces(batches, "text"):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            parts = [Part() for _ in texts]
            if len(texts) == 1 and len(texts[0] or "") > part_chars:  # checked to its end first, as one wrong unit leaves the document without tokens
                if all(numbered(x) is not None for x in stretches(texts[0], part_chars)):
                    for x in stretches(texts[0], part_chars):
                        align([numbered(x)], both, parts)
            else:
                cut = [_CUT.split(t) if t else [] for t in texts]
                flat = units.of(list(chain.from_iterable(cut)))
                odd, ends = np.isin(flat, units.odd), np.cumsum([0, *map(len, cut)])
                good = [i for i in range(len(texts)) if cut[i] and not odd[ends[i] : ends[i + 1]].any()]
                if good:
                    align([flat[ends[i] : ends[i + 1]] for i in good], both, [parts[i] for i in good])
            yield rows(ids, range(at, at + len(ids)), parts)
            at += len(ids)

    return stored(source.mapInArrow(run, DOCUMENT + ", a array<int>, b array<int>, n array<long>"), "aligned")


def _pair_keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a batch as single numbers, with their counts."""
    a, b, n = (pc.list_flatten(batch.column(c)).to_numpy(zero_copy_only=False) for c in "abn")
    return a.astype(np.int64) << 32 | b, n


def pair_counts(found: DataFrame) -> DataFrame:
    """Rows (pair, n) over all documents; pair is the first id times 2**32 plus the second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.Table:
            return pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        for batch in batches:
            pair, n = _pair_keys(batch)
            held.append(pa.table({"pair": pair, "n": n}))
            size += len(pair)
            if size > COUNTED_ROWS:
                held = [counted()]
                size = len(held[0])
                if size > COUNTED_ROWS // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from counted().to_batches()

    return found.select("a", "b", "n").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_counts(found: DataFrame, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """The documents of `aligned` with n_best and count_sum."""
    spark = found.sparkSession
    counts = pair_counts(found).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    counts = stored(counts, "pair-counts")
    tops = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("top")))  # a row an id of the second vocabulary
    counts = counts.join(tops, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))

    # the least power of two such that the pairs of that count or more are few enough
    sizes = sorted((counts.groupBy((F.length(F.bin("n")) - 1).alias("bits")).count().collect()), reverse=True)  # at most 63 rows
    least, held = 1 << 62, 0
    for bits, n in sizes:
        held += n
        if held > sent_pairs:
            break
        least = 1 << bits
    rest = any((1 << bits) < least for bits, _ in sizes)
    sent = counts.filter(F.col("n") >= least).toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast(tuple(sent[c].to_numpy() for c in ("pair", "n", "best")))

    def looked_up(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = known.value[0]
        at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
        return at, (keys[at] == pair if len(keys) else np.zeros(len(pair), bool))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = _pair_keys(batch)
            at, seen = looked_up(pair)
            at, times, doc = at[seen], n[seen], pc.list_parent_indices(batch.column("a")).to_numpy()[seen]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], doc, times * known.value[2][at])
            np.add.at(sums[1], doc, times * known.value[1][at])
            kept = [batch.column(c) for c in ("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, sums)], names=["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"])

    out = found.mapInArrow(summed, DOCUMENT + ", n_best long, count_sum long")
    if rest:

        def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pair, n = _pair_keys(batch)
                at = np.flatnonzero(~looked_up(pair)[1])
                rid = batch.column("rid").to_numpy()[pc.list_parent_indices(batch.column("a")).to_numpy()[at]]
                yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(pair[at]), pa.array(n[at])], names=["rid", "pair", "times"])

        rare = found.select("rid", "a", "b", "n").mapInArrow(unseen, "rid long, pair long, times long")
        rare = rare.join(counts.filter(F.col("n") < least), "pair").groupBy("rid").agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
        )
        out = out.join(rare, "rid", "left").withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def cross_tokenizer_alignment(docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """How the tokens of two tokenizers cover each document of docs.

    One row a document: doc_id, n_a and n_b (tokens), n_groups (stretches between byte offsets where tokens of both end), n_links (token pairs
    with a common byte), n_best (links whose id pair has the corpus-wide highest count of its second id, ties included),
    count_sum (the counts of its links' id pairs) and groups_sha256 over `a1,a2|b1;a3|b2,b3`. A text that is null, empty, or not what
    its tokens spell has zeros and the empty string, and counts nowhere. Repeated rows and null ids are rows like any others and count each
    time; an empty table gives no rows; docs' other columns aren't read.
    """
    return with_counts(aligned(docs, byte_level_path, pieces_path, id_col, text_col), sent_pairs)


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str, paths: Callable[[], tuple[str, str]] = tokenizer_files) -> DataFrame:
    """All documents under the byte-level vocabulary of 50 k and the pieces of 32 k."""
    return cross_tokenizer_alignment(table(spark, sf_dir, "documents"), *paths())
