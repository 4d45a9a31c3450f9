"""Near duplicates: an n-gram Jaccard join by MinHash banding, with verification on whole n-gram sets.

1. Each text's set of word n-grams is hashed; texts with the same set are one class (exact copies and the like), kept once.
2. Bands of MinHash rows, counts chosen for the target recall at the threshold, are shuffled; classes that share a band are tied
   to the least class of that band, and the ties' connected components hold all candidate pairs.
3. Classes are ordered by component, then by the least of the bands that they share, so that classes alike stand together, and cut into
   blocks of bounded size. Pairs of blocks that share a band are compared in one task each, on the whole n-gram sets, so that neither a
   large component nor a hot band meets in one task and no pair becomes a row. Within a task only classes that bands tie are compared. A
   task returns each class's number of links and a spanning forest of them.
4. Components of the forests are the groups.

A component of one block is compared once. In a larger one a block goes to each block that it shares a band with: n classes in one band
are sent n / 1024 times at most, as all of them must be compared with each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeplane.llm.common import shield, pieces, stored, table
from lodeplane.llm.words import mixed, shingles, words
from lodeplane.operators.graph import connected_components, stars

NGRAM, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9995, 160
#: Size of a block in n-grams; a class counts LEAST_GRAMS at least, so that a block has 1024 classes at most.
BLOCK_GRAMS, LEAST_GRAMS = 1 << 19, 1 << 9
#: Classes whose keys are sent to the tasks as a whole (24 bytes each), for picking their texts.
BROADCAST_KEYS = 1_000_000
#: Columns of the matrices that a task multiplies at once.
COLUMNS = 1024
#: Rows of the matrix of pairs that are looked through at once.
ROWS = 128


def bands_for(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """The most rows a band, and the bands, with which a pair at the threshold shares a band with the target probability."""
    best = None
    for rows in range(1, max_hashes + 1):
        p = threshold**rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-p))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("max_hashes is too small for the target recall")
    return best


def ngram_sets(column: pa.Array, n: int = NGRAM) -> list[np.ndarray]:
    """The sorted hashes of each text's n-grams of words; a text of fewer words is one n-gram, one without words has none."""
    w = words(column)
    grams = shingles(w.key, n)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        out.append(np.unique(grams[a : b - n + 1]) if b - a >= n else shingles(w.key[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def coefficients(hashes: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, hashes, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, hashes, np.uint64)


def min_hashes(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The upper halves of the least of a*x + b over the set, for each pair of coefficients."""
    low = np.full(len(a), np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for i in range(0, len(grams), 256):
            low = np.minimum(low, (grams[i : i + 256, None] * a + b).min(axis=0))
    return low >> np.uint64(20)


def signatures(docs: DataFrame, bands: int, rows: int, n: int) -> DataFrame:
    """doc_id, text_key (a hash of the text), set_key (128 bits), n_grams and band keys of each row of docs (doc_id, text, text_key)."""
    out = "doc_id long, text_key long, set_key binary, n_grams int, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coefficients(bands * rows)
        salt = mixed(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in pieces(batches, 1):
            sets = ngram_sets(batch.column(1), n)
            keys, own = [], []
            with np.errstate(over="ignore"):
                for s in sets:
                    keys.append(np.array([mixed(s).sum(dtype=np.uint64), mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64).tobytes())
                    if len(s):
                        own.append(shingles_of_rows(min_hashes(s, a, b).reshape(bands, rows), salt).view(np.int64))
                    else:
                        own.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array([len(s) for s in sets], pa.int32()), pa.array(own, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "set_key", "n_grams", "bands"],
            )

    return docs.select("doc_id", "text", "text_key").mapInArrow(run, out)


def shingles_of_rows(rows: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """One key for each band from its rows and its number."""
    key = salt.copy()
    with np.errstate(over="ignore"):
        for j in range(rows.shape[1]):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key


def tied_parts(bands: np.ndarray) -> list[np.ndarray]:
    """Places of the classes (rows of band keys) that bands tie together, in parts of at least two."""
    n, width = bands.shape
    flat = bands.ravel()
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(n), width)[order]
    new = np.ones(n * width, bool)
    new[1:] = flat[order][1:] != flat[order][:-1]
    root = forest(n, owner, owner[np.flatnonzero(new)][np.cumsum(new) - 1])  # each with the first class of its key
    by_root = np.argsort(root, kind="stable")
    cuts = np.flatnonzero(np.diff(root[by_root])) + 1
    return [x for x in np.split(by_root, cuts) if len(x) > 1]


def links_in_blocks(side: np.ndarray, across: bool, keys: np.ndarray, sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places) with a band in common whose sets are alike: of side 0 with side 1 if across, else all; part by part."""
    found = []
    for part in tied_parts(keys) if len(keys) else []:
        left, right = part[side[part] == 0], part[side[part] == 1]
        if len(left) and (len(right) or not across):
            own = {p: i for i, p in enumerate(part.tolist())}
            place = lambda x: [own[p] for p in x.tolist()]  # noqa: E731, B023
            a, b = links_in_block(place(left), place(right) if across else None, keys[part], [sets[p] for p in part.tolist()], threshold)
            found.append((part[a], part[b]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def links_in_block(left: list[int], right: list[int] | None, keys: np.ndarray, sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places) with a band in common whose sets are alike: within left, or of left with right."""
    rows, cols = np.array(left), np.array(left if right is None else right)
    candidate = np.zeros((len(rows), len(cols)), bool)
    for j in range(keys.shape[1]):
        candidate |= keys[rows, j][:, None] == keys[cols, j][None, :]
    if right is None:
        candidate = np.triu(candidate, 1)
    used = np.unique(np.concatenate((rows[candidate.any(axis=1)], cols[candidate.any(axis=0)])))
    if not len(used):
        return rows[:0], cols[:0]
    size = np.array([len(s) for s in sets])
    column, times = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True, return_counts=True)[1:]
    owner = np.repeat(used, size[used])
    shared = np.cumsum(times > 1) - 1
    keep = times[column] > 1
    column, owner, n_columns = shared[column[keep]], owner[keep], int((times > 1).sum())
    common = np.zeros((len(rows), len(cols)), np.float32)
    at_row, at_col = np.full(len(sets), -1), np.full(len(sets), -1)
    at_row[rows], at_col[cols] = np.arange(len(rows)), np.arange(len(cols))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = min(COLUMNS, max(1, n_columns))
    for start in range(0, n_columns, width):
        lo, hi = np.searchsorted(column, (start, start + width))
        x, y = np.zeros((len(rows), width), np.float32), np.zeros((len(cols), width), np.float32)
        c, o = column[lo:hi] - start, owner[lo:hi]
        x[at_row[o][at_row[o] >= 0], c[at_row[o] >= 0]] = 1
        y[at_col[o][at_col[o] >= 0], c[at_col[o] >= 0]] = 1
        common += x @ y.T
    found = []
    for start in range(0, len(rows), ROWS):
        inter = common[start : start + ROWS].astype(np.int64)
        both = size[rows[start : start + ROWS]][:, None] + size[cols][None, :]
        i, j = np.nonzero(candidate[start : start + ROWS] & (inter >= threshold * (both - inter) - 1e-9))
        found.append((rows[start + i].astype(np.int32), cols[j].astype(np.int32)))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place that edges between places a and b lead to, for each of n places."""
    node, least = stars(a.astype(np.int64), b.astype(np.int64))
    root = np.arange(n)
    root[node] = least
    return root


def in_blocks(members: DataFrame, block_grams: int) -> DataFrame:
    """members (component, near, class, n_grams) plus block: the order by component, near and class, cut where sizes reach block_grams.

    Rows are dealt by range, so that a large component spreads over tasks; a partition's sizes begin with those of the partitions before it.
    """
    order = ["component", "near", "class"]
    dealt = members.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    dealt = stored(dealt.withColumn("_size", F.greatest("n_grams", F.lit(LEAST_GRAMS)).cast("long")), "ordered")
    before, total = [], 0
    for part, size in sorted(map(tuple, dealt.groupBy("_part").agg(F.sum("_size")).collect())):  # a row a partition
        before.append((part, total))
        total += size
    starts = members.sparkSession.createDataFrame(before, "_part int, _before long")
    upto = F.sum("_size").over(Window.partitionBy("_part").orderBy(*order)) - F.col("_size")
    block = F.floor((F.col("_before") + upto) / block_grams).cast("long")
    return dealt.join(F.broadcast(starts), "_part").withColumn("block", block).drop("_part", "_size", "_before")


def near_duplicates(
    docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES,
    block_grams: int = BLOCK_GRAMS, broadcast_keys: int = BROADCAST_KEYS,
) -> tuple[DataFrame, DataFrame]:
    """(rows, classes) for docs (doc_id, text).

    rows: doc_id, text_key (a hash of the text; null as empty), set_key, n_grams for each row of docs. classes: set_key, first_id and first_key (its
    least row by doc_id, nulls first, then text_key), n_rows, group (number), n_links (rows of other classes alike). Texts
    without words are in no class. Repeated rows are rows of one class. An empty table gives empty tables.
    """
    bands, rows = bands_for(threshold, recall, max_hashes)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    signed = stored(signatures(source, bands, rows, n), "signatures")
    least = F.min(F.struct("doc_id", "text_key")).alias("least")
    grouped = signed.filter("n_grams > 0").groupBy("set_key").agg(least, F.count("*").alias("n_rows"), F.any_value("bands").alias("bands"), F.any_value("n_grams").alias("n_grams"))
    numbered = grouped.select("set_key", "least.doc_id", "least.text_key", "n_rows", "n_grams", "bands", F.monotonically_increasing_id().alias("class"))
    classes = stored(numbered, "classes")

    banded = classes.select("class", F.explode("bands").alias("band"))
    shared = stored(banded.groupBy("band").agg(F.count("*").alias("n"), F.min("class").alias("hub")).filter("n > 1").drop("n"), "bands")
    ties = stored(banded.join(shared, "band"), "ties")
    component = connected_components(ties.select(F.col("class").alias("u"), F.col("hub").alias("v"))).withColumnRenamed("node", "class")
    near = ties.groupBy("class").agg(F.min("band").alias("near"))
    members = component.join(near, "class").join(classes.select("class", "n_grams"), "class")
    place = stored(in_blocks(members, block_grams), "places")

    # components of one block are compared at once, the blocks of others in the pairs that share a band
    extent = place.groupBy("component").agg(F.min("block").alias("low"), F.max("block").alias("high"))
    spread = extent.filter("low < high").select("component")
    large, small, zero = place.join(spread, "component", "left_semi"), place.join(spread, "component", "left_anti"), F.lit(0).cast("long")
    whole = small.select("class", "component", zero.alias("i"), zero.alias("j"), F.lit(0).alias("side"))
    met = ties.join(large.select("class", "component", "block"), "class").select("band", "component", "block").distinct()
    x, y = met.alias("x"), met.alias("y")
    pairs = x.join(y, ["band", "component"]).filter("x.block <= y.block").select("component", F.col("x.block").alias("i"), F.col("y.block").alias("j")).distinct()
    first = pairs.select("component", "i", "j", F.col("i").alias("block"), F.lit(0).alias("side"))
    second = pairs.filter("i < j").select("component", "i", "j", F.col("j").alias("block"), F.lit(1).alias("side"))
    cut = large.join(first.union(second), ["component", "block"]).select("class", "component", "i", "j", "side")

    wanted = classes.join(place.select("class"), "class", "left_semi").select("class", F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    if wanted.count() <= broadcast_keys:
        wanted = F.broadcast(wanted)
    texts = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))).select("class", "text")
    if not repeated_rows(signed).isEmpty():
        texts = texts.dropDuplicates(["class"])  # rows that are the same in id and text too: one a task before the shuffle

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            sets = [s.astype("<u8").tobytes() for s in ngram_sets(batch.column(1), n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["class", "grams"])

    sets = texts.mapInArrow(with_sets, "class long, grams binary")
    compared = whole.union(cut).join(sets, "class").join(classes.select("class", "n_rows", "bands"), "class")

    def compare(key: tuple, members: pd.DataFrame) -> pd.DataFrame:
        own, count, side = members["class"].to_numpy(), members["n_rows"].to_numpy(), members["side"].to_numpy()
        grams = [np.frombuffer(x, "<u8") for x in members["grams"]]
        a, b = links_in_blocks(side, key[1] < key[2], np.stack(members["bands"].to_list()), grams, threshold)
        links = np.bincount(a, count[b], len(own)) + np.bincount(b, count[a], len(own))
        some = np.flatnonzero(links)
        return pd.DataFrame({"class": own[some], "links": links[some].astype(np.int64), "root": own[forest(len(own), a, b)[some]]})

    linked = stored(compared.groupBy("component", "i", "j").applyInPandas(compare, "class long, links long, root long"), "links")
    group = connected_components(linked.select(F.col("class").alias("u"), F.col("root").alias("v"))).select(F.col("node").alias("class"), F.col("component").alias("group"))
    counted = linked.groupBy("class").agg(F.sum("links").alias("n_links"))
    out = classes.select("set_key", F.col("doc_id").alias("first_id"), F.col("text_key").alias("first_key"), "n_rows", "class")
    out = out.join(counted, "class", "left").join(group, "class", "left")
    out = out.select("set_key", "first_id", "first_key", "n_rows", F.coalesce("group", "class").alias("group"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return signed.drop("bands"), out


def repeated_rows(rows: DataFrame) -> DataFrame:
    """Ids and texts that stand in several rows."""
    return rows.filter("n_grams > 0").groupBy("doc_id", "text_key").count().filter("count > 1").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))


def with_groups(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id (the least doc_id of the group, the own one for texts without words), n_links (other rows alike, copies included), n_copies."""
    rows, classes = near_duplicates(docs, **options)
    classes = stored(classes, "groups")
    group_id = classes.groupBy("group").agg(F.min("first_id").alias("class_id"))
    found = classes.join(group_id, "group").select("set_key", "class_id", "n_links", "n_rows")
    out = rows.filter("n_grams > 0").join(found, "set_key").select("doc_id", "class_id", (F.col("n_links") + F.col("n_rows") - 1).alias("n_links"), F.col("n_rows").alias("n_copies"))
    return out.union(rows.filter("n_grams = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long"), F.lit(1).cast("long")))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents without near duplicates: of each group the row that is least by doc_id (nulls first), then a hash of the text.

    Of repeated rows of that one, one stays; texts without words all stay. docs' columns are kept.
    """
    docs, restore = shield(docs, "doc_id", "text")
    rows, classes = near_duplicates(docs.select("doc_id", "text"), **options)
    first = classes.groupBy("group").agg(F.min(F.struct("first_id", "first_key")).alias("x")).select(F.col("x.first_id").alias("_id"), F.col("x.first_key").alias("_key"))
    wordless = rows.filter("n_grams = 0").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    keyed = docs.withColumn("_text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    repeated = stored(repeated_rows(rows), "repeated")
    kept = keyed.join(stored(first.union(wordless), "kept"), same, "left_semi")
    if repeated.isEmpty():
        return restore(kept)
    single = kept.join(repeated, same, "left_anti")
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "_text_key"])
    return restore(single.union(once))


def op3_minhash_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of near duplicates and its number of links."""
    return with_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
