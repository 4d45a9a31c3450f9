"""Language identification with interpolated Kneser-Ney character language models, one a language.

Texts become sequences of 64 symbols: a boundary for every run of characters that aren't letters, a to z, and 37 classes of other
letters, by their code points' remainders: most letters of an alphabet are symbols of their own, the thousands of a logographic script share them. Sequences of four symbols are counted over all training texts, per task and then by key; a model
grows with the different sequences of its language. Lower orders count the distinct predecessors (continuation counts). Each order's
n-grams stand in a sorted array of packed keys with their probabilities; a text is looked up by binary search.

Of languages with equal cross-entropy the first by name is taken. A null in lang or text leaves a row out of the training; repeated rows count
as often as they stand there in the counts, and once in the calibration. Without training rows all texts are `und`.

The language with the lowest cross-entropy per symbol wins. Rejection is calibrated on all training texts, each scored by models
that learned from the other fold alone: a text is rejected if its cross-entropy lies more than `tolerance` deviations above its
language's centre, where the variance has a part that shrinks with the text's length and a part that doesn't. A language with few
texts has a wide spread of its own accord, as PRIOR texts of a known one count with its own.

Held-out texts of the 0.1 GB table, rejected at this tolerance: 0.45 % of all in their own language (word salad, secrets, mixed ones); of
those in a language left out 89 % of 16 to 63 symbols, 99.6 % of 64 to 255 and 99.99 % of longer ones; all random letters from 20 on.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import shield, pieces, stored, strings, table
from lodeplane.llm.words import in_sorted

ORDER, BITS = 4, 6
#: Classes of the letters other than a to z, a prime.
CLASSES = 37
PAD = "\n" * (ORDER - 1)
#: Folds of the training texts that calibrate rejection.
FOLDS = 2
#: Texts with the prior variances (independent of length, and for one symbol) that count with a language's own.
PRIOR, PRIOR_FIXED, PRIOR_SINGLE = 30, 0.0064, 4.0
#: Share of the longer half's distances from the centre, and the normal deviate that has it.
TAIL, TAIL_DEVIATE = 0.99, 2.576
#: Deviations; chosen from the rates above.
TOLERANCE = 4.0
#: Symbols of evidence that a score counts at most: a text's symbols depend on each other, so that more of them would make nearly every score 1.
SCORE_SYMBOLS = 48


@functools.cache
def symbol_table() -> np.ndarray:
    """Symbols of the code points below 65,536."""
    out = np.zeros(65_536, np.uint16)
    for cp in range(65_536):
        c = chr(cp)
        if not c.isalpha():
            continue
        low = c.lower()[0] if c.lower() else c
        out[cp] = 1 + ord(low) - 97 if "a" <= low <= "z" else 27 + ord(unicodedata.normalize("NFC", low)[0]) % CLASSES
    return out


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' symbols one after another, each text behind ORDER - 1 boundaries, and the n+1 places where they begin."""
    texts = [x if unicodedata.is_normalized("NFC", x) else unicodedata.normalize("NFC", x) for x in texts]
    joined = "".join(f"{PAD}{x}\n" for x in texts)
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    start = np.cumsum([0, *(len(x) + len(PAD) + 1 for x in texts)])
    sym = symbol_table()[np.minimum(cps, 65_535)]
    high = np.flatnonzero(cps > 65_535)
    if len(high):
        kinds, of = np.unique(cps[high], return_inverse=True)
        sym[high] = np.array([27 + c % CLASSES if chr(c).isalpha() else 0 for c in kinds.tolist()], np.uint16)[of]
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
    for i in range(ORDER - 1):
        keep[start[:-1] + i] = True
    return sym[keep], np.concatenate(([0], np.cumsum(keep)))[start]


def grams(sym: np.ndarray) -> np.ndarray:
    """Packed keys of all runs of ORDER symbols."""
    m = len(sym) - ORDER + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = sym[:m].astype(np.uint64)
    for i in range(1, ORDER):
        out = out << np.uint64(BITS) | sym[i : i + m]
    return out


@dataclass
class Level:
    """One order: sorted keys with a probability for each language, sorted contexts with the weight of the order below."""

    keys: np.ndarray
    p: np.ndarray | None  # None: the highest order's, kept as logarithms alone
    contexts: np.ndarray
    back: np.ndarray


@dataclass
class Models:
    langs: list[str]
    levels: list[Level]  # from order 1 up
    log_top: np.ndarray  # logarithms of the highest order's probabilities
    centre: np.ndarray  # of cross-entropy, by language
    fixed: np.ndarray  # variances: independent of length, and for one symbol
    single: np.ndarray

    def probability(self, key: np.ndarray, order: int) -> np.ndarray:
        """Interpolated probabilities (n x languages) of the last symbol of each packed key of this order."""
        if not order:
            return np.full((len(key), len(self.langs)), 1 / (1 << BITS))
        level = self.levels[order - 1]
        at, there = in_sorted(key, level.keys)
        out = np.empty((len(key), len(self.langs)))
        out[there] = level.p[at[there]] if level.p is not None else np.exp(self.log_top[at[there]])
        if len(miss := np.flatnonzero(~there)):
            out[miss] = lowered(level, key[miss]) * self.probability(key[miss] & np.uint64((1 << BITS * (order - 1)) - 1), order - 1)
        return out

    def log_probability(self, key: np.ndarray) -> np.ndarray:
        at, there = in_sorted(key, self.levels[-1].keys)
        out = self.log_top[at]
        if len(miss := np.flatnonzero(~there)):
            out[miss] = np.log(self.probability(key[miss], ORDER))
        return out

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats a symbol (texts x languages), and each text's number of predicted symbols; texts without letters have none."""
        sym, start = symbols(texts)
        key = grams(sym)
        n = np.diff(start) - (ORDER - 1)
        total = np.zeros((len(texts), len(self.langs)))
        some = np.flatnonzero(n > 0)
        if len(some):
            logs = self.log_probability(key)
            inside = np.stack([start[some], start[some] + n[some]], axis=1).ravel()
            inside = inside[:-1] if inside[-1] >= len(logs) else inside
            total[some] = np.add.reduceat(logs, inside, axis=0)[::2]
        return -total / np.maximum(n, 1)[:, None], n


def lowered(level: Level, key: np.ndarray) -> np.ndarray:
    """The weight that the order below gets after the contexts of these keys; 1 where the context is unknown."""
    at, there = in_sorted(key >> np.uint64(BITS), level.contexts)
    return np.where(there[:, None], level.back[at], 1.0) if len(level.contexts) else np.ones((len(key), 1))


def discount(counts: np.ndarray) -> float:
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return ones / (ones + 2 * twos) if ones else 0.5


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    """Models of the languages from the sorted keys and counts of their n-grams."""
    langs = sorted(counts)
    by_order: list[dict[str, tuple[np.ndarray, np.ndarray]]] = [counts]
    for order in range(ORDER - 1, 0, -1):
        by_order.insert(0, {x: np.unique(by_order[0][x][0] & np.uint64((1 << BITS * order) - 1), return_counts=True) for x in langs})
    models = Models(langs, [], np.zeros(0), *np.zeros((3, len(langs))))
    for order in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([by_order[order - 1][x][0] for x in langs]))
        contexts = np.unique(keys >> np.uint64(BITS))
        own, back = np.zeros((len(keys), len(langs))), np.ones((len(contexts), len(langs)))
        for j, x in enumerate(langs):
            k, c = by_order[order - 1][x]
            if not len(k):
                continue
            d = discount(c)
            context, at = np.searchsorted(contexts, k >> np.uint64(BITS)), np.searchsorted(keys, k)
            totals, kinds = np.bincount(context, c, len(contexts)), np.bincount(context, minlength=len(contexts))
            own[at, j] = np.maximum(c - d, 0) / totals[context]
            back[:, j] = np.where(totals > 0, d * kinds / np.maximum(totals, 1), 1.0)
        level = Level(keys, own, contexts, back.astype(np.float32))
        level.p = own + lowered(level, keys) * models.probability(keys & np.uint64((1 << BITS * (order - 1)) - 1), order - 1)
        models.levels.append(level)
    models.log_top = np.log(models.levels[-1].p).astype(np.float32)
    models.levels[-1].p = None
    return models


def gram_counts(training: DataFrame) -> DataFrame:
    """Rows (lang, fold, gram, n) of all training texts, summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        for batch in pieces(batches, 1):
            owners, texts = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)), strings(batch.column(1))
            for owner in set(owners):
                sym, start = symbols([t for x, t in zip(owners, texts, strict=True) if x == owner])
                key, n = grams(sym), np.diff(start) - (ORDER - 1)
                inside = np.zeros(len(sym) + 1, np.int32)
                np.add.at(inside, start[:-1], 1)
                np.add.at(inside, start[:-1] + np.maximum(n, 0), -1)
                held[owner].append(np.unique(key[np.cumsum(inside)[: len(key)] > 0], return_counts=True))
                if len(held[owner]) >= 32:
                    held[owner] = [merged(held[owner])]
        for (lang, fold), x in held.items():
            keys, n = merged(x)
            for i in range(0, len(keys), 100_000):
                k = keys[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array([fold] * len(k), pa.int32()), pa.array(k.view(np.int64)), pa.array(n[i : i + 100_000])], names=["lang", "fold", "gram", "n"])

    return training.select("lang", "text", "fold").mapInArrow(run, "lang string, fold int, gram long, n long").groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n"))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their summed counts."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def own_scores(training: DataFrame, models: dict[int, Models]) -> DataFrame:
    """Rows (lang, h, n): each text's cross-entropy by its own language in the model for its fold, if that has it; copies are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            langs, texts, folds = batch.column(0).to_pylist(), strings(batch.column(1)), batch.column(2).to_pylist()
            for fold, model in models.items():
                rows = [i for i, (x, f) in enumerate(zip(langs, folds, strict=True)) if f == fold and x in model.langs]
                if not rows:
                    continue
                h, n = model.cross_entropy([texts[i] for i in rows])
                own = np.array([model.langs.index(langs[i]) for i in rows])
                some = np.flatnonzero(n > 0)
                yield pa.RecordBatch.from_arrays([pa.array([langs[rows[i]] for i in some.tolist()], pa.string()), pa.array(h[some, own[some]]), pa.array(n[some])], names=["lang", "h", "n"])

    return training.select("lang", "text", "fold").mapInArrow(run, "lang string, h double, n long").distinct()


def spreads(scores: DataFrame) -> DataFrame:
    """A row a language: its number of texts, centre, and variances (independent of length, and for one symbol)."""
    scores = stored(scores, "scores")
    middle = lambda c, share=0.5: F.percentile_approx(c, share, 10_000)
    centres = scores.groupBy("lang").agg(F.count("*").alias("texts"), middle("h").alias("centre"), middle("n").alias("half"))
    off = F.abs(F.col("h") - F.col("centre"))
    return scores.join(F.broadcast(centres), "lang").groupBy("lang", "texts", "centre").agg(
        F.pow(middle(F.when(F.col("n") >= F.col("half"), off), TAIL) / TAIL_DEVIATE, F.lit(2)).alias("fixed"), (middle(off * off * F.col("n")) * 1.4826**2).alias("single")
    )


def train(training: DataFrame) -> Models | None:
    """Models of all languages in training (columns lang, text; rows with a null in either are left out); None if there are none."""
    training = training.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"))
    found = gram_counts(training).toPandas()  # a row for each different sequence of a language and fold
    counts: dict[int, dict[str, tuple[np.ndarray, np.ndarray]]] = {f: {} for f in range(FOLDS)}
    for (lang, fold), x in found.groupby(["lang", "fold"]):
        x = x.sort_values("gram")
        counts[int(fold)][str(lang)] = (x["gram"].to_numpy().astype(np.uint64), x["n"].to_numpy())
    del found

    def without(fold: int | None) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        for f, x in counts.items():
            for lang, c in x.items() if f != fold else ():
                parts[lang].append(c)
        return {lang: merged(x) for lang, x in parts.items()}

    if not any(counts.values()):
        return None
    others = {f: fit(c) for f in range(FOLDS) if (c := without(f))}
    spread = {r["lang"]: r for r in spreads(own_scores(training, others)).collect()}  # a row a language
    del others
    models = fit(without(None))
    if alone := [x for x in models.langs if x not in spread]:  # all texts in one fold: their own model gives the centre, and the prior the spread
        scored = own_scores(training.filter(F.col("lang").isin(alone)), dict.fromkeys(range(FOLDS), models))
        spread |= {r["lang"]: r.asDict() | {"texts": 0} for r in spreads(scored).collect()}
    for j, lang in enumerate(models.langs):
        r = spread.get(lang) or {"texts": 0, "centre": np.log(1 << BITS), "fixed": 0.0, "single": 0.0}
        m = r["texts"]
        models.centre[j] = r["centre"]
        models.fixed[j] = (m * r["fixed"] + PRIOR * PRIOR_FIXED) / (m + PRIOR)
        models.single[j] = (m * r["single"] + PRIOR * PRIOR_SINGLE) / (m + PRIOR)
    return models


def identify(docs: DataFrame, models: Models | None, tolerance: float = TOLERANCE) -> DataFrame:
    """docs (with a string column text) plus lang_pred, score (0 to 1), cross_entropy (nats a symbol) and rejected.

    score is the language's probability among the known ones, halved for a text at the limit of rejection and next to nothing for one far beyond it: a
    rejected text scores less than 0.5. A text that is null or has no letter is `und`, score 0, rejected; so is every text if there are no models. Columns of docs with
    these names are replaced. Each row depends on its text alone.
    """
    docs = docs.drop("lang_pred", "score", "cross_entropy", "rejected")
    names = [*docs.columns, "lang_pred", "score", "cross_entropy", "rejected"]
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at_text):
            texts = strings(batch.column(at_text))
            if models is None:
                pred, score, best, bad = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts), [True] * len(texts)
            else:
                h, n = models.cross_entropy(texts)
                j = h.argmin(axis=1)
                best = h[np.arange(len(j)), j]
                weight = np.minimum(n, SCORE_SYMBOLS)
                score = np.where(n > 0, 1 / np.exp(-(h - best[:, None]) * weight[:, None]).sum(axis=1), 0.0)
                limit = tolerance * np.sqrt(models.fixed[j] + models.single[j] / np.maximum(n, 1))
                beyond = np.maximum(best - models.centre[j], 0) / np.maximum(limit, 1e-12)
                bad = (n <= 0) | (beyond > 1)
                score /= 1 + np.minimum(beyond, 1e6) ** 4
                pred = [models.langs[k] if m > 0 else "und" for k, m in zip(j.tolist(), n.tolist(), strict=True)]
                best = pa.array(best, mask=n <= 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(best, pa.float64()), pa.array(bad, pa.bool_())], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double, cross_entropy double, rejected boolean")


def held_out(doc_id: F.Column) -> F.Column:
    """Documents that no model learns from. A null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train_on_documents(docs: DataFrame) -> Models | None:
    return train(docs.filter(~held_out(F.col("doc_id"))).select("lang", "text"))


def in_known_language(docs: DataFrame) -> DataFrame:
    """The documents whose language the models, trained on docs, don't reject; with their own columns."""
    inner, restore = shield(docs, "text")
    return restore(identify(inner, train_on_documents(docs)).filter("NOT rejected"))


def op9_kneser_ney_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train_on_documents(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
