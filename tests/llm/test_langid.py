import collections
import math
import random
import string

import numpy as np
from pyspark.sql import functions as F

from lodeplane.llm.langid import BITS, ORDER, discount, grams, identify, in_known_language, op9_kneser_ney_language_id, symbols, train, train_on_documents
from tests.oracle import SF

TEXTS = {"en": "the quick brown fox jumps over the lazy dog and runs away from the house", "de": "der schnelle braune fuchs springt über den faulen hund und läuft davon"}


def training(spark, copies=6):
    rows = [(x, " ".join(t.split()[i:] + t.split()[:i])) for x, t in TEXTS.items() for i in range(copies)]
    return spark.createDataFrame([*rows, (None, "nobody"), ("en", None)], "lang string, text string")


def plain_sequences(texts):
    sym, start = symbols(texts)
    return [sym[a:b].tolist() for a, b in zip(start[:-1], start[1:])]


def kneser_ney(seqs):
    """Interpolated Kneser-Ney from its definition, on lists of symbols."""
    counts = {ORDER: collections.Counter(tuple(s[i : i + ORDER]) for s in seqs for i in range(len(s) - ORDER + 1))}
    for n in range(ORDER - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (1 << BITS)
        own = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        d, total = discount(np.array(list(counts[n].values()))), sum(own.values())
        return max(own.get(gram, 0) - d, 0) / total + d * len(own) / total * p(gram[1:])

    return p


def test_probabilities_follow_the_definition(spark):
    models = train(training(spark))
    for j, lang in enumerate(models.langs):
        p = kneser_ney(plain_sequences([r.text for r in training(spark).collect() if r.lang == lang and r.text]))
        for text in ("the fox läuft", "xyz", "über", "a"):
            seq = plain_sequences([text])[0]
            want = -np.mean([math.log(p(tuple(seq[i : i + ORDER]))) for i in range(len(seq) - ORDER + 1)])
            got = models.cross_entropy([text])[0][0, j]
            assert abs(got - want) < 1e-4, (lang, text)


def test_probabilities_sum_to_one(spark):
    models = train(training(spark))
    for context in (0, 5, 20 << 2 * BITS | 8 << BITS | 5):
        keys = np.arange(1 << BITS, dtype=np.uint64) | np.uint64(context << BITS)
        assert np.allclose(models.probability(keys, ORDER).sum(axis=0), 1)


def test_a_text_alone_decides(spark, make):
    models = train(training(spark))
    docs = [(1, "the dog runs"), (2, None), (3, "123 !?"), (4, ""), (5, "der hund läuft über den"), (6, "qqqq xxxx qxqx " * 400), (7, "the dog runs"), (8, "über den")]
    out = {r.doc_id: r for r in identify(make(docs).repartition(3), models, tolerance=6.0).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 4, 5)] == ["en", "und", "und", "und", "de"]
    assert out[1].score == out[7].score and out[8].lang_pred == "de"
    assert all(out[i].rejected for i in (2, 3, 4, 6)) and not out[1].rejected and all(0 <= r.score <= 1 for r in out.values())


def test_batches_and_boundaries():
    a, b = symbols(["Ab, c!", ""]), symbols(["Ab, c!"])
    assert a[0][: len(b[0])].tolist() == b[0].tolist() == [0, 0, 0, 1, 2, 0, 3, 0]
    assert len(grams(np.zeros(2, np.uint8))) == 0


def test_nothing_to_learn_from(spark, make):
    assert train(spark.createDataFrame([], "lang string, text string")) is None
    assert [r.lang_pred for r in identify(make([(1, "abc")]), None).collect()] == ["und"]
    assert in_known_language(make([])).count() == 0


def test_stage_keeps_columns(spark, make):
    rows = [(i, t, x) for i, (x, t) in enumerate(TEXTS.items())] * 30 + [(99, None, "en"), (100, "...", "en")]
    kept = in_known_language(make(rows))
    assert kept.columns == make([]).columns and {r.doc_id for r in kept.collect()} == {0, 1} and kept.count() == 60


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in op9_kneser_ney_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = [(got[d.doc_id].lang_pred, d.lang) for d in docs if got[d.doc_id].held_out]
    assert len(got) == len(docs) and len(held) > 200 and sum(a == b for a, b in held) / len(held) > 0.98
    assert sum(r.rejected for r in got.values()) < 0.01 * len(got)


def test_texts_of_no_known_language_are_rejected(spark):
    """At the tolerance of production: a language left out, and letters at random; the known languages stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("text IS NOT NULL")
    models = train(docs.filter("lang <> 'de'").select("lang", "text"))
    cut = docs.filter("lang = 'de' AND n_chars >= 400").selectExpr("doc_id", "substring(text, 1, 300) AS text")
    out = identify(cut, models).collect()
    assert len(out) > 50 and sum(r.rejected for r in out) > 0.95 * len(out)
    draw = random.Random(3)
    noise = spark.createDataFrame([(i, "".join(draw.choices(string.ascii_lowercase + "   ", k=30))) for i in range(100)], "doc_id long, text string")
    assert identify(noise, models).filter("rejected").count() == 100
    assert identify(docs.filter("lang <> 'de'"), models).filter("rejected").count() < 0.01 * docs.count()


SCRIPTS = {
    "ru": "каждое утро старый мельник выходил на крыльцо и смотрел как солнце поднимается над тихой рекой где рыбаки уже чинили свои сети а дети бежали в школу через мокрый луг",
    "uk": "щоранку старий мельник виходив на ґанок і дивився як сонце підіймається над тихою річкою де рибалки вже лагодили свої сіті а діти бігли до школи через мокрий луг",
    "ja": "毎朝年老いた粉屋は玄関に出て静かな川の上に太陽が昇るのを眺めました漁師たちはもう網を直していて子供たちは濡れた草原を通って学校へ走って行きました",
    "zh": "每天早晨老磨坊主都会走到门廊上看着太阳从宁静的河面上升起渔夫们已经在修补他们的渔网孩子们穿过湿润的草地跑去上学",
}


def test_languages_of_one_script_are_told_apart(spark):
    """Two languages each of the Cyrillic and the Han script; texts are cut anew, so that none was learned as it stands."""
    cut = lambda t, i, n: (t * 2)[i : i + n]
    rows = [(x, cut(t, 5 * i, 40)) for x, t in SCRIPTS.items() for i in range(len(t) // 5)]
    models = train(spark.createDataFrame(rows, "lang string, text string"))
    tests = spark.createDataFrame([(x, cut(t, 7 * i + 3, 25)) for x, t in SCRIPTS.items() for i in range(len(t) // 7)], "lang string, text string")
    found = identify(tests, models)
    assert found.filter("lang_pred <> lang").count() == 0 and tests.count() > 50
    latin = spark.createDataFrame([("the quick brown fox jumps over the lazy dog and runs away from the house",)], "text string")
    assert identify(latin, models).filter("rejected").count() == 1


def test_a_long_text(spark, make):
    models = train(training(spark))
    long = " ".join([TEXTS["de"]] * 30_000)
    out = {r.doc_id: r for r in identify(make([(1, long), (2, "the dog runs away")]), models).collect()}
    assert out[1].lang_pred == "de" and not out[1].rejected and out[2].lang_pred == "en"


def test_rejected_texts_score_low(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    models = train_on_documents(docs)
    odd = spark.createDataFrame([("Съешь же ещё этих мягких французских булок, да выпей чаю. " * 5,), ("xqzj kvwq zzxj qqkv jxzq wvkq " * 20,)], "text string")
    assert all(r.rejected and r.score < 0.1 for r in identify(odd, models).collect())
    own = identify(docs, models).groupBy("rejected").agg(F.min("score").alias("low"), F.max("score").alias("high")).collect()
    assert all(r.high < 0.5 if r.rejected else r.low >= 0.1 for r in own)
