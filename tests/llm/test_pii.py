import hashlib
import math
import random

from pyspark.sql import functions as F

from lodeplane.llm.pii import KINDS, SECRET, TERM, base_spans, entity_contexts, find_personal_data, luhn, op10_disclosure_sanitisation, without_personal_data
from tests.llm import brute
from tests.oracle import SF


def test_patterns_against_plain_regular_expressions():
    random.seed(8)
    parts = ["a@b.c", "@", ".", "x.y@z-1.co.uk.", "a@b", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (555) 010-2030", "+", "+12", "5" * 20, " ", "-", "é", "00010.1.1.1", "%+", "\n", "49 30 1234567", "+49 30 1234567 ", "9" * 50]
    for _ in range(4000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 9)))
        assert base_spans(text) == brute.base_spans(text), repr(text)
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def people(n=40):
    """An entity near which a tell-tale word stands in several contexts, and words that stand everywhere."""
    docs = []
    for i in range(n):
        filler = " ".join(random.Random(i).choices(["river", "stone", "cloud", "meadow", "window"], k=12))
        docs.append((i, f"{filler} Zebulon writes from w{i} ann@example.com about things {filler}" if i % 10 == 0 else f"{filler} nothing here {filler}"))
    return [*docs, (100, "Zebulon is mentioned alone."), (101, None), (102, "")]


def test_disclosing_terms_are_found_and_generalised(spark, make):
    docs = [(i, t) for i, t in people() if i != 100]
    found = {r.doc_id: r.spans for r in find_personal_data(make(docs)).collect()}
    for i, text in docs:
        terms = {text[s.start : s.end] for s in found[i] if s.kind == TERM}
        assert terms == ({"Zebulon", "writes", "about", "from", "things"} if (text or "").find("@") > 0 else set()), (i, terms)
    clean = {r.doc_id: r for r in without_personal_data(make(docs)).collect()}
    assert "ann@" not in clean[0].text and "[EMAIL]" in clean[0].text and "Zebulon" not in clean[0].text and "river" in clean[0].text + clean[10].text
    assert clean[1].text == docs[1][1] and clean[101].text is None and clean[0].n_chars == len(clean[0].text) and clean[1].spans == "s"


def test_information_share(spark, make):
    """p(e|t) = 4/5 with one mention elsewhere: (log 4/5 - log p) / -log p, below the threshold of 0.95 and above that of 0.9."""
    docs = people()
    p = 4 / len(docs)
    share = (math.log(4 / 5) - math.log(p)) / -math.log(p)
    assert 0.9 <= share < 0.95
    terms = lambda x: {r.doc_id for r in find_personal_data(make(docs), threshold=x).collect() if any(s.kind == TERM and s.start > 0 and r.text[s.start : s.end] == "Zebulon" or s.kind == TERM and s.start == 0 for s in r.spans)}
    assert 100 in terms(0.9) and 100 not in terms(0.95)


def test_copies_are_one_context(spark, make):
    rows = [(i, "Yorick holds the line bob@example.com as ever") for i in range(30)] + [(50 + i, f"plain words number {i}") for i in range(20)]
    assert all(s.kind < SECRET for r in find_personal_data(make(rows)).collect() for s in r.spans)


def test_terms_by_join_give_the_same(spark, make):
    docs = [*people(), *keys()]
    for rewrite in (False, True):
        sent, joined = ({r.doc_id: (r.text, r.spans) for r in find_personal_data(make(docs), rewrite, broadcast_terms=n).collect()} for n in (1000, 0))
        assert sent == joined and len(sent) == len(docs)


def keys(n=12):
    """A word before random keys, the same kind of value without it, and words with a date."""
    draw = random.Random(4)
    key = lambda: "".join(draw.choices("0123456789abcdef", k=40))
    fill = lambda: " ".join(draw.choices(["lamp", "chair", "table", "floor", "ceiling", "door", "wall"], k=9))
    cued = [(200 + i, f'{fill()} x{i} apikey = "{key()}" {fill()}') for i in range(n)]
    return [*cued, (300, f"{fill()} commit {key()} {fill()}"), (301, f"{fill()} a-day-in-the-city-2024-10-02-and-on {fill()}"), *[(400 + i, fill()) for i in range(40)]]


def test_a_disclosing_word_shows_which_values_are_secrets(spark, make):
    docs = keys()
    clean = {r.doc_id: r for r in find_personal_data(make(docs), rewrite=True).collect()}
    for i, text in docs:
        kinds = sorted(s.kind for s in clean[i].spans)
        if i < 300:
            assert kinds == [SECRET, TERM] and '"[SECRET]"' in clean[i].text and "apikey" not in clean[i].text
        else:
            assert kinds == [] and clean[i].text == text


def test_groups_of_entities_are_disclosed(spark, make):
    """No address stands often, but the domain does: the company's name gives it away. remove_at decides what happens to it."""
    draw = random.Random(9)
    fill = lambda: " ".join(draw.choices(["lamp", "chair", "table", "floor", "ceiling", "door"], k=8))
    docs = [(i, f"{fill()} {draw.random():.9f} Quibblex p{i}@quib.example.com {fill()}") for i in range(8)] + [(50 + i, fill()) for i in range(60)]
    found = terms_by_doc(make, docs)
    assert all("Quibblex" in found[i] for i in range(8))
    gone = find_personal_data(make(docs), rewrite=True).filter("doc_id = 1").first().text
    kept = find_personal_data(make(docs), rewrite=True, remove_at=1.5).filter("doc_id = 1").first().text
    assert "[TERM]" not in gone and "[TERM]" in kept and "Quibblex" not in gone + kept


def test_chance_is_not_disclosure(spark, make):
    """Addresses stand everywhere, and so a rare word always stands near one."""
    docs = [(i, " ".join(f"w{i}q{j} p{i}x{j}@a.example.com odd and" if j % 3 else f"p{i}z{j}@a.example.com and" for j in range(6))) for i in range(4)]
    assert "odd" not in set().union(*terms_by_doc(make, docs).values())


def test_against_brute_force_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = brute.personal_data({r.doc_id: r.text or "" for r in docs.collect()})
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in find_personal_data(docs).collect()}
    assert got == want
    assert sum(k == TERM for x in got.values() for _, k, _ in x) > 5 and sum(k == SECRET for x in got.values() for _, k, _ in x) > 5


def test_a_long_text_and_clashing_columns(spark, make):
    long = " ".join(f"word{i % 977}" for i in range(1_200_000)) + " mail ann@example.com"
    out = {r.doc_id: r for r in without_personal_data(make([(1, long), (2, ""), (3, None), *keys()])).collect()}
    assert out[1].text.endswith("[EMAIL]") and out[1].spans == "s" and out[2].text == "" and out[3].text is None


def test_empty(spark, make):
    assert without_personal_data(make([])).count() == 0


def test_query(spark):
    docs = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op10_disclosure_sanitisation(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute.base_spans(docs[r.doc_id])
        line = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def terms_by_doc(make, docs):
    return {r.doc_id: {r.text[s.start : s.end] for s in r.spans if s.kind == TERM} for r in find_personal_data(make(docs)).collect()}


def plain(n=30):
    return [(i, f"plain words number q{i} of a river and a stone") for i in range(1000, 1000 + n)]


def test_contexts_of_one_document_count(spark, make):
    lines = [f"river{i} stone{i} cloud{i} Zebulon meadow{i} ann@example.com window{i} door{i}." + " and so on with other things until the next line" for i in range(5)]
    found = terms_by_doc(make, [(1, "\n".join(lines)), *plain()])
    assert "Zebulon" in found[1] and "river3" not in found[1]
    # a document counts once, in whichever contexts: three with five lines each, one with the name alone
    docs = [(i, "\n".join(x.replace("river", f"r{i}x") for x in lines)) for i in range(3)] + [(9, "Zebulon alone")]
    contexts = entity_contexts(make([*docs, *plain()]))
    assert {r.n for r in contexts.groupBy("entity", "term").agg(F.sum("n").alias("n")).filter("term = 0").collect()} == {3}
    assert contexts.groupBy("entity", "term").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] == 3


def test_numbers_and_words_behind_long_ones_are_terms(spark, make):
    long = " ".join(c * 60 for c in "abcdef")
    docs = [(i, f"x{i} account 471199 of ann@example.com y{i}") for i in range(4)] + [(10 + i, f"z{i} Quentin {long} bob@example.com u{i}") for i in range(4)]
    found = terms_by_doc(make, [*docs, *plain()])
    assert all("471199" in found[i] for i in range(4)) and all("Quentin" in found[10 + i] for i in range(4))
