import math
import random
import re
from collections import Counter

import pyarrow as pa

from lodeplane.llm.license_texts import NOTICES
from lodeplane.llm.licenses import COVERAGE, SHORT, TELLING, TELLING_GNU, Templates, disjoint, increasing, op5_patience_license_scan, patience, scan_licenses
from lodeplane.llm.words import words as hashed_words
from tests.llm.brute import words
from tests.oracle import SF


def test_patience_matches_in_order():
    random.seed(1)
    for _ in range(300):
        a, b = ([random.randint(0, 9) for _ in range(random.randint(0, 12))] for _ in range(2))
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert len(patience(list(range(50)), [*range(20), 99, *range(20, 50)])) == 50


def test_notices_are_found_wherever_they_stand(spark, make):
    random.seed(2)
    filler = lambda n: " ".join(f"w{random.randint(0, 500)}" for _ in range(n))
    docs, want = [], {}
    for i, (name, text) in enumerate(NOTICES):
        docs.append((i, f"{filler(40)}\n{text}\n{filler(300)}"))
        want[i] = [(40, 40 + len(words(text)), name)]
    docs += [(100, filler(5000)), (101, None), (102, ""), (103, f"{NOTICES[0][1]} {filler(30)} {NOTICES[4][1]} {filler(9)} {NOTICES[0][1]}"), (104, "Released under the BSD License. The license of MIT was released.")]
    found = {r.doc_id: r.licenses for r in scan_licenses(make(docs)).collect()}
    for i, spans in want.items():
        assert [(x.start, x.end, x["name"]) for x in found[i]] == spans, NOTICES[i]
    assert [x["name"] for x in found[103]] == ["mit", "apache-2.0", "mit"] and not any(found[i] for i in (100, 101, 102, 104))


def test_small_changes_are_covered(spark, make):
    text = NOTICES[3][1].replace("Software", "Program", 1).replace("free of charge", "without charge")
    (row,) = scan_licenses(make([(1, f"x {text} y")])).collect()
    assert [x["name"] for x in row.licenses] == ["mit"] and 0.9 < row.licenses[0].coverage < 1
    assert scan_licenses(make([])).count() == 0


def test_query(spark):
    """Against the lines of the documents that hold a notice as it is."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in op5_patience_license_scan(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        w = " ".join(words(d.text))
        plain = {n for n, t in NOTICES if f" {' '.join(words(t))} " in f" {w} "}
        assert set(filter(None, got[d.doc_id].licenses.split(","))) >= plain if plain else got[d.doc_id].n_found == 0


def test_adjacent_notices_are_all_found(spark, make):
    text = {n: t for n, t in NOTICES[:15]}
    mit = NOTICES[3][1]
    docs = [(1, f"{mit} {mit} {mit}"), (2, f"{text['gpl-3.0']}\n{NOTICES[6][1]}\n{text['gpl-3.0']}"), (3, "\n".join(t for _, t in NOTICES[:15]))]
    found = {r.doc_id: [x["name"] for x in r.licenses] for r in scan_licenses(make(docs)).collect()}
    assert found == {1: ["mit"] * 3, 2: ["gpl-3.0"] * 3, 3: [n for n, _ in NOTICES[:15]]}


def test_licenses_of_one_wording_are_told_apart(spark, make):
    docs = [
        (1, "This work is licensed under the GNU General Public License, version 2."),
        (2, "This work is licensed under the GNU General Public License, version 2. There are 3 kinds of it."),
        (3, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
        (4, "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
        (5, NOTICES[7][1].replace("GNU General", "GNU Affero General")),
        (6, NOTICES[7][1].replace("version 3", "version 2")),
        (7, "This work is licensed under the GNU General Public License, version 7."),
        (8, "This work is licensed under the GNU General Public License, version 2. This work is licensed under the GNU General Public License, version 3."),
    ]
    found = {r.doc_id: [x["name"] for x in r.licenses] for r in scan_licenses(make(docs)).collect()}
    assert found == {1: ["gpl-2.0"], 2: ["gpl-2.0"], 3: ["cc-by-sa-4.0"], 4: ["cc-by-nd-4.0"], 5: ["agpl-3.0"], 6: ["gpl-2.0"], 7: [], 8: ["gpl-2.0", "gpl-3.0"]}


def test_full_texts(spark, make):
    """Each as one match of its own name, also with words lost; a text of another license with nearly the same words isn't taken for it."""
    random.seed(4)
    bodies = [(n, t) for n, t in NOTICES if len(words(t)) >= 150]
    assert {"gpl-2.0", "gpl-3.0", "lgpl-2.1", "apache-2.0", "mit", "bsd-2-clause", "bsd-3-clause", "isc", "cc0-1.0", "mpl-2.0"} <= {n for n, _ in NOTICES} and len(bodies) >= 15
    docs = [(i, " ".join(w for w in words(t) if random.random() > 0.03 or w == "endorse")) for i, (_, t) in enumerate(bodies)]
    docs.append((99, re.sub("(?i)gnu general", "GNU Affero General", dict(bodies)["gpl-3.0"])))
    found = {r.doc_id: [x["name"] for x in r.licenses] for r in scan_licenses(make(docs)).collect()}
    assert found == {**{i: [n] for i, (n, _) in enumerate(bodies)}, 99: ["agpl-3.0"]}


def test_longest_increasing_runs_against_brute_force():
    random.seed(4)
    for _ in range(300):
        seconds = [random.randint(0, 12) for _ in range(random.randint(0, 9))]
        best: list[int] = []
        for i, x in enumerate(seconds):
            best.append(1 + max((best[j] for j in range(i) if seconds[j] < x), default=0))
        chain = increasing(list(enumerate(seconds)))
        assert len(chain) == max(best, default=0) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(chain, chain[1:]))


def test_overlapping_matches_ties_and_many_of_them():
    found = [(0, 5, "b", 1.0, 5), (3, 9, "a", 1.0, 6), (9, 12, "c", 1.0, 3), (9, 12, "a", 1.0, 3), (20, 26, "z", 1.0, 6)]
    assert disjoint(found) == [(3, 9, "a", 1.0), (9, 12, "a", 1.0), (20, 26, "z", 1.0)]
    assert len(disjoint([(7 * i, 7 * i + 6, "x", 1.0, 6) for i in range(30_000)])) == 30_000


def test_many_notices_in_one_long_text(spark, make):
    text = "Licensed under the MIT License. some words between "
    docs = [(1, text * 3000), (1, text * 3000), (2, "licensed under the " * 100_000), (3, f"{NOTICES[3][1]} " * 200)]
    found = scan_licenses(make(docs).withColumnRenamed("spans", "licenses"))
    assert found.columns.count("licenses") == 1
    got = [(r.doc_id, [(x.start, x.end, x["name"]) for x in r.licenses]) for r in found.collect()]
    assert [(i, len(x)) for i, x in got] == [(1, 3000), (1, 3000), (2, 0), (3, 200)]
    assert got[0][1] == [(8 * i, 8 * i + 5, "mit") for i in range(3000)]


def test_full_texts_without_their_rare_words(spark, make):
    """A coverage of 0.85 or more is found whichever words are missing, telling ones aside: here of those that occur once, up to 13 % of all words."""
    bodies = [(n, t) for n, t in NOTICES if len(words(t)) >= 400]
    docs, want = [], {}
    for i, (name, text) in enumerate(bodies):
        w = text.split()
        low = Counter(x for y in w for x in words(y))
        once = [k for k, x in enumerate(w) if words(x) and all(low[y] == 1 for y in words(x)) and not {*TELLING, *TELLING_GNU, "gnu"} & set(words(x))]
        gone = set(random.Random(i).sample(once, min(len(once), int(0.13 * len(words(text))))))
        docs.append((i, " ".join(x for k, x in enumerate(w) if k not in gone)))
        want[i] = name
    assert len(bodies) >= 13
    for r in scan_licenses(make(docs)).collect():
        best = max(r.licenses, key=lambda x: x.end - x.start)
        assert best["name"] == want[r.doc_id] and 0.85 <= best.coverage < 1, want[r.doc_id]


def windows_by_hand(text, name, template):
    """Matches of a template straight from the definition: all runs are looked at, each counted anew, none left out by a filter or cut into stretches."""
    own, w = words(template), words(text)
    there = Counter(own)
    need = math.ceil((COVERAGE if len(own) >= SHORT else 1.0) * len(own) - 1e-9)
    key = {x: i for i, x in enumerate(sorted({*own, *w}))}
    templates = Templates([(name, template)])
    out, todo, reach = [], [(0, len(w))], len(own) + len(own) // 2 + 2
    while todo:
        lo, hi = todo.pop()
        runs = []
        at = [i for i in range(lo, hi) if w[i] in there]
        for p in at:
            inside = [i for i in at if p - reach < i <= p]
            total = sum((Counter(w[i] for i in inside) & there).values())
            if total >= need:
                tight = max(t for t in inside if sum((Counter(w[i] for i in inside if i >= t) & there).values()) == total)
                runs.append((-total, p - tight, inside[0], tight, p + 1))
        others = []
        for _, _, loose, tight, end in sorted(runs):
            if any(2 * (min(y, end) - max(x, tight)) > end - tight for x, y in others):
                continue
            found = None
            for start in dict.fromkeys((tight, loose)):
                a, b = max(lo, start - len(own) // 4), min(hi, end + len(own) // 4)
                matched = patience([key[x] for x in w[a:b]], [key[x] for x in own])
                if len(matched) >= need and len(matched) >= 0.8 * (matched[-1][0] + 1 - matched[0][0]):
                    span = a + matched[0][0], a + matched[-1][0] + 1
                    if templates.agrees(0, templates_keys(w[a:b]), matched):
                        found = (*span, name, len(matched) / len(own), len(matched))
                        break
                    others.append(span)
            if found:
                out.append(found)
                todo += [(lo, found[0]), (found[1], hi)]
                break
    return out


def templates_keys(tokens):
    return hashed_words(pa.array([" ".join(tokens)], pa.large_string())).key.tolist() if tokens else []


def test_every_window_by_hand():
    """The whole scan, filter, stretches and all, against the definition, on texts of notices that are cut, shuffled, doubled and spoilt."""
    rng = random.Random(9)
    notices = [(n, t) for n, t in NOTICES if len(words(t)) <= 40][:14]
    texts = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(1, 4)):
            w = rng.choice(notices)[1].split()
            w = [x for x in w if rng.random() > rng.choice((0, 0.05, 0.15))]
            if rng.random() < 0.2:
                k = rng.randrange(len(w) + 1)
                w = w[k:] + w[:k]
            parts += w + [rng.choice(("the", "version", "license", "x", "affero"))] * rng.randint(0, 3)
        texts.append(" ".join(parts))
    got = Templates(notices).scan(pa.array(texts))
    n = 0
    for text, found in zip(texts, got, strict=True):
        want = disjoint([m for name, t in notices for m in windows_by_hand(text, name, t)])
        assert found == want
        n += len(found)
    assert n > 100
