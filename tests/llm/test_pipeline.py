"""The pipeline stage by stage against plain versions, each on its own input."""

import random

import corpus_pipeline
from lodeplane.llm.common import table
from lodeplane.llm.langid import identify, train_on_documents
from tests.llm import brute
from tests.oracle import SF


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        outs.append((docs, spark.read.parquet(f"{tmp_path}/{name}")))
        docs = outs[-1][1]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "pii", "packing"]
    for before, after in outs[:-1]:
        assert before.columns == after.columns
    rows = lambda df: {r.doc_id: r for r in df.collect()}

    before, after = outs[0]
    judged = {r.doc_id for r in identify(before, train_on_documents(before)).filter("NOT rejected").collect()}
    assert set(rows(after)) == judged and len(judged) > 0.99 * before.count()

    before, after = map(rows, outs[1])
    group, _, _ = brute.jaccard_groups([(i, r.text) for i, r in before.items()])
    assert set(after) == {i for i in before if group[i] == i}

    before, after = map(rows, outs[2])
    assert set(after) == {i for i, r in before.items() if not brute.hits(r.text, items)[1]} < set(before)

    before, after = map(rows, outs[3])
    assert set(after) == set(before)
    for i, r in after.items():
        spans = brute.base_spans(before[i].text)
        assert not brute.base_spans(r.text) and (r.text == before[i].text) <= (not spans) and r.n_chars == len(r.text)

    before, after = rows(outs[4][0]), outs[4][1].collect()
    assert {r.doc_id for r in after} == set(before)
    last = {}
    for r in after:
        last[r.doc_id] = last.get(r.doc_id, 0) + r.length
    assert all(last[r.doc_id] == r.doc_tokens for r in after)
    assert corpus_pipeline.run(spark, SF).count() == len(after)


def run_on(spark, folder, docs, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return corpus_pipeline.run(spark, str(folder)).collect()


def test_empty_tables(spark, make, tmp_path):
    assert run_on(spark, tmp_path, make([]), []) == []


def test_nulls_repeated_rows_and_clashing_columns(spark, make, tmp_path):
    words = "the of and to in that it is was for on are with as his they at be this from have or by one had not but what all were".split()
    text = lambda i: " ".join(random.Random(i).choices(words, k=60)) + f" number{i}"
    rows = [(i, text(i)) for i in range(40)]
    rows += [rows[0], rows[0], (100, None), (101, ""), (102, "..."), (None, text(200)), (103, "qxqz zzkq " * 50, None), (104, text(300), None), (105, f"{text(400)} ann@example.com")]
    item = "these ten words make up one item of the benchmark here"
    rows.append((106, f"{text(500)} {item} {text(501)}"))
    pieces = run_on(spark, tmp_path, make(rows), [(1, item), (2, None), (None, "")])
    ids = [r.doc_id for r in pieces if r.start == 0]
    kept = {i for i, *_ in rows if i not in (100, 101, 102, 103, 106)}
    assert set(ids) <= kept and {None, 104, 105} <= set(ids) and len(ids) == len(set(ids))


def test_a_long_text(spark, make, tmp_path):
    base = "the quick brown fox jumps over the lazy dog and runs far away from its old house".split()
    long = " ".join(base[(i * i) % len(base)] + ("" if i % 3 else str(i)) for i in range(400_000))
    pieces = run_on(spark, tmp_path, make([(1, long), *((i, " ".join(base[i % 7 :]) + f" w{i}") for i in range(2, 30))]), [(1, "no such item")])
    assert sum(r.length for r in pieces if r.doc_id == 1) == max(r.doc_tokens for r in pieces) > 400_000
