"""The pipeline, stage by stage, against brute-force versions on its own intermediate tables."""

import importlib
from collections import Counter

import pytest
from edge_cases import documents, no_documents
from test_exact_dedup import brute as all_copies
from test_jaccard_join import brute as all_pairs
from test_packing import PATH, check_sequences, pieces
from test_pii import plain

import corpus_pipeline
from predial.llm import packing, pii, quality
from predial.llm.support import prepare

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The input and each stage's result, stored as the checks store them."""
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    found, folder = [docs], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found.append(docs)
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_and_columns(tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "exact_dedup", "near_dedup", "personal_data", "packing"]
    assert all(t.columns == tables[0].columns for t in tables[:5])


def test_quality_keeps_good_documents(tables):
    kept, labels = set(texts(tables[1])), tables[0].sparkSession.read.parquet(f"{SF}/labels.parquet")
    good = [r.doc_id for r in labels.filter("quality = 1").collect()]
    bad = [r.doc_id for r in labels.filter("quality = 0").collect()]
    assert sum(i in kept for i in good) >= 0.99 * len(good)
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)
    weights = quality.train(tables[0], labels)
    scores = quality.with_score(tables[0], weights).select("doc_id", "score").collect()
    assert kept == {r.doc_id for r in scores if r.score >= corpus_pipeline.REJECT_BELOW}


def test_exact_copies(tables):
    before = texts(tables[1])
    assert texts(tables[2]) == {i: before[i] for i, _, _, kept, _ in all_copies(before.items()) if kept}


def test_near_copies(tables):
    before = texts(tables[2])
    found = all_pairs(before.items(), 5, 80)
    assert texts(tables[3]) == {i: t for i, t in before.items() if found[i][1] == i}


def test_personal_data(tables):
    before, after = texts(tables[3]), texts(tables[4])
    assert before.keys() == after.keys()
    model = pii.train(tables[3])
    for i, text in before.items():
        spans = [s for s, _ in model.accepted(text, plain(text))]
        assert after[i] == pii.redacted(text, spans)
        assert set(plain(text)) <= set(spans)
    assert sum(before[i] != after[i] for i in before) > 20
    assert all(r.n_chars == len(r.text) for r in tables[4].collect())


def test_packing(tables):
    before, rows = texts(tables[4]), tables[5].collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == Counter((i, *p) for i, t in before.items() for p in pieces(t, 2048))
    bound = -(-sum(r.length for r in rows) // 2048)
    assert check_sequences(rows, 2048) <= 1.02 * bound + 1
    assert packing.CAPACITY == 2048 and corpus_pipeline.TOKENIZER == PATH


def test_edges_through_all_stages(spark, tmp_path):
    for name, docs in (("some", documents(spark)), ("none", no_documents(spark))):
        columns = docs.columns
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            assert number == 4 or out.columns == columns
            out.write.parquet(f"{tmp_path}/{name}{number}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{number}")
        assert (docs.count() > 0) == (name == "some")


def test_without_labels(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    stage = corpus_pipeline.STAGES[0][1]
    assert stage(spark, documents(spark), str(tmp_path)).count() == documents(spark).count()


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run
