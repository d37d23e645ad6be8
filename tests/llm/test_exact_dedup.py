import hashlib
from collections import Counter

import pytest
from edge_cases import TEXTS, documents, no_documents
from pyspark.sql import functions as F

from predial.llm import exact_dedup


def brute(rows):
    rows = [(i, t or "") for i, t in rows]
    keep = {}
    for i, t in rows:
        if i is not None:
            keep[t] = max(i, keep.get(t, i))
    size = Counter(t for _, t in rows)
    return sorted(
        ((i, keep.get(t), size[t], i == keep.get(t), hashlib.sha256(t.encode()).hexdigest())
         for i, t in rows), key=str)


def weak(text):
    """A digest that many texts share."""
    return F.lpad(F.hex(F.length(text) % 3), 2, "0")


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_every_row_finds_its_winner(spark, digest):
    found = exact_dedup.mark_copies(documents(spark), digest=digest)
    assert sorted(map(tuple, found.collect()), key=str) == brute(TEXTS)


def test_smallest(spark):
    found = exact_dedup.mark_copies(documents(spark), smallest=True)
    assert {r.keep_id for r in found.collect() if r.group_size == 4} == {3}


def test_dropping_keeps_one_row_of_each_text_and_all_columns(spark):
    df = documents(spark)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert Counter(r.text or "" for r in rows) == Counter({t or "" for _, t in TEXTS})
    assert {r.doc_id for r in rows if r.text == "same words"} == {9}


def test_rows_that_repeat_with_their_id_leave_one(spark):
    df = documents(spark).filter("doc_id = 13")
    assert exact_dedup.drop_copies(df.union(df).union(df)).count() == 1


def test_nothing(spark):
    assert exact_dedup.mark_copies(no_documents(spark)).count() == 0
    assert exact_dedup.drop_copies(no_documents(spark)).count() == 0


def test_a_text_of_a_third_of_all_rows(spark):
    many = spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    found = exact_dedup.mark_copies(many)
    hot = found.filter("group_size > 1").agg(F.count("*"), F.max("keep_id"), F.min("keep_id")).first()
    assert tuple(hot) == (10_000, 29_997, 29_997)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan


def test_repeated_rows_are_combined_before_they_are_shuffled(spark):
    rows = [(7, "hot", 1)] * 900 + [(None, "no id", 2)] * 50 + [(3, None, 3), (3, "", 4), (2, "hot", 5), (4, "x", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` long").repartition(4)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    got = sorted(((r[0], r[1] or "") for r in kept.collect()), key=str)
    assert got == sorted([(7, "hot"), (None, "no id"), (3, ""), (4, "x")], key=str)
    plan = kept._jdf.queryExecution().toString()
    assert "Window" not in plan and "partial_first" in plan
