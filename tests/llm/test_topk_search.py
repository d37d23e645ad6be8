import math

import numpy as np
import pytest
from edge_cases import SF
from pyspark.sql import functions as F

from predial.llm import topk_search
from predial.llm.support import prepare


def brute(rows, is_query, k):
    whole = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for q, a in whole:
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, k=10, **options):
    df = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = topk_search.search(df, F.col("vec_id") % 3 == 0, k, **options)
    return sorted(map(tuple, found.collect()))


def test_random_vectors_in_blocks_of_queries(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(700)]
    assert search(spark, rows, query_block=50) == brute(rows, lambda i: i % 3 == 0, 10)


def test_ties_nulls_lengths_and_hot_vector(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, -0.5, 0.25]) for i in range(300)]
    rows += [(300 + i, [0.1 * i, 1.0, -i / 7]) for i in range(60)]
    rows += [(900, None), (903, [1.0, None]), (906, [nan]), (909, [inf, 1.0]), (None, [1.0])]
    rows += [(912, [2.0]), (915, []), (918, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])]
    assert search(spark, rows) == brute(rows, lambda i: i % 3 == 0, 10)


def test_huge_components_are_exact(spark):
    rows = [(0, [1e8, 3.0]), (1, [1e4, 1.0]), (2, [1e4, 2.0]), (3, [-1e4, 5.0])]
    assert search(spark, rows, k=2) == brute(rows, lambda i: i % 3 == 0, 2)


def test_fewer_than_k_and_nothing(spark):
    assert len(search(spark, [(0, [1.0]), (1, [2.0])])) == 1
    assert search(spark, [(0, [1.0])]) == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, score int, rank int")
    assert topk_search.search(empty, F.lit(True)).count() == 0


@pytest.mark.parametrize("slices", [1, 4, 7])
def test_threshold_leaves_out_only_what_is_below(slices, monkeypatch):
    monkeypatch.setattr(topk_search, "SLICES", slices)
    rng = np.random.default_rng(slices)
    rows, queries = np.floor(rng.normal(size=(200, 16)) * 50), np.floor(rng.normal(size=(9, 16)) * 50)
    scores = rows @ queries.T
    cutoff = np.sort(scores, axis=0)[-10]
    at, of, found = topk_search._sufficient_entries(rows, queries, cutoff)
    assert set(zip(at, of)) == set(zip(*np.nonzero(scores >= cutoff)))
    assert (found == scores[at, of]).all()


def test_given_vectors(spark):
    df = prepare(spark).read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    found = topk_search.search(df, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 100 == 0, 10)
