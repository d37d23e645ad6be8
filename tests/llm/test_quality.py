import numpy as np
import zlib
from edge_cases import TEXTS, documents, no_documents
from pyspark.sql import functions as F

from predial.llm import queries, quality
from predial.llm.support import prepare

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op7_quality_classifier"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert np.mean([a for a, b in held if b == 1]) > 0.98


def test_scores_are_sparse_dot_products():
    words, weights = quality.Words(), np.random.default_rng(1).normal(size=quality.BUCKETS + 1)
    texts = ["a b a b a b", "", "Hello, world!", "x"]
    together = quality.score_texts(words, weights, texts)
    for text, score in zip(texts, together):
        kinds, sizes = quality.cells(quality.Words(), [text])
        dot = sum(weights[c] for _, cells in kinds for c in cells) / max(1, sizes[0])
        assert np.isclose(score, 1 / (1 + np.exp(-dot - weights[-1])))


def test_updates_learn_and_unused_cells_stay_zero():
    texts = ["good words here now", "BAD!! BAD!! BAD!!"] * 30
    weights = quality.fit_weights(texts, [1.0, 0.0] * 30)
    good, bad = quality.score_texts(quality.Words(), weights, texts[:2])
    assert good > 0.9 and bad < 0.1 and (weights == 0).mean() > 0.99


def test_shapes():
    assert [quality.shape(w) for w in ("the,", "The", "IT!!", "|", "a1b22", "x***")] == [
        "a,", "Aa", "AA!!", "|", "a0a0", "a***"]


def test_edges(spark):
    labels = prepare(spark).createDataFrame(
        [(1, 1), (2, 1), (13, 0), (12, 0), (None, 1), (8, None), (3, 0), (3, 1), (77, 1)],
        "doc_id long, quality int")
    df = documents(spark)
    scored = quality.with_score(df, quality.train(df, labels), score="own")
    rows = scored.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.own <= 1 for r in rows)
    empties = {r.own for r in rows if r.doc_id in (5, 6, 7)}
    assert len(empties) == 1
    assert quality.train(df, labels.filter("false")) is None
    assert {r.own for r in quality.with_score(df, None, score="own").collect()} == {0.5}
    nothing = no_documents(spark)
    assert quality.train(nothing, labels) is None
    assert quality.with_score(nothing, quality.train(df, labels)).count() == 0


def test_result_does_not_depend_on_the_partitioning(spark):
    df = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    a = quality.train(df, labels, sample=60)
    b = quality.train(df.repartition(7), labels.repartition(5), sample=60)
    assert np.array_equal(a, b) and (a != 0).sum() > 100


def test_labels_teach_only_where_allowed(spark):
    df = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(F.col("doc_id") % 2 == 0, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    odd = F.col("doc_id") % 2 == 1
    assert np.array_equal(quality.train(df, labels, odd), quality.train(df, flipped, odd))


def test_shapes_are_of_whole_words():
    assert quality.shape("a" * 300 + "9") != quality.shape("a" * 300 + "!")
    assert quality.shape("a1" * 8 + "B-") != quality.shape("a1" * 8 + "-B")


def test_repeated_ids_teach_the_same_on_any_partitioning(spark):
    df = prepare(spark).createDataFrame(
        [(i % 4, f"word{i} {'good' if i % 2 else 'bad!'}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    a = quality.train(df, labels, sample=30)
    assert np.array_equal(a, quality.train(df.repartition(7, "text"), labels, sample=30))


def test_updates_against_a_scalar_version():
    """The leader's update written out for one coordinate at a time."""
    rng = np.random.default_rng(2)
    leader = quality.Leader()
    z, squares = {}, {}
    examples = []
    for _ in range(60):
        cells = np.unique(rng.integers(0, 40, 6))
        examples.append((cells, rng.random(len(cells)), float(rng.integers(0, 2))))

    def weight(c):
        if abs(z.get(c, 0.0)) <= quality.L1:
            return 0.0
        return -(z[c] - np.sign(z[c]) * quality.L1) / ((quality.SMOOTHING + np.sqrt(squares[c])) / quality.RATE + quality.L2)

    for cells, values, label in examples:
        p = 1 / (1 + np.exp(-sum(weight(c) * v for c, v in zip(cells, values))))
        for c, v in zip(cells, values):
            g, old = (p - label) * v, squares.get(c, 0.0)
            w = weight(c)
            sigma = (np.sqrt(old + g * g) - np.sqrt(old)) / quality.RATE
            z[c] = z.get(c, 0.0) + g - sigma * w
            squares[c] = old + g * g
        leader.learn(cells, values, label)
    got = leader.weights()
    assert all(np.isclose(got[c], weight(c)) for c in z)
