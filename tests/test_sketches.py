import pytest
from pyspark.sql import functions as F

from conftest import rows
from predial.operators import sketches

PROBS = (0.25, 0.5, 0.75)


def data(spark, low, high):
    return spark.range(low, high).select(
        (F.col("id") * 7919 % 100_003 + 1).cast("double").alias("a"),
        F.when(F.col("id") % 2 == 0, F.lit(5.0)).alias("b"),
        (F.col("id") / 10_000).cast("int").alias("part"),
    )


def test_parts_in_any_order_give_one_answer_within_the_error(spark, root):
    whole = data(spark, 0, 60_000)
    for low, high in ((40_000, 60_000), (0, 40_000), (10_000, 20_000)):  # one part twice
        sketches.store_sketches(
            sketches.part_sketches(data(spark, low, high), ["a", "b"], F.col("part")), root)
    stored = sketches.read_sketches(spark, root)
    assert stored.count() == 12 and sketches.stored_parts(spark, root) == list("012345")
    assert rows(stored.groupBy("precio").agg(F.sum("registros"))) == [("a", 60_000), ("b", 30_000)]
    found = {(r.precio, r.p): r.cuantil for r in sketches.merged_quantiles(stored, PROBS).collect()}
    for p in PROBS:
        assert found["b", p] == 5.0
        rank = whole.filter(F.col("a") <= found["a", p]).count() / 60_000
        assert abs(rank - p) < 0.001


def test_rows_without_part_and_without_values(spark, root):
    df = spark.createDataFrame([(1.0, None), (-1.0, 1), (None, 1), (0.0, 2)], "a double, part int")
    sketches.store_sketches(sketches.part_sketches(df, ["a"], F.col("part")), root)
    assert sketches.stored_parts(spark, root) == [sketches.NO_PART]
    assert rows(sketches.merged_quantiles(sketches.read_sketches(spark, root), [0.5])) == [("a", 0.5, 1.0)]


@pytest.mark.parametrize("column", ["a"])
def test_no_rows(spark, column):
    df = spark.createDataFrame([], f"{column} double, part int")
    assert sketches.merged_quantiles(sketches.part_sketches(df, [column], F.col("part"))).count() == 0
