import pytest
from pyspark.sql import functions as F

from conftest import rows
from predial.operators import counting, duplicates, joins, sampling


def test_tally_does_not_count_null(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    found = counting.tally(df, {"neg": F.col("x") < 0, "pos": F.col("x") > 0, "all": F.lit(True)})
    assert rows(counting.as_rows(found, "control", "registros")) == [
        ("all", 3), ("neg", 1), ("pos", 1),
    ]


def test_exact_duplicates_compare_raw_text(spark):
    df = spark.createDataFrame([("007",), ("7",), ("7",), (None,), (None,)], "a string")
    assert tuple(duplicates.exact_duplicates(df).first()) == (5, 3, 2)
    assert tuple(duplicates.exact_duplicates(df.limit(0)).first()) == (0, 0, 0)


def test_repeated_groups_nulls_together(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (3, 1), (3, 1), (3, 1)], "a int, b int")
    groups = duplicates.repeated(df, ["a", "b"])
    assert rows(groups) == [(3, 1, 3), (None, 1, 2)]
    assert [tuple(r) for r in duplicates.most_repeated(groups, 1).collect()] == [(3, 1, 3)]


def hot_sales(spark, n=2000):
    """A third of the rows share one key; some keys are null or have no match."""
    return spark.range(n).selectExpr(
        "case when id % 3 = 0 then 7 when id % 97 = 0 then null else cast(id % 50 as int) end as key",
        "id as row",
    )


@pytest.mark.parametrize("measured", [10, joins.BROADCAST_ROWS + 1])
def test_lookup_join_is_the_same_either_way(spark, measured):
    left = hot_sales(spark)
    lookup = spark.range(40).selectExpr("cast(id as int) as day", "id * 10 as uf")
    found = joins.join_lookup(left, lookup, "key", "day", measured)
    assert found.columns == ["key", "row", "uf"]
    expected = [(k, r, k * 10 if k is not None and k < 40 else None) for k, r in left.collect()]
    assert rows(found) == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])


def test_unbounded_lookup_is_salted_not_broadcast(spark):
    lookup = spark.range(40).selectExpr("cast(id as int) as day", "id * 10 as uf")
    found = joins.join_lookup(hot_sales(spark), lookup, "key", "day", joins.BROADCAST_ROWS + 1)
    assert "_salt" in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def small_partitions(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_of_the_totals_join_is_split_at_run_time(spark, small_partitions):
    left = spark.range(0, 60_000, 1, 12).selectExpr(
        "case when id % 3 = 0 then 7 else cast(id % 5000 as int) end as key",
        "id as row", "sha2(cast(id as string), 256) as payload",
    )
    lines = spark.range(20_000).selectExpr("cast(id % 4000 as int) as key", "1 as area")
    totals = lines.groupBy("key").agg(F.sum("area").alias("area"))
    joined = joins.join_totals(left, totals, ["key"])
    found = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert len(found) == 60_000 and len({r["row"] for r in found}) == 60_000
    assert all(r["area"] == (5 if r["key"] < 4000 else None) for r in found)
    # The plain join cannot be split: its aggregate sits between shuffle and join.
    plain = left.join(totals, ["key"], "left")
    plain.collect()
    assert "skew=true" not in plain._jdf.queryExecution().executedPlan().toString()


def test_totals_join_wants_equal_key_types(spark):
    totals = spark.range(3).selectExpr("id as key", "1 as area")
    with pytest.raises(ValueError):
        joins.join_totals(hot_sales(spark), totals, ["key"])


def test_sample_is_the_same_on_any_partitioning(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES_AT_ONCE", 100)
    df = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 'hot', string(id)) as a", "if(id % 7 = 0, null, id / 8.0d) as b"
    ).unionByName(spark.sql("SELECT 'hot' AS a, cast(0.5 AS double) AS b FROM range(2000)"))
    first = rows(sampling.capped_sample(df.repartition(3), 1000, 42))
    assert len(first) == 1000 and rows(sampling.capped_sample(df.repartition(7), 1000, 42)) == first
    assert rows(sampling.capped_sample(df, 1000, 43)) != first
    hot = sum(r == ("hot", 0.5) for r in first)
    assert 220 <= hot <= 350  # 2,000 of 7,000 rows are copies of it
    numbered = sampling.numbered_copies(df, "n").filter("b = 0.5 AND a = 'hot'")
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 2001))


def test_sample_of_few_rows(spark):
    df = spark.range(20).selectExpr("id % 4 as id")
    assert rows(sampling.capped_sample(df, 100)) == rows(df)
    assert sampling.capped_sample(df.limit(0), 10).count() == 0
