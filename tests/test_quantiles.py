import math
import random

import pytest

from predial.operators import quantiles as q


def brute(values, p):
    values = sorted(v for v in values if v is not None and v > 0)
    return values[max(1, math.ceil(p * len(values))) - 1]


def frame(spark, values):
    return spark.createDataFrame([(v, None) for v in values], "precio_clp double, precio_uf double")


def exact(spark, values, probs=q.QUARTILES):
    counts = q.collapse(q.positive_values(frame(spark, values), ["precio_clp", "precio_uf"]))
    return {r["p"]: r["cuantil"] for r in q.exact_quantiles(counts, probs).collect()}


rng = random.Random(7)
CASES = {
    "small": [1.0, 2.0, 3.0, 4.0, 10.0, 20.0, 30.0],
    "one": [5.0],
    "hot": [7.0] * 500 + [float(i) for i in range(1, 300)],
    "not positive": [0.0, -3.0, None, 8.0, 9.0],
    "wide": [10 ** rng.uniform(-300, 300) for _ in range(800)],
    "close": [1e9 + rng.random() for _ in range(800)],
    "next doubles": [1.0 + i * 2.0**-52 for i in range(200)],
    "extremes": [5e-324, 1.7976931348623157e308, 1.0],
}


@pytest.mark.parametrize("name", CASES)
def test_exact_quantiles_against_sorting(spark, name):
    values = CASES[name]
    assert exact(spark, values) == {p: brute(values, p) for p in q.QUARTILES}


def test_known_quartiles(spark):
    assert exact(spark, CASES["small"]) == {0.25: 2.0, 0.5: 4.0, 0.75: 20.0}


def test_no_positive_value_gives_no_row(spark):
    prices = ["precio_clp", "precio_uf"]
    counts = q.collapse(q.positive_values(frame(spark, [0.0, None]), prices))
    assert q.iqr_report(q.spread(counts, q.fences(q.exact_quantiles(counts)))).count() == 0
    plain = q.positive_values(frame(spark, [0.0, None]), prices)
    assert q.iqr_report(q.spread(plain, q.fences(q.approx_quantiles(plain)))).count() == 0


def test_approximate_quartiles_stay_within_the_error(spark):
    n = 60_000
    df = spark.range(n).selectExpr(
        "cast((id * 7919) % 60000 + 1 as double) as precio_clp", "cast(null as double) as precio_uf"
    )
    plain = q.positive_values(df, ["precio_clp", "precio_uf"])
    for row in q.approx_quantiles(plain).collect():
        assert abs(row["cuantil"] - row["p"] * n) <= q.QUARTILE_ERROR * n + 1


def test_reports(spark):
    values = [1.0, 2.0, 3.0, 4.0, 10.0, 20.0, 30.0, 1000.0, -5.0, None]
    plain = q.positive_values(frame(spark, values), ["precio_clp", "precio_uf"])
    counts = q.collapse(plain)
    limits = q.fences(q.exact_quantiles(counts))
    report = q.iqr_report(q.spread(counts, limits)).collect()
    assert [tuple(r) for r in report] == [("precio_clp", 2.0, 20.0, 18.0, -25.0, 47.0, 8, 0, 1)]
    assert [tuple(r) for r in q.iqr_report(q.spread(plain, limits)).collect()] == [tuple(r) for r in report]
    box = q.box_summary(q.spread(counts, limits)).collect()
    assert [tuple(r) for r in box] == [("precio_clp", 2.0, 4.0, 20.0, 1.0, 30.0, 1, 8)]


def test_statistics_include_values_that_are_not_positive(spark):
    found = {r["precio"]: r for r in q.describe(frame(spark, [2.0, 4.0, -6.0, None]), ["precio_clp", "precio_uf"]).collect()}
    clp = found["precio_clp"]
    assert (clp["registros"], clp["media"], clp["minimo"], clp["maximo"]) == (3, 0.0, -6.0, 4.0)
    assert clp["desviacion"] == pytest.approx(math.sqrt(28))
    assert found["precio_uf"]["registros"] == 0 and found["precio_uf"]["media"] is None


def test_source_is_scanned_once(spark, tmp_path):
    path = str(tmp_path / "p")
    frame(spark, CASES["hot"]).write.parquet(path)
    counts = q.collapse(q.positive_values(spark.read.parquet(path), ["precio_clp", "precio_uf"]))
    report = q.iqr_report(q.spread(counts, q.fences(q.exact_quantiles(counts))))
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1
