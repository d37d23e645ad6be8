import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import rows
from predial.contracts import CLP_CAP, RAW_SALES, SCHEMAS, UF_CAP, ContractError
from predial.functions import rules
from predial.operators.casting import check_schema
from predial.sinks.guards import measure, measures
from predial.operators import quantiles
from predial.plans import prices, profile
from workload import views

DAY = dt.date(2020, 1, 2)


def sales(spark, *data):
    return spark.createDataFrame(list(data), ", ".join(f"{c} string" for c in RAW_SALES))


def rates(spark, *data):
    df = spark.createDataFrame(list(data), "date string, uf string")
    return prices.type_rates(df)


def sale(clp=None, uf=None, day="20200102", com="1"):
    return (com, "2", "3", day, clp, uf)


GOOD = [("2020-01-02", "100"), ("2020-01-02", "100"), ("2020-01-03", "200")]


def build(spark, *data, **options):
    return prices.build_precios(sales(spark, *data), rates(spark, *GOOD), **options)


def prices_of(spark, *data, **options):
    return [r[4:] for r in rows(build(spark, *data, **options))]


def test_both_prices_are_filled_from_what_came_in(spark):
    assert prices_of(spark, sale("500", None)) == [(500.0, 5.0)]
    assert prices_of(spark, sale(None, "7")) == [(700.0, 7.0)]
    assert prices_of(spark, sale("500", "7")) == [(500.0, 7.0)]
    assert prices_of(spark, sale(None, None)) == [(None, None)]
    assert prices_of(spark, sale("500", None, day="20200105")) == [(500.0, None)]


def test_caps_are_not_applied_again_after_filling(spark):
    at_cap = str(int(UF_CAP))
    assert prices_of(spark, sale("0", at_cap)) == [(UF_CAP * 100, UF_CAP)]
    assert prices_of(spark, sale(str(int(CLP_CAP)), "NaN")) == [(CLP_CAP, CLP_CAP / 100)]
    assert prices_of(spark, sale(str(int(CLP_CAP) + 1), None)) == [(None, None)]
    assert prices_of(spark, sale(None, "1000000.5")) == [(None, None)]
    free = prices_of(spark, sale(None, "1000001"), uf_cap=None, clp_cap=None)
    assert free == [(100_000_096.0, 1_000_001.0)]  # 100,000,100 as a 32-bit float


def test_rows_without_key_or_date_go_and_copies_go_first(spark):
    data = [sale("1"), sale("1"), sale("2", com="x"), sale("3", day="2020-01-02"), sale("4", com="")]
    assert len(rows(build(spark, *data))) == 1
    # 007 and 7 are different text: both stay.
    assert len(rows(build(spark, sale("1", com="007"), sale("1", com="7")))) == 2


def test_key_reading_modes(spark):
    data = [sale("1", com="12.7"), sale("1", com=" 13 ")]
    assert [r[0] for r in rows(build(spark, *data))] == [12, 13]
    assert [r[0] for r in rows(build(spark, *data, strict_key=True))] == [13]


def test_schema(spark):
    check_schema(build(spark, sale("1")), SCHEMAS["precios_transaccionales"], "t")


@pytest.mark.parametrize(
    "bad", [("x", "1"), ("2020-01-05", "0"), ("2020-01-05", "-1"), ("2020-01-05", "NaN"),
            ("2020-01-05", None), ("2020-01-02", "101")],
)
def test_bad_or_contradictory_rates_stop_the_job(spark, bad):
    with pytest.raises(ContractError):
        prices.check_rates(rates(spark, *GOOD, bad))


def test_rates_table_keeps_copies_and_reference_does_not(spark):
    df = rates(spark, *GOOD)
    assert prices.check_rates(df) == 2
    assert prices.build_uf(df).count() == 3
    assert rows(prices.rate_reference(df)) == [(DAY, 100.0), (dt.date(2020, 1, 3), 200.0)]
    assert rows(prices.conflicting_rates(rates(spark, *GOOD, ("2020-01-02", "5")))) == [(DAY, 2)]


SF = "/root/testdata/sf0.01"


def test_expected_figures_at_sf_001(spark):
    """Figures of FIXTURES.md section 3."""
    raw = views.raw_sales(spark, SF)
    found = {r["control"]: r["registros"] for r in profile.controls(
        profile.with_values(raw), dt.date(2026, 1, 1)).collect()}
    assert len(found) == 21
    assert raw.count() == 16_407
    assert found["cod_com_faltante"] + found["cod_com_invalido"] == 388
    assert found["cod_pr_no_entero"] == 93
    assert found["fecha_faltante"] + found["fecha_invalida"] == 273
    assert found["precio_clp_faltante"] + found["precio_clp_invalido"] == 1_372
    assert found["precio_clp_no_positivo"] == 2_347
    final = prices.build_precios(raw, prices.type_rates(views.raw_rates(spark, SF)))
    assert final.count() == 14_367
    assert tuple(prices.pending_audit(final).first()) == (823, 824, 709)


def test_invariants(spark):
    raw = views.raw_sales(spark, SF)
    typed = prices.type_sales(raw)
    df = prices.type_rates(views.raw_rates(spark, SF))
    capped = prices.cap_prices(typed)
    attached = prices.attach_rates(capped, prices.rate_reference(df), prices.check_rates(df))
    final = prices.finish_sales(typed, prices.rate_reference(df), prices.check_rates(df))
    assert final.count() == attached.filter(rules.usable_sale()).count() == 14_367
    assert attached.count() == capped.count()
    kept = attached.select("*", F.col("precio_clp").cast("float").alias("before"))
    assert kept.filter(F.col("before") <= 0).isEmpty()
    again = raw.distinct()
    assert again.distinct().count() == again.count()
    # A price that survives the caps is stored as it is.
    survivors = capped.filter("precio_clp is not null").select(F.sum(F.col("precio_clp").cast("float")))
    final = prices.impute(attached.filter("precio_clp is not null"))
    total = final.select(F.sum("precio_clp")).first()[0]
    assert total == pytest.approx(survivors.first()[0], rel=1e-12)


def test_combined_counts_agree_with_the_single_reports(spark):
    raw = views.raw_sales(spark, "/root/testdata/sf0.001")
    values = profile.with_values(raw)
    today = dt.date(2001, 1, 1)
    found = {}
    for group, name, n in profile.profile_counts(values, today).collect():
        found.setdefault(group, {})[name] = n
    assert found["total"] == {"registros": raw.count()}
    assert found["nulos"] == profile.null_profile(raw).first().asDict()
    assert found["vacios"] == profile.blank_profile(raw).first().asDict()
    assert found["controles"] == dict(map(tuple, profile.controls(values, today).collect()))


def test_unusable_rows_are_left_out_by_the_scan(spark, tmp_path):
    prices.type_sales(views.raw_sales(spark, SF)).write.parquet(f"{tmp_path}/typed")
    df = prices.type_rates(views.raw_rates(spark, SF))
    final = prices.finish_sales(
        spark.read.parquet(f"{tmp_path}/typed"), prices.rate_reference(df), prices.check_rates(df))
    plan = final._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "typed" in line and "PushedFilters" in line)
    for c in ("cod_com", "cod_mz", "cod_pr", "fecha_escritura"):
        assert f"IsNotNull({c})" in scan


def test_figures_observed_while_writing(spark):
    """The audits and what the guards ask, counted on the way, against scans of their own."""
    typed = prices.type_sales(views.raw_sales(spark, SF))
    df = prices.type_rates(views.raw_rates(spark, SF))
    args = (typed, prices.rate_reference(df), prices.check_rates(df), None, None)
    huge = typed.limit(1).selectExpr("1 cod_com", "1 cod_mz", "1 cod_pr", "date'1995-01-02' fecha_escritura",
                                     "1e300D precio_clp", "cast(null as double) precio_uf")
    for sales in (typed, typed.union(huge)):
        dropped, changed, written = (Observation(n) for n in ("dropped", "changed", "written"))
        final = prices.finish_sales(prices.watched_sales(sales, dropped), *args[1:], watch=changed)
        watched = final.observe(written, *measures("precios_transaccionales"))
        watched.write.format("noop").mode("overwrite").save()
        assert dropped.get | changed.get == prices.sales_audit(sales, *args[1:]).first().asDict()
        assert written.get == measure(prices.finish_sales(sales, *args[1:]), "precios_transaccionales")
    assert written.get["not finite precio_clp"] == written.get["not finite precio_uf"] == 1


def test_one_pass_summary_agrees_with_the_single_reports(spark):
    values = profile.with_values(views.raw_sales(spark, "/root/testdata/sf0.001"))
    today = dt.date(2001, 1, 1)
    found = profile.profile_prices(values, today)
    assert rows(found.counts) == rows(profile.profile_counts(values, today))
    plain = quantiles.describe(profile.read_prices(values), profile.PRICES)
    for a, b in zip(rows(found.statistics), rows(plain)):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9)
    positive = quantiles.positive_values(profile.read_prices(values), profile.PRICES)
    limits = quantiles.fences(quantiles.approx_quantiles(positive))
    assert rows(found.iqr) == rows(quantiles.iqr_report(quantiles.spread(positive, limits)))
    empty = profile.profile_prices(values.filter("false"), today)
    assert empty.iqr.count() == 0 and empty.statistics.count() == 2
