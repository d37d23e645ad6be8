import pytest
from pyspark.sql import functions as F

from conftest import rows
from predial.contracts import PERIOD, SCHEMAS, ContractError
from predial.operators.casting import check_schema
from predial.plans import cadastre
from predial.sources.text import tidy_text
from workload import views

SF = "/root/testdata/sf0.01"


def buildings(spark, *data):
    """(com, periodo, superficie, año) lines of property (com, 1, 1)."""
    full = [(c, 1, 1, p, i, 1, "H", "A", area, None, year) for i, (c, p, area, year) in enumerate(data)]
    return spark.createDataFrame(full, SCHEMAS["construcciones"])


def properties(spark, *data):
    """(com, periodo, com_bc, pr)"""
    full = [(c, 1, pr, p, "X", 1, 1, "H", 1, 1, bc, 1, 1) for c, p, bc, pr in data]
    return spark.createDataFrame(full, cadastre.PROPERTIES)


P = "2026_1"


def test_totals(spark):
    lines = buildings(spark, (1, P, 10, 0), (1, P, 5, 1990), (1, P, 1, 1980), (2, P, 7, 0), (3, P, None, None))
    found = rows(cadastre.building_totals(lines).select("cod_com", *cadastre.TOTALS))
    assert found == [(1, 16, 1980), (2, 7, None), (3, None, None)]
    plain = rows(cadastre.building_totals(lines, positive_only=False).select("cod_com", "ano_construccion"))
    assert plain == [(1, 0), (2, 0), (3, None)]


def test_join_keeps_every_property_once_and_minds_the_period(spark):
    lines = buildings(spark, (1, P, 10, 1990), (1, "2025_2", 99, 1950))
    owned = properties(spark, (1, P, None, 1), (1, P, None, 1), (2, P, None, 1), (None, P, None, 1))
    final = cadastre.build_no_agricola(owned, cadastre.building_totals(lines))
    check_schema(final, SCHEMAS["no_agricola"], "t")
    found = rows(final.select("cod_com", *cadastre.TOTALS))
    assert found == [(1, 10, 1990), (1, 10, 1990), (2, None, None), (None, None, None)]
    assert rows(cadastre.with_buildings(final).select("cod_com")) == [(1,), (1,)]


def test_area_over_the_integer_range_fails(spark):
    big = 2_000_000_000
    lines = buildings(spark, (1, P, big, 0), (1, P, big, 0))
    final = cadastre.build_no_agricola(properties(spark, (1, P, None, 1)), cadastre.building_totals(lines))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        final.collect()


def test_valuations_over_the_integer_range_are_kept(spark):
    typed = cadastre.type_properties(tidy_text(views.raw_properties(spark, SF)))
    assert typed.filter(F.col("avaluo_fiscal_clp") > 2**31 - 1).count() == 14_963


def test_links(spark):
    owned = properties(spark, (1, P, 5, 1), (2, P, 0, 1), (3, P, None, 1), (4, P, 5, 70_000), (5, P, 5, 69_999))
    found = cadastre.build_nexo_bc(owned)
    assert [r[0] for r in rows(found)] == [1, 5]
    check_schema(found, SCHEMAS["nexo_bc"], "t")


def test_missing_column(spark):
    with pytest.raises(ContractError, match="cod_com_bc"):
        cadastre.type_properties(views.raw_properties(spark, SF).drop("cod_com_bc"))


def test_expected_figures_at_sf_001(spark):
    """Figures of FIXTURES.md section 3."""
    typed = cadastre.type_properties(tidy_text(views.raw_properties(spark, SF)))
    lines = cadastre.build_construcciones(tidy_text(views.raw_buildings(spark, SF)))
    final = cadastre.build_no_agricola(typed, cadastre.building_totals(lines))
    area, year = (F.col(c).isNull() for c in cadastre.TOTALS)
    found = final.agg(F.count("*"), F.count_if(area), F.count_if(year), F.count_if(F.col("cod_pr") >= 70000))
    assert tuple(found.first()) == (15_000, 257, 402, 1_875)
    assert cadastre.build_nexo_bc(typed).count() == 6_541


def test_period_column(spark):
    df = cadastre.with_period(spark.range(1), P)
    assert df.first()[PERIOD] == P
    with pytest.raises(ContractError):
        cadastre.with_period(spark.range(1), "2026")
