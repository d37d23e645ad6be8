import os

import pytest

from conftest import SF, rows
from predial.contracts import RAW_COMMUNES, RAW_SALES, RAW_USES, SCHEMAS, ContractError
from predial.plans import cadastre, jobs, prices
from predial.sources.tables import read_period
from predial.sources.text import tidy_text
from workload import views
from workload.fixture_columns import PERIODS
from workload.registry import write_cadastre, write_sales, write_text


@pytest.fixture
def base(spark, tmp_path):
    """All six sources as text files."""
    folder = str(tmp_path / "raw")

    def put(df, name, header=None):
        df = df if header is None else df.toDF(*header)
        write_text(df, f"{folder}/{name}.csv", header=True)

    put(views.raw_sales(spark, SF), "precios_transaccionales", ["A", "B", "C", "D", "E", "F"])
    put(views.raw_rates(spark, SF), "precios_uf")
    put(views.raw_coordinates(spark, SF).select("longitud", "latitud", "cod_pr", "cod_mz", "cod_com"), "coordenadas")
    put(views.raw_communes(spark, SF), "codigo_comuna_region", [f"X{c}" for c in RAW_COMMUNES])
    put(views.raw_uses(spark, SF), "codigo_destino", [f"X{c}" for c in RAW_USES])
    put(views.raw_materials(spark, SF), "codigo_material")
    return folder


def test_prices_job(spark, base, root):
    written, audit = jobs.run_prices(spark, base, root, root)
    expected = prices.build_precios(
        views.raw_sales(spark, SF), prices.type_rates(views.raw_rates(spark, SF))
    )
    assert rows(spark.read.parquet(f"{root}/precios_transaccionales")) == rows(expected)
    assert set(written) == {t for t in SCHEMAS if t not in ("construcciones", "no_agricola", "nexo_bc")}
    for name, n in written.items():
        assert spark.read.parquet(f"{root}/{name}").count() == n
    assert audit["transacciones_tras_limpieza"] == written["precios_transaccionales"]
    assert audit["rol_faltante_o_invalido"] > 0 and audit["clp_sobre_limite_plausible"] > 0
    assert audit["ambos_pendientes_conservados"] > 0


def test_prices_job_writes_nothing_when_rates_contradict(spark, base, root):
    bad = views.raw_faulty_rates(spark, SF).filter("uf not in ('0', 'x')")
    bad.write.mode("overwrite").csv(f"{base}/precios_uf.csv", header=True)
    with pytest.raises(ContractError, match="more than one rate"):
        jobs.run_prices(spark, base, root, root)
    assert not os.path.exists(root)


def test_prices_job_with_other_paths_and_plain_headers(spark, base, root, tmp_path):
    plain = {t: str(tmp_path / t) for t in ("precios_transaccionales", "codigo_destino")}
    write_text(views.raw_sales(spark, SF).select("precio_uf", *RAW_SALES[:-1]), plain["precios_transaccionales"], header=True)
    write_text(views.raw_uses(spark, SF), plain["codigo_destino"], header=True)
    names = {"codigo_comuna_region": RAW_COMMUNES}
    moved, _ = jobs.run_prices(spark, base, root, root, paths=plain, names=names)
    usual, _ = jobs.run_prices(spark, base, root + "2", root + "2")
    assert moved == usual
    both = [rows(spark.read.parquet(f"{r}/precios_transaccionales")) for r in (root, root + "2")]
    assert both[0] == both[1]


def test_cadastre_job(spark, root):
    base = write_cadastre(spark, SF)
    both = jobs.run_cadastre(spark, base, root, root, PERIODS)
    again = jobs.run_cadastre(spark, base, root, root, PERIODS[:1])
    assert 0 < again["no_agricola"] < both["no_agricola"] == views.raw_properties(spark, SF).count()
    found = []
    for period in PERIODS:
        found += rows(read_period(spark, f"{root}/no_agricola", "no_agricola", period))
    typed = cadastre.type_properties(tidy_text(views.raw_properties(spark, SF, True)))
    lines = cadastre.build_construcciones(tidy_text(views.raw_buildings(spark, SF, True)))
    expected = cadastre.build_no_agricola(typed, cadastre.building_totals(lines))
    assert sorted(found, key=str) == sorted(rows(expected), key=str)


def test_cadastre_job_refuses_before_reading(spark, root):
    with pytest.raises(ContractError):
        jobs.run_cadastre(spark, "/nowhere", root, root, ["2026"])
    with pytest.raises(ContractError):
        jobs.run_cadastre(spark, "/nowhere", "/elsewhere", root, ["2026_1"])


def test_profile_job(spark, root):
    path = write_sales(spark, SF)
    reports = jobs.run_profile(spark, path, root)
    exact = jobs.run_profile(spark, path, root + "2", exact=True)
    assert reports["counts"].filter("grupo = 'controles'").count() == 21
    total = views.raw_sales(spark, SF).count()
    assert reports["duplicates"].first()["registros"] == total
    assert reports["iqr"].count() == exact["iqr"].count() == 2
    assert reports["sample"].count() == total  # fewer rows than the bound
    assert reports["most_repeated"].count() <= 5
    by_price = {r["precio"]: r for r in exact["box"].collect()}
    for row in reports["box"].collect():
        assert row["q1"] == pytest.approx(by_price[row["precio"]]["q1"], rel=0.05)


def test_profile_of_an_empty_file(spark, tmp_path, root):
    path = tmp_path / "e.csv"
    path.write_text("a,b,c,d,e,f\n")
    with pytest.raises(ContractError, match="no rows"):
        jobs.run_profile(spark, str(path), root)


def everything(spark, root):
    tables = ("construcciones", "no_agricola", "nexo_bc")
    return {t: rows(spark.read.parquet(f"{root}/{t}")) for t in tables}


def test_a_total_that_overflows_leaves_all_three_tables_as_they_were(spark, root, tmp_path):
    base = write_cadastre(spark, SF)
    jobs.run_cadastre(spark, base, root, root, PERIODS)
    before = everything(spark, root)
    line = "1|1|1|{}|A|1|2000|2000000000|H||||"[:-1]
    bad = str(tmp_path / "bad")
    for name, lines in (
        ("construcciones", [line.format(1), line.format(2)]),
        ("no_agricola", ["1|1|1|CALLE|1|1|H|1|0|0|0||||1|||||"]),
    ):
        os.makedirs(f"{bad}/{name}")
        with open(f"{bad}/{name}/{PERIODS[0]}.csv", "w") as out:
            out.write("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        jobs.run_cadastre(spark, bad, root, root, PERIODS[:1])
    assert everything(spark, root) == before


def test_lines_of_wrong_width_stop_the_cadastre_job(spark, root):
    base = write_cadastre(spark, SF)
    with open(f"{base}/construcciones/{PERIODS[1]}.csv/part-x.csv", "w") as out:
        out.write("1|2|3\n" + "1|2|3|4|A|5|2000|10|H|||\n" + "1|" * 14 + "\n")
    with pytest.raises(ContractError, match="corta', 1.*larga', 1"):
        jobs.run_cadastre(spark, base, root, root, PERIODS)
    assert not os.path.exists(root)


@pytest.mark.parametrize("table", ["coordenadas", "precios_uf", "precios_transaccionales"])
def test_a_bad_value_in_any_price_table_leaves_all_as_they_were(spark, base, root, table):
    first, _ = jobs.run_prices(spark, base, root, root)
    add = {
        "coordenadas": "1e300,1,1,1,1", "precios_uf": "1990-01-01,1e300",
        "precios_transaccionales": "1,1,1,19950102,,1e300",
    }[table]
    folder = f"{base}/{table}.csv"
    header = next(open(f"{folder}/{f}").readline() for f in os.listdir(folder) if f.endswith(".csv"))
    with open(f"{folder}/part-x.csv", "w") as out:
        out.write(header + add + "\n")
    before = {t: rows(spark.read.parquet(f"{root}/{t}")) for t in first}
    with pytest.raises(ContractError, match=f"{table}: .*not finite"):
        jobs.run_prices(spark, base, root, root, clp_cap=None, uf_cap=None)
    assert {t: rows(spark.read.parquet(f"{root}/{t}")) for t in first} == before


def test_ragged_sales_stop_the_job_unless_accepted(spark, base, root):
    folder = f"{base}/precios_transaccionales.csv"
    with open(f"{folder}/part-x.csv", "w") as out:
        out.write("A,B,C,D,E,F\n1,2\n")
    with pytest.raises(ContractError, match="corta', 1"):
        jobs.run_prices(spark, base, root, root)
    assert not os.path.exists(root)
    written, _ = jobs.run_prices(spark, base, root, root, accept_ragged=True)
    assert written["precios_transaccionales"] > 0
