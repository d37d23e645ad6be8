import os
import shutil

import pytest

from conftest import rows
from predial.contracts import SCHEMAS, ContractError
from predial.plans import publish as publishing
from predial.sinks import catalog, guards
from predial.sinks.staging import Stage
from predial.sources.tables import read_period



def publish(df, table, root, agreed_root, periods=()):
    return publishing.publish({table: df}, root, agreed_root, periods)[table]


LINKS = SCHEMAS["nexo_bc"]
OLD, NEW = "2025_2", "2026_1"


def links(spark, *data, pr=1, bc=1):
    return spark.createDataFrame([(c, 1, pr, p, bc, 1, 1) for c, p in data], LINKS)


def codes(spark, root, period):
    return [r[0] for r in rows(read_period(spark, f"{root}/nexo_bc", "nexo_bc", period))]


def test_a_rerun_replaces_its_own_period_only(spark, root):
    publish(links(spark, (1, OLD), (2, OLD), (3, NEW)), "nexo_bc", root, root, [OLD, NEW])
    assert publish(links(spark, (9, OLD)), "nexo_bc", root, root, [OLD]) == 1
    assert (codes(spark, root, OLD), codes(spark, root, NEW)) == ([9], [3])


def test_an_empty_period_is_cleared(spark, root):
    publish(links(spark, (1, OLD), (3, NEW)), "nexo_bc", root, root, [OLD, NEW])
    assert publish(links(spark), "nexo_bc", root, root, [OLD]) == 0
    assert (codes(spark, root, OLD), codes(spark, root, NEW)) == ([], [3])
    df = read_period(spark, f"{root}/nexo_bc", "nexo_bc", OLD)
    guards.check_schema(df, LINKS, "t")


def test_an_empty_period_next_to_a_full_one(spark, root):
    publish(links(spark, (1, OLD)), "nexo_bc", root, root, [OLD])
    publish(links(spark, (3, NEW)), "nexo_bc", root, root, [OLD, NEW])
    assert (codes(spark, root, OLD), codes(spark, root, NEW)) == ([], [3])


def test_several_periods_do_not_scatter_into_small_files(spark, root):
    df = spark.range(0, 4000, 1, 16).selectExpr(
        "cast(id as int) as cod_com", "1 as cod_mz", "1 as cod_pr",
        f"if(id % 2 = 0, '{OLD}', '{NEW}') as periodo",
        "1 as cod_com_bc", "1 as cod_mz_bc", "1 as cod_pr_bc",
    )
    publish(df, "nexo_bc", root, root, [OLD, NEW])
    for period in (OLD, NEW):
        files = os.listdir(f"{root}/nexo_bc/periodo={period}")
        assert len([f for f in files if f.endswith(".parquet")]) == 1


def test_period_stays_text(spark, root):
    publish(links(spark, (1, NEW)), "nexo_bc", root, root, [NEW])
    assert dict(spark.read.parquet(f"{root}/nexo_bc").dtypes)["periodo"] == "string"


def unchanged(spark, root, action):
    publish(links(spark, (1, NEW)), "nexo_bc", root, root, [NEW])
    with pytest.raises(ContractError):
        action()
    assert codes(spark, root, NEW) == [1]


def test_foreign_period_is_refused(spark, root):
    for period in (OLD, None):
        unchanged(spark, root, lambda: publish(
            links(spark, (2, NEW), (3, period)), "nexo_bc", root, root, [NEW]))


@pytest.mark.parametrize("wrong", [{"pr": 70_000}, {"bc": 0}, {"bc": None}, {"pr": None}])
def test_bad_links_are_refused(spark, root, wrong):
    unchanged(spark, root, lambda: publish(
        links(spark, (2, NEW), **wrong), "nexo_bc", root, root, [NEW]))


def test_all_tables_are_inspected_before_any_is_written(spark, root):
    tables = {
        "codigo_material": spark.createDataFrame([("A", "a")], SCHEMAS["codigo_material"]),
        "precios_uf": spark.createDataFrame([], SCHEMAS["precios_uf"]),
    }
    with pytest.raises(ContractError, match="precios_uf"):
        publishing.publish(tables, root, root)
    assert not os.path.exists(root)


def test_known_figures_are_compared_with_what_was_written(spark, root):
    figures = {"rows": 2, f"period {NEW}": 2, "bad links": 0}
    with pytest.raises(ContractError, match="1 rows read back, 2 written"):
        publishing.publish({"nexo_bc": links(spark, (1, NEW))}, root, root, [NEW], {"nexo_bc": figures})


def test_wrong_schema_is_refused(spark, root):
    unchanged(spark, root, lambda: publish(
        links(spark, (2, NEW)).select(*reversed(LINKS.names)), "nexo_bc", root, root, [NEW]))


def test_empty_required_tables_are_refused(spark, root):
    for table, periods in (("construcciones", [NEW]), ("no_agricola", [NEW]), ("precios_uf", [])):
        with pytest.raises(ContractError):
            publish(spark.createDataFrame([], SCHEMAS[table]), table, root, root, periods)
    assert not os.path.exists(root)


@pytest.mark.parametrize("value", [float("inf"), float("-inf"), float("nan")])
def test_floats_must_be_finite(spark, root, value):
    bad = spark.createDataFrame([(1, 1, 1, 0.0, value)], SCHEMAS["coordenadas"])
    with pytest.raises(ContractError, match="not finite longitud"):
        publish(bad, "coordenadas", root, root)
    assert tuple(guards.non_finite_audit(bad, "coordenadas").first()) == (0, 1)


def test_overflow_of_a_float_is_caught(spark, root):
    df = spark.sql("SELECT date'2020-01-01' AS date, cast(1e300 AS float) AS uf")
    with pytest.raises(ContractError, match="not finite uf"):
        publish(df, "precios_uf", root, root)


def test_periods_only_where_they_belong(spark, root):
    with pytest.raises(ContractError):
        publish(links(spark, (1, NEW)), "nexo_bc", root, root)
    lookup = spark.createDataFrame([("A", "b")], SCHEMAS["codigo_material"])
    with pytest.raises(ContractError):
        publish(lookup, "codigo_material", root, root, [NEW])


@pytest.mark.parametrize("bad", ["/agreed2", "/", "/agreed/../x", "", "/other/agreed"])
def test_destination(bad):
    assert guards.check_destination("/agreed/", "/agreed") == "/agreed"
    assert guards.check_destination("/agreed/sub", "/agreed/") == "/agreed/sub"
    with pytest.raises(ContractError):
        guards.check_destination(bad, "/agreed")


def test_read_back_check(spark, root):
    publish(links(spark, (1, NEW)), "nexo_bc", root, root, [NEW])
    with pytest.raises(ContractError, match="1 rows read back, 2 written"):
        guards.check_written_periods(spark, f"{root}/nexo_bc", "nexo_bc", {NEW: 2})
    with pytest.raises(ContractError, match="0 rows read back, 1 written"):
        guards.check_written_periods(spark, f"{root}/nexo_bc", "nexo_bc", {NEW: 1, OLD: 1})
    lookup = spark.createDataFrame([("A", "b")], SCHEMAS["codigo_material"])
    publish(lookup, "codigo_material", root, root)
    with pytest.raises(ContractError):
        guards.check_written_table(spark, f"{root}/codigo_material", "codigo_material", 5)


def test_overwrite_replaces_a_whole_table(spark, root):
    schema = SCHEMAS["codigo_material"]
    publish(spark.createDataFrame([("A", "a"), ("B", "b")], schema), "codigo_material", root, root)
    publish(spark.createDataFrame([("C", "c")], schema), "codigo_material", root, root)
    assert rows(spark.read.parquet(f"{root}/codigo_material")) == [("C", "c")]


def test_catalog_sees_every_period(spark, root):
    publish(links(spark, (1, OLD), (2, NEW), (3, NEW)), "nexo_bc", root, root, [OLD, NEW])
    catalog.register_table(spark, "predial_test", "nexo_bc", f"{root}/nexo_bc")
    assert rows(catalog.period_counts(spark, "predial_test", "nexo_bc")) == [(OLD, 1), (NEW, 2)]
    assert rows(catalog.row_count(spark, "predial_test", "nexo_bc")) == [(3,)]
    assert rows(catalog.bad_link_count(spark, "predial_test")) == [(0,)]
    assert len(rows(catalog.head(spark, "predial_test", "nexo_bc", 2))) == 2
    for name in ("x; drop", "predial`"):
        with pytest.raises(ContractError):
            catalog.row_count(spark, name, "nexo_bc")


def test_a_path_with_an_apostrophe(spark, tmp_path):
    root = str(tmp_path / "d'aval x")
    publish(links(spark, (1, NEW)), "nexo_bc", root, root, [NEW])
    catalog.register_table(spark, "predial_test", "nexo_bc", f"{root}/nexo_bc")
    assert rows(catalog.row_count(spark, "predial_test", "nexo_bc")) == [(1,)]


def test_a_table_that_fails_to_compute_leaves_all_as_they_were(spark, root):
    schema = SCHEMAS["codigo_material"]
    publish(spark.createDataFrame([("A", "a")], schema), "codigo_material", root, root)
    late = spark.range(3).selectExpr(
        "if(id < 2, cast(id as string), raise_error('late')) as cod_destino",
        "'x' as descripcion_destino", "'y' as tipo")
    tables = {
        "codigo_material": spark.createDataFrame([("B", "b")], schema), "codigo_destino": late,
    }
    with pytest.raises(Exception, match="late"):
        publishing.publish(tables, root, root)
    assert rows(spark.read.parquet(f"{root}/codigo_material")) == [("A", "a")]
    assert sorted(os.listdir(root)) == ["_commits", "codigo_material"]


def test_read_back_takes_one_job_whatever_the_number_of_periods(spark, root):
    periods = [f"{year}_{half}" for year in range(2010, 2020) for half in (1, 2)]
    publish(links(spark, *((1, p) for p in periods)), "nexo_bc", root, root, periods)
    group = "read-back"
    spark.sparkContext.setJobGroup(group, group)
    guards.check_written_periods(spark, f"{root}/nexo_bc", "nexo_bc", dict.fromkeys(periods, 1))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 4


def test_stage_survives_until_its_end(spark):
    with Stage(spark, "test") as stage:
        kept = stage.keep(spark.range(10), "ids")
        assert kept.count() == 10 and os.path.isdir(f"{stage.folder}/ids")
    assert not os.path.exists(stage.folder)


def test_registering_again_minds_only_what_changed(spark, root):
    old = [f"{year}_{half}" for year in range(2000, 2010) for half in (1, 2)]
    publish(links(spark, *((1, p) for p in old)), "nexo_bc", root, root, old)
    path, database = f"{root}/nexo_bc", "predial_again"
    catalog.register_table(spark, database, "nexo_bc", path)
    assert len(rows(catalog.period_counts(spark, database, "nexo_bc"))) == 20
    publish(links(spark, (1, NEW), (2, NEW)), "nexo_bc", root, root, [NEW])
    publish(links(spark, (8, old[0]), (9, old[0])), "nexo_bc", root, root, [old[0]])
    context = spark.sparkContext
    context.setJobGroup("register", "register")
    catalog.register_table(spark, database, "nexo_bc", path, changed=[NEW, old[0]])
    context.setLocalProperty("spark.jobGroup.id", None)
    assert not context.statusTracker().getJobIdsForGroup("register")
    counts = dict(rows(catalog.period_counts(spark, database, "nexo_bc")))
    assert counts[NEW] == 2 and counts[old[0]] == 2 and len(counts) == 21
    shown = spark.sql(f"DESCRIBE EXTENDED {database}.nexo_bc PARTITION (periodo = '{NEW}')").collect()
    assert any(r[0] == "Partition Statistics" and "bytes" in r[1] for r in shown)
    shutil.rmtree(f"{path}/periodo={old[1]}")
    catalog.register_table(spark, database, "nexo_bc", path)
    assert len(rows(catalog.period_counts(spark, database, "nexo_bc"))) == 20


def test_registering_another_folder_replaces_the_entry(spark, root):
    schema = SCHEMAS["codigo_material"]
    for name, word in (("one", "a"), ("two", "b")):
        publish(spark.createDataFrame([(word, word)], schema), "codigo_material", f"{root}/{name}", root)
        catalog.register_table(spark, "predial_again", "codigo_material", f"{root}/{name}/codigo_material")
        assert rows(catalog.head(spark, "predial_again", "codigo_material")) == [(word, word)]
