import pytest

from conftest import rows
from predial.contracts import RAW_BUILDINGS, SCHEMAS, ContractError
from predial.operators.casting import check_schema, conform
from predial.sources import text


def put(tmp_path, name, content):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)
    return str(path)


def test_headered_text_edge_rows(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'p,q,r\n1,,"x"\n2,"",y\n3\n4,a,b,c\n\n5, s ,t\n007,u,v\n')
    found = rows(text.read_headered(spark, path))
    assert found == [
        ("007", "u", "v"), ("1", None, "x"), ("2", None, "y"), ("3", None, None),
        ("4", "a", "b"), ("5", " s ", "t"),
    ]


def test_names_replace_the_header_by_position(spark, tmp_path):
    path = put(tmp_path, "a.csv", "P,Q\n1,2\n")
    assert text.read_headered(spark, path, ("a", "b")).columns == ["a", "b"]
    with pytest.raises(ContractError):
        text.read_headered(spark, path, ("a", "b", "c"))


def test_delimited_text_and_its_width(spark, tmp_path):
    line = "|".join(["1", "2", "3", "1", "A", " 4 ", "0", "50", "H", "  ", "", ""])
    base = str(tmp_path)
    path = put(tmp_path, "construcciones/2026_1.csv", line + "\n")
    df = text.read_buildings(spark, base, "2026_1")
    assert df.columns == list(RAW_BUILDINGS)
    assert rows(df) == [("1", "2", "3", "1", "A", "4", "0", "50", "H", None, None, None)]
    with pytest.raises(ContractError):
        text.read_delimited(spark, path, RAW_BUILDINGS[:-1])


def test_comma_layout_with_other_names(spark, tmp_path):
    put(tmp_path, "construcciones/2026_1.csv", "1,2,3,x\n")
    df = text.read_buildings(spark, str(tmp_path), "2026_1", ("cod_com", "cod_mz", "cod_pr", "z"), ",")
    assert rows(df) == [("1", "2", "3", "x")]


def test_required_columns(spark):
    df = spark.createDataFrame([("1",)], "a string")
    assert text.require_columns(df, ["a"], "t") is df
    with pytest.raises(ContractError, match=r"\['b', 'c'\]"):
        text.require_columns(df, ["c", "a", "b"], "t")


@pytest.mark.parametrize("period", ["2026_3", "2026-1", "26_1", "2026_1 ", "2026_11", ""])
def test_bad_period(period):
    with pytest.raises(ContractError):
        text.period_path("/x", "construcciones", period)


def test_period_path():
    assert text.period_path("/x/", "no_agricola", "2025_2") == "/x/no_agricola/2025_2.csv"


def test_schema_check_minds_name_type_and_order(spark):
    schema = SCHEMAS["precios_uf"]
    good = spark.createDataFrame([], schema)
    check_schema(good, schema, "t")
    for bad in ("uf float, date date", "date date, uf double", "date date"):
        with pytest.raises(ContractError):
            check_schema(spark.createDataFrame([], bad), schema, "t")


@pytest.mark.parametrize("text_value", ["x", "12.5", "99999999999"])
def test_strict_cast_fails(spark, text_value):
    schema = SCHEMAS["nexo_bc"]
    row = tuple(text_value if c == "cod_pr" else "1" for c in schema.names)
    df = spark.createDataFrame([row], [c for c in schema.names])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW"):
        conform(df, schema).collect()


def test_lines_of_wrong_width_are_marked(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'a,b,c\n1,"x,y",z\n2,x\n3,x,y,z\n4,,\n\n5\n')
    df = text.read_headered(spark, path, ("p", "q", "r"), marked=True)
    assert rows(df) == [
        ("1", "x,y", "z", None), ("4", None, None, None), (None, None, None, "corta"),
        (None, None, None, "corta"), (None, None, None, "larga")]
    assert rows(text.width_report(df.select("p", text.WIDTH))) == [("corta", 2), ("larga", 1)]
    with pytest.raises(ContractError, match="corta', 2"):
        text.refuse_ragged(df, "a")
    clean = text.read_headered(spark, put(tmp_path, "b.csv", "a,b\n1,2\n"), marked=True)
    assert text.refuse_ragged(clean, "b").columns == ["a", "b"]


def test_many_periods_in_one_scan(spark, tmp_path):
    names = ("cod_com", "cod_mz", "x")
    put(tmp_path, "t/2025_2.csv", "1|2|a\n3|4\n")
    put(tmp_path, "t/2026_1.csv/part-0.csv", " 5 |6| \n7|8|b|c\n")
    df = text.read_periods(spark, str(tmp_path), "t", ["2025_2", "2026_1"], names)
    assert rows(df.filter("_ancho is null").drop("_ancho")) == [
        ("1", "2", "a", "2025_2"), ("5", "6", None, "2026_1")]
    assert rows(text.width_report(df, "periodo")) == [
        ("2025_2", "corta", 1), ("2026_1", "larga", 1)]
    plain = text.read_periods(spark, str(tmp_path), "t", ["2025_2", "2026_1"], names, marked=False)
    assert ("3", "4", None, "2025_2") in rows(plain) and ("7", "8", "b", "2026_1") in rows(plain)
    scans = df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")
    assert scans == 1
