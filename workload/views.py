"""The raw-shaped views in Spark, over whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.contracts import RAW_BUILDINGS, RAW_PROPERTIES
from workload import fixture_columns as fx


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    words = fx.DIALECTS["spark"]
    return df.selectExpr(
        *(f"{e.format(**words) if '{' in e else e} as {c}" for c, e in columns.items())
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text sales. Rows whose commune ends in 7 occur twice; the table is read once."""
    sales = _select(_select(table(spark, sf_dir, "orders"), fx.ORDER_KEYS), fx.SALES)
    copies = F.when(F.right("cod_com", F.lit(1)) == "7", 2).otherwise(1)
    return sales.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("cast(o_orderdate as date) as d").distinct()


def raw_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _days(spark, sf_dir).filter("day(d) <> 13")
    return _select(days, {"date": "cast(d as string)", "uf": fx.RATE})


def raw_faulty_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With bad values, repeated rows (day 2) and contradictory rows (day 1)."""
    days = _days(spark, sf_dir).selectExpr(
        "d", "explode(if(day(d) <= 2, array(false, true), array(false))) as again"
    )
    rate = f"case when again and day(d) = 1 then {fx.NEXT_RATE} else {fx.FAULTY_RATE} end"
    return _select(days, {"date": "cast(d as string)", "uf": rate})


def _with_key(columns: dict[str, str], period: bool) -> dict[str, str]:
    return columns | ({"periodo": fx.PERIOD} if period else {"periodo": "'2026_1'"})


def raw_buildings(spark: SparkSession, sf_dir: str, periods: bool = False) -> DataFrame:
    lines = _select(table(spark, sf_dir, "lineitem"), fx.LINE_KEYS)
    return _select(lines, _with_key(fx.BUILDINGS, periods))


def raw_properties(spark: SparkSession, sf_dir: str, periods: bool = False) -> DataFrame:
    orders = _select(table(spark, sf_dir, "orders"), fx.ORDER_KEYS)
    return _select(orders, _with_key(fx.PROPERTIES, periods))


def file_columns(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Raw file order, with the fields nothing reads as blanks."""
    blank = F.lit(None).cast("string")
    return df.select(*(F.col(c) if c in df.columns else blank.alias(c) for c in names))


def building_file(df: DataFrame) -> DataFrame:
    return file_columns(df, RAW_BUILDINGS)


def property_file(df: DataFrame) -> DataFrame:
    return file_columns(df, RAW_PROPERTIES)


def raw_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "supplier"), fx.COORDINATES)


def raw_communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "cast(n_nationkey as string) as cod_com",
        "cast(r_regionkey as string) as cod_region",
        "n_name as comuna",
        "r_name as region",
    )


def raw_uses(spark: SparkSession, sf_dir: str) -> DataFrame:
    priorities = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return _select(priorities, fx.USES)


def raw_materials(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.selectExpr("p_brand as cod_material", "p_brand as descripcion_material")
