"""Output folders as catalog tables, and the SQL checks run on them."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from predial.contracts import PERIOD, PERIOD_TABLES, SCHEMAS, ContractError
from predial.sinks.folders import Folders
from predial.sources.text import check_period


def _qualified(database: str, table: str) -> str:
    if table not in SCHEMAS or not re.fullmatch(r"[A-Za-z0-9_-]+", database):
        raise ContractError(f"no table {database}.{table}")
    return f"`{database}`.`{table}`"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _is_over(spark: SparkSession, name: str, table: str, path: str) -> bool:
    """Whether the catalog's table is the contract's one over this folder."""
    if not spark.catalog.tableExists(name.replace("`", "")):
        return False
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()  # a row a column, and a few
    location = next((r["data_type"] for r in rows if r["col_name"] == "Location"), "")
    expected = [(f.name, f.dataType.simpleString()) for f in SCHEMAS[table]]
    folders = Folders(spark, path)
    same = folders.qualified(location) == folders.qualified(path)
    return same and spark.table(name).dtypes == expected


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    changed: Iterable[str] | None = None,
) -> str:
    """An external table over a folder, with the periods that the folder holds.

    A table that is registered already stays. Its periods are compared with the names of the
    folders, which takes one listing of names and no job, and only new and vanished ones are
    added and dropped. `changed` names periods that were written since (by default all that
    the catalog has no size of): their sizes are measured for the planner, file by file,
    without reading them. Periods that were neither written nor removed cost nothing.
    """
    name = _qualified(database, table)
    partitioned = table in PERIOD_TABLES
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if not _is_over(spark, name, table, path):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[table])
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            + (f"PARTITIONED BY ({PERIOD}) " if partitioned else "")
            + f"LOCATION '{_quoted(path)}'"
        )
    if partitioned:
        _match_periods(spark, name, path, changed)
    else:
        spark.sql(f"REFRESH TABLE {name}")
    return name


def _match_periods(
    spark: SparkSession, name: str, path: str, changed: Iterable[str] | None
) -> None:
    prefix = f"{PERIOD}="
    folders = Folders(spark, path).names(path)
    present = {n.removeprefix(prefix) for n in folders if n.startswith(prefix)}
    listed = spark.sql(f"SHOW PARTITIONS {name}").collect()  # a row a period
    known = {r[0].removeprefix(prefix) for r in listed}
    new, gone = sorted(present - known), sorted(known - present)

    def parts(periods: Iterable[str]) -> str:
        return " ".join(f"PARTITION ({PERIOD} = '{check_period(p)}')" for p in periods)

    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts(new)}")
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts(gone).replace(') PARTITION', '), PARTITION')}")
    written = {*new, *(p for p in changed or () if p in present)}
    for period in sorted(written):
        spark.sql(f"ANALYZE TABLE {name} {parts([period])} COMPUTE STATISTICS NOSCAN")
    spark.sql(f"REFRESH TABLE {name}")


def head(spark: SparkSession, database: str, table: str, rows: int = 10) -> DataFrame:
    """First rows, in the order of all columns so that runs agree."""
    order = ", ".join(f"`{c}`" for c in SCHEMAS[table].names)
    return spark.sql(
        f"SELECT * FROM {_qualified(database, table)} ORDER BY {order} LIMIT {int(rows)}"
    )


def row_count(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.sql(f"SELECT count(*) AS registros FROM {_qualified(database, table)}")


def period_counts(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.sql(
        f"SELECT {PERIOD}, count(*) AS registros FROM {_qualified(database, table)} "
        f"GROUP BY {PERIOD}"
    )


def bad_link_count(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"""
        SELECT count(*) AS nexos_invalidos FROM {_qualified(database, "nexo_bc")}
        WHERE NOT coalesce(cod_com_bc <> 0 AND cod_pr < 70000, false)""")


def pending_count(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"""
        SELECT count_if(coalesce(precio_clp, precio_uf) IS NULL) AS ambos_precios_pendientes
        FROM {_qualified(database, "precios_transaccionales")}""")
