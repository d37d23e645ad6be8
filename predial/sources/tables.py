"""Published Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.contracts import PERIOD, PERIOD_TABLES, SCHEMAS
from predial.sinks.commits import current_folders
from predial.sinks.folders import Folders
from predial.sources.text import check_period


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table at its folder, or wherever its published folders still are.

    After a run that was killed while it replaced several tables this reads all of the new
    ones, though some haven't been moved to their places yet.
    """
    root, _, table = path.rstrip("/").rpartition("/")
    moved = current_folders(spark, root, table) if table in SCHEMAS else {}
    if not moved:
        return spark.read.parquet(path)
    if table not in PERIOD_TABLES:
        return spark.read.parquet(moved[table])
    names = Folders(spark, root).names(path)
    parts = {f"{table}/{n}": f"{path}/{n}" for n in names if n.startswith(f"{PERIOD}=")} | moved
    # Folders of one base are one scan; the bases are the table's and those of open versions.
    bases: dict[str, list[str]] = {}
    for folder in parts.values():
        bases.setdefault(folder.rpartition("/")[0], []).append(folder)
    frames = [spark.read.option("basePath", base).parquet(*f) for base, f in bases.items()]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole.select(*SCHEMAS[table].names)


def period_folder(path: str, period: str) -> str:
    return f"{path.rstrip('/')}/{PERIOD}={check_period(period)}"


def read_period(spark: SparkSession, path: str, table: str, period: str) -> DataFrame:
    """One period of a partitioned table, columns in contract order.

    Only that folder is listed. A period without rows may hold no file that
    tells Spark about the partition column, so it is put back when absent.
    """
    root, _, name = path.rstrip("/").rpartition("/")
    moved = current_folders(spark, root, name) if name in SCHEMAS else {}
    folder = moved.get(f"{name}/{PERIOD}={check_period(period)}", period_folder(path, period))
    df = spark.read.option("basePath", folder.rpartition("/")[0]).parquet(folder)
    if PERIOD not in df.columns:
        df = df.withColumn(PERIOD, F.lit(period))
    return df.select(*SCHEMAS[table].names)
