"""Raw delimited text. Every column is read as a string.

Files must be splittable (plain text, or one of Spark's splittable codecs) to be
read by more than one task each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.contracts import (
    PERIOD,
    PERIOD_PATTERN,
    RAW_BUILDINGS,
    RAW_PROPERTIES,
    ContractError,
)
from predial.functions.parsing import blank_to_null
from predial.sources.headers import columns_of, files_by_header


def require_columns(df: DataFrame, columns: Iterable[str], label: str) -> DataFrame:
    """Fail, without a job, when a column is missing."""
    missing = sorted(c for c in columns if c not in df.columns)
    if missing:
        raise ContractError(f"{label}: missing {missing}, found {df.columns}")
    return df


def _named(df: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    if len(df.columns) != len(names):
        raise ContractError(f"{label}: {len(names)} fields expected, {len(df.columns)} read")
    return df.toDF(*names)


def read_headered(
    spark: SparkSession,
    path: str,
    names: Sequence[str] | None = None,
    sep: str = ",",
    marked: bool = False,
) -> DataFrame:
    """Text with header lines, of one file or a folder of them.

    Each file's columns go by its own header (`headers.columns_of`), and a column that its
    header lacks is null. `names` replaces a header with other titles by position. With
    `marked`, lines of another width than their header carry a mark (`read_marked`).
    """
    headers = files_by_header(spark, path, sep)
    if len(headers) < 2 and names is None:
        df = spark.read.csv(path, header=True, inferSchema=False, sep=sep)
        return read_marked(spark, path, df.columns, sep, header=True) if marked else df
    if not headers:
        raise ContractError(f"{path}: {len(names)} fields expected, none read")
    columns = columns_of(headers, names, path)
    wanted = list(names or max(columns.values(), key=len))
    parts = []
    for titles, own in columns.items():
        files = path if len(headers) == 1 else headers[titles]
        if marked:
            part = read_marked(spark, files, own, sep, header=True)
        else:
            schema = ", ".join(f"`{c}` string" for c in own)
            part = spark.read.schema(schema).csv(files, header=True, sep=sep)
        absent = {c: F.lit(None).cast("string") for c in wanted if c not in own}
        mark = [WIDTH] if marked else []
        parts.append(part.select(*(absent.get(c, F.col(c)).alias(c) for c in wanted), *mark))
    return reduce(DataFrame.unionByName, parts)


def read_delimited(
    spark: SparkSession, path: str, names: Sequence[str], sep: str = "|"
) -> DataFrame:
    """Text without a header; the first line must have as many fields as `names`."""
    return _named(spark.read.csv(path, header=False, inferSchema=False, sep=sep), names, path)


# Name of the mark of lines whose number of fields is wrong, and of Spark's copy of them.
WIDTH = "_ancho"
_LINE = "_linea"
SHORT, LONG = "corta", "larga"


def read_marked(
    spark: SparkSession,
    paths: str | Sequence[str],
    names: Sequence[str],
    sep: str,
    header: bool = False,
    file_path: str | None = None,
) -> DataFrame:
    """Text of a fixed width in one scan: `names`, and the mark `WIDTH`.

    A line with too few or too many fields is marked short or long (by its separators), and
    its fields, which may have shifted, are null. The mark needs every field parsed, so the
    scan doesn't leave out columns. `file_path` asks for a column with the line's file.
    """
    schema = ", ".join(f"`{c}` string" for c in (*names, _LINE))
    lines = (
        spark.read.schema(schema)
        .options(sep=sep, header=header, mode="PERMISSIVE", columnPruning=False)
        .option("columnNameOfCorruptRecord", _LINE)
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    fields = F.length(_LINE) - F.length(F.replace(_LINE, F.lit(sep), F.lit(""))) + 1
    short = F.col(names[-1]).isNull() & (fields < len(names))
    whole = F.col(_LINE).isNull()
    kind = F.when(~whole, F.when(short, SHORT).otherwise(LONG))
    path = [F.col("_metadata.file_path").alias(file_path)] if file_path else []
    return lines.select(
        *(F.when(whole, F.col(c)).alias(c) for c in names), kind.alias(WIDTH), *path
    )


def width_report(df: DataFrame, *keys: str) -> DataFrame:
    """How many lines of each kind were too short or too long."""
    return df.filter(F.col(WIDTH).isNotNull()).groupBy(*keys, WIDTH).agg(
        F.count("*").alias("registros")
    )


def refuse_ragged(df: DataFrame, label: str, *keys: str) -> DataFrame:
    """Fail, naming the counts, if lines are marked; without marks, `df` minus the mark."""
    if WIDTH not in df.columns:
        return df
    found = sorted(map(tuple, width_report(df, *keys).collect()))  # a few kinds and periods
    if found:
        raise ContractError(f"{label}: lines of wrong width {found}")
    return df.drop(WIDTH)


def tidy_text(df: DataFrame) -> DataFrame:
    """Trim every column and turn blanks into null, in one projection."""
    return df.select(*(blank_to_null(c).alias(c) for c in df.columns))


def check_period(period: str) -> str:
    if not re.fullmatch(PERIOD_PATTERN, period):
        raise ContractError(f"period {period!r} is not year_semester, such as 2026_1")
    return period


def period_path(base: str, table: str, period: str) -> str:
    return f"{base.rstrip('/')}/{table}/{check_period(period)}.csv"


def read_periods(
    spark: SparkSession, base: str, table: str, periods: Sequence[str],
    names: Sequence[str], sep: str = "|", marked: bool = True,
) -> DataFrame:
    """All periods of a table in one scan, tidied, with `periodo` from the file's path.

    With `marked`, lines of the wrong width carry a mark (`read_marked`); without, they are
    cut or filled up with nulls.
    """
    paths = [period_path(base, table, period) for period in periods]
    if marked:
        lines = read_marked(spark, paths, names, sep, file_path="_archivo")
    else:
        schema = ", ".join(f"`{c}` string" for c in names)
        lines = spark.read.schema(schema).csv(paths, sep=sep).select(
            *names, F.col("_metadata.file_path").alias("_archivo")
        )
    period = F.regexp_extract("_archivo", f"/({PERIOD_PATTERN})[.]csv(?:/[^/]*)?$", 1)
    return tidy_text(lines.withColumn(PERIOD, period).drop("_archivo"))


def read_buildings(
    spark: SparkSession, base: str, period: str,
    names: Sequence[str] = RAW_BUILDINGS, sep: str = "|",
) -> DataFrame:
    return tidy_text(read_delimited(spark, period_path(base, "construcciones", period), names, sep))


def read_properties(
    spark: SparkSession, base: str, period: str,
    names: Sequence[str] = RAW_PROPERTIES, sep: str = "|",
) -> DataFrame:
    return tidy_text(read_delimited(spark, period_path(base, "no_agricola", period), names, sep))
