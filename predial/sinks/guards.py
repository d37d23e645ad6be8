"""Checks that must pass before anything is overwritten, and after it was."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.contracts import PERIOD, SCHEMAS, ContractError, float_columns
from predial.functions.rules import is_bad_link, not_finite
from predial.operators.casting import check_schema
from predial.operators.counting import count_by
from predial.sources.tables import read_table

Figures = Mapping[str, int]


def check_destination(root: str, agreed: str) -> str:
    """Allow the agreed root or a folder under it, and nothing else."""
    root, agreed = root.rstrip("/"), agreed.rstrip("/")
    inside = root == agreed or root.startswith(agreed + "/")
    if not agreed or not inside or ".." in root.split("/"):
        raise ContractError(f"{root} is not under {agreed}")
    return root


def check_not_empty(df: DataFrame, label: str) -> DataFrame:
    if df.isEmpty():
        raise ContractError(f"{label}: the source has no rows")
    return df


def non_finite_audit(df: DataFrame, table: str) -> DataFrame:
    """NaN and infinities per float column of a finished table."""
    names = float_columns(SCHEMAS[table])
    return df.agg(*(F.count_if(not_finite(F.col(c))).alias(c) for c in names))


def bad_links(df: DataFrame) -> DataFrame:
    return df.filter(is_bad_link())


def foreign_periods(df: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Rows per period that should not be there; a null period is one."""
    expected = F.coalesce(F.col(PERIOD).isin(*periods), F.lit(False))
    return count_by(df.filter(~expected), PERIOD)


def measures(table: str, periods: Sequence[str] = ()) -> list[Column]:
    """Every figure the guards need, as aggregates over a finished table."""
    figures = [F.count(F.lit(1)).alias("rows")]
    figures += [F.count_if(F.col(PERIOD) == p).alias(f"period {p}") for p in periods]
    figures += [
        F.count_if(not_finite(F.col(c))).alias(f"not finite {c}")
        for c in float_columns(SCHEMAS[table])
    ]
    if table == "nexo_bc":
        figures.append(F.count_if(is_bad_link()).alias("bad links"))
    return figures


def measure(df: DataFrame, table: str, periods: Sequence[str] = ()) -> Mapping[str, int]:
    """The figures in one pass and one row."""
    return df.agg(*measures(table, periods)).first().asDict()


# Names of the parts of a checksum. A hash of 64 bits is summed up in three parts of at most
# 22 bits, so the sums of a million million rows fit a long.
CHECKSUM = ("suma 0", "suma 22", "suma 44")


def checksum(columns: Sequence[str]) -> list[Column]:
    """Aggregates that tell a table's content, in any order of rows and with repeated rows.

    The hash passes over nulls, so which columns are null is hashed as well.
    """
    empty = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns))
    row = F.xxhash64(empty, *columns)
    return [
        F.coalesce(
            F.sum(F.shiftrightunsigned(row, int(name.split()[1])).bitwiseAND(F.lit((1 << 22) - 1))),
            F.lit(0),
        ).alias(name)
        for name in CHECKSUM
    ]


def check_measures(
    figures: Figures, table: str, periods: Sequence[str] = (), may_be_empty: bool = False
) -> None:
    by_period = {p: figures[f"period {p}"] for p in periods}
    if periods and sum(by_period.values()) != figures["rows"]:
        raise ContractError(f"{table}: rows of periods other than {list(periods)}")
    empty = [p for p, n in by_period.items() if n == 0] if periods else figures["rows"] == 0
    if empty and not may_be_empty:
        raise ContractError(f"{table}: nothing to write {empty if periods else ''}".rstrip())
    wrong = {k: n for k, n in figures.items() if n and k.startswith(("not finite", "bad links"))}
    if wrong:
        raise ContractError(f"{table}: {wrong}")


def check_written_table(
    spark: SparkSession, path: str, table: str, expected: int, content: Figures | None = None
) -> int:
    """The rows read back, and with `content` their checksum too; one scan."""
    df = check_schema(read_table(spark, path), SCHEMAS[table], path)
    return _check_read_back(df, path, table, {None: expected}, content)


def check_written_periods(
    spark: SparkSession, path: str, table: str, expected: Mapping[str, int],
    content: Figures | None = None,
) -> None:
    """Rows per period, and the checksum of them all; a period without files has none."""
    df = check_schema(read_table(spark, path).select(*SCHEMAS[table].names), SCHEMAS[table], path)
    _check_read_back(df.filter(F.col(PERIOD).isin(*expected)), path, table, expected, content)


def _check_read_back(
    df: DataFrame, path: str, table: str, expected: Mapping, content: Figures | None
) -> int:
    sums = checksum(SCHEMAS[table].names) if content else []
    by = [PERIOD] if None not in expected else []
    counted = df.groupBy(*by).agg(F.count("*").alias("registros"), *sums).collect()  # a row a period
    found = {row[PERIOD] if by else None: row["registros"] for row in counted}
    for part, rows in expected.items():
        _check_rows(found.get(part, 0), f"{path} {part or ''}".rstrip(), rows)
    if content:
        read = {name: sum(row[name] for row in counted) for name in CHECKSUM}
        if read != {name: content[name] for name in CHECKSUM}:
            raise ContractError(f"{path}: other values read back than were written")
    return sum(found.values())


def _check_rows(found: int, label: str, expected: int) -> None:
    if found != expected:
        raise ContractError(f"{label}: {found} rows read back, {expected} written")
