"""Parquet writers: whole tables and single periods."""

from __future__ import annotations

from pyspark.sql import DataFrame

from predial.contracts import PERIOD
from predial.sources.tables import period_folder


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def by_period(df: DataFrame, periods: int) -> DataFrame:
    """Rows dealt so that a period's end up in few files.

    With one period every task writes one file. With more, tasks that hold rows of
    many periods would each write many small files; the hint makes adaptive execution
    group by period and cut large periods into parts of the advisory size.
    """
    return df.hint("rebalance", PERIOD) if periods > 1 else df


def overwrite_periods(df: DataFrame, path: str) -> None:
    """Replace the periods present in `df` and leave the others alone."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PERIOD).parquet(path)


def replace_empty_period(df: DataFrame, path: str, period: str) -> None:
    """Clear one period. A dynamic overwrite without rows would leave it as it was."""
    df.limit(0).drop(PERIOD).write.mode("overwrite").parquet(period_folder(path, period))
