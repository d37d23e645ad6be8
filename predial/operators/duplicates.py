"""Exact duplicates and repeated keys.

All of it is hash aggregation with a map-side combine: equal rows meet inside each
task first, so a row or key that makes up a third of the table is shuffled as one
record per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus rows, in one scan and one shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("registros"),
        F.count("*").alias("unicos"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicados"),
    )


def repeated(df: DataFrame, keys: Sequence[str], name: str = "registros") -> DataFrame:
    """Key combinations found more than once. Null keys form a group of their own."""
    groups = df.groupBy(*keys).agg(F.count("*").alias(name))
    return groups.filter(F.col(name) > 1)


def most_repeated(groups: DataFrame, rows: int = 5, name: str = "registros") -> DataFrame:
    """The largest groups; ties are settled by the key so that runs agree."""
    ties = [c for c in groups.columns if c != name]
    return groups.orderBy(F.desc(name), *ties).limit(rows)
