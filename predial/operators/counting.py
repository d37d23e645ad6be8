"""Many counters in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def tally(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: how many rows meet each condition. Null is not counted.

    One scan however many counters there are; only one row per task is shuffled.
    """
    return df.agg(*(F.count_if(cond).alias(name) for name, cond in conditions.items()))


def observed(df: DataFrame, watch: Observation, conditions: Mapping[str, Column]) -> DataFrame:
    """`df`, with the same counters taken by `watch` while it is written."""
    return df.observe(watch, *(F.count_if(cond).alias(name) for name, cond in conditions.items()))


def as_rows(one_row: DataFrame, key: str, value: str) -> DataFrame:
    """Turn a one-row result into (name, number) rows without leaving the cluster."""
    return one_row.unpivot([], one_row.columns, key, value)


def count_by(df: DataFrame, *keys: str, name: str = "registros") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))
