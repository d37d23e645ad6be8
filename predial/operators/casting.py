"""Strict projection onto a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from predial.contracts import ContractError


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order and cast them.

    Bad text and overflow fail the job, which takes ANSI casts: without them they would
    turn into null or wrap around unseen, so a session that has them off is refused.
    """
    if df.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise ContractError("strict casts need spark.sql.ansi.enabled (see predial.session)")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))


def conform_marked(df: DataFrame, schema: StructType, mark: str) -> DataFrame:
    """`conform`, and the text column `mark` if `df` has it."""
    extra = [StructField(mark, StringType())] if mark in df.columns else []
    return conform(df, StructType([*schema.fields, *extra]))


def check_schema(df: DataFrame, schema: StructType, label: str) -> DataFrame:
    """Names, types and order must match; nullability may differ. No job."""
    expected = [(f.name, f.dataType.simpleString()) for f in schema]
    if df.dtypes != expected:
        raise ContractError(f"{label}: schema is {df.dtypes}, expected {expected}")
    return df
