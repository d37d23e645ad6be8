"""Random sample of a bounded number of rows: bottom-k by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from predial.contracts import SAMPLE_ROWS, SAMPLE_SEED

# Copies of one row that a task numbers; the copies of a hotter row are dealt over tasks.
COPIES_AT_ONCE = 100_000


def _as_text(df: DataFrame, name: str) -> Column:
    """A text that any engine would write alike: numbers by their hundredths, rounded down."""
    value = F.col(name)
    if not isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return value.cast("string")
    hundredths = F.floor(value.cast("double") * 100).cast("string")  # a long
    return F.when(F.abs(value) < 9e16, hundredths).otherwise(value.cast("string"))


def row_hash(df: DataFrame, seed: int, copy: str) -> Column:
    """Hash of a row and the number of the copy, 128 bits as hexadecimal text.

    Null differs from empty, and no two rows of texts have one spelling.
    """
    fields = []
    for name in df.columns:
        text = _as_text(df, name)
        fields += [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))]
    return F.md5(F.concat(F.lit(f"{seed},"), F.col(copy).cast("string"), F.lit(","), *fields).cast("binary"))


def numbered_copies(df: DataFrame, copy: str) -> DataFrame:
    """Every row with the number of the copy it is, from 1: the same on any partitioning.

    Equal rows meet inside each task first, so a row that fills a third of the table is
    shuffled once per task; its copies are then numbered in stretches dealt over tasks.
    """
    n, low = f"{copy}_n", f"{copy}_low"
    groups = df.groupBy(*df.columns).agg(F.count("*").alias(n))
    few = groups.filter(F.col(n) <= COPIES_AT_ONCE).select(
        *df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))).alias(copy)
    )
    starts = F.sequence(F.lit(1).cast("long"), F.col(n), F.lit(COPIES_AT_ONCE).cast("long"))
    many = groups.filter(F.col(n) > COPIES_AT_ONCE).withColumn(low, F.explode(starts))
    high = F.least(F.col(n), F.col(low) + (COPIES_AT_ONCE - 1))
    dealt = many.repartition(low).select(
        *df.columns, F.explode(F.sequence(F.col(low), high)).alias(copy)
    )
    return few.unionByName(dealt)


def capped_sample(
    df: DataFrame, max_rows: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED
) -> DataFrame:
    """`max_rows` random rows, or all if there are fewer; the same ones on any partitioning.

    Those with the smallest hash of seed, row and number of the copy. Each task keeps its
    smallest, and the smallest of all tasks' are the sample, so one pass does it without
    the total: a scan, a shuffle of the different rows, and `max_rows` rows of each task.
    """
    copy, order = "_copia", "_orden"
    numbered = numbered_copies(df, copy).withColumn(order, row_hash(df, seed, copy))
    return numbered.orderBy(order, *df.columns).limit(max_rows).select(*df.columns)
