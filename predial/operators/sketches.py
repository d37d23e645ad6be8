"""Quartiles from stored sketches: a new part of the data costs its own scan only.

A KLL sketch of each price column is kept per part (a period, a delivery). Sketches of any
parts merge into that of their union, so quartiles over everything that was ever delivered
read a few hundred kilobytes a part and none of its rows. A part that is delivered again
replaces its sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.operators.quantiles import QUARTILES
from predial.sinks.folders import Folders

# Ranks are off by 0.0004 of the rows at most, in 99 of 100 sketches, merged ones too; the
# reports allow 0.001.
ACCURACY = 1 << 14
PART, NO_PART = "parte", "sin_parte"


def part_sketches(df: DataFrame, columns: Sequence[str], part: Column) -> DataFrame:
    """(parte, precio, registros, boceto): a sketch of the positive values of each column.

    One pass; tasks sketch what they read, and only sketches are shuffled, so a part that
    holds a third of the rows is one sketch a task. Rows of no part are a part of their own.
    """
    named = df.select(*columns, F.coalesce(part.cast("string"), F.lit(NO_PART)).alias(PART))
    values = named.unpivot([PART], list(columns), "precio", "valor").filter(F.col("valor") > 0)
    return values.groupBy(PART, "precio").agg(
        F.count("*").alias("registros"),
        F.kll_sketch_agg_double("valor", F.lit(ACCURACY)).alias("boceto"),
    )


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Put the sketches beside those of other parts, replacing those of the same parts."""
    writer = sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PART).parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_quantiles(
    sketches: DataFrame, probs: Sequence[float] = QUARTILES
) -> DataFrame:
    """(precio, p, cuantil) over all parts; a price without values has no rows."""
    merged = sketches.groupBy("precio").agg(F.kll_merge_agg_double("boceto").alias("boceto"))
    found = F.array(*(
        F.struct(
            F.lit(float(p)).alias("p"),
            F.kll_sketch_get_quantile_double("boceto", F.lit(float(p))).alias("cuantil"),
        )
        for p in probs
    ))
    return merged.select("precio", F.inline(found))


def stored_parts(spark: SparkSession, path: str) -> list[str]:
    """The parts that have sketches, by the names of their folders."""
    names = Folders(spark, path).names(path)
    return [n.removeprefix(f"{PART}=") for n in names if n.startswith(f"{PART}=")]
