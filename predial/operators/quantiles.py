"""Quartiles, fences, box-plot figures and descriptive statistics of price columns.

Values travel in long form, `(precio, valor, n)`: the price column's name, a positive
value and how often it occurs. `n` is 1 straight from the table (`positive_values`) and
a total after `collapse`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from predial.contracts import QUARTILE_ERROR, WHISKER

QUARTILES = (0.25, 0.5, 0.75)

# The exact method narrows each quantile down in four steps. A step's cells are few
# whatever the table size: natural logarithms of doubles span 1,455, so the first step
# has under 750,000 cells; the second has 2^20 per quantile; one of those holds at most
# some 2^24 different doubles, which the third deals to 2^12 cells; and the last sorts the
# few thousand values of one of them.
CELLS_PER_LOG_UNIT = 512
CELLS_PER_RANGE = 1 << 20
CELLS_PER_CELL = 1 << 12


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).unpivot([], list(columns), "precio", "valor")


def positive_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _long(df, columns).filter(F.col("valor") > 0).withColumn("n", F.lit(1).cast("bigint"))


def collapse(values: DataFrame) -> DataFrame:
    """One row per different value: prices repeat, and a hot price becomes one row."""
    return values.groupBy("precio", "valor").agg(F.sum("n").alias("n"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Typed count, mean, sample deviation, minimum and maximum per column."""
    return _long(df, columns).groupBy("precio").agg(
        F.count("valor").alias("registros"),
        F.avg("valor").alias("media"),
        F.stddev_samp("valor").alias("desviacion"),
        F.min("valor").alias("minimo"),
        F.max("valor").alias("maximo"),
    )


def approx_quantiles(
    values: DataFrame, probs: Sequence[float] = QUARTILES, error: float = QUARTILE_ERROR
) -> DataFrame:
    """`(precio, p, cuantil)` within a relative rank error, in one pass over plain values."""
    wanted = F.array(*(F.lit(float(p)) for p in probs))
    found = values.groupBy("precio").agg(
        F.percentile_approx("valor", wanted, int(1 / error)).alias("found")
    )
    pairs = F.arrays_zip(wanted.alias("p"), F.col("found").alias("cuantil"))
    return found.select("precio", F.inline(pairs).alias("p", "cuantil"))


def _holding(cells: DataFrame, keys: Sequence[str], order: str, rank: Column) -> DataFrame:
    """The cell in which the wanted rank falls, with the rank counted inside it."""
    running = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("n").over(running) - F.col("n")
    return (
        cells.withColumn("before", before)
        .withColumn("inside", rank - F.col("before"))
        .filter((F.col("inside") >= 1) & (F.col("inside") <= F.col("n")))
    )


def _within(counts: DataFrame, picks: DataFrame) -> DataFrame:
    """Values inside the picked cells. `picks` has one row per price and quantile."""
    bounds = F.broadcast(
        picks.select(F.col("precio").alias("_precio"), "p", "inside", "low", "high")
    )
    match = (F.col("precio") == F.col("_precio")) & F.col("valor").between(
        F.col("low"), F.col("high")
    )
    return counts.join(bounds, match).drop("_precio")


def exact_quantiles(counts: DataFrame, probs: Sequence[float] = QUARTILES) -> DataFrame:
    """`(precio, p, cuantil)`: the smallest value that at least a share `p` does not exceed.

    `counts` is the result of `collapse`; its shuffle is made once and reused by every
    step. No step sorts more rows in one task than the cell limits above.
    """
    extent = (F.sum("n").alias("n"), F.min("valor").alias("low"), F.max("valor").alias("high"))
    cell = F.floor(F.ln("valor") * CELLS_PER_LOG_UNIT).alias("cell")
    coarse = counts.groupBy("precio", cell).agg(*extent)
    total = F.sum("n").over(Window.partitionBy("precio"))
    wanted = F.explode(F.array(*(F.lit(float(p)) for p in probs)))
    coarse = coarse.withColumn("total", total).withColumn("p", wanted)
    rank = F.greatest(F.ceil(F.col("p") * F.col("total")), F.lit(1))
    first = _holding(coarse, ["precio", "p"], "cell", rank)

    second = _narrowed(counts, first, CELLS_PER_RANGE)
    third = _narrowed(counts, second, CELLS_PER_CELL)
    last = _within(counts, third).withColumnRenamed("inside", "rank")
    found = _holding(last, ["precio", "p"], "valor", F.col("rank"))
    return found.select("precio", "p", F.col("valor").alias("cuantil"))


def _narrowed(counts: DataFrame, picks: DataFrame, cells: int) -> DataFrame:
    """The picked cells, cut into `cells` each, and of those the ones with the wanted ranks."""
    extent = (F.sum("n").alias("n"), F.min("valor").alias("low"), F.max("valor").alias("high"))
    span = F.col("high") - F.col("low")
    place = F.floor((F.col("valor") - F.col("low")) / span * cells)
    fine = (
        _within(counts, picks)
        .withColumn("cell", F.when(span > 0, place).otherwise(F.lit(0)))
        .groupBy("precio", "p", "cell")
        .agg(F.first("inside").alias("rank"), *extent)
    )
    return _holding(fine, ["precio", "p"], "cell", F.col("rank"))


def fences(quantiles: DataFrame) -> DataFrame:
    """One row per price: quartiles, median when asked for, range and outlier limits."""

    def at(p: float) -> Column:
        return F.max(F.when(F.col("p") == p, F.col("cuantil")))

    iqr = F.col("q3") - F.col("q1")
    return (
        quantiles.groupBy("precio")
        .agg(at(0.25).alias("q1"), at(0.5).alias("mediana"), at(0.75).alias("q3"))
        .withColumn("iqr", iqr)
        .withColumn("limite_inferior", F.col("q1") - WHISKER * F.col("iqr"))
        .withColumn("limite_superior", F.col("q3") + WHISKER * F.col("iqr"))
    )


def spread(values: DataFrame, limits: DataFrame) -> DataFrame:
    """Everything the two reports below show, in one pass over the values.

    `limits` has one row per price, so it is always broadcast.
    """

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    value, low, high = F.col("valor"), F.col("limite_inferior"), F.col("limite_superior")
    inside = value.between(low, high)
    keys = [c for c in limits.columns if c != "precio"]
    return (
        values.join(F.broadcast(limits), "precio")
        .groupBy("precio", *keys)
        .agg(
            F.sum("n").alias("validos"),
            total(value < low).alias("bajo_limite"),
            total(value > high).alias("sobre_limite"),
            F.min(F.when(inside, value)).alias("bigote_inferior"),
            F.max(F.when(inside, value)).alias("bigote_superior"),
            total(~inside).alias("atipicos"),
        )
    )


def iqr_report(spread: DataFrame) -> DataFrame:
    """Quartiles, fences and how many values lie beyond them.

    A price without positive values has no row.
    """
    return spread.select(
        "precio", "q1", "q3", "iqr", "limite_inferior", "limite_superior",
        "validos", "bajo_limite", "sobre_limite",
    )


def box_summary(spread: DataFrame) -> DataFrame:
    """What a box plot shows: box, median, whisker ends and number of outliers."""
    return spread.select(
        "precio", "q1", "mediana", "q3", "bigote_inferior", "bigote_superior",
        "atipicos", "validos",
    )
