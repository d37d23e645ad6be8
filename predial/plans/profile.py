"""Profile of raw sale prices: gaps, copies, invalid values, spread."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predial.contracts import (
    PRICES,
    QUARTILE_ERROR,
    RAW_SALES,
    ROL,
    SALE_DATE_FORMAT,
    SAMPLE_ROWS,
    SAMPLE_SEED,
)
from predial.functions.parsing import is_blank, to_date, to_int, to_number
from predial.functions.rules import any_of, all_of, has_fraction, outside_dates, unreadable
from predial.operators.counting import as_rows, tally
from predial.operators.duplicates import exact_duplicates, most_repeated, repeated
from predial.operators.quantiles import (
    QUARTILES,
    box_summary,
    collapse,
    exact_quantiles,
    fences,
    iqr_report,
    positive_values,
    spread,
)
from predial.operators.sampling import capped_sample
from predial.sources.text import WIDTH


def value_of(column: str) -> str:
    """Name of the column that holds what was read from a raw column."""
    return f"valor_{column}"


def with_values(
    raw: DataFrame, strict_key: bool = False, pattern: str = SALE_DATE_FORMAT
) -> DataFrame:
    """The raw text side by side with what can be read from it, in one projection."""
    return raw.select(
        *RAW_SALES,
        *(to_int(c, strict_key).alias(value_of(c)) for c in ROL),
        to_date("fecha_escritura", pattern).alias(value_of("fecha_escritura")),
        *(to_number(c).alias(value_of(c)) for c in PRICES),
        *([WIDTH] if WIDTH in raw.columns else []),
    )


def _nulls() -> dict[str, Column]:
    return {c: F.col(c).isNull() for c in RAW_SALES}


def _blanks() -> dict[str, Column]:
    return {c: is_blank(c) for c in RAW_SALES}


def _controls(today: dt.date | None) -> dict[str, Column]:
    # The names of the counters.
    date = "fecha_escritura"
    found = {
        "rol_faltante": any_of(is_blank(c) for c in ROL),
        "fecha_faltante": is_blank(date),
        "fecha_invalida": unreadable(date, value_of(date)),
        "fecha_fuera_de_rango": outside_dates(F.col(value_of(date)), today),
        "ambos_precios_faltantes": all_of(is_blank(c) for c in PRICES),
        "ambos_precios_sin_valor_numerico": all_of(F.col(value_of(c)).isNull() for c in PRICES),
    }
    for c in (*ROL, *PRICES):
        found[f"{c}_faltante"] = is_blank(c)
        found[f"{c}_invalido"] = unreadable(c, value_of(c))
    for c in ROL:
        found[f"{c}_no_entero"] = has_fraction(c, value_of(c))
    for c in PRICES:
        found[f"{c}_no_positivo"] = F.col(value_of(c)) <= 0
    return found


def null_profile(raw: DataFrame) -> DataFrame:
    return tally(raw, _nulls())


def blank_profile(raw: DataFrame) -> DataFrame:
    return tally(raw, _blanks())


def controls(values: DataFrame, today: dt.date | None = None) -> DataFrame:
    """The quality counters as `(control, registros)` rows."""
    return as_rows(tally(values, _controls(today)), "control", "registros")


def _all_counters(today: dt.date | None) -> dict[tuple[str, str], Column]:
    groups = {
        "total": {"registros": F.lit(True)},
        "nulos": _nulls(),
        "vacios": _blanks(),
        "controles": _controls(today),
    }
    return {(g, name): cond for g, conds in groups.items() for name, cond in conds.items()}


def _counts_of(summary: DataFrame, today: dt.date | None) -> DataFrame:
    labelled = [
        F.struct(
            F.lit(group).alias("grupo"),
            F.lit(name).alias("control"),
            F.col(f"c{i}").alias("registros"),
        )
        for i, (group, name) in enumerate(_all_counters(today))
    ]
    return summary.select(F.inline(F.array(*labelled)))


def profile_counts(values: DataFrame, today: dt.date | None = None) -> DataFrame:
    """Rows, nulls, blanks and quality counters together: one scan for all of them."""
    conditions = _all_counters(today).values()
    counted = tally(values, {f"c{i}": cond for i, cond in enumerate(conditions)})
    return _counts_of(counted, today)


STATISTICS = ("registros", "media", "desviacion", "minimo", "maximo")


def summarise(
    values: DataFrame,
    today: dt.date | None = None,
    error: float = QUARTILE_ERROR,
    quartiles: bool = True,
) -> DataFrame:
    """All counters, the statistics and the approximate quartiles: one row, one pass."""
    figures = [F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(_all_counters(today).values())]
    wanted = F.array(*(F.lit(float(p)) for p in QUARTILES))
    for price in PRICES:
        value = F.col(value_of(price))
        found = (F.count(value), F.avg(value), F.stddev_samp(value), F.min(value), F.max(value))
        figures += [f.alias(f"{name}_{price}") for name, f in zip(STATISTICS, found)]
        if quartiles:
            positive = F.when(value > 0, value)
            near = F.percentile_approx(positive, wanted, int(1 / error))
            figures.append(near.alias(f"cuartiles_{price}"))
    return values.agg(*figures)


def _statistics_of(summary: DataFrame) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("precio"), *(F.col(f"{s}_{c}").alias(s) for s in STATISTICS))
        for c in PRICES
    ]
    return summary.select(F.inline(F.array(*rows)))


def _quartiles_of(summary: DataFrame) -> DataFrame:
    """As `approx_quantiles`: a price without positive values has no rows."""
    cells = [
        F.struct(
            F.lit(c).alias("precio"), F.lit(float(p)).alias("p"),
            F.col(f"cuartiles_{c}")[i].alias("cuantil"),
        )
        for c in PRICES
        for i, p in enumerate(QUARTILES)
    ]
    return summary.select(F.inline(F.array(*cells))).filter(F.col("cuantil").isNotNull())


def repeated_sales(values: DataFrame) -> DataFrame:
    """Property and date combinations found more than once, as read."""
    keys = (*ROL, "fecha_escritura")
    typed = values.select(*(F.col(value_of(c)).alias(c) for c in keys))
    return repeated(typed, keys)


def unreadable_dates(values: DataFrame) -> DataFrame:
    date = "fecha_escritura"
    return values.filter(unreadable(date, value_of(date))).select(date)


def read_prices(values: DataFrame) -> DataFrame:
    """The finite prices under their plain names."""
    return values.select(*(F.col(value_of(c)).alias(c) for c in PRICES))


@dataclass
class PriceProfile:
    """The reports, as frames."""

    counts: DataFrame
    duplicates: DataFrame
    repeated: DataFrame
    most_repeated: DataFrame
    unreadable_dates: DataFrame
    statistics: DataFrame
    iqr: DataFrame
    box: DataFrame


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def profile_prices(
    values: DataFrame,
    today: dt.date | None = None,
    exact: bool = False,
    error: float = QUARTILE_ERROR,
    examples: int = 5,
    keep: Callable[[DataFrame, str], DataFrame] = _as_is,
) -> PriceProfile:
    """All reports over `with_values`.

    Counters, statistics and approximate quartiles come from one pass. Quartiles carry a
    relative rank error, or are exact at the cost of a shuffle of the different prices.
    Reports share intermediate results: `keep` (`Stage.keep`) stores those so that they are
    computed once; without it all stays lazy.
    """
    summary = keep(summarise(values, today, error, quartiles=not exact), "summary")
    positive = positive_values(read_prices(values), PRICES)
    if exact:
        positive = keep(collapse(positive), "prices")
        found = exact_quantiles(positive, QUARTILES)
    else:
        found = _quartiles_of(summary)
    figures = keep(spread(positive, keep(fences(found), "limits")), "spread")
    groups = keep(repeated_sales(values), "repeated")
    return PriceProfile(
        counts=_counts_of(summary, today),
        duplicates=exact_duplicates(values.select(*RAW_SALES)),
        repeated=groups.agg(F.count("*").alias("combinaciones")),
        most_repeated=most_repeated(groups, examples),
        unreadable_dates=unreadable_dates(values).limit(examples),
        statistics=_statistics_of(summary),
        iqr=iqr_report(figures),
        box=box_summary(figures),
    )


def sample_view(
    values: DataFrame,
    view: str = "muestra_precios",
    max_rows: int = SAMPLE_ROWS,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """A bounded sample of the read prices as a temporary view, selected in SQL."""
    sample = capped_sample(read_prices(values), max_rows, seed)
    sample.createOrReplaceTempView(view)
    return values.sparkSession.sql(f"SELECT * FROM `{view}`")
