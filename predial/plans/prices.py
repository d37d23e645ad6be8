"""Sale prices: remove copies, read leniently, cap, complete from the daily rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from predial.contracts import (
    CLP_CAP,
    PRICES,
    RATE_DATE_FORMAT,
    ROL,
    SALE_DATE_FORMAT,
    SCHEMAS,
    UF_CAP,
    ContractError,
)
from predial.functions.parsing import to_date, to_int, to_number
from predial.functions.rules import (
    bad_rate,
    bad_rol,
    bad_sale_date,
    no_price,
    positive_up_to,
    usable_sale,
)
from predial.operators.casting import conform
from predial.operators.counting import observed, tally
from predial.operators.joins import join_lookup
from predial.sources.text import WIDTH

SALES = SCHEMAS["precios_transaccionales"]
RATES = SCHEMAS["precios_uf"]


# -- daily rate -----------------------------------------------------------------


def type_rates(raw: DataFrame, pattern: str = RATE_DATE_FORMAT) -> DataFrame:
    """Date and rate in double precision; bad text is null here and refused by the guard."""
    mark = [WIDTH] if WIDTH in raw.columns else []
    return raw.select(to_date("date", pattern).alias("date"), to_number("uf").alias("uf"), *mark)


def invalid_rates(rates: DataFrame) -> DataFrame:
    return rates.filter(bad_rate())


def rates_by_date(rates: DataFrame) -> DataFrame:
    """One row per date: the rate, and whether the source holds different ones."""
    low, high = F.min("uf"), F.max("uf")
    return rates.groupBy("date").agg(low.alias("uf"), (low != high).alias("conflicto"))


def conflicting_rates(rates: DataFrame) -> DataFrame:
    """Dates with more than one rate, and how many different ones they have."""
    kinds = rates.distinct().groupBy("date").agg(F.count("*").alias("valores"))
    return kinds.filter(F.col("valores") > 1)


def rate_reference(rates: DataFrame) -> DataFrame:
    """What sales are joined to: at most one rate per date."""
    return rates_by_date(rates).select("date", "uf")


def check_rates(rates: DataFrame) -> int:
    """Refuse bad or contradictory rates; return how many dates there are. One job."""
    per_date = rates.groupBy("date").agg(
        F.count_if(bad_rate()).alias("bad"), (F.min("uf") != F.max("uf")).alias("differ")
    )
    found = per_date.agg(
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
        F.count_if("differ").alias("differ"),
        F.count("*").alias("dates"),
    ).first()
    if found["bad"]:
        raise ContractError(f"precios_uf: {found['bad']} rows with a bad date or rate")
    if found["differ"]:
        raise ContractError(f"precios_uf: {found['differ']} dates with more than one rate")
    return found["dates"]


def build_uf(rates: DataFrame) -> DataFrame:
    """The rate table as published: every row, repeated ones included."""
    return conform(rates, RATES)


# -- sales ----------------------------------------------------------------------


def type_sales(
    raw: DataFrame, strict_key: bool = False, pattern: str = SALE_DATE_FORMAT
) -> DataFrame:
    """Drop copies of the raw text, then read keys, date and prices.

    `distinct` is a hash aggregation, so copies already meet inside each task and a
    row repeated without end is shuffled once per task.
    """
    return raw.distinct().select(
        *(to_int(c, strict_key).alias(c) for c in ROL),
        to_date("fecha_escritura", pattern).alias("fecha_escritura"),
        *(to_number(c).alias(c) for c in PRICES),
        *([WIDTH] if WIDTH in raw.columns else []),
    )


def cap_prices(
    sales: DataFrame, clp_cap: float | None = CLP_CAP, uf_cap: float | None = UF_CAP
) -> DataFrame:
    """Prices that are not positive or not plausible become null."""
    return sales.withColumns(
        {
            "precio_clp": positive_up_to(F.col("precio_clp"), clp_cap),
            "precio_uf": positive_up_to(F.col("precio_uf"), uf_cap),
        }
    )


def attach_rates(sales: DataFrame, reference: DataFrame, dates: int) -> DataFrame:
    """Put the day's rate next to each sale, as column `uf`."""
    return join_lookup(sales, reference, "fecha_escritura", "date", dates)


def impute(sales: DataFrame) -> DataFrame:
    """Fill either price from the other one; both read the prices as they came in."""
    clp, uf, rate = F.col("precio_clp"), F.col("precio_uf"), F.col("uf")
    complete = sales.select(
        *ROL,
        "fecha_escritura",
        F.coalesce(clp, uf * rate).alias("precio_clp"),
        F.coalesce(uf, clp / rate).alias("precio_uf"),
    )
    return conform(complete, SALES)


def finish_sales(
    typed: DataFrame,
    reference: DataFrame,
    dates: int,
    clp_cap: float | None = CLP_CAP,
    uf_cap: float | None = UF_CAP,
    watch: Observation | None = None,
) -> DataFrame:
    """The finished table; `watch` counts what was capped, filled and left on the way.

    Filter, rate, caps and imputation follow each other in the tasks that write, so the
    counters cost no scan and no join of their own.
    """
    attached = attach_rates(typed.filter(usable_sale()), reference, dates)
    if watch:
        attached = observed(attached, watch, _later(clp_cap, uf_cap))
    return impute(cap_prices(attached, clp_cap, uf_cap))


def watched_sales(typed: DataFrame, watch: Observation) -> DataFrame:
    """`type_sales`, counting what will be dropped and what carries no usable price."""
    return observed(typed, watch, _cleaning())


def build_precios(
    raw: DataFrame,
    rates: DataFrame,
    strict_key: bool = False,
    clp_cap: float | None = CLP_CAP,
    uf_cap: float | None = UF_CAP,
) -> DataFrame:
    """Clean, completed sales from raw sales and typed rates.

    One shuffle, for the copies, which rows without key or date don't reach; reading, caps,
    rate and imputation follow it without another. The rates are checked first, which also
    tells their size for the join.
    """
    dates = check_rates(rates)
    typed = type_sales(raw, strict_key)
    return finish_sales(typed, rate_reference(rates), dates, clp_cap, uf_cap)


# -- audits ---------------------------------------------------------------------
# The names of the counters in the four dictionaries below.


def _cleaning() -> dict[str, Column]:
    return {
        "rol_faltante_o_invalido": bad_rol(),
        "fecha_faltante_o_invalida": bad_sale_date(),
        "filas_eliminadas_por_rol_o_fecha": ~usable_sale(),
        "clp_no_positivo": F.col("precio_clp") <= 0,
        "uf_no_positivo": F.col("precio_uf") <= 0,
        "ambos_sin_valor_numerico": no_price(),
    }


def _capping(clp_cap: float | None, uf_cap: float | None) -> dict[str, Column]:
    never = F.lit(False)
    return {
        "uf_sobre_limite_plausible": never if uf_cap is None else F.col("precio_uf") > uf_cap,
        "clp_sobre_limite_plausible": never if clp_cap is None else F.col("precio_clp") > clp_cap,
    }


def _imputing(clp: Column, uf: Column) -> dict[str, Column]:
    rate = F.col("uf").isNotNull()
    no_clp, no_uf = clp.isNull(), uf.isNull()
    return {
        "transacciones_tras_limpieza": F.lit(True),
        "ambos_ausentes_conservados": no_clp & no_uf,
        "sin_conversion_diaria": ~rate,
        "clp_a_imputar": no_clp & ~no_uf & rate,
        "uf_a_imputar": no_uf & ~no_clp & rate,
    }


def _pending(no_clp: Column, no_uf: Column) -> dict[str, Column]:
    return {
        "clp_pendiente": no_clp,
        "uf_pendiente": no_uf,
        "ambos_pendientes_conservados": no_clp & no_uf,
    }


def _later(clp_cap: float | None, uf_cap: float | None) -> dict[str, Column]:
    """On usable, uncapped sales with their rates: capping, imputing, and what stays open."""
    clp = positive_up_to(F.col("precio_clp"), clp_cap)
    uf = positive_up_to(F.col("precio_uf"), uf_cap)
    no_rate = F.col("uf").isNull()
    unfilled_clp = clp.isNull() & (uf.isNull() | no_rate)
    unfilled_uf = uf.isNull() & (clp.isNull() | no_rate)
    return _capping(clp_cap, uf_cap) | _imputing(clp, uf) | _pending(unfilled_clp, unfilled_uf)


def _among_usable(conditions: dict[str, Column]) -> dict[str, Column]:
    return {name: usable_sale() & condition for name, condition in conditions.items()}


def clean_audit(typed: DataFrame) -> DataFrame:
    """On `type_sales`: what will be dropped and what carries no usable price."""
    return tally(typed, _cleaning())


def cap_audit(typed: DataFrame, clp_cap: float = CLP_CAP, uf_cap: float = UF_CAP) -> DataFrame:
    """On `type_sales`: prices above the caps among the usable rows."""
    return tally(typed, _among_usable(_capping(clp_cap, uf_cap)))


def impute_audit(attached: DataFrame) -> DataFrame:
    """On capped sales with rates: what can and what cannot be filled in, usable rows only."""
    return tally(attached, _among_usable(_imputing(F.col("precio_clp"), F.col("precio_uf"))))


def pending_audit(final: DataFrame) -> DataFrame:
    """On the finished table: prices still missing."""
    return tally(final, _pending(*(F.col(c).isNull() for c in PRICES)))


def sales_audit(
    typed: DataFrame,
    reference: DataFrame,
    dates: int,
    clp_cap: float | None = CLP_CAP,
    uf_cap: float | None = UF_CAP,
) -> DataFrame:
    """The four audits above in one row from one scan of `type_sales`."""
    later = _among_usable(_later(clp_cap, uf_cap))
    return tally(attach_rates(typed, reference, dates), _cleaning() | later)
