"""Quality rules as boolean columns, and the value rules built on them."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from predial.contracts import COMMON_PROPERTY_FROM, FIRST_YEAR, ROL
from predial.functions.parsing import INFINITY, as_double, is_blank


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def all_of(conditions) -> Column:
    return reduce(and_, conditions)


def any_null(*names: str) -> Column:
    return any_of(F.col(c).isNull() for c in names)


def unreadable(text: str, value: str) -> Column:
    """There was text, and no value came out of it."""
    return ~is_blank(text) & F.col(value).isNull()


def outside_dates(date: Column, today: dt.date | None = None) -> Column:
    """Before the first plausible year or after `today` (the current date by default)."""
    last = F.current_date() if today is None else F.lit(today)
    return (F.year(date) < FIRST_YEAR) | (date > last)


def has_fraction(text: str, value: str) -> Column:
    """The number behind a key was cut to an integer."""
    return as_double(text) != F.col(value)


def positive_up_to(value: Column, cap: float | None) -> Column:
    """The value if positive and not above the cap, else null."""
    keep = value > 0 if cap is None else (value > 0) & (value <= cap)
    return F.when(keep, value)


def not_finite(value: Column) -> Column:
    return F.abs(value) >= INFINITY  # NaN compares above infinity


def bad_rol() -> Column:
    return any_null(*ROL)


def bad_sale_date() -> Column:
    return F.col("fecha_escritura").isNull()


def usable_sale() -> Column:
    return ~(bad_rol() | bad_sale_date())


def no_price() -> Column:
    return F.col("precio_clp").isNull() & F.col("precio_uf").isNull()


def bad_rate() -> Column:
    return F.col("date").isNull() | F.col("uf").isNull() | (F.col("uf") <= 0)


def is_link() -> Column:
    """A private unit tied to a common property."""
    linked = F.col("cod_com_bc") != 0
    return linked & (F.col("cod_pr") < COMMON_PROPERTY_FROM)


def is_bad_link() -> Column:
    """Exact negation of `is_link`; null counts as bad."""
    return ~F.coalesce(is_link(), F.lit(False))
