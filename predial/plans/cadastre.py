"""Cadastre: buildings, properties with their building totals, common-property links.

All functions take frames that carry `periodo`, so one run may hold several periods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predial.contracts import COMMON_PROPERTY, PERIOD, ROL, SCHEMAS, subset
from predial.functions.rules import is_link
from predial.operators.casting import conform, conform_marked
from predial.operators.joins import join_totals
from predial.sources.text import WIDTH, check_period, require_columns

KEY = (PERIOD, *ROL)
TOTALS = ("superficie_total_construcciones", "ano_construccion")

# Properties as typed from text: no totals yet, the common property still there.
PROPERTIES = subset(
    "no_agricola", drop=TOTALS, extra=", ".join(f"{c} int" for c in COMMON_PROPERTY)
)


def with_period(df: DataFrame, period: str) -> DataFrame:
    return df.withColumn(PERIOD, F.lit(check_period(period)))


def build_construcciones(raw: DataFrame) -> DataFrame:
    """Every building line, strictly typed."""
    schema = SCHEMAS["construcciones"]
    return conform_marked(require_columns(raw, schema.names, "construcciones"), schema, WIDTH)


def type_properties(raw: DataFrame) -> DataFrame:
    raw = require_columns(raw, PROPERTIES.names, "no_agricola")
    return conform_marked(raw, PROPERTIES, WIDTH)


def building_totals(buildings: DataFrame, positive_only: bool = True) -> DataFrame:
    """Built area and first year per property; a year of 0 means unknown.

    The sums are started inside each task, so a property with any number of lines
    reaches the shuffle as one row per task.
    """
    year = F.col("ano_construccion")
    known = F.when(year > 0, year) if positive_only else year
    return buildings.groupBy(*KEY).agg(
        F.sum("superficie_construida").alias("superficie_total_construcciones"),
        F.min(known).alias("ano_construccion"),
    )


def build_no_agricola(properties: DataFrame, totals: DataFrame) -> DataFrame:
    """Every property once, with null totals where it has no building."""
    return conform(join_totals(properties, totals, KEY), SCHEMAS["no_agricola"])


def build_nexo_bc(properties: DataFrame) -> DataFrame:
    """Links to the main common property. No shuffle."""
    return conform(properties.filter(is_link()), SCHEMAS["nexo_bc"])


def with_buildings(no_agricola: DataFrame) -> DataFrame:
    """Properties whose totals were found."""
    found = no_agricola.filter(F.col("superficie_total_construcciones").isNotNull())
    return found.select(*ROL, PERIOD, *TOTALS)
