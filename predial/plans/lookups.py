"""Lookup tables: chosen by name and cast, no row dropped or filled."""

from __future__ import annotations

from pyspark.sql import DataFrame

from predial.contracts import LOOKUP_TABLES, SCHEMAS, ContractError
from predial.operators.casting import conform_marked
from predial.sources.text import WIDTH, require_columns


def build_lookup(raw: DataFrame, table: str) -> DataFrame:
    if table not in LOOKUP_TABLES:
        raise ContractError(f"{table} is not one of {LOOKUP_TABLES}")
    schema = SCHEMAS[table]
    return conform_marked(require_columns(raw, schema.names, table), schema, WIDTH)
