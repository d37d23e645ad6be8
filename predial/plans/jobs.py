"""End-to-end jobs over files, the ones a scheduler would call."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from predial.contracts import (
    LOOKUP_TABLES,
    PERIOD,
    POSITIONAL_NAMES,
    RAW_BUILDINGS,
    RAW_PROPERTIES,
    RAW_SALES,
    SAMPLE_ROWS,
    SCHEMAS,
)
from predial.plans import cadastre, lookups, prices, profile
from predial.plans.publish import publish
from predial.sinks.commits import begin
from predial.sinks.guards import check_destination, check_not_empty
from predial.sinks.staging import Stage
from predial.sinks.writers import overwrite_table
from predial.sources.text import (
    check_period,
    read_headered,
    read_periods,
    refuse_ragged,
    require_columns,
)


def run_profile(
    spark: SparkSession,
    path: str,
    output: str,
    today: dt.date | None = None,
    exact: bool = False,
    names: Sequence[str] | None = RAW_SALES,
    sample_rows: int = SAMPLE_ROWS,
    accept_ragged: bool = False,
) -> dict[str, DataFrame]:
    """Profile a file of sales and leave each report as a small table under `output`.

    The text is parsed once; all reports read the staged columns they need.
    """
    marked = not accept_ragged
    raw = require_columns(read_headered(spark, path, names, marked=marked), RAW_SALES, path)
    check_not_empty(raw, path)
    reports = {}
    with Stage(spark, "profile") as stage:
        values = refuse_ragged(stage.keep(profile.with_values(raw), "values"), path)
        frames = vars(profile.profile_prices(values, today, exact, keep=stage.keep))
        frames["sample"] = profile.sample_view(values, max_rows=sample_rows)
        for name, frame in frames.items():
            target = f"{output.rstrip('/')}/{name}"
            overwrite_table(frame, target)
            reports[name] = spark.read.schema(frame.schema).parquet(target)
    return reports


def run_cadastre(
    spark: SparkSession,
    base: str,
    root: str,
    agreed_root: str,
    periods: Sequence[str],
    building_names: Sequence[str] = RAW_BUILDINGS,
    property_names: Sequence[str] = RAW_PROPERTIES,
    sep: str = "|",
    positive_years: bool = True,
    accept_ragged: bool = False,
) -> dict[str, int]:
    """Three tables for one or more periods; other periods stay as they are.

    Each text is parsed once, all periods together, into staged typed tables that every
    later step reads. Lines with too few or too many fields stop the run, which names their
    number by period, unless `accept_ragged`.
    """
    for period in periods:
        check_period(period)
    since = begin(spark, check_destination(root, agreed_root))

    def read(table: str, names: Sequence[str]) -> DataFrame:
        return read_periods(spark, base, table, periods, names, sep, marked=not accept_ragged)

    with Stage(spark, "cadastre") as stage:
        buildings = cadastre.build_construcciones(read("construcciones", building_names))
        properties = cadastre.type_properties(read("no_agricola", property_names))
        buildings = refuse_ragged(stage.keep(buildings, "buildings"), "construcciones", PERIOD)
        properties = refuse_ragged(stage.keep(properties, "properties"), "no_agricola", PERIOD)
        totals = cadastre.building_totals(buildings, positive_years)
        tables = {
            "construcciones": buildings,
            "no_agricola": cadastre.build_no_agricola(properties, totals),
            "nexo_bc": cadastre.build_nexo_bc(properties),
        }
        return publish(tables, root, agreed_root, periods, since=since)


def run_prices(
    spark: SparkSession,
    base: str,
    root: str,
    agreed_root: str,
    strict_key: bool = False,
    clp_cap: float | None = prices.CLP_CAP,
    uf_cap: float | None = prices.UF_CAP,
    paths: Mapping[str, str] | None = None,
    names: Mapping[str, Sequence[str]] = POSITIONAL_NAMES,
    accept_ragged: bool = False,
) -> tuple[dict[str, int], dict[str, int]]:
    """Six tables; returns the rows written and the audit of the sales.

    The audit is counted while the sales are staged and while the finished table is written:
    the staged sales are scanned once, and joined to the rates once.

    Sources are `<base>/<table>.csv` unless `paths` says otherwise; `names` renames
    headers by position, and a table without an entry keeps its own header.
    """
    since = begin(spark, check_destination(root, agreed_root))

    def source(table: str) -> DataFrame:
        path = (paths or {}).get(table, f"{base.rstrip('/')}/{table}.csv")
        df = read_headered(spark, path, names.get(table), marked=not accept_ragged)
        return require_columns(df, SCHEMAS[table].names, table)

    with Stage(spark, "prices") as stage:

        def typed(frame: DataFrame, table: str) -> DataFrame:
            return refuse_ragged(stage.keep(frame, table), table)

        rates = typed(prices.type_rates(source("precios_uf")), "precios_uf")
        dates = prices.check_rates(rates)
        raw = source("precios_transaccionales")
        dropped, changed = Observation("sales read"), Observation("sales finished")
        sales = prices.watched_sales(prices.type_sales(raw, strict_key), dropped)
        sales = typed(sales, "precios_transaccionales")
        reference = stage.keep(prices.rate_reference(rates), "reference")
        final = prices.finish_sales(sales, reference, dates, clp_cap, uf_cap, changed)

        tables = {"precios_transaccionales": final, "precios_uf": prices.build_uf(rates)}
        for table in LOOKUP_TABLES:
            tables[table] = typed(lookups.build_lookup(source(table), table), table)
        written = publish(tables, root, agreed_root, since=since)
        return written, dropped.get | changed.get
