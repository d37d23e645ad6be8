"""Guard, write and verify tables, and replace them in one step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation

from predial.contracts import PERIOD_TABLES, SCHEMAS, ContractError
from predial.operators.casting import check_schema
from predial.sinks.commits import Publication
from predial.sinks.folders import Folders
from predial.sinks.guards import (
    CHECKSUM,
    Figures,
    check_destination,
    check_measures,
    check_written_periods,
    check_written_table,
    checksum,
    measure,
    measures,
)
from predial.sinks.writers import by_period, overwrite_periods, overwrite_table, replace_empty_period

MAY_BE_EMPTY = ("nexo_bc",)


def inspect(
    df: DataFrame, table: str, periods: Sequence[str] = (), known: Figures | None = None
) -> Figures:
    """Refuse a frame whose schema, periods, size, floats or links break the contract.

    One pass over `df`; none when the caller has the figures already.
    """
    _check_shape(df, table, periods)
    figures = known or measure(df, table, periods)
    check_measures(figures, table, periods, table in MAY_BE_EMPTY)
    return figures


def _check_shape(df: DataFrame, table: str, periods: Sequence[str]) -> None:
    if (table in PERIOD_TABLES) != bool(periods):
        raise ContractError(f"{table}: periods {list(periods)} given")
    check_schema(df, SCHEMAS[table], table)


def stage(
    df: DataFrame, table: str, path: str, periods: Sequence[str], known: Figures | None = None
) -> Figures:
    """Write a table's files to a folder of the run, and check them there.

    The guards' figures and a checksum of the content are observed while the rows are written,
    and both are compared with one scan of what was written. A row that is foreign to its
    period's folder, or a value that a file has changed, is found before anything is replaced.
    """
    _check_shape(df, table, periods)
    spark, watch = df.sparkSession, Observation(f"{table} written")
    wanted = [*measures(table, periods), *checksum(SCHEMAS[table].names)]
    # Observed in the tasks that write, after any shuffle: a repeated task counts once there.
    if periods:
        overwrite_periods(by_period(df, len(periods)).observe(watch, *wanted), path)
    else:
        overwrite_table(df.observe(watch, *wanted), path)
    seen = watch.get
    figures = known or {k: v for k, v in seen.items() if k not in CHECKSUM}
    check_measures(figures, table, periods, table in MAY_BE_EMPTY)
    content = {name: seen[name] for name in CHECKSUM}
    if not periods:
        check_written_table(spark, path, table, figures["rows"], content)
        return figures
    expected = {period: figures[f"period {period}"] for period in periods}
    for period, rows in expected.items():
        if rows == 0:
            replace_empty_period(df, path, period)
    if any(expected.values()):
        check_written_periods(spark, path, table, expected, content)
    return figures


def publish(
    tables: Mapping[str, DataFrame],
    root: str,
    agreed_root: str,
    periods: Sequence[str] = (),
    known: Mapping[str, Figures] | None = None,
    since: int | None = None,
    folders: Folders | None = None,
) -> dict[str, int]:
    """Replace tables, all or none, and return the rows written to each.

    Every table is computed into a folder of this run, inspected and read back there. Only
    then one step makes all of them the current ones (`sinks.commits`). `since` is the version
    of the root that the run began with, by default the present one: a run whose tables or
    periods were replaced since then is refused. Figures that are `known` are taken for the
    guards, and have to agree with what was written.
    """
    root = check_destination(root, agreed_root)
    for name, df in tables.items():
        _check_shape(df, name, periods)
    spark = next(iter(tables.values())).sparkSession
    figures = {}
    with Publication(spark, root, since, folders) as run:
        for name, df in tables.items():
            given = (known or {}).get(name)
            figures[name] = stage(df, name, run.staged(name), periods, given)
            run.replaces(name, periods)
        run.commit()
    return {name: found["rows"] for name, found in figures.items()}
