"""Side-by-side run of every query and its oracle: `python -m workload.compare [dir] [names]`."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem".split()
KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "float",
    "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
}


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value.isoformat() if isinstance(value, dt.date) else value


def _sorted(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: [(v is not None, str(v)) for v in r])


def compare(spark, sf_dir: str, query, sql: str) -> str:
    """Empty when names, types and rows agree, else what differs."""
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    described = db.execute(f"DESCRIBE {sql}").fetchall()
    theirs_types = {row[0]: KINDS.get(row[1], row[1]) for row in described}
    theirs = db.execute(sql).fetchall()
    df = query(spark, sf_dir)
    if dict(df.dtypes) != theirs_types:
        return f"types {dict(df.dtypes)} against {theirs_types}"
    ours = df.collect()
    names = sorted(df.columns)
    left = _sorted(ours, [df.columns.index(c) for c in names])
    right = _sorted(theirs, [[r[0] for r in described].index(c) for c in names])
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {names} {wrong[0]}" if wrong else ""


def main() -> None:
    from workload.oracles import oracles
    from workload.registry import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sqls, bad = oracles(), 0
    for name, query in QUERIES.items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        if name in sqls:
            verdict = compare(spark, sf_dir, query, sqls[name])
        else:
            verdict = "" if query(spark, sf_dir).count() else "no rows"
        bad += bool(verdict)
        kind = "oracle" if name in sqls else "rows only"
        print(f"{name:28s} {time.time() - start:6.2f}s {kind:9s} {verdict or 'ok'}", flush=True)
    missing = set(sqls) - set(QUERIES)
    print(f"{bad} of {len(QUERIES)} differ; oracles without query: {sorted(missing)}")


if __name__ == "__main__":
    main()
