"""Every registered query against its SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry_point
from conftest import SF
from predial.session import scratch_root
from workload.compare import compare
from workload.oracles import oracles
from workload.registry import QUERIES

ORACLES = oracles()


def test_registration():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(spark, SF, QUERIES[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", ["q_csv_prices", "q_round_trip", "q_sql_pending"])
def test_a_rerun_leaves_one_copy(spark, name):
    def files():
        root = f"{scratch_root(spark)}/predial/workload"
        return sum(f.endswith((".csv", ".parquet")) for _, _, names in os.walk(root) for f in names)

    QUERIES[name](spark, SF).count()
    once = files()
    QUERIES[name](spark, SF).count()
    assert files() == once > 0
