"""Left joins against a side that has one row per key: left rows never multiply."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predial.contracts import ContractError

# 400,000 rows of (date, double) take about 20 MB as a hash relation, and a
# thousand years have 365,000 days.
BROADCAST_ROWS = 400_000
SALTS = 64


def join_totals(left: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two large sides, `totals` being an aggregate over `keys`.

    A key may hold a large share of the left rows. Adaptive execution splits such a
    partition at run time, but only if both join inputs come straight from a
    shuffle; an aggregate reused as join input prevents it. The redundant hash key
    asks for a shuffle of the (already small) totals and so keeps splitting possible.
    It comes first because the merge sorts by the first key's leading bytes: a hash
    tells rows apart at once where a period, the same in most rows, would not.
    A totals side under the broadcast threshold becomes a broadcast join as usual.
    """
    for key in keys:
        kinds = left.schema[key].dataType, totals.schema[key].dataType
        if kinds[0] != kinds[1]:  # equal values of different types hash differently
            raise ContractError(f"join key {key} is {kinds[0]} and {kinds[1]}")
    lane = "_lane"
    hashed = F.xxhash64(*keys)
    joined = left.withColumn(lane, hashed).join(
        totals.withColumn(lane, hashed), [lane, *keys], "left"
    )
    return joined.drop(lane)


def join_lookup(
    left: DataFrame, lookup: DataFrame, left_key: str, lookup_key: str, lookup_rows: int
) -> DataFrame:
    """Left join against a lookup whose row count has been measured.

    Up to `BROADCAST_ROWS` the lookup is broadcast and the left side stays where it
    is. Beyond that both sides are shuffled on the key plus a salt, so a key that
    holds a third of the left rows is spread over `SALTS` tasks. The salt is a hash
    of the row, hence the same when a lost task is run again.
    """
    if lookup_rows <= BROADCAST_ROWS:
        match = F.col(left_key) == F.col(lookup_key)
        return left.join(F.broadcast(lookup), match, "left").drop(lookup_key)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
    copies = lookup.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    match = (F.col(left_key) == F.col(lookup_key)) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies, match, "left").drop("_salt", "_copy", lookup_key)
