"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table: it
starts at an offset and walks on by a step, both hashes of its name. The shards take turns,
each claiming the first free slot of its order, until the table is full. So all shards get
the same number of slots within one, and when a shard is added or leaves, few slots change
hands. A row's slot is the hash of its key modulo the table size; the table has a fixed
size, so it is broadcast, and placing a row takes one probe whatever the number of shards.

Defined results: a null key is placed like an empty text; equal keys share a shard (a hot
key can be spread with `spread`); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.llm.support import fresh

SLOTS = 65537  # a prime, a thousand times the number of shards
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """Where a shard starts, and the step by which it goes on."""
    digest = hashlib.sha256(name.encode()).digest()
    start = int.from_bytes(digest[:8], "big") % slots
    return start, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard number that owns each slot. Bounded work: the table size decides it."""
    if not _is_prime(slots):
        raise ValueError(f"{slots} is not prime: a step could miss slots")
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("shards must be different, at least one, at most one a slot")
    orders = [preference(name, slots) for name in shards]
    nearest = [start for start, _ in orders]
    owner = [-1] * slots
    claimed = 0
    while True:
        for shard, (_, step) in enumerate(orders):
            slot = nearest[shard]
            while owner[slot] >= 0:
                slot = (slot + step) % slots
            owner[slot] = shard
            nearest[shard] = (slot + step) % slots
            claimed += 1
            if claimed == slots:
                return owner


def table_frame(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The lookup table as rows (slot, shard, shard_name)."""
    owners = ",".join(map(str, lookup_table(shards, slots)))
    names = F.split(F.lit("\n".join(shards)), "\n")
    cells = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
    shard = F.col("owner").cast("int")
    return cells.select("slot", shard.alias("shard"), names[shard].alias("shard_name"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """60 bits of the key's hash, modulo the table size."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    return F.pmod(bits, F.lit(slots)).cast("int")


def place(
    df: DataFrame,
    key: str,
    shards: Sequence[str] = SHARDS,
    slots: int = SLOTS,
    spread: Sequence[str] = (),
    spreads: int = 1,
) -> DataFrame:
    """`df` with the columns slot, shard and shard_name (replaced if `df` has them).

    With `spread`, rows of one key are dealt by these columns to up to `spreads` shards,
    so that a key with a third of all rows doesn't fill one shard.
    """
    placed_by = F.col(key)
    if spread:
        part = F.pmod(F.xxhash64(*spread), F.lit(spreads)).cast("string")
        placed_by = F.concat_ws("#", F.coalesce(placed_by.cast("string"), F.lit("")), part)
    slot, others = fresh(df, "slot_"), [c for c in df.columns if c.lower() not in
                                        ("slot", "shard", "shard_name")]
    table = table_frame(df.sparkSession, shards, slots).withColumnRenamed("slot", slot)
    rows = df.withColumn(slot, slot_of(placed_by, slots)).select(*others, slot)
    return rows.join(F.broadcast(table), slot).select(
        *others, F.col(slot).alias("slot"), "shard", "shard_name"
    )


def write_shards(
    placed: DataFrame, path: str, key: str, files_per_shard: int = 8
) -> None:
    """One folder per shard, its rows split over several tasks and files."""
    part = F.pmod(F.xxhash64(key), F.lit(files_per_shard))
    tasks = max(1, placed.select("shard").distinct().count()) * files_per_shard
    dealt = placed.repartition(tasks, "shard", part)
    dealt.write.partitionBy("shard").mode("overwrite").parquet(path)
