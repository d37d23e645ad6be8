import hashlib
from collections import Counter

import pytest
from edge_cases import TEXTS, documents, no_documents
from pyspark.sql import functions as F

from predial.llm import sharding


def claims(names, slots):
    """The turns, written out with whole orders of preference."""
    orders = []
    for name in names:
        start, step = sharding.preference(name, slots)
        orders.append([(start + i * step) % slots for i in range(slots)])
        assert sorted(orders[-1]) == list(range(slots))
    owner, turn = {}, 0
    while len(owner) < slots:
        order = orders[turn % len(names)]
        owner[next(s for s in order if s not in owner)] = turn % len(names)
        turn += 1
    return [owner[s] for s in range(slots)]


@pytest.mark.parametrize("shards,slots", [(1, 7), (3, 13), (10, 499)])
def test_table_against_written_out_turns(shards, slots):
    names = [f"s{i}" for i in range(shards)]
    table = sharding.lookup_table(names, slots)
    assert table == claims(names, slots)
    sizes = Counter(table).values()
    assert max(sizes) - min(sizes) <= 1


def test_a_shard_that_leaves_moves_little_else():
    names = [f"s{i}" for i in range(20)]
    before, after = (sharding.lookup_table(n, 4099) for n in (names, names[:-1]))
    moved = sum(a != b for a, b in zip(before, after) if names[a] != "s19")
    assert moved < 0.1 * 4099


def test_place(spark):
    df = documents(spark)
    placed = sharding.place(df, "doc_id").collect()
    assert Counter(r.doc_id for r in placed) == Counter(i for i, _ in TEXTS)
    table = sharding.lookup_table(sharding.SHARDS)
    for r in placed:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r.slot, r.shard, r.shard_name) == (slot, table[slot], sharding.SHARDS[table[slot]])
    assert sharding.place(no_documents(spark), "doc_id").count() == 0


def test_hot_key_spreads(spark):
    df = spark.range(1000).select("id", F.lit("one").alias("key"))
    assert sharding.place(df, "key").select("shard").distinct().count() == 1
    spread = sharding.place(df, "key", spread=["id"], spreads=8)
    assert 4 <= spread.select("shard").distinct().count() <= 8


def test_written_shards(spark, root):
    df = spark.range(500).withColumnRenamed("id", "k")
    placed = sharding.place(df, "k", shards=["a", "b", "c"], slots=101)
    sharding.write_shards(placed, root, "k", files_per_shard=2)
    back = spark.read.parquet(root)
    assert back.count() == 500 and back.select("shard").distinct().count() == 3


def test_refusals():
    for shards, slots in ((["a"], 10), ([], 7), (["a", "a"], 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)
