import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from predial.llm import prefix_trie, queries
from predial.llm.support import prepare

SCHEMA = "conv_id long, turn long, role string, text string, digest string, path int, depth int, n int"


def frame(spark, rows):
    full = [(*r, "d", 1, 2, 3) for r in rows]
    return prepare(spark).createDataFrame(full, SCHEMA).repartition(3)


def rows_of(sequences):
    """Conversations whose turns are texts of one role."""
    return [(c, i, "user", t) for c, turns in sequences.items() for i, t in enumerate(turns)]


def nodes_of(sequences):
    """The contract written out; `sequences`: id -> list of (role, text)."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in sequences.items():
        ends[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    saved, leaves = defaultdict(int), defaultdict(int)
    for key, convs in members.items():
        own = (len(convs) - 1) * len(key[-1][1]) if key else 0
        for d in range(len(key) + 1):
            saved[key[:d]] += own
            leaves[key[:d]] += not children[key]
    return sorted(
        (min(convs), len(key), min(members[key[:-1]]) if key else -1, len(convs), len(children[key]),
         leaves[key], saved[key],
         hashlib.sha256(",".join(map(str, sorted(ends[key]))).encode()).hexdigest())
        for key, convs in members.items()
    )


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")


def found(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    return sorted((c, d, -1 if p is None else p, *rest) for c, d, p, *rest in rows)


def in_order(rows):
    chats = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            chats[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in chats.items()}


def check(spark, rows):
    got = prefix_trie.trie(prefix_trie.turns_of(frame(spark, rows)))
    assert found(got) == nodes_of(in_order(rows))


def test_random_sequences(spark):
    random.seed(5)
    sequences = {c: random.choices("ab", k=random.randint(1, 5)) for c in range(90)}
    check(spark, rows_of(sequences))


def test_nested_and_equal_sequences(spark):
    """Each conversation goes on from the one before; a third of all are equal; one is long."""
    chain = [f"turn {i}" for i in range(7)]
    sequences = {c: chain[: c + 1] for c in range(7)}
    sequences |= {c: chain[:4] for c in range(100, 120)}
    sequences |= {200: chain[:5] + ["x"] * 40, 201: chain[:5] + ["x"] * 39 + ["y"]}
    check(spark, rows_of(sequences))


def test_nulls_ties_repeats_and_extra_columns(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", None), (1, 2, None, "c"),
        (2, None, "user", "a"), (2, 5, "assistant", ""), (2, 9, "", "c"),  # equal to 1
        (3, 0, "user", "a"), (3, 1, "user", "a"), (3, 1, "user", "a"),  # repeated rows
        (4, 0, "us", "era"),  # not the same turn as user, a
        (5, 0, "user", "été \U0001f642" * 30_000),
        (-6, 0, "user", "a"),
        (None, 0, "user", "a"),
    ]
    check(spark, rows)


@pytest.mark.parametrize("sequences", [{}, {7: ["only"]}, {1: ["a", "b"], 2: ["a", "b"]}])
def test_small_tables(spark, sequences):
    check(spark, rows_of(sequences))


def test_two_fattest(spark):
    def fattest(low, high):
        return max(range(low + 1, high + 1), key=lambda i: i & -i)

    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for a, b, f in df.select("a", "b", prefix_trie.two_fattest("a", "b")).collect():
        assert f == fattest(a, b)


def test_exit_of_each_sequence(spark):
    """Fat binary search against a walk from the root."""
    random.seed(8)
    known = {c: random.choices("abc", k=random.randint(1, 12)) for c in range(40)}
    asked = {c: random.choices("abc", k=random.randint(1, 12)) for c in range(40)}
    asked |= {c + 100: known[c][: 1 + c % 5] + ["z"] for c in range(40)}

    def pathed(sequences):
        return prefix_trie.paths(prefix_trie.turns_of(frame(spark, rows_of(sequences))))

    unique = {tuple(v): (c, v) for c, v in known.items()}
    nodes = prefix_trie.build(pathed(dict(unique.values())))
    got = prefix_trie.locate(pathed(asked), nodes, 4).select("conv_id", "leaves", "n").collect()
    prefixes = {tuple(v[:d]) for v in known.values() for d in range(len(v) + 1)}
    for c, leaves, n in got:
        walked = max(d for d in range(n + 1) if tuple(asked[c][:d]) in prefixes)
        assert leaves == walked


def test_ids_of_a_hot_end_in_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 7)
    df = prepare(spark).range(1000).select(
        F.col("id").alias("conv_id"),
        F.when(F.col("id") % 3 == 0, F.lit(b"hot")).otherwise(F.col("id").cast("string").cast("binary")).alias("end"),
    )
    got = {bytes(r.end): r.ends_sha256 for r in prefix_trie.ends_digest(df).collect()}
    ids = ",".join(str(i) for i in range(0, 1000, 3))
    assert got[b"hot"] == hashlib.sha256(ids.encode()).hexdigest()
    assert got[b"7"] == hashlib.sha256(b"7").hexdigest() and len(got) == 667


def test_rebuilt(spark):
    import zlib

    random.seed(3)
    sequences = {c: [f"{c} {i}" for i in range(random.randint(1, 7))] for c in (0, 1, 2, 3, 99, 100, 101, 250)}
    turns = prefix_trie.turns_of(frame(spark, rows_of(sequences)))
    digest = {}
    for r in turns.collect():
        for i, t in enumerate(r.turns):
            digest[bytes(t.digest)] = sequences[r.conv_id][i]
    for r in queries._rebuilt(turns).collect():
        c, h = r.conv_id, zlib.crc32(str(r.conv_id).encode()) % 6
        want = sequences.get(c - c % 100, [])[:h] + sequences[c][h:]
        assert [digest[bytes(t.digest)] for t in r.turns] == want
