import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import SF, TEXTS, documents, no_documents
from pyspark.sql import functions as F

from predial.llm import jaccard_join
from predial.llm.shingles import similar
from predial.llm.support import prepare


def brute(rows, size, percent):
    """Components by comparing all pairs that share a shingle."""
    sets = {}
    for i, text in rows:
        low = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())
        words = re.findall(rb"[^\x20\x09-\x0D]+", low)
        whole = {tuple(words)} if words else set()
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or whole
    where = defaultdict(list)
    for i, shingles in sets.items():
        for s in shingles:
            where[s].append(i)
    common = Counter(p for ids in where.values() for p in itertools.combinations(sorted(ids), 2))
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {i: (len(s), top(i)) for i, s in sets.items()}


def linked(df, size, percent):
    found = jaccard_join.link(df, size, percent).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_documents_against_all_pairs(spark, size, percent):
    df = jaccard_join._read(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert linked(df, size, percent) == brute(rows, size, percent)


def test_small_sets_and_a_chain(spark):
    """Many short texts that differ by a word, so that groups stay open for several rounds."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    texts = [words[:30]]
    for _ in range(250):
        text = list(texts[int(rng.integers(len(texts)))])
        at = int(rng.integers(len(text)))
        text[at : at + 1] = [str(w) for w in rng.choice(words, int(rng.integers(0, 3)))]
        texts.append(text)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert linked(df, 4, 85) == brute(rows, 4, 85)


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    pairs = 0
    for trial in range(1500):
        n = int(rng.integers(2, 900 if trial % 3 else 40))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        d = int(rng.integers(1, max(2, n // 5)))
        stay = rng.permutation(len(a))[: max(1, len(a) - int(rng.integers(0, d + 1)))]
        more = rng.integers(0, 2**63, int(rng.integers(0, d + 1)), dtype=np.uint64)
        b = np.unique(np.concatenate([a[stay], more]))
        if similar(a, b, percent) and not np.array_equal(a, b):
            pairs += 1
            value, of = jaccard_join.signatures([a, b], percent)
            assert set(value[of == 0]) & set(value[of == 1])
    assert pairs > 200


def test_edges(spark):
    found = jaccard_join.link(documents(spark), 4, 85)
    rows = found.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in TEXTS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[None].component_id is None
    assert [by_id[i].component_id for i in (3, 9, 4)] == [3, 3, 3]
    assert [(by_id[i].n_shingles, by_id[i].component_id) for i in (5, 6, 7)] == [
        (0, 5), (0, 6), (0, 7)]
    assert by_id[2].component_id == 1
    assert jaccard_join.link(no_documents(spark)).count() == 0


def test_rows_that_share_an_id_are_one_node(spark):
    one, two = " ".join(map(str, range(20))), " ".join(map(str, range(50, 70)))
    rows = [(5, one), (5, two), (7, one), (2, two)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in jaccard_join.link(df).collect()} == {2}


def test_dropping_keeps_one_of_each_component(spark):
    df = documents(spark)
    kept = jaccard_join.drop_near_copies(df, 4, 85)
    assert kept.columns == df.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert set(ids) == {i for i, _ in TEXTS} - {2, 4, 9} and ids[3] == 2 and ids[None] == 2


def test_hot_group_of_near_copies_is_not_paired_out(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.when(
            i == F.col("id") % 100, F.concat(F.lit("x"), F.col("id").cast("string")),
        ).otherwise(i.cast("string")))).alias("text"))
    members = jaccard_join._groups(jaccard_join.signed_sets(rows, 4, 85))
    assert members.count() < 3000 * 100
    found = jaccard_join.link(rows, 4, 85)
    assert found.filter("component_id <> 0").count() == 0


def test_open_groups_are_compared_in_blocks(spark, monkeypatch):
    """Families that share half of their text and are not similar, in blocks of seven."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    rng = np.random.default_rng(9)
    shared = [f"s{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = [f"o{i % 25}x{k}" for k in range(25)]
        if i >= 25:
            own[int(rng.integers(25))] = f"e{i}"
        rows.append((i, " ".join(shared + own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert linked(df, 4, 85) == brute(rows, 4, 85)


def test_sketches_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(3)
    for _ in range(400):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 700)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * rng.uniform(0.5, 1))], rng.integers(
            0, 2**63, int(rng.integers(0, 60)), dtype=np.uint64)]))
        words = jaccard_join._folded([jaccard_join.sketch(a), jaccard_join.sketch(b)])
        apart = int(np.bitwise_count(words[0] ^ words[1]).sum())
        assert apart <= len(np.setxor1d(a, b))
        if similar(a, b, 80):
            assert jaccard_join._possible(words[0], words[1], len(a), len(b), 80)


def test_groups_of_signatures(spark):
    """Whole groups, lone signatures gone, hot rows linked to a row of their group."""
    pairs = [(1, i) for i in range(500, 3500)] + [(s, s % 97) for s in range(2, 400)] + [(7, 3), (7, 3), (7, 1)]
    members = defaultdict(set)
    for s, i in pairs:
        members[s].add(i)
    hot = [{"signature": 1, "centre": 600}]
    rows = [(i, [s], []) for s, i in pairs] + [(i, [], hot) for i in (1, 2, 600)]
    members[1] |= {1, 2}
    schema = "doc_id long, signatures array<long>, hot array<struct<signature: long, centre: long>>"
    groups = jaccard_join._groups(prepare(spark).createDataFrame(rows, schema))
    found = defaultdict(set)
    for s, i, centre in groups.collect():
        assert i != centre and {i, centre} <= members[s]
        found[s] |= {i, centre}
    assert found == {s: ids for s, ids in members.items() if len(ids) > 1}
    assert "Window" not in groups._jdf.queryExecution().toString()


def test_batches_of_a_group():
    """A group that goes on over batches stays one: every row or centre is linked to it."""
    def batch(*rows):
        return pa.RecordBatch.from_pylist([{"signature": s, "doc_id": i} for s, i in rows])

    got = list(jaccard_join._members([batch((1, 5), (2, 9)), batch((2, 7)), batch((2, 8), (3, 1))]))
    assert [tuple(r.values()) for b in got for r in b.to_pylist()] == [(2, 9, 7), (2, 8, 7)]


def test_rows_of_a_hot_signature_in_a_task():
    hot = jaccard_join.Hot()
    hot.OFTEN, hot.SHOWN = 3, 4
    shown, others = hot.taken(np.array([5, 6, 5, 7, 5], np.uint64), list("abcde"))
    assert shown.all() and not others
    shown, others = hot.taken(np.array([5, 5, 6], np.uint64), list("fgh"))
    assert shown.tolist() == [True, False, True] and others == [(1, "a")]
