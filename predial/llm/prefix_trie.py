"""The trie of conversation prefixes, built and searched as a z-fast trie.

A turn is known by 128 bits of the SHA-256 of its role and text, and a prefix by the chained
digest of its turns, so a conversation is an array of 16 bytes a turn; texts are read once
and never shuffled. Equal conversations are one sequence, whose ends are counted.

The trie is a table of compacted nodes. A node stands for its extent, the prefix at its own
depth, and for the edge above it, whose labels (digest and length of each turn) it carries.
It is hashed at its handle: the prefix at the two-fattest depth of its edge, the one between
the parent's depth (excluded) and its own that has the most trailing zero bits. A sequence
finds its exit node by fat binary search: at the two-fattest depth of the interval that is
left it looks up its own prefix among the handles; a hit whose extent is a prefix of the
sequence moves the lower end there, another hit is the exit edge, a miss moves the upper end
below. That takes as many joins as the longest depth has bits; a last one, by the first turn
of an edge, tells whether the sequence leaves below the node that was found.

Sequences are inserted in batches. A batch splits every edge at all depths where sequences
leave or end on it, and adds, for each prefix that is new, the sequence with the smallest id
among those that want it; the others are searched again with the next batch. There are as
many batches as branches lie above one another, and every sequence ends up at a node.

Sums over subtrees follow the parents by doubling: after k steps a node has the sums of all
nodes less than 2**k levels below it, and gets those from 2**k levels further down in the
next. At the end the edges are expanded to one row a depth.

Defined results: rows without conversation id are left out; a null role or text counts as
empty; a null turn comes first, rows with equal turn are ordered by role and then by digest,
and repeated rows are turns of their own. An empty table has no members and gives no rows, not
even the root's. Other columns are not read. A conversation is held as one array of digests
(16 bytes and a length a turn); joins on a prefix that very many sequences share are cut up
by adaptive execution, and ids of equal conversations are strung together in sorted parts, so
one task only hashes what the parts hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predial.llm.arrays import indices, totals_before
from predial.llm.support import keep

ROOT = bytes(16)  # the digest of the empty prefix
IDS_AT_ONCE = 50_000  # of one end that are strung together in one row

NODE = (
    "digest binary, depth int, parent binary, parent_depth int, "
    "labels array<struct<digest: binary, chars: int>>"
)


# -- sequences ----------------------------------------------------------------------


def turns_of(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv_id, turns: in order, the digest of each turn and the code points of its text."""
    blank = F.lit("")
    rows = df.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), blank).alias("role"),
        F.coalesce(F.col(text).cast("string"), blank).alias("text"),
    )
    # The length in front tells where the role ends.
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    digest = F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16)
    narrow = rows.select(
        "conv_id",
        F.struct("turn", "role", digest.alias("digest"), F.length("text").alias("chars")).alias("row"),
    )
    sorted_rows = narrow.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    return sorted_rows.select(
        "conv_id",
        F.transform(
            "rows", lambda r: F.struct(r["digest"].alias("digest"), r["chars"].alias("chars"))
        ).alias("turns"),
    )


def paths(sequences: DataFrame) -> DataFrame:
    """conv_id, n, path (digest and chars of each prefix), end (digest of the whole)."""
    kind = sequences.schema["conv_id"].dataType.simpleString()
    label = pa.struct([("digest", pa.binary()), ("chars", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ends = [], []
            for turns in batch["turns"].to_pylist():
                state, path = ROOT, []
                for t in turns:
                    state = hashlib.blake2b(state + t["digest"], digest_size=16).digest()
                    path.append({"digest": state, "chars": t["chars"]})
                found.append(path)
                ends.append(state)
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], pa.array([len(p) for p in found], pa.int32()),
                 pa.array(found, pa.list_(label)), pa.array(ends, pa.binary())],
                names=["conv_id", "n", "path", "end"],
            )

    schema = f"conv_id {kind}, n int, path array<struct<digest: binary, chars: int>>, end binary"
    return sequences.select("conv_id", "turns").mapInArrow(run, schema)


# -- the trie -----------------------------------------------------------------------


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] with the most trailing zero bits."""
    return F.expr(f"{high} & shiftleft(-1, length(bin({low} ^ {high})) - 1)")


def _at(path: str, depth: Column) -> Column:
    """The digest of a prefix; null beyond the path."""
    return F.get(F.col(path), depth - 1)["digest"]


def _spread(key: Column, wanted: Column) -> Column:
    """The key, or where none is wanted one that nothing has and that differs from row to row."""
    return F.when(wanted, key).otherwise(F.concat(F.col("end"), F.lit(b"\0")))


def locate(waiting: DataFrame, nodes: DataFrame, steps: int) -> DataFrame:
    """For each sequence its exit: `edge` (null: it hangs on a node), `leaves`, the depth at
    which it parts from the trie, and the ends of the edge."""
    handles = nodes.withColumn("fat", two_fattest("parent_depth", "depth")).select(
        _at("labels", F.col("fat") - F.col("parent_depth")).alias("handle"),
        F.col("digest").alias("hit"),
        F.col("depth").alias("hit_depth"),
    )
    names = nodes.select(
        F.get("labels", F.lit(0))["digest"].alias("name"), F.col("digest").alias("child")
    )
    edges = nodes.select(
        F.col("digest").alias("edge"), "labels", F.col("depth").alias("edge_depth"),
        F.col("parent_depth").alias("edge_from"),
    )
    x = waiting.withColumns(
        {"low": F.lit(0), "high": F.col("n"), "edge": F.lit(None).cast("binary")}
    )
    columns = x.columns
    for _ in range(steps):
        searching = F.col("edge").isNull() & (F.col("low") < F.col("high"))
        x = x.withColumn("fat", F.when(searching, two_fattest("low", "high")))
        x = x.withColumn("key", _spread(_at("path", F.col("fat")), F.col("fat").isNotNull()))
        x = x.join(handles, x["key"] == handles["handle"], "left")
        hit = F.col("hit").isNotNull()
        along = hit & F.coalesce(_at("path", F.col("hit_depth")) == F.col("hit"), F.lit(False))
        missed = F.col("fat").isNotNull() & ~hit
        moved = {
            "low": F.when(along, F.col("hit_depth")).otherwise(F.col("low")),
            "high": F.when(missed, F.col("fat") - 1).otherwise(F.col("high")),
            "edge": F.when(hit & ~along, F.col("hit")).otherwise(F.col("edge")),
        }
        x = x.select(*(moved.get(c, F.col(c)).alias(c) for c in columns))
    below = F.col("edge").isNull() & (F.col("low") < F.col("n"))
    x = x.withColumn("key", _spread(_at("path", F.col("low") + 1), below))
    x = x.join(names, x["key"] == names["name"], "left")
    x = x.withColumn("edge", F.coalesce("edge", "child")).select(*columns)
    x = x.withColumn("key", _spread(F.col("edge"), F.col("edge").isNotNull())).drop("edge")
    x = x.join(edges, x["key"] == edges["edge"], "left")
    # Digests are of whole prefixes, so the labels that agree are the first ones.
    agree = F.filter(
        indices(F.col("labels")),
        lambda i: F.coalesce(
            F.get("labels", i)["digest"] == F.get("path", F.col("edge_from") + i)["digest"],
            F.lit(False),
        ),
    )
    parts = F.when(F.col("edge").isNull(), F.col("low")).otherwise(
        F.col("edge_from") + F.size(agree)
    )
    return x.select(
        "conv_id", "n", "path", "end", "edge", "edge_from", "edge_depth", parts.alias("leaves")
    )


def _cut(nodes: DataFrame, splits: DataFrame) -> DataFrame:
    """The nodes with their edges cut at the depths in `splits` (edge, at)."""
    # Not more depths than the edge has labels.
    at = splits.groupBy("edge").agg(F.sort_array(F.collect_set("at")).alias("cuts"))
    both = nodes.join(at, nodes["digest"] == at["edge"], "left")
    ends = F.concat(F.coalesce("cuts", F.expr("cast(array() as array<int>)")), F.array("depth"))
    one = both.withColumn("ends", ends).select("*", F.posexplode("ends").alias("k", "to"))
    one = one.withColumn(
        "since", F.when(F.col("k") == 0, F.col("parent_depth")).otherwise(F.get("ends", F.col("k") - 1))
    )
    above = F.col("since") - F.col("parent_depth")
    return one.select(
        _at("labels", F.col("to") - F.col("parent_depth")).alias("digest"),
        F.col("to").alias("depth"),
        F.when(above == 0, F.col("parent")).otherwise(_at("labels", above)).alias("parent"),
        F.col("since").alias("parent_depth"),
        F.slice("labels", above + 1, F.col("to") - F.col("since")).alias("labels"),
    )


def insert(nodes: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes after a batch, and the sequences that are still to be inserted."""
    new = placed.filter("n > leaves").withColumn("name", _at("path", F.col("leaves") + 1))
    firsts = keep(new.groupBy("name").agg(F.min("conv_id").alias("conv_id")).select("conv_id"), "firsts")
    root = F.lit(ROOT)
    leaves = new.join(firsts, "conv_id", "left_semi").select(
        F.col("end").alias("digest"),
        F.col("n").alias("depth"),
        F.coalesce(_at("path", F.col("leaves")), root).alias("parent"),
        F.col("leaves").alias("parent_depth"),
        F.slice("path", F.col("leaves") + 1, F.col("n") - F.col("leaves")).alias("labels"),
    )
    splits = placed.filter("edge IS NOT NULL AND leaves > edge_from AND leaves < edge_depth")
    splits = splits.select("edge", F.col("leaves").alias("at"))
    grown = keep(_cut(nodes, splits).unionByName(leaves), "nodes")
    rest = new.join(firsts, "conv_id", "left_anti").select("conv_id", "n", "path", "end")
    return grown, keep(rest, "waiting")


def build(sequences: DataFrame) -> DataFrame:
    """All compacted nodes but the root, of different sequences (conv_id, n, path, end)."""
    spark = sequences.sparkSession
    nodes = spark.createDataFrame([], NODE)
    waiting = sequences.filter("n > 0")
    longest = waiting.agg(F.max("n")).first()[0] or 0
    empty, steps = longest == 0, 0  # the first batch finds nothing but the root
    while not empty:
        placed = keep(locate(waiting, nodes, steps), "placed")
        nodes, waiting = insert(nodes, placed)
        empty, steps = waiting.isEmpty(), longest.bit_length()
    return nodes


# -- sums over subtrees ---------------------------------------------------------------


def ancestors(nodes: DataFrame) -> list[DataFrame]:
    """(digest, up): the node 1, 2, 4, ... levels above each one that has it."""
    found, now = [], nodes.select("digest", F.col("parent").alias("up"))
    now = keep(now, "up")
    while not now.isEmpty():
        found.append(now)
        further = now.select(F.col("digest").alias("up"), F.col("up").alias("next"))
        now = keep(now.join(further, "up").select("digest", F.col("next").alias("up")), "up")
    return found


def subtree(tree: DataFrame, up: Sequence[DataFrame], combine: dict[str, object]) -> DataFrame:
    """(digest, measures): each measure combined over all nodes of a node's subtree."""
    now = tree.select("digest", *combine)
    for level in up:
        gained = now.join(level, "digest").groupBy("up").agg(
            *(function(name).alias(f"{name}_below") for name, function in combine.items())
        )
        both = now.join(gained, now["digest"] == gained["up"], "left")
        totals = []
        for name, function in combine.items():
            own, below = F.col(name), F.col(f"{name}_below")
            total = F.least(own, below) if function is F.min else own + F.coalesce(below, F.lit(0))
            totals.append(total.alias(name))
        now = keep(both.select("digest", *totals), "subtree")
    return now


def ends_digest(members: DataFrame) -> DataFrame:
    """(end, ends_sha256): of the ids at each end, ascending, joined by commas.

    Ids are sorted by range and strung together in parts, so the task that hashes an end
    reads only as many rows as there are parts of it, one after the other.
    """
    kind = members.schema["conv_id"].dataType.simpleString()

    def string(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, ids = None, []

        def part() -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([end], pa.binary()), pa.array([ids[0]], id_type), pa.array([text])],
                names=["end", "first", "ids"],
            )

        id_type = None
        for batch in batches:
            id_type = batch["conv_id"].type
            for own, conv in zip(batch["end"].to_pylist(), batch["conv_id"].to_pylist()):
                if ids and (own != end or len(ids) == IDS_AT_ONCE):
                    yield part()
                    ids = []
                end = own
                ids.append(conv)
        if ids:
            yield part()

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, state = None, None

        def result(pairs: list[tuple]) -> pa.RecordBatch:
            ends, digests = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(ends, pa.binary()), pa.array(digests, pa.string())],
                names=["end", "ends_sha256"],
            )

        for batch in batches:
            done = []
            for own, ids in zip(batch["end"].to_pylist(), batch["ids"].to_pylist()):
                if own != end:
                    if state:
                        done.append((end, state.hexdigest()))
                    end, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield result(done)
        if state:
            yield result([(end, state.hexdigest())])

    ordered = members.select("end", "conv_id").repartitionByRange("end", "conv_id")
    ordered = ordered.sortWithinPartitions("end", "conv_id")
    parts = ordered.mapInArrow(string, f"end binary, first {kind}, ids string")
    by_end = parts.repartition("end").sortWithinPartitions("end", "first")
    return by_end.mapInArrow(hashed, "end binary, ends_sha256 string")


# -- all of it ------------------------------------------------------------------------


def trie(sequences: DataFrame) -> DataFrame:
    """One row per different prefix of the sequences (conv_id, turns), the empty one included:
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = sequences.sparkSession
    members = keep(paths(sequences), "paths")
    classes = keep(
        members.groupBy("end").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")),
        "classes",
    )
    nodes = build(members.join(classes.select("conv_id"), "conv_id", "left_semi"))
    root = spark.createDataFrame([(ROOT, 0, None, None, [])], NODE)
    root = root if not classes.isEmpty() else root.limit(0)

    children = nodes.groupBy("parent").agg(F.count("*").alias("n_children"))
    children = children.withColumnRenamed("parent", "digest")
    ends = classes.withColumnRenamed("end", "digest")
    tree = nodes.unionByName(root).join(ends, "digest", "left").join(children, "digest", "left")
    none = F.lit(0).cast("long")
    tree = keep(
        tree.select(
            *nodes.columns,
            "conv_id",
            F.coalesce("n_convs", none).alias("n_convs"),
            F.coalesce("n_children", none).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ),
        "tree",
    )
    up = ancestors(nodes)
    counted = subtree(tree, up, {"conv_id": F.min, "n_convs": F.sum, "n_leaves": F.sum})
    tree = tree.drop("conv_id", "n_convs", "n_leaves").join(counted, "digest")
    chars = F.transform("labels", lambda x: x["chars"].cast("long"))
    length = F.aggregate(chars, none, lambda a, x: a + x)
    tree = keep(tree.withColumn("saved", (F.col("n_convs") - 1) * length), "counted")
    saved = subtree(tree, up, {"saved": F.sum})

    above = tree.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = (
        tree.drop("saved").join(saved, "digest")
        .join(above, "parent", "left")
        .join(ends_digest(members).withColumnRenamed("end", "digest"), "digest", "left")
    )
    # One row a label; the root, which has none, stays one row.
    whole = whole.withColumn("before", totals_before(chars))
    rows = whole.select("*", F.posexplode_outer("labels").alias("k", "label"))
    k = F.coalesce("k", F.lit(0))
    last = k >= F.size("labels") - 1
    passed = F.coalesce(F.get("before", k), none) * (F.col("n_convs") - 1)
    depth = F.coalesce(F.col("parent_depth") + k + 1, F.lit(0))
    of_none = hashlib.sha256(b"").hexdigest()
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        depth.cast("long").alias("depth"),
        F.when(k == 0, F.col("parent_conv_id")).otherwise(F.col("conv_id")).cast("long").alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        "n_leaves",
        (F.col("saved") - passed).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(of_none))).otherwise(F.lit(of_none)).alias("ends_sha256"),
    )
