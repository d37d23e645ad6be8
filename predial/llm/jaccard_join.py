"""Near duplicates: sets of word shingles joined by Jaccard similarity, exactly.

Candidates come from PartEnum signatures. Set sizes fall into bands; two sets that are
similar enough lie in one band or in neighbouring ones, and each set signs for its own band
and, if a partner can lie there, for the next. Within a band, similar sets differ in at
most k shingles. The domain of shingles is partitioned, by hash, into n parts, and small
bands partition each part again into three and enumerate the subsets of two of them, so
that among all signatures (the shingles inside one subset) two similar sets share at least
one. k differences can spoil only so many parts; the number of parts exceeds that by a
margin for parts without shingles, whose signatures would say nothing and are left out. A
set that lacks more parts than the margin allows signs again under another partition, so
the join stays exact: no link is lost, and every candidate is verified on whole texts.

Signatures are grouped without writing out the pairs inside a group. First each member is
compared with the group's smallest id. Groups whose other members the links then found
don't join to one component are open: their members are compared across components, in
blocks of bounded size, by sketches; at first for the nearest pairs, as few as it takes to
join what can be joined, and then, where that left components apart, for all. A sketch has one bit per bucket of shingles, the parity
of how many fall into it, so the bits in which two sketches differ are no more than the
shingles in which the sets differ; a pair with more of them than similar sets may have is
out, and only the others are written down. Those, and the pairs with a centre that the
sketches leave, are verified on whole texts. Sets that are equal are one class from the
start.

Defined results: null, empty and blank texts have no shingles and no links. Rows that
share an id are one node; rows without id have no component. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predial.llm.components import smallest_reachable
from predial.llm.exact_dedup import per_salt, salt_of
from predial.llm.shingles import Shingler, mixed, set_digest, similar
from predial.llm.support import batches_of, discard, forget_others, fresh, full_text, keep

WORDS, PERCENT = 5, 80
BAND_STEPS = 2  # a band spans this many times the size ratio of similar sets
SMALL_DIFFERENCE = 12  # bands of at most so many differences enumerate subsets of parts
PARTITIONS = 4  # tried by sets that lack parts, before a last signature for all such sets
BLOCK = 2000  # members of an open group that are compared at once, with as many others
NARROW_ROWS = 1 << 16  # a batch of signatures
REMEMBERED_SETS = 100_000  # of a task, to sign equal sets once


# -- signatures -------------------------------------------------------------------


@lru_cache(maxsize=8)
def bands(percent: int, largest: int) -> np.ndarray:
    """Upper ends of the size bands, up to one above `largest`."""
    ends, low = [], 1
    while not ends or ends[-1] <= largest or len(ends) < 2 or ends[-2] <= largest:
        high = low
        for _ in range(BAND_STEPS):
            high = max(high, high * 100 // percent)
        ends.append(high)
        low = high + 1
    return np.array(ends, np.int64)


def difference(percent: int, high: np.ndarray) -> np.ndarray:
    """How many shingles similar sets of at most this size can differ in."""
    return 2 * high * (100 - percent) // (100 + percent)


def _shape(percent: int, band: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each band: parts, subparts of a part, and parts that may be spoilt."""
    k = difference(percent, ends[band])
    subparts = np.where(k <= SMALL_DIFFERENCE, 3, 1)
    spoilt = np.where(subparts == 3, k // 2, k)
    # Members of a band have at least about this many shingles.
    low = np.where(band > 0, ends[np.maximum(band - 1, 0)] + 1, 1) * percent / 100
    parts = spoilt + 1
    for _ in range(3):
        if_none = np.exp(-low / parts * np.where(subparts == 3, 2 / 3, 1)) * subparts
        empty = np.minimum(parts * if_none, parts)
        parts = spoilt + 1 + np.ceil(empty + 3 * np.sqrt(empty)).astype(np.int64)
    return np.minimum(parts, 2 * spoilt + 2), subparts, spoilt


def _sums(cell: np.ndarray, value: np.ndarray, cells: int) -> np.ndarray:
    """Sums of 64-bit values per cell, exact: halves stay below 2**53."""
    low = np.bincount(cell, value & np.uint64(0xFFFFFFFF), cells).astype(np.uint64)
    high = np.bincount(cell, value >> np.uint64(32), cells).astype(np.uint64)
    with np.errstate(over="ignore"):
        return low + (high << np.uint64(32))


def _sign(sets, band, ends, percent, seed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Under one partition: signature values, the set of each, and which sets lack parts."""
    parts, subparts, spoilt = _shape(percent, band, ends)
    sizes = np.array([len(s) for s in sets])
    of = np.repeat(np.arange(len(sets)), sizes)
    shingles = np.concatenate(sets)
    spread = mixed(shingles, 2 * seed + 11)
    part = (spread >> np.uint64(33)).astype(np.int64) % parts[of]
    sub = (spread & np.uint64(0xFFFFFF)).astype(np.int64) % subparts[of]
    first = np.cumsum(parts * subparts) - parts * subparts
    cells = int((parts * subparts).sum())
    cell = first[of] + part * subparts[of] + sub
    value, filled = _sums(cell, mixed(shingles, 2 * seed + 12), cells), np.bincount(cell, minlength=cells)

    of_cell = np.repeat(np.arange(len(sets)), parts * subparts)
    within = np.arange(cells) - first[of_cell]
    for_three = subparts[of_cell] == 3
    if for_three.any():  # a subset of two is the part without the third
        at = np.flatnonzero(for_three).reshape(-1, 3)
        with np.errstate(over="ignore"):
            value[at] = value[at].sum(axis=1, keepdims=True) - value[at]
        filled[at] = filled[at].sum(axis=1, keepdims=True) - filled[at]
    some = filled > 0
    whole_part = first[of_cell] + within // subparts[of_cell] * subparts[of_cell]
    lacking_part = np.zeros(cells, bool)
    lacking_part[whole_part[~some]] = True
    lacks = np.bincount(of_cell[lacking_part], minlength=len(sets)) >= parts - spoilt
    with np.errstate(over="ignore"):
        name = mixed(within.astype(np.uint64), 3) + band[of_cell].astype(np.uint64)
        signature = mixed(value + mixed(name, 17 + seed), 5)
    return signature[some], of_cell[some], lacks


def signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets, none empty, and the number of the set of each."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if not len(sizes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = bands(percent, 1 << int(sizes.max()).bit_length())
    own = np.searchsorted(ends, sizes)
    found, whose = [], []
    reach = sizes * 100 // percent  # the largest partner
    for band, wanted in ((own, np.full(len(sizes), True)), (own + 1, reach > ends[own])):
        # Without room for a difference only equal sets are similar, and those are known.
        at = np.flatnonzero(wanted & (difference(percent, ends[band]) > 0))
        for seed in range(PARTITIONS):
            if not len(at):
                break
            values, number, lacks = _sign([sets[i] for i in at], band[at], ends, percent, seed)
            found.append(values)
            whose.append(at[number])
            at = at[lacks]
        if len(at):
            found.append(mixed(band[at].astype(np.uint64), 99))
            whose.append(at)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(whose)


# -- on tables --------------------------------------------------------------------


def _read(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).alias("doc_id"), full_text(text).alias("text"))


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles in each of two to four times as many buckets."""
    buckets = max(64, 1 << max(0, 2 * len(shingles) - 1).bit_length())
    place = (mixed(shingles, 55) & np.uint64(buckets - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=buckets) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of words, all as short as the shortest: halves add up."""
    width = min(map(len, sketches)) // 8
    rows = np.empty((len(sketches), width), np.uint64)
    for i, value in enumerate(sketches):
        words = np.frombuffer(value, np.uint64)
        rows[i] = np.bitwise_xor.reduce(words.reshape(-1, width), axis=0)
    return rows


def _possible(
    first: np.ndarray, second: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int
) -> np.ndarray:
    """Whether sets of sizes n and m with these sketches can be similar (broadcasting)."""
    apart = np.bitwise_count(first ^ second).sum(axis=-1, dtype=np.int64)
    sizes = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    return sizes & ((100 + percent) * apart <= (100 - percent) * (n + m))


class Hot:
    """Signatures that very many rows of a task have, and one of those rows for each.

    A signature that `OFTEN` sets of one batch have is counted from then on. The task hands
    over `SHOWN` of its rows to the signature's group; the rest go straight to the row that
    was first, so the task that gathers a group doesn't gather a third of the table.
    """

    OFTEN, SHOWN = 8, 200

    def __init__(self):
        self.first: dict[int, tuple] = {}
        self.count: dict[int, int] = {}

    def taken(self, values: np.ndarray, ids: list) -> tuple[np.ndarray, list[tuple]]:
        """Which (signature, id) rows go to their groups, and the others as (row, first id)."""
        found, counts = np.unique(values, return_counts=True)
        for value in found[counts >= self.OFTEN].tolist():
            self.count.setdefault(value, 0)
        shown, others = np.ones(len(values), bool), []
        if not self.count:
            return shown, others
        known = np.fromiter(self.count, np.uint64, len(self.count))
        for at in np.flatnonzero(np.isin(values, known)).tolist():
            value = int(values[at])
            self.first.setdefault(value, ids[at])
            self.count[value] += 1
            if self.count[value] > self.SHOWN:
                shown[at] = False
                others.append((at, self.first[value]))
        return shown, others


def signed_sets(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """One pass over the texts: of each row's set the size, 128 bits, sketch and signatures.

    doc_id, n_shingles, d1, d2, sketch, signatures; `hot` has signatures with the id of another
    row of their group (`Hot`). Sets that repeat inside a task sign once, rows without id not.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("jaccard_join")
        shingler, seen, hot = Shingler(words), set(), Hot()
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            sets = [shingler(t) for t in batch["text"].to_pylist()]
            digests = [set_digest(s) for s in sets]
            signing = []
            for i, digest in enumerate(digests):
                if len(sets[i]) and ids[i] is not None and digest not in seen:
                    signing.append(i)
                    if len(seen) < REMEMBERED_SETS:
                        seen.add(digest)
            values, number = signatures([sets[i] for i in signing], percent)
            whose = np.array(signing, np.int64)[number]
            order = np.argsort(whose, kind="stable")
            values, whose = values[order], whose[order]
            shown, others = hot.taken(values, [ids[i] for i in whose.tolist()])
            held: list[list] = [[] for _ in ids]
            for at, first in others:
                held[whose[at]].append({"signature": int(values[at].astype(np.int64)), "centre": first})
            ends = np.searchsorted(whose[shown], np.arange(len(ids) + 1))
            listed = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(values[shown].astype(np.int64), pa.int64())
            )
            pair = pa.struct([("signature", pa.int64()), ("centre", batch["doc_id"].type)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                    listed,
                    pa.array(held, pa.list_(pair)),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "sketch", "signatures", "hot"],
            )

    schema = (
        f"doc_id {kind}, n_shingles long, d1 long, d2 long, sketch binary, "
        f"signatures array<long>, hot array<struct<signature: long, centre: {kind}>>"
    )
    return rows.mapInArrow(run, schema)


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature those that aren't alone, each with a centre of its group.

    The centre is the smallest id, as far as the batch reaches; a group that goes on in the
    next batch goes on with that centre, and if a smaller one comes, the two are linked.
    """
    last = None  # signature and centre of the group that the batch before ended in
    for batch in batches:
        if not batch.num_rows:
            continue
        value = batch["signature"].to_numpy()
        ids = batch["doc_id"].to_numpy(zero_copy_only=False)
        if last is not None:
            value = np.concatenate([last[0], value])
            ids = np.concatenate([last[1], ids])
        opens = np.concatenate([[True], value[1:] != value[:-1]])
        starts = np.flatnonzero(opens)
        centre = np.minimum.reduceat(ids, starts)[np.cumsum(opens) - 1]
        apart = ids != centre
        last = value[-1:], centre[-1:]
        yield pa.RecordBatch.from_arrays(
            [pa.array(value[apart], pa.int64()), pa.array(ids[apart], batch["doc_id"].type),
             pa.array(centre[apart], batch["doc_id"].type)],
            names=["signature", "doc_id", "centre"],
        )


def _groups(signed: DataFrame) -> DataFrame:
    """(signature, doc_id, centre): members of all groups of two or more but their centres.

    Every signature is shuffled once, in narrow rows; the many that are alone end there.
    """
    kind = signed.schema["doc_id"].dataType.simpleString()
    rows = signed.select(F.explode("signatures").alias("signature"), "doc_id")
    dealt = rows.repartition("signature").sortWithinPartitions("signature")
    members = dealt.mapInArrow(_members, f"signature long, doc_id {kind}, centre {kind}")
    hot = signed.select("doc_id", F.explode("hot").alias("h")).select(
        "h.signature", "doc_id", "h.centre"
    )
    with batches_of(signed.sparkSession, NARROW_ROWS):
        return keep(members.unionByName(hot.filter("doc_id <> centre")), "groups")


def _as_pairs(pairs: DataFrame, class_of: DataFrame) -> DataFrame:
    """Different pairs (a, b), a < b, of classes, from pairs of documents."""
    a = class_of.select(F.col("doc_id").alias("left"), F.col("class").alias("class_a"))
    b = class_of.select(F.col("doc_id").alias("right"), F.col("class").alias("class_b"))
    found = pairs.distinct().join(a, "left").join(b, "right").filter("class_a <> class_b")
    return found.select(
        F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")
    ).distinct()


def _sketched(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that the sketches don't rule out."""
    kind = pairs.schema["a"].dataType.simpleString()
    for end in ("a", "b"):
        own = sketches.select(
            F.col("class").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"s_{end}")
        )
        pairs = pairs.join(own, end)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keeps = np.zeros(batch.num_rows, bool)
            n, m = (batch[c].to_numpy() for c in ("n_a", "n_b"))
            first, second = (batch[c].to_pylist() for c in ("s_a", "s_b"))
            for i in range(len(keeps)):
                both = _folded([first[i], second[i]])
                keeps[i] = _possible(both[0], both[1], n[i], m[i], percent)
            yield batch.select(["a", "b"]).filter(pa.array(keeps))

    found = pairs.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, f"a {kind}, b {kind}")
    return found.distinct()


def _spanning(
    words: np.ndarray, n: np.ndarray, component: np.ndarray, own: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Nearest pairs that join what can be joined: a least spanning forest, by Prim's method.

    Members of one component are joined from the start; of two blocks, `own` tells them
    apart, only pairs across count.
    """
    far = 1 << 40
    waiting = np.ones(len(n), bool)
    distance, parent, pairs = np.full(len(n), far), np.full(len(n), -1), []
    across = own.min() != own.max()
    for _ in range(len(n)):
        v = int(np.argmin(np.where(waiting, distance, far + 1)))
        if 0 <= distance[v] < far:
            pairs.append((int(parent[v]), v))
        waiting[v] = False
        apart = np.bitwise_count(words ^ words[v]).sum(axis=1, dtype=np.int64)
        fits = _possible(words[v], words, n[v], n, percent)
        if across:
            fits &= own != own[v]
        apart = np.where(component == component[v], -1, np.where(fits, apart, far))
        nearer = waiting & (apart < distance)
        distance[nearer], parent[nearer] = apart[nearer], v
    return pairs


def _crossing(members: DataFrame, percent: int, spanning: bool) -> DataFrame:
    """Pairs (a, b) of classes in open groups, of different components, that can be similar.

    `members`: signature, size (of the group, at most), class, component, n, sketch. Groups
    of more than a block are dealt by pairs of blocks. With `spanning` only as many pairs a
    group as it takes to join all members that can be joined, the nearest ones.
    """
    kind = members.schema["class"].dataType.simpleString()
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("class"), blocks.cast("long")).cast("int")
    others = F.sequence(F.lit(0), blocks - 1)
    dealt = members.withColumn("own", own).withColumn("other", F.explode(others)).select(
        "signature",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
        "own", "class", "component", "n", "sketch",
    )
    key = ["signature", "left", "right"]

    def compare(rows: list[tuple]) -> tuple[list, list]:
        left, right, own, names, component, n, sketches = zip(*rows)
        words, n, own = _folded(list(sketches)), np.array(n), np.array(own)
        _, component = np.unique(np.array(component), return_inverse=True)
        a, b = [], []
        if spanning:
            for x, y in _spanning(words, n, component, own, percent):
                low, high = sorted((names[x], names[y]))
                a.append(low)
                b.append(high)
            return a, b
        first = np.flatnonzero(own == left[0])
        second = np.flatnonzero(own == right[0])
        step = max(1, (1 << 22) // max(1, words.shape[1] * len(second)))
        for i in range(0, len(first), step):
            at = first[i : i + step, None]
            near = _possible(words[at], words[second][None], n[at], n[second][None], percent)
            near &= component[at] != component[second][None]
            if left[0] == right[0]:
                near &= at < second[None]
            for x, y in zip(*np.nonzero(near)):
                low, high = sorted((names[at[x, 0]], names[second[y]]))
                a.append(low)
                b.append(high)
        return a, b

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, waiting = None, []
        columns = ("left", "right", "own", "class", "component", "n", "sketch")

        def batch_of(a: list, b: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(a, id_type), pa.array(b, id_type)], names=["a", "b"]
            )

        id_type = None
        for batch in batches:
            id_type = batch["class"].type
            found_a, found_b = [], []
            rows = list(zip(*(batch[c].to_pylist() for c in columns)))
            for signature, row in zip(batch["signature"].to_pylist(), rows):
                if (signature, row[0], row[1]) != present:
                    if len(waiting) > 1:
                        a, b = compare(waiting)
                        found_a += a
                        found_b += b
                    present, waiting = (signature, row[0], row[1]), []
                waiting.append(row)
            yield batch_of(found_a, found_b)
        if len(waiting) > 1:
            yield batch_of(*compare(waiting))

    placed = dealt.repartition(*key).sortWithinPartitions(*key)
    return placed.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _verified(pairs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    involved = pairs.select("a").union(pairs.select("b")).distinct().toDF("doc_id")
    texts = keep(rows.join(involved, "doc_id", "left_semi"), "texts")
    kind = pairs.schema["a"].dataType.simpleString()
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    compared = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("jaccard_join")
        shingler, last, last_set = Shingler(words), None, None
        for batch in batches:
            keeps = []
            for text_a, text_b in zip(batch["text_a"].to_pylist(), batch["text_b"].to_pylist()):
                if text_a != last:  # rows come sorted by `a`
                    last, last_set = text_a, shingler(text_a)
                keeps.append(similar(last_set, shingler(text_b), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keeps, pa.bool_()))

    return compared.mapInArrow(run, f"a {kind}, b {kind}")


def link(
    df: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of `df`: doc_id, n_shingles, component_id.

    The component is the smallest id reachable by links, the row's own included.
    """
    rows = _read(df, doc_id, text)
    signed = keep(signed_sets(rows, words, percent), "signed")
    groups = _groups(signed)
    sets = keep(signed.drop("signatures", "hot"), "sets")
    discard(signed)
    full = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL").withColumn("salt", salt_of("doc_id"))
    classes = full.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("class"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts")
    )
    in_class = full.join(per_salt(classes), ["d1", "d2", "salt"]).drop("d1", "d2", "salt")
    in_class = keep(in_class, "classes")
    sketches = keep(
        in_class.filter("doc_id = class")
        .select("class", F.col("n_shingles").alias("n"), "sketch").distinct(),
        "sketches",
    )
    in_class = in_class.select("doc_id", "class").distinct()
    class_of = in_class.groupBy("doc_id").agg(F.min("class").alias("class"))
    # Rows that share an id tie the classes of their texts together.
    links = in_class.join(class_of.withColumnRenamed("class", "first"), "doc_id")
    links = links.filter("class <> first").select(F.col("first").alias("a"), F.col("class").alias("b"))

    with_centre = groups.select(F.col("centre").alias("left"), F.col("doc_id").alias("right"))
    pairs = keep(_sketched(_as_pairs(with_centre, in_class), sketches, percent), "pairs")
    links = keep(links.union(_verified(pairs, rows, words, percent)), "links")
    discard(pairs)
    components = smallest_reachable(links)

    # Groups whose rows, but a single centre that all were compared with, are two or more.
    sizes = groups.groupBy("signature").agg(
        (F.count("*") + 1).alias("members"), (F.min("centre") < F.max("centre")).alias("several")
    )
    sizes = keep(sizes.filter("members > 2"), "sizes")
    centres = groups.join(sizes.filter("several"), "signature")
    centres = centres.select("signature", F.col("centre").alias("doc_id"), "members").distinct()
    others = groups.join(sizes, "signature").select("signature", "doc_id", "members").union(centres)
    for spanning in (True, False):
        labelled = in_class.join(components, in_class["class"] == components["node"], "left")
        labelled = labelled.select(
            "doc_id", "class", F.coalesce("component", "class").alias("component")
        )
        present = keep(others.join(labelled, "doc_id"), "others")
        still = present.groupBy("signature").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        ).filter("low <> high").select("signature")
        open_groups = keep(present.join(still, "signature", "left_semi"), "open")
        members = open_groups.groupBy("signature", "class", "component").agg(
            F.max("members").alias("size")
        )
        pairs = keep(_crossing(members.join(sketches, "class"), percent, spanning), "pairs")
        if pairs.isEmpty():
            break
        links = keep(links.union(_verified(pairs, rows, words, percent)), "links")
        components = smallest_reachable(links)
        others = open_groups.select("signature", "doc_id", "members")

    found = class_of.join(components, class_of["class"] == components["node"], "left").select(
        "doc_id", F.coalesce("component", "class").alias("component_id")
    )
    own = sets.select("doc_id", "n_shingles")
    return own.join(found, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def drop_near_copies(
    df: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`df` with one document of each component, the one with the smallest id; all columns.

    Documents without shingles, and rows without id, all stay.
    """
    linked = link(df, words, percent, doc_id, text)
    gone = linked.filter("component_id < doc_id").select(
        F.col("doc_id").alias(fresh(df, "gone_id"))
    ).distinct()
    return df.join(gone, df[doc_id] == gone[gone.columns[0]], "left_anti")
