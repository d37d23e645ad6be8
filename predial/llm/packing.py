"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Documents longer than a sequence are cut into full pieces and a rest; full pieces fill a
sequence each. What remains is decided on the histogram of lengths, which has at most as
many rows as the capacity, whatever the corpus:

1. Large pieces, above a third of the capacity: at most two of them share a sequence.
   Greedy matching, the longest first, each with the longest partner that fits.
2. Smaller pieces, the longest first, go where they leave the least room; a new sequence
   is opened only when none has room.

The histogram yields groups of equally filled sequences, and each place of a group takes a
range of ranks among the pieces of its length. Ranks are counted per length and bucket,
with enough buckets that a length of a third of all pieces is no hot key, so the pieces
find their places without meeting in one task.

Defined results: a null text counts as empty; an empty text is one piece that holds the
end-of-document id only. Equal rows are placed one by one. An empty table gives no pieces.
"""

from __future__ import annotations

import gc
import os
import zlib
from array import array
from bisect import insort
from collections.abc import Callable, Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from predial.llm.support import keep, remembered

CAPACITY = 2048
END_OF_DOCUMENT = 0
BUCKET_ROWS = 200  # pieces of a length that are ranked together
BUCKETS = 200_000  # buckets at most, besides one for each length
CACHE_ENTRIES = 400_000  # words a worker remembers
LONGEST_WORD = 64
WORDS_AT_ONCE = 4096  # new words tokenised in one call
MARKS = frozenset((b".", b",", b";", b":", b"!", b"?"))

PIECE = "doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary"


# -- tokens -----------------------------------------------------------------------


class Words(dict):
    """Packed ids by word: the latest words, and behind them those of the generation before.

    A word that is unknown gets an empty place at once, which `settle` fills when its text's
    batch is through; so a text is looked up word by word in one go.
    """

    def __init__(self, entries: int, longest: int):
        super().__init__()
        self.entries, self.longest = entries, longest
        self.old: dict[bytes, bytes] = {}
        self.plain: list[bytes] = []  # without ids so far
        self.marked: list[bytes] = []  # those that end in a mark, which is tokenised apart

    def __missing__(self, word: bytes) -> bytes | bytearray:
        known = self.old.get(word)
        if known is None:
            known = bytearray()
            ends = word[-1:] in MARKS and word[-2:-1].isalnum()
            (self.marked if ends else self.plain).append(word)
        self[word] = known
        return known

    def settle(self, tokenise: Callable[[list[bytes]], Iterable[bytes]]) -> None:
        parts = [(word, self[word[:-1]], self[word[-1:]]) for word in self.marked]
        plain, self.plain, self.marked = self.plain, [], []
        for word, ids in zip(plain, tokenise(plain)):
            self[word].extend(ids)
            self._keep(word, ids)
        for word, first, mark in parts:
            ids = bytes(first + mark)
            self[word].extend(ids)
            self._keep(word, ids)
        if len(self) > self.entries:
            self.old = dict(self)
            self.clear()

    def _keep(self, word: bytes, ids: bytes) -> None:
        if len(word) <= self.longest:
            self[word] = ids
        else:
            del self[word]


class WordTokenizer:
    """Ids of texts by a tokenizer that never merges across ASCII white space.

    It ignores the case of letters and takes punctuation apart from words, so a word is
    remembered in small letters, and one that ends in a mark by its two parts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        gc.set_threshold(1_000_000, 50, 50)  # many small lists, none of them in cycles
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = Words(CACHE_ENTRIES, LONGEST_WORD)

    def _tokenise(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of each word. One of the letters a-z alone goes to the tokenizer's model as it
        is: nothing in it is normalised, split or added, and no mark or space stands beside."""
        tokens = self.model.tokenize
        for block in batched(words, WORDS_AT_ONCE):
            plain = [w.isalpha() and w.islower() for w in block]
            others = [w.decode() for w, letters in zip(block, plain) if not letters]
            encoded = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
            for word, letters in zip(block, plain):
                ids = [t.id for t in tokens(word.decode())] if letters else next(encoded).ids
                yield array("I", ids).tobytes()

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Packed little-endian ids of each text. Words that are new are tokenised once."""
        ids_of, look_up = [], self.words.__getitem__
        for text in texts:
            raw = (text or "").encode()
            # A special token's string counts in small letters only.
            ids_of.append(list(map(look_up, (raw if b"<|" in raw else raw.lower()).split())))
        self.words.settle(self._tokenise)
        return [b"".join(ids) for ids in ids_of]


def tokenizer(path: str) -> WordTokenizer:
    return remembered(f"packing {path}", lambda: WordTokenizer(path))


def cut_pieces(
    df: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of every document with their ids (packed, or null) and their checksum."""
    kind = df.schema[doc_id].dataType.simpleString()
    end = np.array([END_OF_DOCUMENT], "<u4").tobytes()
    schema = PIECE.format(kind=kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids_of = tokenizer(path).encode_many(batch.column(1).to_pylist())
            rows, pieces, starts, lengths, sums, kept = [], [], [], [], [], []
            for row, ids in enumerate(ids_of):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    kept.append(part if with_ids else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    rows = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    return rows.mapInArrow(run, schema)


# -- the plan, from the histogram --------------------------------------------------


class Room:
    """Groups of equally filled sequences by the room they have left.

    A group is (sequences, places); a place is (length, offset, pieces side by side).
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.groups: dict[int, list[tuple[int, tuple]]] = {}
        self.rooms: list[int] = []  # sorted, those that have groups
        self.done: list[tuple[int, tuple]] = []

    def put(self, sequences: int, places: tuple, room: int) -> None:
        if sequences and room:
            if room not in self.groups:
                insort(self.rooms, room)
            self.groups.setdefault(room, []).append((sequences, places))
        elif sequences:
            self.done.append((sequences, places))

    def take_tightest(self, length: int) -> tuple[int, int, tuple] | None:
        """A group with the least room that still holds `length`."""
        low, high = 0, len(self.rooms)
        while low < high:
            middle = (low + high) // 2
            if self.rooms[middle] < length:
                low = middle + 1
            else:
                high = middle
        if low == len(self.rooms):
            return None
        room = self.rooms[low]
        sequences, places = self.groups[room].pop()
        if not self.groups[room]:
            del self.groups[room]
            del self.rooms[low]
        return room, sequences, places

    def all(self) -> list[tuple[int, tuple]]:
        return self.done + [g for room in self.rooms for g in self.groups[room]]


def match_large(counts: dict[int, int], room: Room) -> None:
    """Two large pieces a sequence where any fit, the longest first with its best partner."""
    left = dict(counts)
    lengths = sorted(left)
    for length in reversed(lengths):
        while left[length]:
            fits = [x for x in lengths if x <= room.capacity - length and left[x] > (x == length)]
            if not fits:
                room.put(left[length], ((length, 0, 1),), room.capacity - length)
                left[length] = 0
                break
            partner = fits[-1]
            pairs = left[length] // 2 if partner == length else min(left[length], left[partner])
            places = ((length, 0, 2),) if partner == length else (
                (length, 0, 1), (partner, length, 1)
            )
            room.put(pairs, places, room.capacity - length - partner)
            left[length] -= pairs
            left[partner] -= pairs


def fill_small(counts: dict[int, int], room: Room) -> None:
    """Smaller pieces, the longest first, into the tightest room."""
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            group = room.take_tightest(length)
            if group is None:
                room.put(-(-left // (room.capacity // length)), (), room.capacity)
                continue
            free, sequences, places = group
            fit = free // length
            offset = room.capacity - free
            full = min(sequences, left // fit)
            room.put(full, (*places, (length, offset, fit)), free - fit * length)
            left -= full * fit
            sequences -= full
            if sequences and left:  # fewer than `fit` are left
                room.put(1, (*places, (length, offset, left)), free - left * length)
                sequences, left = sequences - 1, 0
            room.put(sequences, places, free)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, pieces side by side, first sequence, offset), sorted.

    From its first rank on, a row's pieces go, so many side by side, to one sequence after
    the other. Ranks of a length without gaps; every piece of the histogram has a place.
    """
    room = Room(capacity)
    large = {x: n for x, n in histogram.items() if 3 * x > capacity and x < capacity}
    small = {x: n for x, n in histogram.items() if 3 * x <= capacity}
    room.put(histogram.get(capacity, 0), ((capacity, 0, 1),), 0)
    match_large(large, room)
    fill_small(small, room)
    ranks = dict.fromkeys(histogram, 0)
    rows, sequence = [], 0
    for sequences, places in room.all():
        for length, offset, beside in places:
            rows.append((length, ranks[length], beside, sequence, offset))
            ranks[length] += sequences * beside
        sequence += sequences if places else 0
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# -- places -----------------------------------------------------------------------


def _bucketed(pieces: DataFrame, histogram: dict[int, int], capacity: int) -> DataFrame:
    """With a bucket for each piece, by its id; lengths that are frequent have many."""
    rows = max(BUCKET_ROWS, sum(histogram.values()) // BUCKETS)
    counts = [-(-histogram.get(length, 0) // rows) or 1 for length in range(capacity + 1)]
    buckets = F.split(F.lit(",".join(map(str, counts))), ",")[F.col("length").cast("int")]
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), buckets.cast("long"))
    return pieces.withColumn("bucket", bucket)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with sequence_id and offset. `pieces` should be a stored table."""
    sizes = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    histogram = {row["length"]: row["count"] for row in sizes}
    rows = plan(histogram, capacity)
    bucketed = _bucketed(pieces, histogram, capacity)
    found = bucketed.groupBy("length", "bucket").count().collect()  # bounded by BUCKETS
    counted = np.array(sorted(map(tuple, found)), np.int64).reshape(-1, 3)
    before = np.cumsum(counted[:, 2]) - counted[:, 2]
    first = np.searchsorted(counted[:, 0], counted[:, 0])
    before = before - (before[first] if len(first) else 0)  # within the length
    wide = 1 << 40  # above any rank and any bucket
    buckets = (counted[:, 0] * wide + counted[:, 1], before)
    starts = rows[:, 0] * wide + rows[:, 1]
    names = [c for c in pieces.columns]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, bucket, nth = (
                batch.column(batch.schema.get_field_index(c)).to_numpy()
                for c in ("length", "bucket", "nth")
            )
            at = np.searchsorted(buckets[0], length * wide + bucket)
            rank = buckets[1][at] + nth - 1
            row = rows[np.searchsorted(starts, length * wide + rank, side="right") - 1]
            from_first = rank - row[:, 1]
            sequence = row[:, 3] + from_first // row[:, 2]
            offset = row[:, 4] + from_first % row[:, 2] * length
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    order = Window.partitionBy("length", "bucket").orderBy(
        "doc_id", "piece", "start", "ids_crc32"
    )
    ranked = bucketed.withColumn("nth", F.row_number().over(order).cast("long"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(
    df: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of all documents and their places.

    Columns doc_id, piece, start, length, ids_crc32, ids (packed ids; null without
    `with_ids`), sequence_id, offset. The pieces are stored once, in the shared folder.
    """
    pieces = keep(cut_pieces(df, path, capacity, doc_id, text, with_ids), "pieces")
    return place(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids, packed, and the documents in it. From `pack` with ids."""
    part = F.struct("offset", "doc_id", "ids")
    parts = F.array_sort(F.collect_list(part))  # at most `capacity` pieces in a sequence
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("aggregate(parts, cast('' as binary), (a, p) -> a || p.ids)").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
    )
