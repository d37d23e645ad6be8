"""Byte-level BPE encoding and decoding with a public rank file.

A piece of text (one match of the pattern) starts as its bytes. A segment tree over the
byte positions holds, at every node, the leftmost smallest rank among the pairs that start
below it: the leaf of a position holds `rank * width + position` of the live token there
and its right neighbour, or a value above all others, so the root's minimum is the next
merge. A merge changes the leaf of the merged token, of its left neighbour and of the
token that went; each change walks up one path. A piece of n bytes costs n log n.
Pieces of like length that a batch has and the worker doesn't remember are merged side by
side, as the rows of one array of trees.

Defined results: null and empty texts have no ids and decode to no bytes. Texts of any
length are encoded whole. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import gc
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from predial.llm.support import Recent, remembered

CACHE_ENTRIES = 400_000  # stretches and pieces a worker remembers, at most
SHORT = 64  # characters or bytes of the longest that it remembers
FOREST_CELLS = 1 << 17  # leaves of the trees that are merged side by side

# At a space that another character follows the pattern always starts a new piece, whatever
# stands before the space, so a text can be cut there and its stretches encoded apart.
_BEFORE_WORD = re.compile(r" (?=\S)")

# Fixed value: stretches of this form are one piece of the public pattern.
_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeTable:
    """Which two token ids merge into which, from ranks that name a token by its bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values(), default=0) + 1
        pairs = [
            (ranks[token[:cut]] * self.size + ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        pairs.sort()
        self.codes = np.array([code for code, _ in pairs] or [-1], np.int64)
        self.merged = np.array([rank for _, rank in pairs] or [0], np.int32)
        self.of_byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged id, which is also the pair's rank; -1 where there is none."""
        code = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        return np.where((self.codes[at] == code) & (left >= 0) & (right >= 0), self.merged[at], -1)


class Forest:
    """Segment trees of many pieces of up to `width` bytes, merged one step at a time.

    Row p is the tree of piece p: node 1 the root, leaf `width + i` the pair that starts at
    byte i. A step takes the root's pair of every tree that has one, links the neighbours,
    sets three leaves and walks their paths up, level by level.
    """

    def __init__(self, pieces: list[bytes], width: int, table: MergeTable):
        self.table, self.width = table, width
        self.none = (table.size + 1) * width
        kind = np.int32 if self.none < 2**31 else np.int64
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        size = np.array([len(p) for p in pieces])
        place = np.arange(width, dtype=np.int32)
        # One more column than bytes: the neighbour of the last token, and of the first.
        self.token = np.full((len(pieces), width + 1), -1, np.int32)
        self.token[:, :width] = np.where(
            place < size[:, None], table.of_byte[raw].reshape(-1, width), -1
        )
        self.after = np.broadcast_to(np.minimum(place + 1, width), (len(pieces), width)).copy()
        self.after[np.arange(len(pieces)), size - 1] = width
        self.after = np.pad(self.after, ((0, 0), (0, 1)), constant_values=width)
        self.before = np.broadcast_to(place - 1, (len(pieces), width)).copy()
        self.before = np.pad(self.before, ((0, 0), (0, 1)))
        self.before[:, 0] = width
        self.tree = np.full((len(pieces), 2 * width), self.none, kind)
        rank = table(self.token[:, :-1].ravel(), self.token[:, 1:].ravel())
        rank = rank.reshape(-1, width).astype(kind)
        self.tree[:, width:] = np.where(rank >= 0, rank * width + place, self.none)
        level = width // 2
        while level:
            nodes = self.tree[:, 2 * level : 4 * level]
            self.tree[:, level : 2 * level] = np.minimum(nodes[:, ::2], nodes[:, 1::2])
            level //= 2

    def _set(self, rows: np.ndarray, start: np.ndarray) -> None:
        """The leaf of the tokens at `start`: their pair with the token after them."""
        follower = self.token[rows, self.after[rows, start]]
        rank = self.table(self.token[rows, start], follower).astype(self.tree.dtype)
        value = np.where(rank >= 0, rank * self.width + start, self.none)
        inside = start < self.width
        self.tree[rows[inside], self.width + start[inside]] = value[inside]

    def run(self) -> list[bytes]:
        width, tree = self.width, self.tree
        rows = np.flatnonzero(tree[:, 1] < self.none)
        while len(rows):
            least = tree[rows, 1]
            start = least % width
            gone = self.after[rows, start]
            following = self.after[rows, gone]
            self.token[rows, start] = least // width
            self.token[rows, gone] = -1
            self.after[rows, start] = following
            self.before[rows, following] = start
            earlier = self.before[rows, start]
            tree[rows, width + gone] = self.none
            self._set(rows, start)
            self._set(rows, earlier)
            nodes = [width + gone, width + start, width + np.where(earlier < width, earlier, start)]
            for _ in range(width.bit_length() - 1):
                nodes = [node // 2 for node in nodes]
                for node in nodes:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            rows = rows[tree[rows, 1] < self.none]
        live = self.token[:, :width] >= 0
        packed = self.token[:, :width][live].astype("<u4").tobytes()
        ends = 4 * np.cumsum(live.sum(axis=1))
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class TextCodec:
    """Whole texts to packed ids (little-endian unsigned 32-bit) and back to bytes."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.table = MergeTable(self.ranks)
        self.split = regex.compile(pattern).findall
        self.bytes_of = [b""] * self.table.size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.recent = Recent(CACHE_ENTRIES, SHORT)

    def _merge(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The packed ids of pieces; a piece that is a token needs no merges."""
        found, by_width = {}, defaultdict(list)
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                found[piece] = rank.to_bytes(4, "little")
            else:
                by_width[max(2, 1 << (len(raw) - 1).bit_length())].append((piece, raw))
        for width, group in by_width.items():
            some = max(1, FOREST_CELLS // width)
            for i in range(0, len(group), some):
                names, raw = zip(*group[i : i + some])
                found.update(zip(names, Forest(raw, width, self.table).run()))
        return found

    def _learn(self, stretches: set[str]) -> dict[str, bytes]:
        """The packed ids of stretches that aren't remembered."""
        words = set(filter(_WORD.fullmatch, stretches))
        pieces_of = {s: self.split(s) for s in stretches - words}
        found, unknown = self.recent.fill({p for pieces in pieces_of.values() for p in pieces})
        found.update(self._merge(unknown | words))
        found.update((s, b"".join([found[p] for p in pieces])) for s, pieces in pieces_of.items())
        return found

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        cut = []
        for text in texts:
            first, *rest = _BEFORE_WORD.split(text or "")
            cut.append([first, *[" " + s for s in rest]] if first else [" " + s for s in rest])
        recent = self.recent.young.get
        packed = [list(map(recent, stretches)) for stretches in cut]
        gaps = [(s, p) for s, p in zip(cut, packed) if None in p]
        found, unknown = self.recent.fill(
            {s for stretches, ids in gaps for s, p in zip(stretches, ids) if p is None}
        )
        found.update(self._learn(unknown))
        for stretches, ids in gaps:
            ids[:] = [found[s] if p is None else p for s, p in zip(stretches, ids)]
        self.recent.add(found)
        return [b"".join(ids) for ids in packed]

    def decode(self, packed: bytes | None) -> bytes:
        ids = np.frombuffer(packed or b"", "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, ids))


def codec(path: str, pattern: str) -> TextCodec:
    """One codec a worker, kept between its tasks."""

    def make() -> TextCodec:
        gc.set_threshold(1_000_000, 50, 50)  # many small lists, none of them in cycles
        return TextCodec(path, pattern)

    return remembered(f"byte_bpe {path} {pattern}", make)


def _mapped(df: DataFrame, columns: dict[str, str], added: str, convert) -> DataFrame:
    """`columns` of `df` under new names, and a binary column made from the last of them."""
    taken = df.select(*(df[old].alias(new) for new, old in columns.items()))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in taken.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(convert(batch.column(batch.num_columns - 1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*columns, added])

    return taken.mapInArrow(run, f"{schema}, {added} binary")


def encode(
    df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id and `ids`, the ids of the whole text packed as little-endian 32-bit numbers."""
    columns = {"doc_id": doc_id, "text": text}
    encoded = _mapped(df, columns, "ids", lambda texts: codec(path, pattern).encode_many(texts))
    return encoded.select("doc_id", "ids")


def decode(
    df: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """doc_id, the packed `ids`, and `decoded`, the bytes that they stand for."""
    columns = {"doc_id": doc_id, "ids": ids}
    return _mapped(
        df, columns, "decoded", lambda packed: [codec(path, pattern).decode(p) for p in packed]
    )
