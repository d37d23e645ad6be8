"""Quality of texts: hashed word n-grams, logistic regression learnt by FTRL.

A text is its words (stretches without white space). Each word has two faces, hashed: the
lower-case letters and digits in it, and its shape (`Aa,` or `A!!` or `|`), so that words
never seen before still say something. Features are the n-grams of one and two words over
both faces, a mark for a word that repeats the one before it, and a mark for three words
that came before in the same text, all hashed into `BUCKETS` cells and divided by the
number of words. The weights are learnt by follow-the-regularised-leader updates, and a
score is the logistic function of a sparse dot product.

The model is fitted on at most `SAMPLE` labelled rows, those with the smallest hash of
their id, in one task; the labels of other rows aren't read. That task keeps the cells of
each text, not the text. Scores cover all rows.

Defined results: null text counts as empty, and a text without words is scored by the bias
alone. A document whose labels contradict each other equally often doesn't teach. Without
any label every score is 0.5. Repeated rows and ties get equal scores.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predial.llm.support import forget_others, full_text, give_back, smallest_hashes

BUCKETS = 1 << 18
SAMPLE = 6000  # labelled rows that the model is fitted on, at most
EPOCHS = 3
RATE, SMOOTHING, L1, L2 = 0.5, 1.0, 0.02, 0.1
KNOWN_WORDS = 300_000  # words a worker remembers
PORTION = 1 << 20  # characters that are scored at once; a longer text is scored alone

_RUNS = re.compile(r"[A-ZÀ-ÖØ-Þ]+|[a-zß-öø-ÿ]+|[0-9]+|[^A-Za-z0-9À-ÖØ-öø-ÿ]")
_CORE = re.compile(r"\W+")

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """Cells of 64-bit values, differently for each salt."""
    x = (values + np.uint64(salt)) * _MIX
    x ^= x >> np.uint64(29)
    x *= _MIX
    return (x >> np.uint64(64 - 18)).astype(np.int64)


def shape(word: str) -> str:
    """`A` for capitals, `a` for small letters, `0` for digits, other characters as they are."""
    signs = []
    for run in _RUNS.findall(word):
        first = run[0]
        sign = "0" if first.isdigit() else "a" if first.islower() else (
            ("AA" if len(run) > 1 else "A") if first.isupper() else first
        )
        if signs[-3:] != [sign] * 3:
            signs.append(sign)
    return "".join(signs)


class Words:
    """Numbers of words and the two hashes of each; forgets when there are too many."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.hashes = np.zeros((2, 1 << 12), np.uint64)

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts in a row, and how many words each text has."""
        if len(self.number) > KNOWN_WORDS:
            self.__init__()
        number, found, sizes = self.number, [], []
        for text in texts:
            words = text.split()
            ids = list(map(number.get, words))
            if None in ids:
                for i, (word, known) in enumerate(zip(words, ids)):
                    if known is None:
                        ids[i] = number.get(word)
                        if ids[i] is None:
                            ids[i] = self._learn(word)
            found += ids
            sizes.append(len(ids))
        return np.array(found, np.int64), np.array(sizes, np.int64)

    def _learn(self, word: str) -> int:
        n = self.number[word] = len(self.number)
        if n >= self.hashes.shape[1]:
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)], axis=1)
        core = _CORE.sub("", word.lower()).encode()
        self.hashes[0, n] = zlib.crc32(core) | len(core) << 32
        self.hashes[1, n] = zlib.crc32(shape(word).encode())
        return n


def cells(words: Words, texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each kind of feature the text's row and the cell, and the texts' word counts."""
    ids, sizes = words.numbers(texts)
    row = np.repeat(np.arange(len(texts)), sizes)
    kinds = []
    with np.errstate(over="ignore"):
        for face in (0, 1):
            value = words.hashes[face][ids]
            kinds.append((row, _mixed(value, 1 + face)))
            pair = value[:-1] * np.uint64(1_000_003) + value[1:]
            inside = row[:-1] == row[1:]
            kinds.append((row[1:][inside], _mixed(pair, 3 + face)[inside]))
        word = words.hashes[0][ids]
        again = np.flatnonzero((row[:-1] == row[1:]) & (word[:-1] == word[1:]))
        marks = _mixed(np.arange(2, dtype=np.uint64), 7)
        kinds.append((row[again], np.full(len(again), marks[0])))
        three = (word[:-2] * np.uint64(31) + word[1:-1]) * np.uint64(1_000_003) + word[2:]
        inside = np.flatnonzero(row[:-2] == row[2:])
        key = three[inside] * _MIX + row[inside].astype(np.uint64)
        _, first = np.unique(key, return_index=True)
        before = np.delete(inside, first)
        kinds.append((row[before], np.full(len(before), marks[1])))
    return kinds, sizes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Leader:
    """FTRL-proximal logistic regression over `BUCKETS` cells and a bias."""

    def __init__(self):
        self.z = np.zeros(BUCKETS + 1)
        self.n = np.zeros(BUCKETS + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((SMOOTHING + np.sqrt(n)) / RATE + L2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        """`at` without repeats."""
        w = self.weights(at)
        gradient = (_sigmoid(w @ value) - label) * value
        n = self.n[at]
        step = (np.sqrt(n + gradient**2) - np.sqrt(n)) / RATE
        self.z[at] += gradient - step * w
        self.n[at] = n + gradient**2


Example = tuple[np.ndarray, np.ndarray, int]


def example(words: Words, text: str) -> Example:
    """The cells of a text, how often each occurs (in as few bytes as hold it), its words."""
    kinds, sizes = cells(words, [text])
    at, count = np.unique(np.concatenate([c for _, c in kinds]), return_counts=True)
    small = np.min_scalar_type(int(count.max()) if len(count) else 0)
    return at.astype(np.int32), count.astype(small), int(sizes[0])


def fit_examples(examples: list[Example], labels: list[float]) -> np.ndarray:
    """Weights of the cells, the bias last."""
    leader = Leader()
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(examples)):
            at, count, size = examples[i]
            value = np.append(count.astype(float) / max(1, size), 1.0)
            leader.learn(np.append(at, np.int32(BUCKETS)), value, labels[i])
    return leader.weights()


def fit_weights(texts: list[str], labels: list[float]) -> np.ndarray:
    """Weights of the cells, the bias last."""
    words = Words()
    return fit_examples([example(words, text) for text in texts], labels)


def portions(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, so many at a time that they have about `PORTION` characters."""
    part, held = [], 0
    for text in texts:
        if part and held + len(text) > PORTION:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part


def score_texts(words: Words, weights: np.ndarray, texts: list[str]) -> np.ndarray:
    scores = [np.zeros(0)]
    for part in portions(texts):
        kinds, sizes = cells(words, part)
        total = np.zeros(len(part))
        for row, cell in kinds:
            total += np.bincount(row, weights=weights[cell], minlength=len(part))
        scores.append(_sigmoid(total / np.maximum(1, sizes) + weights[BUCKETS]))
    return np.concatenate(scores)


# -- on tables --------------------------------------------------------------------


def train(
    documents: DataFrame,
    labels: DataFrame,
    teaches: Column | None = None,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
) -> np.ndarray | None:
    """Weights from labelled documents whose id satisfies `teaches`; None without any."""
    taught = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("label"))
    taught = taught.filter("doc_id IS NOT NULL AND label IS NOT NULL")
    if teaches is not None:
        taught = taught.filter(teaches)
    agreed = (
        taught.groupBy("doc_id").agg(F.avg("label").alias("label"))
        .filter("label <> 0.5")
        .select("doc_id", F.round("label").cast("double").alias("label"))
    )
    chosen = smallest_hashes(agreed, "doc_id", sample)
    texts = documents.select(F.col(doc_id).alias("doc_id"), full_text(text).alias("text"))
    # Where a sampled id occurs on several rows, the same ones teach on any partitioning.
    rows = texts.join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "text").limit(sample)

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("quality")
        words, seen = Words(), []
        for b in batches:
            for t, y, i in zip(*(b[c].to_pylist() for c in ("text", "label", "doc_id"))):
                digest = hashlib.blake2b(t.encode(), digest_size=16).digest()
                seen.append((i, digest, y, example(words, t)))
        seen.sort(key=lambda x: x[:2])  # the result must not depend on the order
        if seen:
            weights = fit_examples([e for _, _, _, e in seen], [y for _, _, y, _ in seen])
            packed = weights.astype("<f4").tobytes()
            del words, seen
            give_back()
            yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["weights"])

    found = rows.coalesce(1).mapInArrow(fit, "weights binary").collect()
    return np.frombuffer(found[0]["weights"], "<f4").astype(float) if found else None


def with_score(
    df: DataFrame, weights: np.ndarray | None, text: str = "text", score: str = "score"
) -> DataFrame:
    """`df` and the score of its text, 0 to 1. The weights, one megabyte, are broadcast."""
    if weights is None:
        return df.withColumn(score, F.lit(0.5))
    shared = df.sparkSession.sparkContext.broadcast(weights)
    state: dict[str, Words] = {}

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        forget_others("quality")
        words = state.setdefault("words", Words())
        return pa.array(score_texts(words, shared.value, texts.to_pylist()), pa.float64())

    return df.withColumn(score, scored(full_text(text)))
