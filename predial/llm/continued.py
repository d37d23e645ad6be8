"""Boosted trees of several kinds that go on learning from all rows of a table.

The trees that a fixed set of examples has given are followed by `ROUNDS` more for each kind
that the table has examples of. A row of the table is an example as often as it was found;
each level of a round is one pass over all rows, which sums gradients per node, feature and
value. The sums are of whole numbers, so the trees are the same on any partitioning. The
fixed examples take part in every sum; those of the table together weigh no more than them,
each of its rows alike, or else the most frequent form would be all that counts.

Features are whole numbers from -1 on, known by a byte; those above `TOP` count as `TOP`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predial.llm.boosting import DEPTH, LEAST_WEIGHT, RATE, Booster, Tree, sigmoid
from predial.llm.support import batches_of, discard, keep

ROUNDS = 10
TOP = 254
VALUES = TOP + 2
UNIT = 1 << 20  # of the sums
SCORE_STEPS = 64  # scores of the table are told apart by this part of a unit
ROWS = 1 << 14  # a batch

EXAMPLES = "kind int, label int, held boolean, x binary, n long"


@dataclass
class Examples:
    """Examples in memory: bytes of features, kind, label and score, a row each, n alike."""

    x: np.ndarray
    kind: np.ndarray
    label: np.ndarray
    raw: np.ndarray
    n: np.ndarray


def as_bytes(x: np.ndarray) -> np.ndarray:
    return (np.clip(x, -1, TOP) + 1).astype(np.uint8)


def as_numbers(x: np.ndarray) -> np.ndarray:
    return x.astype(np.float64) - 1


def _read(batch: pa.RecordBatch) -> Examples:
    x = np.frombuffer(b"".join(batch["x"].to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    kind, label, n, raw = (batch[c].to_numpy() for c in ("kind", "label", "n", "raw"))
    return Examples(x, kind, label, raw.copy(), n)


def _add_trees(examples: Examples, trees: Sequence[Sequence[Tree]]) -> None:
    for k, own in enumerate(trees):
        mine = np.flatnonzero(examples.kind == k)
        if len(mine) and len(own):
            x = as_numbers(examples.x[mine])
            for tree in own:
                examples.raw[mine] += tree(x)


def _sums(examples: Examples, growing: Sequence[Tree], level: int) -> np.ndarray:
    """Per kind, node of the level, feature and value: sums of gradients and of their weights."""
    features, nodes = examples.x.shape[1], 2**level
    p = sigmoid(examples.raw)
    gradient = np.rint((p - examples.label) * UNIT) * examples.n
    weight = np.rint(p * (1 - p) * UNIT) * examples.n
    node = np.zeros(len(p), np.int64)
    for k, tree in enumerate(growing):
        mine = np.flatnonzero(examples.kind == k)
        x = as_numbers(examples.x[mine])
        at = np.zeros(len(mine), np.int64)
        for _ in range(level):
            at = 2 * at + 1 + (x[np.arange(len(mine)), tree.feature[at]] > tree.limit[at])
        node[mine] = at - (nodes - 1)
    first = ((examples.kind * nodes + node) * features)[:, None] + np.arange(features)
    cell = (first * VALUES + examples.x).ravel()
    cells = len(growing) * nodes * features * VALUES
    return np.stack([np.bincount(cell, np.repeat(part, features), cells) for part in (gradient, weight)])


def _split(gradient: np.ndarray, weight: np.ndarray) -> tuple[int, float, np.ndarray]:
    """The best feature and limit by sums per feature and value; sums on both sides of it."""
    total_g, total_w = gradient[0].sum(), weight[0].sum()
    left_g, left_w = np.cumsum(gradient, axis=1)[:, :-1], np.cumsum(weight, axis=1)[:, :-1]
    right_g, right_w = total_g - left_g, total_w - left_w
    gain = left_g**2 / (left_w + 1.0) + right_g**2 / (right_w + 1.0)
    gain[(left_w < LEAST_WEIGHT) | (right_w < LEAST_WEIGHT)] = -1
    f, value = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if gain[f, value] <= 1e-9 + total_g**2 / (total_w + 1.0):
        return 0, np.inf, np.array([[total_g, total_w], [0.0, 0.0]])
    sides = np.array([[left_g[f, value], left_w[f, value]], [right_g[f, value], right_w[f, value]]])
    return int(f), float(value) - 1, sides


def _summed(table: DataFrame, trees: list[list[Tree]], growing: list[Tree], level: int, size: int) -> np.ndarray:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size))
        for batch in batches:
            if batch.num_rows:
                examples = _read(batch)
                _add_trees(examples, trees)
                total += _sums(examples, growing, level)
        at = np.flatnonzero(total.any(axis=0))
        columns = [pa.array(c.astype(np.int64)) for c in (at, *total[:, at])]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "gradient", "weight"])

    found = table.filter("NOT held").mapInArrow(run, "cell long, gradient long, weight long")
    found = found.groupBy("cell").agg(F.sum("gradient").alias("gradient"), F.sum("weight").alias("weight")).toArrow()
    total = np.zeros((2, size))
    cells = found["cell"].to_numpy()
    for row, name in enumerate(("gradient", "weight")):
        total[row, cells] = found[name].to_numpy()
    return total


def with_scores(table: DataFrame, boosters: Sequence[Booster], row: Callable[[np.ndarray, int], np.ndarray]) -> DataFrame:
    """`table` with the score `raw` by the boosters; `row` makes their features from numbers and kind."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch["x"].to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            kind, raw = batch["kind"].to_numpy(), np.zeros(batch.num_rows)
            for k in np.unique(kind):
                raw[kind == k] = boosters[k].raw(row(as_numbers(x[kind == k]), k))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw)], names=[*batch.schema.names, "raw"])

    return table.mapInArrow(run, f"{EXAMPLES}, raw double")


def go_on(table: DataFrame, made: Examples, shares: np.ndarray, rounds: int = ROUNDS) -> list[list[Tree]]:
    """More trees for each kind. `table` has scores; `shares`: what a row of it weighs, by kind."""
    kinds, features = len(shares), made.x.shape[1]
    made = replace(made, raw=made.raw.copy())
    trees: list[list[Tree]] = [[] for _ in range(kinds)]
    wanted = np.flatnonzero(shares > 0)
    for _ in range(rounds if len(wanted) else 0):
        growing = [Tree(np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf), np.zeros(2**DEPTH))
                   for _ in range(kinds)]
        for level in range(DEPTH):
            nodes = 2**level
            shape = (2, kinds, nodes, features, VALUES)
            of_table = _summed(table, trees, growing, level, int(np.prod(shape[1:]))).reshape(shape)
            of_made = _sums(made, growing, level).reshape(shape)
            sums = (of_made + of_table * shares[None, :, None, None, None]) / UNIT
            for k in wanted:
                for node in range(nodes):
                    f, limit, sides = _split(*sums[:, k, node])
                    inner = nodes - 1 + node
                    growing[k].feature[inner], growing[k].limit[inner] = f, limit
                    if level == DEPTH - 1:
                        growing[k].value[2 * node : 2 * node + 2] = -RATE * sides[:, 0] / (sides[:, 1] + 1.0)
        _add_trees(made, [[growing[k]] if k in wanted else [] for k in range(kinds)])
        for k in wanted:
            trees[k].append(growing[k])
    return trees


def held_scores(table: DataFrame, trees: list[list[Tree]]) -> np.ndarray:
    """Of the rows held back: kind, label, score (down to a step) and how many."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                examples = _read(batch)
                _add_trees(examples, trees)
                step = np.floor(examples.raw * SCORE_STEPS).astype(np.int64)
                columns = [batch["kind"], batch["label"], pa.array(step), batch["n"]]
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "label", "step", "n"])

    found = table.filter("held").mapInArrow(run, "kind int, label int, step long, n long")
    found = found.groupBy("kind", "label", "step").agg(F.sum("n").alias("n")).toArrow()
    rows = np.array([found[c].to_numpy() for c in ("kind", "label", "step", "n")], np.float64).reshape(4, -1).T
    rows = rows[np.lexsort(rows.T[::-1])]
    rows[:, 2] /= SCORE_STEPS
    return rows


@dataclass
class Learnt:
    trees: list[list[Tree]]
    held: np.ndarray  # kind, label, score, weight
    shares: np.ndarray


def learn(
    examples: DataFrame,
    boosters: Sequence[Booster],
    made: Examples,
    row: Callable[[np.ndarray, int], np.ndarray],
) -> Learnt | None:
    """What all rows of `examples` add to boosters of `made`; None where there are none."""
    alike = keep(examples.groupBy("kind", "label", "held", "x").agg(F.sum("n").alias("n")), "alike")
    with batches_of(examples.sparkSession, ROWS):
        counted = alike.groupBy("kind").agg(F.sum("n").alias("n")).collect()
        if not counted:
            discard(alike)
            return None
        of_table = np.zeros(len(boosters))
        for found in counted:
            of_table[found["kind"]] = found["n"]
        of_made = np.bincount(made.kind, made.n, len(boosters))
        shares = np.where(of_table > 0, np.minimum(1.0, np.maximum(of_made, 1.0) / np.maximum(of_table, 1.0)), 0.0)
        table = keep(with_scores(alike, boosters, row), "scored")
        trees = go_on(table, made, shares)
        held = held_scores(table, trees)
        discard(alike, table)
    held[:, 3] *= shares[held[:, 0].astype(int)]
    return Learnt(trees, held, shares)
