"""Exact top-k inner products by a three-phase uniform threshold.

A vector's score for a query is the sum of its partial products over `SLICES` slices of
the dimensions: as many score lists a query, each ordered by partial product.

1. Every task takes the first k entries of each list among its vectors, scores these
   exactly, and hands on its best k a query. The k-th best score of all that is gathered is
   a lower bound of the k-th best score at all: the safe cutoff. It is broadcast.
2. A vector whose partial products all lie below cutoff / `SLICES` has a lower sum than the
   cutoff. So each task collects the entries at or above that uniform threshold from its
   lists, and bounds each vector's score from above by its collected entries and the
   threshold for the others.
3. Vectors whose bound reaches the cutoff are scored exactly. A task's best k a query, not
   below the cutoff, go on to the final ranking.

Queries are taken in blocks of bounded size, each broadcast and run against all vectors;
tasks keep k entries a query whatever the number of their vectors, so copies of one vector,
however many, cost nothing more.

Components are scaled to integers, floor(scale * x), and all scores are exact: products are
summed in floating point where every sum stays below 2**53, else in whole numbers, held to
the range of a long at the end. Defined results: vectors that are null, or hold null or
values that aren't finite, take no part; shorter vectors count as filled up with zeros; of
equal scores the smaller id comes first; a query's own id is never its result; rows without
id take no part; of a query id that repeats the first vector, by value, asks. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from predial.session import scratch_folder

K = 10
SCALE = 1024
SLICES = 4
QUERY_BLOCK = 32_768  # queries that are broadcast at once
ROW_BLOCK, COLUMN_BLOCK = 512, 1024  # vectors and queries that are scored at once
LONG = 2**63


@dataclass
class Queries:
    """A block of queries: ids and integer vectors, and their cutoffs once known."""

    ids: np.ndarray
    vectors: np.ndarray
    cutoff: np.ndarray


def _matrix(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors take part, and their components, filled up with zeros."""
    values = vectors.flatten()
    sizes = vectors.value_lengths()
    if not vectors.null_count and not values.null_count and len(sizes.unique()) == 1:
        out = values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
        valid = np.isfinite(out).all(axis=1)
        return np.flatnonzero(valid), out[valid]
    taking, rows = [], []
    for i, vector in enumerate(vectors.to_pylist()):
        if vector is not None and None not in vector:
            row = np.asarray(vector, np.float64)
            if np.isfinite(row).all():
                taking.append(i)
                rows.append(row)
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return np.array(taking, np.int64), out


def scaled(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors take part, and their integer components, filled up with zeros."""
    valid, out = _matrix(vectors)
    with np.errstate(over="ignore"):
        product = np.floor(out * scale)
    if not np.isfinite(product).all() or (np.abs(product) >= 2**53).any():
        whole = np.empty(out.shape, object)
        for i, j in np.ndindex(out.shape):
            whole[i, j] = _exact_floor(float(out[i, j]), scale)
        return valid, whole
    return valid, product


def _exact_floor(x: float, scale: int) -> int:
    top, bottom = x.as_integer_ratio()
    return top * scale // bottom


def _fit(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with as many columns, and of a kind in which their products are exact."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    if a.size and b.size and a.dtype != object and b.dtype != object:
        if np.abs(a).max() * np.abs(b).max() * width < 2**53:
            return a, b
    whole = [x if x.dtype == object else np.vectorize(int, otypes=[object])(x) if x.size
             else x.astype(object) for x in (a, b)]
    return whole[0], whole[1]


def _slices(width: int) -> list[slice]:
    ends = np.linspace(0, width, SLICES + 1).astype(int)
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def _exact(rows: np.ndarray, queries: np.ndarray, at: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whole scores of chosen (vector, query) pairs."""
    if rows.dtype == object:
        return np.array([rows[i].dot(queries[j]) for i, j in zip(at, of)], object)
    return np.einsum("ij,ij->i", rows[at], queries[of])


def _first_entries(rows: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Phase 1: pairs among the first k of any list of a query, with exact scores."""
    marked = np.zeros((len(rows), len(queries)), bool)
    for part in _slices(rows.shape[1]):
        products = rows[:, part] @ queries[:, part].T
        if len(rows) <= k:
            marked[:] = True
        else:
            order = np.argsort(-products, axis=0, kind="stable") if products.dtype == object \
                else np.argpartition(-products, k - 1, axis=0)
            np.put_along_axis(marked, order[:k], True, axis=0)
    at, of = np.nonzero(marked)
    return at, of, _exact(rows, queries, at, of)


def _sufficient_entries(rows: np.ndarray, queries: np.ndarray, cutoff: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phases 2 and 3: pairs whose exact score reaches the cutoff."""
    threshold = cutoff / SLICES
    seen = np.zeros((len(rows), len(queries)), bool)
    bound = np.zeros((len(rows), len(queries)))
    for part in _slices(rows.shape[1]):
        products = (rows[:, part] @ queries[:, part].T).astype(float)
        enough = products >= threshold
        seen |= enough
        bound += np.where(enough, products, threshold)
    slack = 1e-9 * np.abs(cutoff) + 1e-6
    at, of = np.nonzero(seen & (bound >= cutoff - slack))
    scores = _exact(rows, queries, at, of)
    reach = scores >= cutoff[of]
    return at[reach], of[reach], scores[reach]


def _merge(best: list, pairs: tuple[np.ndarray, ...], k: int) -> list:
    """The best k (query, id, score) a query out of two lots."""
    of, ids, scores = (np.concatenate([a, b]) for a, b in zip(best, pairs)) if best else pairs
    order = np.lexsort((ids, -scores, of)) if scores.dtype != object else np.array(
        sorted(range(len(of)), key=lambda i: (of[i], -scores[i], ids[i])), np.int64)
    of, ids, scores = of[order], ids[order], scores[order]
    first = np.searchsorted(of, of)
    stays = np.arange(len(of)) - first < k
    return [of[stays], ids[stays], scores[stays]]


def _local_best(vectors: DataFrame, shared, scale: int, k: int, final: bool) -> DataFrame:
    """Each task's best k (query_id, vec_id, score) a query, one pass over all vectors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        parts = [slice(i, i + COLUMN_BLOCK) for i in range(0, len(queries.ids), COLUMN_BLOCK)]
        best: list[list] = [[] for _ in parts]
        for batch in batches:
            all_ids = batch["vec_id"].to_numpy(zero_copy_only=False)
            valid, rows = scaled(batch["embedding"], scale)
            ids = all_ids[valid]
            for start in range(0, len(ids), ROW_BLOCK):
                some = ids[start : start + ROW_BLOCK]
                for i, part in enumerate(parts):
                    block, asked = _fit(rows[start : start + ROW_BLOCK], queries.vectors[part])
                    # A query may lie among the vectors: one entry more, itself, goes below.
                    at, of, scores = (
                        _sufficient_entries(block, asked, queries.cutoff[part]) if final
                        else _first_entries(block, asked, k + 1)
                    )
                    other = some[at] != queries.ids[part][of]
                    found = [of[other], some[at[other]], scores[other]]
                    if len(found[0]):
                        best[i] = _merge(best[i], found, k)
        for part, found in zip(parts, best):
            if found:
                scores = [max(-LONG, min(LONG - 1, int(s))) for s in found[2]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(queries.ids[part][found[0]], pa.int64()),
                        pa.array(found[1], pa.int64()),
                        pa.array(scores, pa.int64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return vectors.mapInArrow(run, "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block(vectors: DataFrame, chosen: DataFrame, scale: int, k: int, path: str) -> None:
    """The results of one block of queries, added to the table at `path`."""
    one = chosen.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    collected = one.toArrow().combine_chunks()
    if not collected.num_rows:
        return
    valid, rows = scaled(collected["embedding"].combine_chunks(), scale)
    context = vectors.sparkSession.sparkContext
    ids = collected["vec_id"].to_numpy()[valid]
    order = np.argsort(ids)
    queries = Queries(ids[order], rows[order], np.full(len(ids), -np.inf))

    gathered = _ranked(_local_best(vectors, context.broadcast(queries), scale, k, False), k)
    cutoffs = gathered.filter(F.col("rank") == k).select("query_id", "score").collect()
    at = np.searchsorted(queries.ids, [row["query_id"] for row in cutoffs]).astype(int)
    queries.cutoff[at] = [float(row["score"]) for row in cutoffs]
    queries.cutoff[np.abs(queries.cutoff) >= 2**53] = -np.inf  # beyond exact floats: all

    found = _local_best(vectors, context.broadcast(queries), scale, k, True)
    _ranked(found, k).select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)


def search(
    df: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best, all others searched."""
    spark = df.sparkSession
    vectors = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    vectors = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    asked = df.filter(is_query).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")
    ).filter("vec_id IS NOT NULL AND embedding IS NOT NULL AND NOT exists(embedding, x -> "
             "x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    path = f"{scratch_folder(spark, 'topk')}/ranked"
    schema = "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    blocks = -(-asked.count() // query_block)
    for block in range(blocks):
        of_block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block
        _block(vectors, asked.filter(of_block), scale, k, path)
    return spark.read.schema(schema).parquet(path)
