"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

A component c of a vector becomes the integer floor(64 c) + 1000000. The scatter of the
different vectors, n sum(y y') - S S' (which is n squared times their covariance, and the
same for any offset), is a matrix of integers, summed up exactly by the tasks. Then

1. its characteristic polynomial is found modulo one prime a row: a reduction to Hessenberg
   form and the recurrence over its leading blocks. The primes are rows of a Spark table;
2. Chinese remaindering joins the remainders into the integer coefficients;
3. all roots are real, so the sign changes of the polynomial shifted by t count the roots
   above t, without error and with multiplicity. Halving by that count encloses each of the
   wanted roots until its width is 2**-64 of it;
4. a component is found by inverse iteration near the null space of the scatter minus the
   root, in fixed point with hundreds of bits; roots that one interval holds share an
   orthonormal basis.

Steps 3 and 4 are one row a component, too. What reaches the driver or is broadcast are the
scatter, the polynomial and the components: bounded by the square of the dimension (times the
length of its numbers), whatever the number of vectors.

Defined results: vectors that are null, hold null or non-finite entries, or entries whose
integer a long can't hold, take no part. The commonest number of entries (of equally common
ones the largest) is the dimension; a vector of another length has no place among them and
takes no part either. Components whose root is zero, known exactly from the polynomial, can't be
whitened and are left out, so fewer than two different vectors, or an empty table, give no
rows. A null or repeated id is a row like any other. `deviation` is null where a long can't
hold it. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.llm.support import keep

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
ROOT_BITS = 64  # of each root, relative to it
LARGEST_PRIME = 2**31 - 1  # products of two remainders fit a long


# -- integers of the vectors --------------------------------------------------------


def integers(embedding: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """The vector as longs; null where it takes no part."""
    value = lambda c: F.floor(c.cast("double") * scale)
    fits = lambda c: F.coalesce(
        F.abs(c.cast("double")) < 2.0**62 / scale, F.lit(False)  # false for nan as well
    ) & ~F.isnan(c.cast("double"))
    return F.when(
        F.forall(embedding, fits), F.transform(embedding, lambda c: value(c) + F.lit(offset))
    )


def _vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    rows = df.select(F.col(vec_id).alias("vec_id"), integers(F.col(embedding)).alias("x"))
    return rows.filter("x IS NOT NULL")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, without the offset."""
    values = batch["x"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(batch.num_rows, -1) - OFFSET


def _product(y: np.ndarray) -> np.ndarray:
    """y'y in exact integers, by the fastest arithmetic that can hold it."""
    size = max(abs(int(y.min(initial=0))), abs(int(y.max(initial=0))))
    largest = size * size * len(y)
    if largest < 2**53:
        as_floats = y.astype(np.float64)
        return (as_floats.T @ as_floats).astype(np.int64).astype(object)
    if largest < 2**63:
        return (y.T @ y).astype(object)
    return y.T.astype(object) @ y.astype(object)


def _sums(fit: DataFrame) -> DataFrame:
    """(i, j, value): sums of the products of entries i and j; i = -1: sums, and the count."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _matrix(batch)
            ones = np.concatenate([np.ones((len(y), 1), np.int64), y], axis=1)
            found = _product(ones)
            total = found if total is None else total + found
        if total is None:
            return
        i, j = np.triu_indices(len(total))
        # As text: a product may have more digits than Arrow's decimals convert quickly.
        values = [str(v) for v in total[i, j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i - 1, pa.int32()), pa.array(j - 1, pa.int32()), pa.array(values)],
            names=["i", "j", "value"],
        )

    partial = fit.select("x").mapInArrow(run, "i int, j int, value string")
    return partial.groupBy("i", "j").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))


# -- the polynomial -----------------------------------------------------------------


def primes_below(limit: int, wanted_bits: int) -> list[int]:
    """The largest primes up to `limit` whose product has more than `wanted_bits` bits."""
    small = np.ones(isqrt(limit) + 1, bool)
    small[:2] = False
    for q in range(2, isqrt(len(small)) + 1):
        if small[q]:
            small[q * q :: q] = False
    small = np.flatnonzero(small)
    found, bits, high = [], 0.0, limit
    while bits <= wanted_bits + 1:
        low = max(2, high - (1 << 16) + 1)
        segment = np.ones(high - low + 1, bool)
        for q in small:
            segment[max(q * q, -(-low // q) * q) - low :: q] = False
        for at in np.flatnonzero(segment)[::-1]:
            found.append(int(at) + low)
            bits += np.log2(found[-1])
            if bits > wanted_bits + 1:
                return found
        high = low - 1
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime, the constant one first."""
    h = np.array(matrix % p, np.int64)
    size = len(h)
    for m in range(1, size - 1):  # similarity transforms clear column m - 1 below m
        pivots = np.flatnonzero(h[m:, m - 1])
        if not len(pivots):
            continue
        i = m + int(pivots[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    leading = np.zeros((size + 1, size + 1), np.int64)  # of the leading blocks, by size
    leading[0, 0] = 1
    for m in range(1, size + 1):
        now = np.roll(leading[m - 1], 1)
        now[0] = 0
        now = (now - h[m - 1, m - 1] * leading[m - 1]) % p
        below = 1
        for i in range(1, m):
            below = below * int(h[m - i, m - i - 1]) % p
            if not below:
                break
            now = (now - below * int(h[m - i - 1, m - 1]) % p * leading[m - i - 1]) % p
        leading[m] = now
    return leading[size].tolist()


def coefficient_bits(trace: int, size: int) -> int:
    """No coefficient has more bits: sums of products of k roots, which aren't negative, are
    largest where the roots are equal."""
    mean = trace // size + 1
    return max((comb(size, k) * mean**k).bit_length() for k in range(size + 1))


def _joined(remainders: list[tuple[int, list[int]]]) -> list[int]:
    """Integers between minus and plus half the product, from their remainders."""
    modulus, values = 1, [0] * len(remainders[0][1])
    for p, found in remainders:
        inverse = pow(modulus % p, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, found)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Of a scatter (integers, no negative root); one row of a table for each prime."""
    size = len(matrix)
    trace = sum(int(matrix[i, i]) for i in range(size))
    primes = primes_below(LARGEST_PRIME, coefficient_bits(trace, size) + 1)
    shared = spark.sparkContext.broadcast(_as_text(matrix))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _from_text(shared.value)
        for batch in batches:
            found = [polynomial_mod(own, p) for p in batch["p"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["p"], pa.array(found, pa.list_(pa.int64()))], names=["p", "found"]
            )

    table = _spread(spark, [(p,) for p in primes], "p long")
    rows = table.mapInArrow(run, "p long, found array<long>").collect()  # a row a prime
    return _joined([(r["p"], r["found"]) for r in rows])


def _spread(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of work, over as many tasks as there are rows or cores."""
    cores = spark.sparkContext.defaultParallelism
    return spark.createDataFrame(rows, schema).repartition(max(1, min(len(rows), cores)))


def _as_text(matrix: np.ndarray) -> list[list[str]]:
    return [[str(v) for v in row] for row in matrix]


def _from_text(rows: list[list[str]]) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in rows], object)


# -- roots --------------------------------------------------------------------------


class Roots:
    """Counts the roots of a polynomial that has real ones only."""

    def __init__(self, coefficients: list[int]):
        self.coefficients, self.known = coefficients, {}

    def above(self, numerator: int, bits: int) -> int:
        """How many roots, with multiplicity, are larger than numerator / 2**bits."""
        while bits and not numerator & 1:
            numerator, bits = numerator >> 1, bits - 1
        if (numerator, bits) not in self.known:
            size = len(self.coefficients) - 1
            # 2**(bits * size) p(x / 2**bits), then shifted by the numerator.
            c = [v << (bits * (size - i)) for i, v in enumerate(self.coefficients)]
            for low in range(size):
                carried = c[size]
                for i in range(size - 1, low - 1, -1):
                    carried = c[i] = c[i] + numerator * carried
            signs = [v > 0 for v in c if v]
            changes = sum(a != b for a, b in zip(signs, signs[1:]))
            self.known[numerator, bits] = changes
        return self.known[numerator, bits]

    def enclose(self, nth: int, largest: int) -> tuple[int, int, int, int]:
        """(low, bits, first, last): the nth largest root, positive and not above `largest`,
        is in (low, low + 1] / 2**bits, as are those numbered first to last."""
        low, high, bits = 0, largest, 0
        while True:
            while high - low > 1:
                middle = (low + high) // 2
                if self.above(middle, bits) >= nth:
                    low = middle
                else:
                    high = middle
            if low.bit_length() > ROOT_BITS:
                return low, bits, self.above(high, bits) + 1, self.above(low, bits)
            # Not close enough: the same interval on a finer scale.
            finer = max(1, ROOT_BITS + 1 - max(1, low.bit_length()))
            low, high, bits = low << finer, high << finer, bits + finer


def zero_roots(coefficients: list[int]) -> int:
    return next(i for i, c in enumerate(coefficients) if c)


# -- components -----------------------------------------------------------------------


def null_basis(matrix: np.ndarray, numerator: int, bits: int, vectors: int) -> np.ndarray:
    """Unit vectors, orthogonal, that the matrix nearly multiplies by numerator / 2**bits.

    Inverse iteration in fixed point, from starts that depend on nothing but the dimension.
    """
    size = len(matrix)
    root_bits = max(1, (numerator >> bits).bit_length())
    unit = 4 * ROOT_BITS + 2 * max(1, size.bit_length()) + max(bits, 0)
    trace_bits = max(int(matrix[i, i]).bit_length() for i in range(size))
    unit += max(0, trace_bits - root_bits)
    one = 1 << unit
    # Relative to the root, so that numbers are near one.
    scaled = matrix * (one << bits) // numerator
    shifted = scaled.copy()
    for i in range(size):
        shifted[i, i] -= one
    lower, order = _factors(shifted, unit)
    state = np.random.RandomState(size)
    basis = np.array(
        [[int(v) << (unit - 30) for v in state.randint(-(1 << 29), 1 << 29, size)]
         for _ in range(vectors)], object,
    )
    basis = _orthonormal(basis, unit)
    for _ in range(60):
        before = basis
        basis = _orthonormal(np.array([_solved(lower, order, v, unit) for v in basis]), unit)
        # Converged when the spanned space, not its basis, stays.
        inside = before @ basis.T >> unit
        lost = max(abs(one - int((row * row).sum() >> unit)) for row in inside)
        if lost >> (unit - 2 * ROOT_BITS) == 0:
            break
    rotated = _rotated(scaled, basis, unit) if vectors > 1 else basis
    return np.array([[_as_double(v, unit) for v in row] for row in rotated])


def _as_double(value: int, unit: int) -> float:
    return value / (1 << unit)


def _rotated(scaled: np.ndarray, basis: np.ndarray, unit: int) -> np.ndarray:
    """The basis turned so that it diagonalises what the matrix does to its space.

    Roots of one interval may still differ; the larger ones come first, as far as doubles of
    their differences from one can tell.
    """
    inner = basis @ ((scaled @ basis.T) >> unit) >> unit
    one = 1 << unit
    gaps = np.array([[int(v) - one * (i == j) for j, v in enumerate(row)] for i, row in enumerate(inner)], object)
    largest = max((abs(int(v)) for row in gaps for v in row), default=0)
    if largest >> max(0, unit - 3 * ROOT_BITS) == 0:
        return basis  # equal as far as can be told
    down = np.array([[int(v) / largest for v in row] for row in gaps])
    values, turn = np.linalg.eigh((down + down.T) / 2)
    turn = turn[:, np.argsort(-values)]
    whole = np.array([[int(v * 2**52) for v in row] for row in turn.T], object)
    return _orthonormal(whole @ basis >> 52, unit)


def _orthonormal(rows: np.ndarray, unit: int) -> np.ndarray:
    """Gram-Schmidt in fixed point, twice."""
    done: list[np.ndarray] = []
    for row in rows:
        # A solution may be huge; its length doesn't matter.
        excess = max(int(abs(v)).bit_length() for v in row) - unit
        row = row >> excess if excess > 0 else row << -excess
        for _ in range(2):
            for other in done:
                row = row - ((int((row * other).sum()) >> unit) * other >> unit)
            length = isqrt(int((row * row).sum()))
            row = (row << unit) // max(1, length)
        done.append(row)
    return np.array(done)


def _factors(matrix: np.ndarray, unit: int) -> tuple[np.ndarray, list[int]]:
    """Triangular factors in one matrix, rows exchanged for the largest pivot."""
    a, order = matrix.copy(), list(range(len(matrix)))
    for k in range(len(a)):
        pivot = k + max(range(len(a) - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if not a[k, k]:
            a[k, k] = 1  # the root is exact here: the smallest number instead of zero
        if k + 1 < len(a):
            a[k + 1 :, k] = (a[k + 1 :, k] << unit) // a[k, k]
            a[k + 1 :, k + 1 :] -= a[k + 1 :, k][:, None] * a[k, k + 1 :][None] >> unit
    return a, order


def _solved(a: np.ndarray, order: list[int], right: np.ndarray, unit: int) -> np.ndarray:
    x = right[order].copy()
    size = len(x)
    for k in range(1, size):
        x[k] -= int((a[k, :k] * x[:k]).sum()) >> unit
    for k in range(size - 1, -1, -1):
        rest = int((a[k, k + 1 :] * x[k + 1 :]).sum()) >> unit if k + 1 < size else 0
        x[k] = ((x[k] - rest) << unit) // a[k, k]
    return x


# -- on tables ------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """What whitens: the fit's count and sums, unit components as rows, their variances."""

    n: int
    sums: list[int]  # of the integers without the offset
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def weights(self) -> np.ndarray:
        return (self.components / np.sqrt(self.variances)[:, None]).T

    def whitened(self, y: np.ndarray) -> np.ndarray:
        centred = (y.astype(object) * self.n - np.array(self.sums, object)) / self.n
        return centred.astype(np.float64) @ self.weights()

    def deviation(self, y: np.ndarray) -> list[int | None]:
        moved = np.array(self.sums, object)
        size = max(abs(int(y.min(initial=0))), abs(int(y.max(initial=0))))
        reach = self.n * size + max(map(abs, self.sums), default=0)
        if reach * reach * max(1, len(self.sums)) < 2**63:
            apart = y * self.n - moved.astype(np.int64)
            return (apart * apart).sum(axis=1).tolist()
        apart = y.astype(object) * self.n - moved
        found = (apart * apart).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in found]


def _components(
    spark: SparkSession, matrix: np.ndarray, coefficients: list[int], wanted: int
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Unit vectors as rows, and each root as (numerator, bits); one row a component."""
    trace = sum(int(matrix[i, i]) for i in range(len(matrix)))
    wanted = min(wanted, len(matrix) - zero_roots(coefficients))
    if not wanted:
        return np.zeros((0, len(matrix))), []
    shared = spark.sparkContext.broadcast((_as_text(matrix), [str(c) for c in coefficients]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, roots = _from_text(shared.value[0]), Roots([int(c) for c in shared.value[1]])
        for batch in batches:
            rows = []
            for nth in batch["component"].to_pylist():
                low, bits, first, last = roots.enclose(nth, trace)
                middle, bits = 2 * low + 1, bits + 1
                basis = null_basis(own, middle, bits, last - first + 1)
                rows.append((str(middle), bits, basis[nth - first].tolist()))
            root, bits, vector = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["component"], pa.array(root, pa.string()), pa.array(bits, pa.int32()),
                 pa.array(vector, pa.list_(pa.float64()))],
                names=["component", "root", "bits", "vector"],
            )

    table = _spread(spark, [(i + 1,) for i in range(wanted)], "component int")
    found = table.mapInArrow(run, "component int, root string, bits int, vector array<double>")
    rows = sorted(found.collect())  # a row a component
    return np.array([r["vector"] for r in rows]), [(int(r["root"]), r["bits"]) for r in rows]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of different vectors `x` (arrays of longs of one length); None without any."""
    sums = {(r["i"], r["j"]): int(r["value"]) for r in _sums(vectors).collect()}  # a row an entry
    if not sums:
        return None
    n, size = sums[-1, -1], max(j for _, j in sums) + 1
    first = [sums[-1, j] for j in range(size)]
    matrix = np.empty((size, size), object)
    for i in range(size):
        for j in range(i, size):
            matrix[i, j] = matrix[j, i] = n * sums[i, j] - first[i] * first[j]
    trace = sum(matrix[i, i] for i in range(size))
    spark = vectors.sparkSession
    if trace:
        polynomial = characteristic_polynomial(spark, matrix)
        found, roots = _components(spark, matrix, polynomial, components)
    else:
        found, roots = np.zeros((0, size)), []
    explained = np.array([root / (trace << bits) for root, bits in roots])
    variances = np.array([root / ((n * n) << bits) for root, bits in roots])
    return Model(n, first, found, variances, explained)


def identity_error(vectors: DataFrame, model: Model) -> float:
    """The largest entry of the whitened fit's covariance minus the identity, measured."""
    wanted = len(model.variances)
    if not wanted:
        return 0.0
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # With a column of ones: the sums of the whitened, which is centred up to rounding.
        total = np.zeros((wanted + 1, wanted + 1))
        for batch in batches:
            if batch.num_rows:
                w = shared.value.whitened(_matrix(batch))
                w = np.concatenate([np.ones((len(w), 1)), w], axis=1)
                total += w.T @ w
        i, j = np.triu_indices(wanted + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
            names=["i", "j", "value"],
        )

    partial = vectors.select("x").mapInArrow(run, "i int, j int, value double")
    found = partial.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((wanted + 1, wanted + 1))
    for r in found:
        total[r["i"], r["j"]] = r["value"] / model.n
    means = total[0, 1:]
    i, j = np.triu_indices(wanted)
    covariance = total[1:, 1:][i, j] - means[i] * means[j]
    return float(np.abs(covariance - (i == j)).max())


def dimension(vectors: DataFrame) -> int | None:
    """The commonest length of `x`."""
    sizes = vectors.groupBy(F.size("x").alias("d")).count()
    best = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return best["d"] if best else None


def whiten(
    df: DataFrame,
    components: int = COMPONENTS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error."""
    rows = _vectors(df, vec_id, embedding)
    spark = df.sparkSession
    kind = rows.schema["vec_id"].dataType.simpleString()
    size = dimension(rows)
    rows = rows.filter(F.size("x") == F.lit(size or 0))
    different = keep(rows.select("x").distinct(), "fit") if size else None
    model = fit(different, components) if size else None
    model = model or Model(0, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    error = identity_error(different, model) if size else 0.0
    wanted = len(model.variances)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not wanted:
                continue
            y = _matrix(batch)
            flat = pa.array(shared.value.whitened(y).reshape(-1))
            ends = pa.array(np.arange(0, len(y) * wanted + 1, wanted), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(shared.value.deviation(y), pa.int64()),
                 pa.ListArray.from_arrays(ends, flat)],
                names=["vec_id", "deviation", "values"],
            )

    found = rows.mapInArrow(run, f"vec_id {kind}, deviation long, values array<double>")
    shares = F.array(*(F.lit(float(v)) for v in model.explained)).cast("array<double>")
    return found.select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
