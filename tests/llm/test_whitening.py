from fractions import Fraction

import numpy as np
import pytest

from predial.llm import whitening
from predial.llm.support import prepare

SCHEMA = "vec_id long, embedding array<float>, x int, component int, n long, vector string"


def frame(spark, vectors):
    rows = [(i, v, 1, 2, 3, "v") for i, v in vectors]
    return prepare(spark).createDataFrame(rows, SCHEMA).repartition(3)


def leverrier(matrix):
    """Coefficients, the constant first, by exact fractions."""
    size = len(matrix)
    a = [[Fraction(int(v)) for v in row] for row in matrix]
    m = [[Fraction(0)] * size for _ in range(size)]
    c = [Fraction(1)]
    for k in range(1, size + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(size)) + (c[-1] if i == j else 0)
              for j in range(size)] for i in range(size)]
        trace = sum(a[i][t] * m[t][i] for i in range(size) for t in range(size))
        c.append(-trace / k)
    return [int(v) for v in reversed(c)]


def scatter(y):
    y = np.array(y, object)
    return len(y) * (y.T @ y) - np.outer(y.sum(0), y.sum(0))


def random_scatter(size, rows, seed=0):
    return scatter(np.random.RandomState(seed).randint(-20, 21, (rows, size)))


@pytest.mark.parametrize("size,rows", [(1, 3), (2, 5), (7, 30), (9, 4)])
def test_polynomial_against_leverrier(spark, size, rows):
    matrix = random_scatter(size, rows)
    assert whitening.characteristic_polynomial(prepare(spark), matrix) == leverrier(matrix)


def test_polynomial_of_matrices_that_fall_apart(spark):
    blocks = np.zeros((6, 6), object)
    blocks[:2, :2], blocks[3:, 3:] = random_scatter(2, 9), random_scatter(3, 9)
    for matrix in (blocks, np.diag([3, 0, 3, 1]).astype(object), np.zeros((3, 3), object) + 4):
        assert whitening.characteristic_polynomial(prepare(spark), matrix) == leverrier(matrix)


def test_primes():
    found = whitening.primes_below(100, 20)
    assert found == [97, 89, 83, 79]
    large = whitening.primes_below(whitening.LARGEST_PRIME, 100)
    assert large[0] == 2**31 - 1 and all(all(p % q for q in range(2, 2000)) for p in large)


def test_roots_with_multiplicity():
    """(x - 2)^2 (x - 5) x: counts and enclosures."""
    c = [0, -20, 24, -9, 1]
    roots = whitening.Roots(c)
    assert [roots.above(t, 0) for t in (-1, 0, 1, 2, 4, 5)] == [4, 3, 3, 1, 1, 0]
    assert roots.above(2 * 8 - 1, 3) == 3
    assert whitening.zero_roots(c) == 1
    for nth, value, same in ((1, 5, (1, 1)), (2, 2, (2, 3)), (3, 2, (2, 3))):
        low, bits, first, last = roots.enclose(nth, 9)
        assert low < value << bits <= low + 1 and (first, last) == same


def check(spark, vectors, components=16):
    """Against numpy; rows with a null, a null entry or a non-finite one stay out."""
    good = [(i, v) for i, v in vectors
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([np.float32(v) for _, v in good]).astype(float)) + 1_000_000
    unique = np.unique(x, axis=0)
    n, s = len(unique), unique.sum(0)
    values, found = np.linalg.eigh(np.cov(unique.T, bias=True))
    values, found = values[::-1], found[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    white = (x - s / n) @ found[:, :k] / np.sqrt(values[:k])
    got = whitening.whiten(frame(spark, vectors)).collect()
    assert len(got) == len(good) * k and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    ours = {}
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        ours.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    deviation = ((n * x - s) ** 2).sum(1)
    sign = np.zeros(k)
    for (i, _), w, d in zip(good, white, deviation):
        mine = np.array([ours[i, int(d)][c + 1][0] for c in range(k)])
        sign = np.where((sign == 0) & (abs(w) > 1e-3), np.sign(w * mine), sign)
        assert np.abs(mine * np.where(sign == 0, 1, sign) - w).max() < 1e-8


def test_against_numpy(spark):
    state = np.random.RandomState(4)
    mix = state.randn(24, 24)
    vectors = [(i, (state.randn(24) @ mix * 0.1).tolist()) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(100)]  # copies count once in the fit
    vectors += [(500, None), (501, [None] * 24), (502, [float("nan")] * 24),
                (503, [float("inf")] + [0.0] * 23), (None, vectors[3][1])]
    check(spark, vectors)


def test_fewer_vectors_than_entries(spark):
    state = np.random.RandomState(2)
    check(spark, [(i, state.randn(10).tolist()) for i in range(5)])


def test_equal_roots(spark):
    """Any orthonormal basis of a root's space whitens."""
    vectors = []
    for axis in range(4):
        for sign in (1.0, -1.0):
            v = [0.0] * 5
            v[axis] = sign
            vectors.append((len(vectors), v))
    got = whitening.whiten(frame(spark, vectors)).collect()
    assert len(got) == 8 * 4 and got[0].identity_error < 1e-12
    for r in got:
        assert r.explained == pytest.approx(0.25)
    lengths = {}
    for r in got:
        lengths[r.vec_id] = lengths.get(r.vec_id, 0) + r.whitened**2
    assert list(lengths.values()) == pytest.approx([4.0] * 8)


def test_close_roots(spark):
    """Roots that differ in the tenth digit keep their own components."""
    matrix = np.diag([10**12 + 1, 10**12, 3]).astype(object)
    roots = whitening.Roots(leverrier(matrix))
    for nth, axis in ((1, 0), (2, 1), (3, 2)):
        low, bits, first, last = roots.enclose(nth, 10**13)
        vector = whitening.null_basis(matrix, 2 * low + 1, bits + 1, last - first + 1)[nth - first]
        assert abs(vector[axis]) == 1 and np.abs(np.delete(vector, axis)).max() < 1e-15


@pytest.mark.parametrize("vectors", [[], [(1, [0.5, 1.0])], [(1, [0.5]), (2, [0.5])], [(1, [])], [(1, None)]])
def test_nothing_to_whiten(spark, vectors):
    assert whitening.whiten(frame(spark, vectors)).count() == 0


def test_lengths_and_large_numbers(spark):
    """Another length and numbers beyond a long take no part; large ones are exact."""
    vectors = [(1, [2.0**40, 0.0]), (2, [-(2.0**40), 1.0]), (3, [0.0, 2.0]), (4, [1.0]), (5, [1e30, 0.0])]
    got = whitening.whiten(frame(spark, vectors)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and {r.component for r in got} == {1, 2}
    assert {r.vec_id: r.deviation for r in got} == {1: None, 2: None, 3: (3 * 128 - 192) ** 2}
    assert got[0].identity_error < 1e-4
