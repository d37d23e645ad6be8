"""Array expressions that stay linear: bound values, indices, running totals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256  # running totals are appended within chunks of so many, and over the chunks


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def indices(items: Column) -> Column:
    """0 to size - 1; empty for an empty array."""
    return F.slice(F.sequence(F.lit(0), F.size(items)), F.lit(1), F.size(items))


def _appended(numbers: Column, first: Column) -> Column:
    """Totals before each number, from `first` on."""
    state = F.struct(first.alias("total"), F.expr("cast(array() as array<bigint>)").alias("seen"))

    def step(a: Column, x: Column) -> Column:
        seen = F.concat(a["seen"], F.array(a["total"]))
        return F.struct((a["total"] + x).alias("total"), seen.alias("seen"))

    return F.aggregate(numbers, state, step, lambda a: a["seen"])


def totals_before(numbers: Column) -> Column:
    """Exclusive running totals of an array of longs."""
    zero = F.lit(0).cast("bigint")

    def by_chunk(n: Column) -> Column:
        count = F.ceil(F.size(n) / CHUNK).cast("int")
        places = F.slice(F.sequence(F.lit(0), count), F.lit(1), count)
        return F.transform(places, lambda c: F.slice(n, c * CHUNK + 1, F.lit(CHUNK)))

    def joined(chunks: Column) -> Column:
        sums = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x))
        return let(
            _appended(sums, zero),
            lambda bases: F.flatten(
                F.transform(chunks, lambda c, i: _appended(c, F.get(bases, i)))
            ),
        )

    return let(numbers, lambda n: let(by_chunk(n), joined))
