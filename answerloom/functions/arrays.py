"""Array expressions that keep per-row work inside the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``.

    Without it an expression named inside a lambda is computed again for every
    element the lambda sees.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def places(values: Column) -> Column:
    """The indices ``0 .. size - 1``; none for an empty array."""
    return F.when(F.size(values) > 0, F.sequence(F.lit(0), F.size(values) - 1)).otherwise(
        F.array().cast("array<int>")
    )


def run_lengths(values: Column) -> Column:
    """Distinct values with their counts, as ``array<struct<value, n>>``.

    Sorting the array and measuring runs replaces ``explode`` + ``groupBy``
    when the group is the row itself, so nothing is shuffled.
    """

    def runs(s: Column) -> Column:
        firsts = F.filter(places(s), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(
            firsts,
            lambda f: F.transform(
                f,
                lambda at, j: F.struct(
                    F.get(s, at).alias("value"),
                    (F.coalesce(F.get(f, j + 1), F.size(s)) - at).alias("n"),
                ),
            ),
        )

    return let(F.sort_array(values), runs)


_STEPS = [1 << k for k in range(31)]


def prefix_sum(values: Column) -> Column:
    """Inclusive running sum of an integer array.

    Each pass adds the element ``step`` places back, with the step doubling, so
    the cost is n log n and the result array is built once per pass.
    """
    steps = F.array(*[F.lit(s) for s in _STEPS])
    return let(
        values,
        lambda v: F.aggregate(
            F.filter(steps, lambda s: s < F.size(v)),
            v,
            lambda acc, s: F.transform(
                acc, lambda x, i: x + F.coalesce(F.get(acc, i - s), F.lit(0))
            ),
        ),
    )
