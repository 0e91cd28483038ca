"""Small building blocks for row-local array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    The optimizer may inline a projected column into the lambda that reads it,
    and would then re-evaluate it for every array element.  A bound value is a
    lambda variable, so however the plan is rewritten it is computed once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def indices(array: Column) -> Column:
    """0-based positions of a non-empty array."""
    return F.sequence(F.lit(0), F.size(array) - 1)


def running_totals(values: Column) -> Column:
    """Exclusive prefix sums of an array of ints of 1 or more, without leaving the row.

    Each index is repeated as often as its value says; the places where the
    index changes are the sums.  One pass, and as many steps as the values add
    up to.
    """

    def sums(flat: Column) -> Column:
        changes = lambda i: (i == 0) | (F.get(flat, i) != F.get(flat, i - 1))
        return F.filter(indices(flat), changes)

    repeated = F.flatten(F.transform(values, lambda x, k: F.array_repeat(k, x)))
    return F.when(F.size(values) > 0, bind(repeated, sums)).otherwise(values)
