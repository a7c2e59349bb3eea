"""Running values over arrays, without a copy of the result at every step.

A fold that appends to its result copies all that it holds each time, so its
cost is the square of the array's length.  These take about n log n steps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once (a one-element array's lambda)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """At each place, ``op`` over all values up to it (``op`` associative;
    values not null).  After the pass of stride d a place holds ``op`` over
    its last 2d values, so the logarithm of the length in passes is enough."""
    def passes(v: Column) -> Column:
        strides = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.size(v))).cast("int")),
                              lambda k: F.pow(F.lit(2), k).cast("int"))
        return F.aggregate(strides, v, lambda a, d: F.transform(
            a, lambda x, i: F.when(i >= d, op(F.get(a, i - d), x)).otherwise(x)))

    return let(values, lambda v: F.when(F.size(v) > 0, passes(v)).otherwise(v))


def running_sum(values: Column) -> Column:
    """Sums of all values up to each place, itself included."""
    return running(values, lambda a, b: a + b)


def running_max(values: Column) -> Column:
    """Greatest value up to each place, itself included."""
    return running(values, F.greatest)
