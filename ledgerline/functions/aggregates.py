"""Aggregate expressions with engine-independent results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_avg(col: Column | str) -> Column:
    """Average of an integer or decimal column as a double, bit-for-bit stable.

    The sum of integers/decimals is exact whatever the partial-aggregation
    order, so one final division gives the same double on every engine and
    every partitioning.  (``avg`` of a decimal returns a decimal in Spark.)
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast("double") / F.count(c)


def stable_avg(col: Column | str, digits: int = 6) -> Column:
    """Average of a floating column rounded to ``digits``.

    Floating sums depend on the order partial aggregates are merged; rounding
    removes those last-bit differences.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.avg(c), digits)
