"""Join helpers: semi/anti membership, lookup join.

No side is marked for broadcast: Spark broadcasts a side under its byte
threshold, by statistics or at run time, and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def keep_matching(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key exists in ``keys`` (left semi join, J1)."""
    return df.join(keys, on, "left_semi")


def drop_matching(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``keys`` (left anti join, J4/J5)."""
    return df.join(keys, on, "left_anti")


def lookup(df: DataFrame, table: DataFrame, on: str, value: str,
           default: Column | int | str | None = None, alias: str | None = None) -> DataFrame:
    """Left lookup join bringing ``value`` from ``table`` onto ``df``.

    ``table`` is reduced to one (key, value) row per key first: only two
    columns shuffle, a duplicated key can never fan out the left side, and
    because the side is visibly unique on the key Catalyst drops the whole
    join from plans that never read ``value``.  The reduction is a map-side
    partial aggregate on the join key, so the join reuses its partitioning.
    A missing key -- or a NULL value on an existing key -- becomes ``default``.
    """
    out = alias or value
    side = table.groupBy(F.col(on)).agg(F.max(F.col(value)).alias(out))
    joined = df.join(side, on, "left")
    if default is not None:
        d = default if isinstance(default, Column) else F.lit(default)
        joined = joined.withColumn(out, F.coalesce(F.col(out), d))
    return joined
