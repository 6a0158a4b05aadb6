"""Version resolution over append-only logs.

A serve-layer table is an append-only log of row images; the current view is
the newest image per key.  Both "latest wins" (merge-on-read) and "first
wins" (insert-or-ignore) are one ``row_number`` over the key.  Spark plans the
``rn == 1`` filter as a partial ``WindowGroupLimit`` below the shuffle, so each
map task sends at most one row per key -- a key holding a third of the log
collapses before the exchange instead of landing whole on one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _order_cols(order: Sequence[str | Column], descending: bool) -> list[Column]:
    cols = []
    for c in order:
        c = F.col(c) if isinstance(c, str) else c
        cols.append(c.desc_nulls_last() if descending else c.asc_nulls_first())
    return cols


def pick_one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                     newest: bool = True) -> DataFrame:
    """Keep one row per ``keys``: the greatest ``order`` when ``newest``, else the least.

    ``order`` must be a total order within a key (append a unique column as a
    tiebreak) or the pick is arbitrary.
    """
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order, newest))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   where: Column | None = None) -> DataFrame:
    """D3: newest version per key (``FINAL`` over a replacing table).

    ``where`` asks only for current rows matching a predicate (a point
    lookup such as "reviews of product 42").  The predicate cannot go below
    the version resolution -- an older version may match while the newest
    does not -- but the keys can: only keys with *some* matching version can
    have a matching newest version.  So the matching keys are found first
    (a filtered scan, pushed to Parquet), the log is semi-joined to them,
    and only those keys' versions are ranked; the log itself is never
    shuffled.  Exact for any row predicate.
    """
    if where is None:
        return pick_one_per_key(df, keys, order, newest=True)
    candidates = df.filter(where).select(*keys).distinct()
    return pick_one_per_key(df.join(candidates, list(keys), "left_semi"), keys, order,
                            newest=True).filter(where)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in load order wins (insert-or-ignore)."""
    return pick_one_per_key(df, keys, order, newest=False)


def compact(log: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
            target: str, partition_by: Sequence[str] = ()) -> None:
    """Rewrite a version log as its current view into a new snapshot folder.

    ``target`` must be a folder nobody is reading; publish it afterwards by
    pointing readers at it.  Old versions are gone from the snapshot (SCD 1).
    """
    current = latest_per_key(log, keys, order)
    if partition_by:
        # Cluster by the partition columns; AQE splits a hot partition value
        # over several tasks (rebalance), files stay sorted by key.
        current = (current.hint("rebalance", *partition_by)
                   .sortWithinPartitions(*partition_by, *keys))
        current.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    else:
        current.write.mode("overwrite").parquet(target)


def sum_collapse(df: DataFrame, keys: Sequence[str], sums: Sequence[str],
                 count_alias: str = "row_count") -> DataFrame:
    """Collapse rows sharing ``keys`` by summing the numeric ``sums``.

    This is what a summing table does at merge time, done explicitly.  A row
    count is carried so that averages over the collapsed table stay exact.
    Partial aggregation runs map-side, so a hot key is pre-summed per task.
    """
    aggs = [F.sum(F.col(c)).cast("bigint").alias(c) for c in sums]
    aggs.append(F.count(F.lit(1)).alias(count_alias))
    return df.groupBy(*keys).agg(*aggs)
