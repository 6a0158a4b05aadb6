"""Keyed loading into the clean layer.

The row store's insert path is "insert, and on a duplicate primary key do
nothing": within one load the first row in load order wins, and a row whose
key already exists in the table is ignored.  Here that is one
``row_number`` (first per key) and one anti join against the existing keys;
the result is appended, never merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import drop_matching, keep_matching
from .versions import first_per_key


def first_wins(rows: DataFrame, keys: Sequence[str], load_order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key in load order."""
    return first_per_key(rows, keys, load_order)


def rows_to_insert(rows: DataFrame, existing: DataFrame, keys: Sequence[str],
                   load_order: Sequence[str | Column], buckets: int | None = None) -> DataFrame:
    """K1 + J5: rows an insert-or-ignore load would add to ``existing``.

    Only the key columns of ``existing`` are read for the anti join.  ``buckets``
    tells in how many it lies bucketed by the key: the first row of each key goes
    to its bucket then, and the table is not shuffled.
    """
    first = first_wins(rows, keys, load_order)
    if buckets:
        return drop_known(first, existing, keys, buckets)
    return drop_matching(first, existing.select(*keys), list(keys))


def drop_known(rows: DataFrame, existing: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows whose key is not in a table that lies in ``buckets`` buckets of the key.

    Rows go to the table's buckets.  An outer join and a filter, as the optimizer
    would move an anti join below the rows' exchange and shuffle the table instead.
    """
    known = existing.select(*keys, F.lit(True).alias("_known"))
    return rows.repartition(buckets, *keys).join(known, list(keys), "left").where("_known IS NULL").select(*rows.columns)


def insert_or_ignore(rows: DataFrame, existing: DataFrame, keys: Sequence[str],
                     load_order: Sequence[str | Column]) -> DataFrame:
    """The table after an insert-or-ignore load: ``existing`` plus the new keys' first rows."""
    new = rows_to_insert(rows, existing, keys, load_order).select(*existing.columns)
    return existing.unionByName(new)


def orphan_keys(rows: DataFrame, referenced: DataFrame, key: str, ref_key: str | None = None) -> DataFrame:
    """The values of ``key`` in ``rows``, each once, that ``referenced`` lacks; nulls are left out.

    Only keys are shuffled, and of ``rows`` each task sends a key once.  Landed,
    they are few where references mostly hold, so that a join with them, of which
    the planner knows the size, need not shuffle whole rows.
    """
    ref = referenced.select(F.col(ref_key or key).alias(key))
    return drop_matching(rows.select(key).where(F.col(key).isNotNull()).distinct(), ref, key)


def split_by_orphans(rows: DataFrame, orphans: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """J1, as ``split_by_reference`` but given the ``orphan_keys`` of the rows: (rows that are referenced, orphan rows)."""
    known = drop_matching(rows.where(F.col(key).isNotNull()), orphans, key)
    return known, keep_matching(rows, orphans, key).unionByName(rows.where(F.col(key).isNull()))


def split_by_reference(rows: DataFrame, referenced: DataFrame, key: str,
                       ref_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` exists in ``referenced``, orphan rows).

    The reference side is reduced to its key column (duplicates do not change
    a semi or anti join, so no distinct/shuffle is added); Spark broadcasts it
    when small and otherwise runs a shuffle join, so the set of valid keys
    never has to fit on the driver.
    """
    ref = referenced.select(F.col(ref_key or key).alias(key))
    return keep_matching(rows, ref, key), drop_matching(rows, ref, key)
