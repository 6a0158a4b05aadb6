"""Snapshots compared by digests first.

A diff of two snapshots joins every row of both, though most are equal.  Here each
snapshot is reduced to one digest a *range* of keys: the number of its rows, the
exclusive or of their 64-bit hashes and the sum of their 32-bit ones.  The three do
not depend on the order of rows, so they are aggregated where the rows lie and no
row is shuffled.  Digests go up a tree, ``FANOUT`` ranges to one of the level
above; from the root down only the children of nodes that differ are compared.
The rows of ranges that differ, and no others, go to the join.

Ranges with equal digests are taken for equal: 96 bits of two different ranges
agree by chance once in some 1e28.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges under one node of the next level, as a power of two.
FANOUT_BITS = 8


def digests(rows: DataFrame, key_range: Column, columns: Sequence[str]) -> DataFrame:
    """(range, n, x, s): the digest of each key range; ``key_range`` is a whole number, NULL is a range too."""
    cols = [F.col(c) for c in columns]
    # a null and a value must not hash alike, and neither may two columns in turn
    shape = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cols])
    return rows.select(key_range.cast("long").alias("range"), F.xxhash64(shape, *cols).alias("_h"),
                       F.hash(shape, *cols).cast("long").alias("_s")).groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("_h").alias("x"), F.sum("_s").alias("s"))


def level_above(nodes: DataFrame, bits: int = FANOUT_BITS) -> DataFrame:
    """The digests of the next level of the tree."""
    return nodes.groupBy(F.shiftright("range", bits).alias("range")).agg(
        F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"))


def _unequal(old: DataFrame, new: DataFrame) -> DataFrame:
    """(range): nodes of one level that differ, or that only one side has."""
    o, n = old.alias("o"), new.alias("n")
    same = F.col("o.range").eqNullSafe(F.col("n.range"))
    for c in ("n", "x", "s"):
        same = same & (F.col(f"o.{c}") == F.col(f"n.{c}"))
    sides = [a.join(b, same, "left_anti").select("range") for a, b in ((o, n), (n, o))]
    return sides[0].unionAll(sides[1]).distinct()


def differing_ranges(old: DataFrame, new: DataFrame, levels: int = 2, bits: int = FANOUT_BITS) -> DataFrame:
    """(range): leaves that differ, found from the root down over ``levels`` levels above the leaves."""
    trees = []
    for leaves in (old, new):
        tree = [leaves]
        for _ in range(levels):
            tree.append(level_above(tree[-1], bits))
        trees.append(tree)
    found = None
    for o, n in reversed(list(zip(*trees))):
        if found is not None:
            below = F.shiftright("range", bits)
            o, n = (side.withColumn("_up", below).join(
                found.select(F.col("range").alias("_up2")), F.col("_up").eqNullSafe(F.col("_up2")), "left_semi").drop("_up")
                for side in (o, n))
        found = _unequal(o, n)
    return found


def rows_that_may_differ(old: DataFrame, new: DataFrame, key_range: Column, columns: Sequence[str] | None = None,
                         levels: int = 2) -> tuple[DataFrame, DataFrame]:
    """The rows of both snapshots in ranges whose digests differ; a diff of these is a diff of the whole."""
    columns = columns or new.columns
    found = differing_ranges(digests(old, key_range, columns), digests(new, key_range, columns), levels)
    found = found.select(F.col("range").alias("_differs"))

    def some(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("_range", key_range.cast("long"))
                .join(found, F.col("_range").eqNullSafe(F.col("_differs")), "left_semi").drop("_range"))
    return some(old), some(new)
