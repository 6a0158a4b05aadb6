"""Which change-log rows were applied, as intervals of audit ids.

The mirror records every applied row; asking it "was this id applied?" would mean
reading ever more of it.  The answer is kept beside it instead, as sorted
disjoint intervals: ids are handed out in order, so all that were applied make
one interval, broken only where an id is missing or came late.  A batch joins its
ids to the intervals before it and writes the result as its own snapshot, the
last of its writes; the guard of the next batch reads that snapshot alone.  Its
rows number the gaps, not the changes.

    <mirror>_ranges/run_id=<r>/batch_id=<b>/...     lo, hi (both applied)

A batch that runs again reads the snapshot before its own, so it does not see its
earlier attempt.  A late id lies in a gap and is applied once; one that was
applied lies in an interval, whatever the batch or the run that brought it.

Rows meet intervals by *blocks* of 2**10 ids: an interval either covers a block of
the batch -- found by a window over the blocks and the long intervals -- or begins
or ends in it.  Both are equi-joins, and a block has room for 512 intervals at
most, so a row is compared with a bounded number of them however long the log is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_dir
from ..sinks.parquet import read_log, write_batch

RANGES = T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])
_STORED = T.StructType([*RANGES.fields, T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())])
#: Ids of a block, as a power of two.
BLOCK_BITS = 10


def _block(c: str):
    return F.shiftright(c, BLOCK_BITS)


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """(lo, hi) intervals that may overlap or touch -> the sorted disjoint ones that cover the same ids.

    One window over all intervals, which are as many as there are gaps.
    """
    before = Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.coalesce(F.col("lo") > F.max("hi").over(before) + 1, F.lit(True))
    return (ranges.withColumn("_begins", begins.cast("int")).withColumn("_island", F.sum("_begins").over(so_far))
            .groupBy("_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("lo", "hi"))


def ranges_of(ids: DataFrame, col: str = "audit_id") -> DataFrame:
    """The ids of a column as disjoint intervals (nulls are left out, ids that repeat count once).

    Islands are found block by block, so a large batch is spread over tasks; only
    one row an island and block goes on to be merged.
    """
    one = ids.select(F.col(col).cast("long").alias("_id")).where("_id IS NOT NULL").distinct()
    one = one.withColumn("_block", _block("_id"))
    place = F.row_number().over(Window.partitionBy("_block").orderBy("_id"))
    islands = (one.withColumn("_island", F.col("_id") - place).groupBy("_block", "_island")
               .agg(F.min("_id").alias("lo"), F.max("_id").alias("hi")))
    return merge_ranges(islands.select("lo", "hi"))


def _covered_blocks(blocks: DataFrame, ranges: DataFrame) -> DataFrame:
    """The blocks of which one interval covers every id and more on both sides."""
    long = ranges.select(_block("lo").alias("_block"), _block("hi").alias("_last")).where("_last - _block >= 2")
    marks = blocks.select("_block", F.lit(None).cast("long").alias("_last")).unionAll(long)
    # intervals are disjoint: the last long one that begins before a block is the only one that can cover it
    before = Window.orderBy("_block").rangeBetween(Window.unboundedPreceding, -1)
    return (marks.withColumn("_reach", F.max("_last").over(before))
            .where("_last IS NULL AND _reach > _block").select("_block").distinct())


def drop_applied(rows: DataFrame, ranges: DataFrame, col: str = "audit_id") -> DataFrame:
    """The rows whose id lies in no interval of a disjoint set; rows without an id stay.

    Only rows and the intervals of their blocks meet, so a hot block -- all ids of
    a batch in one -- is a batch against the few intervals at its edges.
    """
    keyed = rows.withColumn("_block", _block(col))
    covered = _covered_blocks(keyed.where(F.col(col).isNotNull()).select("_block").distinct(), ranges)
    edges = ranges.select(F.explode(F.array_distinct(F.array(_block("lo"), _block("hi")))).alias("_edge"), "lo", "hi")
    left = keyed.join(covered, "_block", "left_anti")
    inside = (left["_block"] == edges["_edge"]) & left[col].between(edges["lo"], edges["hi"])
    return left.join(edges, inside, "left_anti").drop("_block")


def ranges_path(mirror_path: str) -> str:
    return f"{mirror_path.rstrip('/')}_ranges"


def read_applied(spark: SparkSession, mirror_path: str, run_id: str | None = None, batch_id: int | None = None) -> DataFrame:
    """The applied ids of all runs, without what the named batch and later ones of its run wrote.

    Of each run the newest snapshot is read; it holds all the earlier ones.
    """
    stored = read_log(spark, ranges_path(mirror_path), _STORED)
    if run_id is not None:
        stored = stored.where((F.col("run_id") != run_id) | (F.col("batch_id") < batch_id))
    newest = stored.groupBy("run_id").agg(F.max("batch_id").alias("batch_id"))
    return merge_ranges(stored.join(newest, ["run_id", "batch_id"], "left_semi").select("lo", "hi"))


def write_applied(spark: SparkSession, mirror_path: str, ids: DataFrame, run_id: str, batch_id: int,
                  col: str = "audit_id") -> None:
    """K6/K7: this batch's snapshot: what was applied before it, and its own ids.

    Snapshots two batches back are deleted: a batch that runs again needs the one
    before it.
    """
    before = read_applied(spark, mirror_path, run_id, batch_id)
    now = merge_ranges(before.unionAll(ranges_of(ids, col)))
    write_batch(now.coalesce(1).sortWithinPartitions("lo"), ranges_path(mirror_path), run_id, batch_id)
    if batch_id >= 2:
        delete_dir(spark, f"{ranges_path(mirror_path)}/run_id={run_id}/batch_id={batch_id - 2}")
