"""Structured Streaming change application.

The change log arrives as Parquet files in a folder (one file per export of
the source's audit table).  A file-source stream picks them up; every
micro-batch is applied by ``foreachBatch`` with the same functions the batch
path uses, and replaces its own folder ``run_id=<run>/batch_id=<id>``.  The
stream's checkpoint is the loader cursor: a restarted query resumes after the
last committed batch and re-runs an uncommitted one with the same ids and the
same files.  A new checkpoint is a new run: it sees all files again, and the
intervals of applied ids keep it from applying them twice.  So nothing is lost or doubled.
Versions are keyed by ``audit_id``, so files arriving out of order do not
change the result.  Rows that cannot be read go to the reject table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cdc
from ..schemas import AUDIT_LOG
from ..session import clean_staged
from ..sinks.parquet import list_batches, stage, write_batch
from .applied import drop_applied, read_applied, write_applied
from .replay import run_id_of, unseen

ApplyBatch = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class StreamPaths:
    source: str        # folder the change-log files arrive in
    versions: str      # append-only version log (partitioned by run_id, batch_id)
    mirror: str        # applied log rows (partitioned by run_id, batch_id)
    checkpoint: str    # stream checkpoint: offsets + commits = the cursor

    @property
    def rejects(self) -> str:
        return f"{self.mirror.rstrip('/')}_rejects"


def make_batch_handler(payload: T.StructType, paths: StreamPaths, run_id: str, keep_deletes: bool = False,
                       refresh: Callable[[SparkSession, int], None] | None = None,
                       refresh_every: int = 5) -> ApplyBatch:
    """The ``foreachBatch`` function: versions, rejects, then mirror for one micro-batch.

    The batch is written three times, so it is persisted for the duration of
    the call instead of being re-read from the source.  ``refresh`` (e.g. a
    mart rebuild) runs on every ``refresh_every``-th batch (I5).
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = cdc.judge(unseen(batch, paths.mirror, run_id, batch_id), routed=False).persist()
        try:
            good = rows.where("reject_reason is null").drop("reject_reason")
            write_batch(cdc.state_versions(good, payload, keep_deletes), paths.versions, run_id, batch_id)
            write_batch(cdc.rejects(rows), paths.rejects, run_id, batch_id)
            mirrored = rows.where("audit_id is not null")
            write_batch(cdc.mirror_rows(mirrored).drop("batch_id"), paths.mirror, run_id, batch_id)
            # the applied ids last: a batch counts as applied when everything else is written
            write_applied(batch.sparkSession, paths.mirror, mirrored, run_id, batch_id)
        finally:
            rows.unpersist()
        if refresh is not None and batch_id % refresh_every == 0:
            refresh(batch.sparkSession, batch_id)
    return handle


def start(spark: SparkSession, source: str, checkpoint: str, handle: ApplyBatch,
          max_files_per_trigger: int | None = None, available_now: bool = True,
          processing_time: str = "60 seconds"):
    """Start a change stream; with ``available_now`` it has finished when this returns.

    Without ``max_files_per_trigger`` a batch takes all files that are there.
    """
    reader = spark.readStream.schema(AUDIT_LOG)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.parquet(source).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def run_change_stream(spark: SparkSession, paths: StreamPaths, payload: T.StructType,
                      keep_deletes: bool = False, max_files_per_trigger: int | None = None,
                      available_now: bool = True, processing_time: str = "60 seconds",
                      refresh: Callable[[SparkSession, int], None] | None = None):
    """Start the change stream.

    ``available_now`` drains everything present and stops (the one-shot
    mode, I3); otherwise it polls on ``processing_time`` (I2).  Returns the
    ``StreamingQuery``; with ``available_now`` it has already finished.
    """
    handle = make_batch_handler(payload, paths, run_id_of(spark, paths.checkpoint), keep_deletes, refresh)
    return start(spark, paths.source, paths.checkpoint, handle, max_files_per_trigger, available_now, processing_time)


def drain(spark: SparkSession, log: DataFrame, mirror_path: str, run_id: str, apply: ApplyBatch,
          batch_size: int | None = None) -> int:
    """S5/L8 in batch form: apply all log rows that were not applied, oldest first, at most ``batch_size`` at a time.

    The log is read, held against the applied ids and sorted once; a batch is
    a range of audit ids of what is left.  Returns the number of batches.  Rows
    without an audit id can never be marked as applied, so they are left to the
    caller's check of the log.
    """
    last = max((b for r, b in list_batches(spark, mirror_path) if r == run_id), default=-1)
    keyed = log.where("audit_id is not null")
    todo = drop_applied(keyed, read_applied(spark, mirror_path)).repartitionByRange("audit_id")
    todo = stage(todo.sortWithinPartitions("audit_id").withColumn("_place", F.monotonically_increasing_id()), "drain")
    starts = _batch_starts(todo, batch_size)
    for k, (lo, hi) in enumerate(zip(starts, [*starts[1:], None])):
        rows = todo.where(F.col("audit_id") >= lo)
        if hi is not None:
            rows = rows.where(F.col("audit_id") < hi)
        apply(rows.drop("_place"), last + 1 + k)
    clean_staged(spark, "drain")
    return len(starts)


def _batch_starts(placed: DataFrame, batch_size: int | None) -> list[int]:
    """The first audit id of each batch of sorted rows: one number a batch, all that the driver gets.

    ``_place`` numbers the rows of each sorted partition; with the rows of the
    partitions before it, it is a row's number in the whole.  Rows of one id go
    to one batch.
    """
    if not batch_size:
        low = placed.agg(F.min("audit_id")).first()[0]
        return [] if low is None else [low]
    placed = placed.select("audit_id", F.shiftright("_place", 33).alias("part"), "_place")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    number = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("offset")
    found = placed.join(parts, "part").where(number % batch_size == 0).select("audit_id").distinct().collect()
    return sorted(r["audit_id"] for r in found)
