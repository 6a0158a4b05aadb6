"""What every change stream shares: run ids, the mirror and the replay guard.

A log row is applied once however often it arrives: beside the mirror stand the
intervals of applied audit ids, and a batch first drops the rows that another
batch -- of this stream run or of one with another checkpoint -- has applied.
A batch that runs again after a crash does not see its own earlier attempt.
One stream run at a time applies changes to a mirror.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.versions import pick_one_per_key
from ..schemas import AUDIT_MIRROR
from ..sinks.parquet import read_log
from .applied import drop_applied, read_applied


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream run a checkpoint belongs to, made and kept in it at the first start."""
    path = f"{checkpoint.rstrip('/')}/run_id"
    try:
        return spark.read.text(path).first()["value"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([(f"run-{uuid.uuid4().hex[:12]}",)], "value string").coalesce(1).write.text(path)
    return spark.read.text(path).first()["value"]


def read_mirror(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, AUDIT_MIRROR)


def unseen(batch: DataFrame, mirror_path: str, run_id: str, batch_id: int) -> DataFrame:
    """The rows of a batch that no other batch has applied, each audit id once.

    What was applied is known as intervals of ids (``applied``); the mirror
    itself is not read.  Of rows that share an id but differ the first in the
    order of their other columns counts, so another attempt takes the same one.
    Rows without an audit id cannot be told apart; all of them stay (and are
    rejected).
    """
    others = [c for c in batch.columns if c != "audit_id"]
    keyed = batch.where("audit_id is not null")
    applied = read_applied(batch.sparkSession, mirror_path, run_id, batch_id)
    # whole rows are shuffled only where some repeat or were applied; otherwise the ids alone are
    if not keyed.groupBy("audit_id").count().where("count > 1").isEmpty():
        keyed = pick_one_per_key(keyed, ["audit_id"], others, newest=False)
    else:
        ids = keyed.select("audit_id")
        if applied.isEmpty() or drop_applied(ids, applied).count() == ids.count():
            return batch
    fresh = drop_applied(keyed, applied)
    return fresh.select(*batch.columns).unionByName(batch.where("audit_id is null"))
