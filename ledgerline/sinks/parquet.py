"""Parquet sinks of the serve layer (K2-K5).

Writes are appends of new files or whole-partition replacements, never
in-place edits, so a failed or repeated task/job leaves no partial state:
Spark's file commit protocol discards attempts that did not commit, and a
batch re-run overwrites only its own folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import freed_shuffles, new_scratch_dir


def append(df: DataFrame, path: str, schema: T.StructType | None = None,
           partition_by: Sequence[str] = ()) -> None:
    """K2: column-ordered append (columns selected in the table's order)."""
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_batch(df: DataFrame, path: str, run_id: str, batch_id: int,
                partition_by: Sequence[str] = (), dealt: bool = False) -> None:
    """Idempotent write of one micro-batch of one stream run.

    Rows replace the folder ``run_id=<run>/batch_id=<id>`` (plus any further
    partition columns), so replaying a batch after a crash replaces its own
    files instead of adding duplicates (T10).  Batch ids restart with every
    new checkpoint; the run id keeps the batches of different checkpoints
    apart.  With ``partition_by``, rows are rebalanced by those columns first:
    few files a folder, a large folder split over several tasks (``dealt``: they are already).
    """
    if partition_by and not dealt:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with freed_shuffles(df.sparkSession):
        w.parquet(f"{path}/run_id={run_id}/batch_id={batch_id}")


def write_fact_by_month(df: DataFrame, path: str, mode: str = "append") -> None:
    """K3: fact rows partitioned by ``created_month`` (yyyyMM of created_at).

    Rows are clustered by month with a ``rebalance`` hint before the write:
    each task writes files for one month (few files per folder), and AQE
    splits a month holding a third of all reviews over several tasks by size
    instead of landing it on one -- without the extra sampling pass a range
    partitioning would cost.  Inside each file rows are sorted by the
    table's order key, which tightens row-group min/max statistics.
    """
    (df.hint("rebalance", "created_month")
       .sortWithinPartitions("created_month", "product_id", "created_at", "review_id")
       .write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("created_month")
       .parquet(path))


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that ``write_batch`` writes, empty before its first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def list_batches(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(run id, batch id) of the batches of a table whose write has ended; folder names only, no data is read."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/run_id=*/batch_id=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    folders = [f.getPath().getParent() for f in found]
    return sorted((f.getParent().getName().split("=", 1)[1], int(f.getName().split("=", 1)[1])) for f in folders)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Land ``df`` as Parquet in a fresh folder of the shared scratch root; return a read of it.

    Cuts the lineage (a lost executor later recomputes from these files, not
    from the raw input) and lets several outputs -- accepted rows, rejects,
    counters -- come from one pass over the input.  It also stops Catalyst
    from pushing a filter on a derived column back into the projection that
    derives it, which would compute every parse twice.
    """
    path = new_scratch_dir(df.sparkSession, purpose)
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

