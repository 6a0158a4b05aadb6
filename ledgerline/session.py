"""Spark session settings and the shared scratch folder.

The library never creates its own session inside an operator; callers pass
one in.  ``build_session`` is a convenience for scripts, tests and the bench.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this library relies on.  AQE re-plans joins at
# runtime (broadcast when a side turns out small, split skewed partitions,
# coalesce tiny shuffle partitions); UTC keeps wall clocks stable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# A whole-stage-codegen method over 8,000 bytes of bytecode is never JIT
# compiled by HotSpot and runs interpreted; with this limit Spark falls back
# to per-operator code for such a stage instead (the wide parse projections
# of the raw-file cleaning run ~3x faster).  ``build_session`` sets it; a session
# that someone else built has it only while ``small_methods`` runs.
CODEGEN_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf.update(CODEGEN_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# A job's shuffle files stay on the executors' disks until the driver's garbage
# collector comes upon its plan, long after the job.  With this setting Spark
# deletes them when the job ends; a stage that is needed again runs again.
CLEANUP_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The jobs run within have these settings; afterwards the session has its own again."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def small_methods(spark: SparkSession):
    """The jobs run within have ``CODEGEN_CONF``."""
    return _settings(spark, CODEGEN_CONF)


def freed_shuffles(spark: SparkSession):
    """What the jobs run within have shuffled is deleted when they end."""
    return _settings(spark, CLEANUP_CONF)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, stream checkpoints and staged tables.

    This is the folder named by ``spark.checkpoint.dir`` (storage that the
    driver and every executor reach).  Only a ``local`` master, where they
    are one process, may leave it unset: then a temporary folder is made and
    recorded in the session so every later call agrees.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^-]*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark).rstrip('/')}/ledgerline/{spark.conf.get('spark.app.id')}"


def new_scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A never-used folder under the shared scratch root; Spark makes it at the first write."""
    return f"{_own_scratch(spark)}/{purpose}-{uuid.uuid4().hex}"


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies in; no error if it is missing."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def clean_staged(spark: SparkSession, purpose: str) -> None:
    """Delete what this application staged for one purpose, once its outputs are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_own_scratch(spark)}/{purpose}-*")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(path) or []:
        fs.delete(found.getPath(), True)


def clean_scratch(spark: SparkSession) -> None:
    """Delete all that this application staged; call it when no result is read any more."""
    delete_dir(spark, _own_scratch(spark))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application: they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(top) for f in names if f.endswith(".py"))
    digest = hashlib.sha256()
    for f in files:
        with open(f, "rb") as source:
            digest.update(source.read())
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-ship-"), f"ledgerline-{digest.hexdigest()[:16]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in files:
            z.write(f, os.path.relpath(f, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
