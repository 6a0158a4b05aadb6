"""Tables that lie bucketed by their key.

A load meets the table by its key: rows whose key is there already are ignored,
reviews need a product that is there.  Where the table's files are bucketed and
sorted by the key, only the new rows are shuffled -- to the table's own buckets --
and the table is read in place, however large it has grown.

The table is a plain Parquet folder with Spark's bucket file names; the number of
buckets is kept beside the files, in a hidden folder, as every later load has to
use the same one.  Each session names the folder in its own catalog.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import freed_shuffles

MARK = "_keyed_by"
#: Buckets of a new table; choose them for its final size, some 256 MB of a bucket.
BUCKETS = 64


class KeyedTable:
    """A Parquet folder bucketed and sorted by one column."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        kept = self._kept()
        if kept is None:
            self._keep(key, buckets)
            kept = (key, buckets)
        if kept[0] != key:
            raise ValueError(f"{path} is keyed by {kept[0]!r}, not by {key!r}")
        self.key, self.buckets = kept
        self.name = f"ledgerline_{hashlib.sha256(f'{self.path} {schema.json()}'.encode()).hexdigest()[:20]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        place = self.path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
                  f"SORTED BY (`{key}`) INTO {self.buckets} BUCKETS LOCATION '{place}'")

    def _kept(self) -> tuple[str, int] | None:
        try:
            r = self.spark.read.schema("key string, buckets int").json(f"{self.path}/{MARK}").first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return (r["key"], r["buckets"]) if r else None

    def _keep(self, key: str, buckets: int) -> None:
        rows = self.spark.createDataFrame([(key, buckets)], "key string, buckets int")
        rows.coalesce(1).write.mode("overwrite").json(f"{self.path}/{MARK}")

    def read(self) -> DataFrame:
        """The table as it is now; a join or aggregate by its key needs no exchange of it."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, rows: DataFrame, dealt: bool = False) -> None:
        """K2: add rows, one file a bucket and load; the rows must not be read from this table.

        ``dealt``: the rows come from a table, or went to a join, of the same buckets, so none is shuffled.
        """
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        if not dealt:
            rows = rows.repartition(self.buckets, self.key)
        with freed_shuffles(self.spark):
            rows.write.insertInto(self.name)

    def forget(self) -> None:
        """Drop the name from the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def is_keyed(spark: SparkSession, path: str) -> bool:
    """Whether a folder is such a table, or free to become one."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return not fs.exists(root) or fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{MARK}"))
