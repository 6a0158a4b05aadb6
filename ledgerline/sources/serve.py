"""Reads of the serve layer: month-pruned fact scans and current views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FACT_REVIEWS


def read_fact(spark: SparkSession, path: str, since: dt.date | str | None = None,
              until: dt.date | str | None = None, schema: T.StructType = FACT_REVIEWS) -> DataFrame:
    """Fact rows, optionally limited to ``since <= created_at < until + 1 day``.

    Spark does not derive a partition filter from a predicate on
    ``created_at``, so the matching ``created_month`` values are added as an
    explicit predicate; the scan then lists only those folders
    (``PartitionFilters`` in the plan).  The schema is always given, so the
    partition column reads back as text, not as an inferred integer (T22).
    """
    df = spark.read.schema(schema).parquet(path)
    if since is None and until is None:
        return df
    s = dt.date.fromisoformat(str(since)) if since is not None else dt.date(1900, 1, 1)
    u = dt.date.fromisoformat(str(until)) if until is not None else dt.date(9999, 12, 31)
    cond = F.col("created_month").between(f"{s.year:04d}{s.month:02d}", f"{u.year:04d}{u.month:02d}")
    if since is not None:
        cond = cond & (F.col("created_at") >= F.lit(s.isoformat()).cast("timestamp_ntz"))
    if until is not None:
        cond = cond & (F.col("created_at") < F.lit((u + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz"))
    return df.filter(cond)
