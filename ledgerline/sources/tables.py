"""Scans of the driver-supplied Parquet tables.

Each read names the columns it needs so the Parquet scan's ``ReadSchema``
carries only those; filters applied later are pushed into the scan by
Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Scan one table, listing its files anew; splits follow ``spark.sql.files.maxPartitionBytes``."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df

