"""Raw marketplace CSV exports.

Every field is read as text (nothing is inferred) and is taken by the name in
the file's own header: files of one load may order their columns differently,
have more columns (ignored) or lack some (NULL).  A file without the key
column is an error, as its rows could not be told apart; one without lines has
no rows.

Quoted fields may hold newlines, doubled quotes and backslashes.  The records of
a file are found in parallel (``records``), so that one large file makes as many
tasks as it has byte ranges.  Each row keeps its load position (file, record
within the file, from 1 on) so "first row wins" is well defined (D2).

A record with more or fewer fields than its header is not padded or cut in
silence: ``_broken_record`` holds its text, NULL for all others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PRODUCT_CSV_COLUMNS, REVIEW_CSV_COLUMNS
from .records import Export, records, survey

LOAD_FILE = "_load_file"
LOAD_ROW = "_load_row"
LOAD_ORDER = (LOAD_FILE, LOAD_ROW)
BROKEN = "_broken_record"
KEY_COLUMN = "_id"
PARSING = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}


def _by_layout(export: Export, files: int, key: str) -> dict[tuple[str, ...], list[str]]:
    """Files of the load by their header."""
    out: dict[tuple[str, ...], list[str]] = {}
    for path, names, count in list(zip(export.paths, export.headers, export.counts))[:files]:
        if names is not None:
            out.setdefault(names, []).append(path)
        elif count:
            raise ValueError(f"the header of {path} does not end in its first byte range")
    for names, paths in out.items():
        if key not in names:
            raise ValueError(f"no column {key!r} in the header of {', '.join(paths[:3])}")
    return out


def read_raw_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str],
                 limit: int | None = None, key: str = KEY_COLUMN) -> DataFrame:
    """Read header CSV files as text columns ``columns`` plus the load position.

    ``limit`` (S3) keeps the first ``limit`` rows in load order; 0/None = all.
    Files after the last one that it reaches are not read again.
    """
    export = survey(spark, paths)
    files, last = len(export.paths), None
    if limit:
        left = limit
        for k, n in enumerate(export.counts):
            if n >= left:
                files, last = k + 1, left
                break
            left -= n
    parts = []
    for names, some in sorted(_by_layout(export, files, key).items()):
        schema = ", ".join([*[f"f{i} string" for i in range(len(names))], f"{BROKEN} string"])
        rows = records(spark, export, some).where(F.col("row") > 0)
        if last is not None:
            rows = rows.where((F.col("file") < export.uris[files - 1]) | (F.col("row") <= last))
        # the one-row ``inline`` is a fence: each record is parsed once, not once a field
        parsed = rows.select("file", "row", F.inline(F.array(F.from_csv("record", schema, PARSING))))
        at = {n: i for i, n in reversed(list(enumerate(names)))}
        parts.append(parsed.select(
            *[(F.col(f"f{at[c]}") if c in at else F.lit(None).cast("string")).alias(c) for c in columns],
            F.col("file").alias(LOAD_FILE), F.col("row").alias(LOAD_ROW), BROKEN))
    if not parts:
        schema = ", ".join([*[f"`{c}` string" for c in columns], f"{LOAD_FILE} string", f"{LOAD_ROW} long", f"{BROKEN} string"])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def read_products_csv(spark: SparkSession, paths, limit: int | None = None) -> DataFrame:
    """The products export."""
    return read_raw_csv(spark, paths, [c for c, _, _ in PRODUCT_CSV_COLUMNS], limit)


def read_reviews_csv(spark: SparkSession, paths, limit: int | None = None) -> DataFrame:
    """The reviews export."""
    return read_raw_csv(spark, paths, [c for c, _, _ in REVIEW_CSV_COLUMNS], limit)
