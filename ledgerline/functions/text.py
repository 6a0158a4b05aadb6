"""Text predicates and word splitting (C7, C10, A4 building blocks)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(col: Column | str, keywords: Sequence[str]) -> Column:
    """Case-sensitive ``col LIKE '%kw%' OR ...``.

    ``contains`` compiles to Catalyst's ``Contains``, which Parquet receives
    as a pushed ``StringContains`` filter when applied to a scanned column.
    """
    if not keywords:
        raise ValueError("at least one keyword is required")
    c = F.col(col) if isinstance(col, str) else col
    return reduce(lambda a, b: a | b, [c.contains(k) for k in keywords])


def text_length(col: Column | str, unit: str = "char") -> Column:
    """Length in characters (``char``) or UTF-8 bytes (``byte``); see T8."""
    c = F.col(col) if isinstance(col, str) else col
    if unit == "char":
        return F.length(c)
    if unit == "byte":
        return F.octet_length(c)
    raise ValueError(f"unit must be 'char' or 'byte', not {unit!r}")


def split_words(col: Column | str, sep: str = " ") -> Column:
    """Array of pieces between single separators (empty pieces kept)."""
    c = F.col(col) if isinstance(col, str) else col
    # split() takes a regex; quote the separator so '.' or '|' stay literal.
    pattern = "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in sep)
    return F.split(c, pattern, -1)
