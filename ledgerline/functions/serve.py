"""Serve-layer value rules.

The column store keeps no NULLs: missing values take a default.  These
expressions reproduce the publishing rules of the reference loader.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The serve layer's stand-in for a missing timestamp, and the
# text spellings its flag conversion treats as true (case-sensitive).
DEFAULT_TIMESTAMP = "2000-01-01 00:00:00"
FLAG_TRUE_TEXT = ("true", "t", "1")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def flag01(col: Column | str) -> Column:
    """P12 on a typed boolean: true -> 1, false/NULL -> 0 (tinyint)."""
    return F.coalesce(_c(col).cast("tinyint"), F.lit(0).cast("tinyint"))


def flag_text(col: Column | str) -> Column:
    """P12 on the text of an image value, as a boolean: exactly 'true', 't' or '1'; NULL stays NULL."""
    return _c(col).isin(*FLAG_TRUE_TEXT)


def flag01_text(col: Column | str) -> Column:
    """P12 on text: exactly 'true', 't' or '1' -> 1, anything else -> 0."""
    return flag01(flag_text(col))


def or_default(col: Column | str, default) -> Column:
    """``x or default``: NULL becomes the default (0 and '' already equal it)."""
    return F.coalesce(_c(col), F.lit(default))


def preparation_days(col: Column | str) -> Column:
    """P10: NULL *and 0* become 1 (a real 0 is lost, as in the reference -- T4)."""
    c = _c(col)
    return F.when(F.coalesce(c, F.lit(0)) == 0, F.lit(1)).otherwise(c)


def ts_or_default(col: Column | str) -> Column:
    """P13 on a typed timestamp: NULL -> 2000-01-01 00:00, truncated to seconds."""
    c = _c(col)
    # Rebuilt field by field so the cut never passes through a zoned
    # timestamp (date_trunc would, and shift wall-clock times in DST gaps).
    whole_seconds = F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c),
                                         F.hour(c), F.minute(c), F.second(c))
    return F.coalesce(whole_seconds, F.lit(DEFAULT_TIMESTAMP).cast("timestamp_ntz"))


def ts_text(col: Column | str) -> Column:
    """P13 on text: drop 'Z', cut everything from the first '+', parse; NULL/junk -> NULL."""
    return F.substring_index(F.replace(_c(col), F.lit("Z"), F.lit("")), "+", 1).try_cast("timestamp_ntz")


def ts_text_or_default(col: Column | str) -> Column:
    """``ts_text`` with the serve layer's stand-in for a missing time."""
    return F.coalesce(ts_text(col), F.lit(DEFAULT_TIMESTAMP).cast("timestamp_ntz"))


def has_attachment(col: Column | str) -> Column:
    """1 when the text after the first 'photos' has no '[]' within 20
    characters; otherwise 1 when it mentions 'http'; else 0 (T6)."""
    a = _c(col)
    # The text between the first and second 'photos' (or the end), first 20 chars.
    after = F.substring(F.try_element_at(F.split(a, "photos"), F.lit(2)), 1, 20)
    return (F.when(a.isNull() | (a == ""), F.lit(0))
             .when(a.contains("photos") & ~F.coalesce(after.contains("[]"), F.lit(False)), F.lit(1))
             .when(a.contains("http"), F.lit(1))
             .otherwise(F.lit(0))).cast("tinyint")


def created_hour(col: Column | str) -> Column:
    """Materialized hour of the creation time."""
    return F.hour(_c(col)).cast("tinyint")


def created_day(col: Column | str) -> Column:
    """Materialized day of the creation time."""
    return F.to_date(_c(col))


def created_month(col: Column | str) -> Column:
    """K3 partition value: yyyyMM of the creation time, as text."""
    return F.date_format(_c(col), "yyyyMM")
