"""Lenient string parsers for untyped CSV fields.

Every parser is a pure Column expression (codegen'd, no Python UDF) and
never raises under ANSI mode: malformed input becomes NULL, which the
quality rules then count or quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings read as true by the raw-file loader (after trim and
# lower-casing); any other non-empty value is false.
TRUE_SPELLINGS = ("true", "1", "yes", "t")

# A plain decimal number with optional sign, fraction and exponent -- the
# forms a float parser and Spark's double cast both accept.  It keeps out
# Spark-only forms ("1.5d", "1f") and the inf/nan spellings.  (The Spark
# code checks it without a regex, see ``is_number``; the oracle SQL uses
# the pattern itself.)
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"

# Fixed value: the ISO shape a timestamp text must have -- a full date, then
# optionally a time of day and an offset.  Spark's cast also takes years,
# months and region zones, which the raw-file loader does not.
TIMESTAMP_PATTERN = (r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([+-]\d{2}:\d{2})?)?$")

# Decimal digits of the two scripts the exports use beside ASCII.
PERSIAN_DIGITS = "\u06f0\u06f1\u06f2\u06f3\u06f4\u06f5\u06f6\u06f7\u06f8\u06f9"
ARABIC_DIGITS = "\u0660\u0661\u0662\u0663\u0664\u0665\u0666\u0667\u0668\u0669"

# The ASCII whitespace stripped around values, and the only
# characters a plain number may contain.
WHITESPACE = " \t\n\r\f\x0b"
NUMBER_CHARS = "0123456789+-.eE" + WHITESPACE
INTEGER_CHARS = "0123456789+-" + WHITESPACE


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def empty_to_null(col: Column | str) -> Column:
    """P8: '' becomes NULL; other text is kept as is."""
    return F.nullif(_c(col), F.lit(""))


def strip_text(col: Column | str) -> Column:
    """Remove leading and trailing ASCII whitespace (tabs and newlines too)."""
    return F.trim(_c(col), F.lit(WHITESPACE))


def parse_bool(col: Column | str) -> Column:
    """NULL/'' -> NULL; a true spelling -> true; anything else -> false."""
    c = _c(col)
    return (F.when(c.isNull() | (c == ""), F.lit(None).cast("boolean"))
             .otherwise(F.lower(strip_text(c)).isin(*TRUE_SPELLINGS)))


def ascii_digits(col: Column | str) -> Column:
    """Persian and Arabic digits as ASCII ones; other scripts' digits stay and make the text junk.

    Text whose characters are one byte each has none of them and is not looked through.
    """
    c = _c(col)
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(
        F.translate(c, PERSIAN_DIGITS + ARABIC_DIGITS, "0123456789" * 2))


def is_number(col: Column | str) -> Column:
    """True for a well-formed plain number (NUMBER_PATTERN), without a regex.

    Only sign, digit, point, exponent and whitespace characters may occur,
    and the whole text must parse as a double.  With those characters the
    double parser accepts exactly the pattern's language; the check runs on
    Spark's own string type instead of a per-row Java regex match.
    """
    return _plain_double(ascii_digits(col)).isNotNull()


def _plain_double(c: Column) -> Column:
    """The value of a plain number in ASCII digits; NULL for other text, which is not tried."""
    return F.when(_only(c, NUMBER_CHARS), c.try_cast("double"))


def _only(c: Column, chars: str) -> Column:
    """Non-empty text made only of ``chars``.

    Used as a guard before a cast: a failing try_cast costs an exception
    inside the JVM, so malformed text should not reach it.
    """
    return (F.length(c) > 0) & (F.translate(c, chars, "") == "")


def _number_to_long(c: Column) -> Column:
    # Spark's string->bigint cast is strict (optional sign and digits, outer
    # whitespace trimmed), so integral text is parsed exactly -- ids above
    # 2**53 keep every digit.  Other numbers go through double like a float
    # parser; try_cast truncates toward zero and gives NULL out of range.
    c = ascii_digits(c)
    exact = F.when(_only(c, INTEGER_CHARS), c.try_cast("bigint"))
    return F.coalesce(exact, _plain_double(c).try_cast("bigint"))


def parse_bigint(col: Column | str) -> Column:
    """P5: integer text, or a decimal number truncated toward zero; junk -> NULL."""
    return _number_to_long(_c(col))


def parse_int(col: Column | str) -> Column:
    """As ``parse_bigint``, NULL when outside the 32-bit range."""
    return _number_to_long(_c(col)).try_cast("int")


def parse_decimal(col: Column | str, precision: int = 4, scale: int = 2) -> Column:
    """Number text rounded half-up to ``scale``; junk or overflow -> NULL."""
    return _plain_double(ascii_digits(col)).try_cast(f"decimal({precision},{scale})")


def parse_ts(col: Column | str) -> Column:
    """ISO timestamp text with every 'Z' removed; offsets dropped (wall clock kept).

    Only a full date, with or without a time, counts (``TIMESTAMP_PATTERN``):
    compact or partial dates, region zones and junk give NULL.
    """
    c = F.replace(_c(col), F.lit("Z"), F.lit(""))
    return F.when(c.rlike(TIMESTAMP_PATTERN), c.try_cast("timestamp_ntz"))

