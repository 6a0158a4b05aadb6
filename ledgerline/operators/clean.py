"""Raw CSV rows -> typed clean rows (P1, P2) with the quality verdict.

``assess_products`` / ``assess_reviews`` make one pass: every typed column
plus ``reject_reason`` (NULL when the row is accepted).  Accepted rows,
quarantined rows and the per-reason counters are all filters or one
aggregate over that single frame, so a load never aborts on a bad row (T9)
and accepted + rejected always equals the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from ..schemas import PRODUCT_CSV_COLUMNS, REVIEW_CSV_COLUMNS, TEXT_LIMITS

REJECT = "reject_reason"
NUMBERS = ("bigint", "int", "int0", "decimal")
#: Text of a raw record with more or fewer fields than its header, where the source tells.
BROKEN = "_broken_record"


def _typed(s: Column, kind: str) -> Column:
    """Parse raw text ``s`` by column kind (no default applied)."""
    if kind in ("bigint", "smallint"):
        return P.parse_bigint(s)
    if kind in ("int", "int0"):
        return P.parse_int(s)
    if kind == "decimal":
        return P.parse_decimal(s, 4, 2)
    if kind == "bool":
        return P.parse_bool(s)
    if kind == "ts":
        return P.parse_ts(s)
    return P.empty_to_null(s)


def _any(checks: list[Column]) -> Column:
    """True when any check is true (NULL checks count as false)."""
    out = F.lit(False)
    for c in checks:
        out = out | F.coalesce(c, F.lit(False))
    return out


def _assess(raw: DataFrame, spec, reasons) -> DataFrame:
    """Two narrow projections: parse, then judge.

    Each parsed value is computed once and the rules refer to it by name.
    Keeping every expression small matters: one giant generated method is
    too large for the JIT and runs interpreted, several times slower.
    """
    spec_src = {s for s, _, _ in spec}
    keep = [c for c in raw.columns if c.startswith("_") and c not in spec_src]
    src_col = {src: F.col(f"`{src}`").cast("string") for src, _, _ in spec}
    # 1. parse; numbers keep their text for the range rule, which looks at it
    # only where there is no value.  The one-row ``inline`` is a fence: the
    # optimizer does not move a filter on the verdict into the projection
    # below it, which would parse twice.
    parsed = raw.select(F.inline(F.array(F.struct(
        *[_typed(src_col[src], kind).alias(dst) for src, dst, kind in spec],
        *[src_col[src].alias(f"__raw_{dst}") for src, dst, kind in spec if kind in NUMBERS],
        *[F.col(c) for c in keep]))))
    # 2. judge; defaults apply only after the range rule has seen the NULL
    verdict = None
    broken = [(F.col(BROKEN).isNotNull(), "broken_record")] if BROKEN in raw.columns else []
    for cond, reason in broken + reasons(spec):
        verdict = (F.when(cond, F.lit(reason)) if verdict is None
                   else verdict.when(cond, F.lit(reason)))
    outs = [F.coalesce(F.col(dst), F.lit(0)).alias(dst) if kind == "int0" else F.col(dst)
            for _, dst, kind in spec]
    return parsed.select(*outs, *keep, verdict.alias(REJECT))


def _out_of_range(spec) -> Column:
    """A well-formed number its column cannot hold."""
    return _any([F.col(dst).isNull() & P.is_number(F.col(f"__raw_{dst}")) for _, dst, kind in spec if kind in NUMBERS])


def _too_long(spec) -> Column:
    return _any([F.length(F.col(dst)) > TEXT_LIMITS[dst] for _, dst, _ in spec if dst in TEXT_LIMITS])


def assess_products(raw: DataFrame) -> DataFrame:
    """P1 + C12/C14 over raw product rows (CSV header names, all text)."""
    def reasons(spec):
        return [
            (F.col("product_id").isNull(), "missing_key"),
            (_out_of_range(spec), "out_of_range"),
            (_too_long(spec), "too_long"),
        ]
    return _assess(raw, PRODUCT_CSV_COLUMNS, reasons)


def assess_reviews(raw: DataFrame) -> DataFrame:
    """P2 + C12/C13/C14 over raw review rows.

    A review needs an id and a non-zero product id (the loader treats 0 like
    a missing id); a parsed star must be 1..5 (unparseable text is NULL).
    """
    def reasons(spec):
        star = F.col("star")
        return [
            (F.col("review_id").isNull(), "missing_key"),
            (F.coalesce(F.col("product_id"), F.lit(0)) == 0, "missing_product"),
            (star.isNotNull() & ~star.between(1, 5), "bad_star"),
            (_out_of_range(spec), "out_of_range"),
            (_too_long(spec), "too_long"),
        ]
    out = _assess(raw, REVIEW_CSV_COLUMNS, reasons)
    return out.withColumn("star", F.col("star").try_cast("smallint"))


def accepted(assessed: DataFrame) -> DataFrame:
    return assessed.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected(assessed: DataFrame) -> DataFrame:
    return assessed.filter(F.col(REJECT).isNotNull())


def reject_counts(assessed: DataFrame, table: str) -> DataFrame:
    """Rows per outcome ('loaded' or the reject reason), in one aggregate."""
    return (assessed.groupBy(F.coalesce(F.col(REJECT), F.lit("loaded")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(table).alias("table_name"), "outcome", "row_count"))
