"""The value rules written as DuckDB SQL text, for the oracle queries.

These restate ``ledgerline.functions.parse`` / ``.serve`` in SQL, patterns and
spellings included, so that the oracle computes clean and serve rows
independently of the Spark code.
"""

from __future__ import annotations

from ..operators.publish import PRODUCT_DEFAULTS, PRODUCT_FLAGS, REVIEW_DEFAULTS
from ..schemas import PRODUCT_CSV_COLUMNS, REVIEW_CSV_COLUMNS, TEXT_LIMITS


# Fixed values, as the raw-file loader and the publisher define them.
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([+-]\d{2}:\d{2})?)?$"
TRUE_SPELLINGS = ("true", "1", "yes", "t")
DEFAULT_TIMESTAMP = "2000-01-01 00:00:00"
DIGITS = ("\u06f0\u06f1\u06f2\u06f3\u06f4\u06f5\u06f6\u06f7\u06f8\u06f9"
          "\u0660\u0661\u0662\u0663\u0664\u0665\u0666\u0667\u0668\u0669")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def ascii_digits(x: str) -> str:
    return f"translate({x}, '{DIGITS}', '01234567890123456789')"


def bigint(x: str) -> str:
    x = ascii_digits(x)
    return (f"(CASE WHEN regexp_matches({x}, {_q(INTEGER_PATTERN)}) THEN TRY_CAST({strip(x)} AS BIGINT)"
            f" WHEN regexp_matches({x}, {_q(NUMBER_PATTERN)})"
            f" THEN TRY_CAST(trunc(TRY_CAST({strip(x)} AS DOUBLE)) AS BIGINT) END)")


def integer(x: str) -> str:
    return f"TRY_CAST({bigint(x)} AS INTEGER)"


def decimal42(x: str) -> str:
    x = ascii_digits(x)
    return (f"(CASE WHEN regexp_matches({x}, {_q(NUMBER_PATTERN)}) THEN "
            f"TRY_CAST(TRY_CAST(TRY_CAST({strip(x)} AS DOUBLE) AS VARCHAR) AS DECIMAL(4,2)) END)")


def boolean(x: str) -> str:
    spellings = ", ".join(_q(s) for s in TRUE_SPELLINGS)
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE lower({strip(x)}) IN ({spellings}) END)"


def timestamp(x: str) -> str:
    c = f"regexp_replace({x}, 'Z', '', 'g')"
    return (f"(CASE WHEN regexp_matches({c}, {_q(TIMESTAMP_PATTERN)}) THEN "
            f"TRY_CAST(regexp_replace({c}, ' *([ T].*)[+-]\\d\\d:\\d\\d$', '\\1') AS TIMESTAMP) END)")


def text(x: str) -> str:
    return f"NULLIF({x}, '')"


def typed(x: str, kind: str) -> str:
    return {
        "bigint": bigint, "int": integer, "smallint": bigint, "decimal": decimal42,
        "bool": boolean, "ts": timestamp, "text": text,
        "int0": lambda v: f"COALESCE({integer(v)}, 0)",
    }[kind](x)


def _overflow(raw: str, kind: str) -> str:
    parsed = typed(raw, "int" if kind == "int0" else kind)
    return f"COALESCE(regexp_matches({ascii_digits(raw)}, {_q(NUMBER_PATTERN)}) AND {parsed} IS NULL, FALSE)"


def _any(conds) -> str:
    return "(" + " OR ".join(conds) + ")"


def _col(src: str) -> str:
    return f'"{src}"'


def _rawname(src: str) -> str:
    return f'"raw__{src}"'


def assessed(raw_view: str, spec, key_rules: list[tuple[str, str]], extra_cols=()) -> str:
    """SELECT typed columns + reject_reason from a raw view (CSV header names)."""
    inner = ", ".join([f"{_col(s)} AS {_rawname(s)}" for s, _, _ in spec] + list(extra_cols))
    typed_cols = ", ".join(f"{typed(_rawname(src), kind)} AS {dst}" for src, dst, kind in spec)
    mid = f"SELECT *, {typed_cols} FROM (SELECT {inner} FROM {raw_view}) r"
    over = _any([_overflow(_rawname(src), kind) for src, _, kind in spec
                 if kind in ("int", "int0", "decimal", "bigint")])
    long_ = _any([f"COALESCE(length({dst}) > {TEXT_LIMITS[dst]}, FALSE)"
                  for _, dst, _ in spec if dst in TEXT_LIMITS])
    rules = key_rules + [(over, "out_of_range"), (long_, "too_long")]
    whens = " ".join(f"WHEN {cond} THEN '{reason}'" for cond, reason in rules)
    names = [dst for _, dst, _ in spec] + list(extra_cols)
    return f"SELECT {', '.join(names)}, CASE {whens} END AS reject_reason FROM ({mid}) t"


def assessed_products(raw_view: str) -> str:
    return assessed(raw_view, PRODUCT_CSV_COLUMNS, [("product_id IS NULL", "missing_key")])


def assessed_reviews(raw_view: str) -> str:
    return assessed(raw_view, REVIEW_CSV_COLUMNS, [
        ("review_id IS NULL", "missing_key"),
        ("COALESCE(product_id, 0) = 0", "missing_product"),
        ("star IS NOT NULL AND NOT (star BETWEEN 1 AND 5)", "bad_star"),
    ], extra_cols=("_load_seq1", "_load_seq2", "_load_seq3", "_load_seq4"))


# ------------------------------------------------------------- serve layer
def served_products(src: str, version: str = "CAST(0 AS BIGINT)") -> str:
    cols = []
    from ..schemas import DIM_PRODUCTS
    for f in DIM_PRODUCTS.fields:
        n = f.name
        if n == "product_id":
            e = n
        elif n == "preparation_days":
            e = f"CASE WHEN COALESCE({n}, 0) = 0 THEN 1 ELSE {n} END"
        elif n in PRODUCT_FLAGS:
            e = f"CAST(COALESCE(CAST({n} AS TINYINT), 0) AS TINYINT)"
        elif n == "updated_at":
            e = f"COALESCE(date_trunc('second', {n}), TIMESTAMP '{DEFAULT_TIMESTAMP}')"
        elif n == "_version":
            e = version
        else:
            d = PRODUCT_DEFAULTS[n]
            e = f"COALESCE({n}, {_q(d) if isinstance(d, str) else d})"
        cols.append(f"{e} AS {n}")
    return f"SELECT {', '.join(cols)} FROM {src}"


def has_attachment(x: str) -> str:
    after = f"COALESCE(substring(split_part({x}, 'photos', 2), 1, 20), '')"
    return (f"CAST(CASE WHEN {x} IS NULL OR {x} = '' THEN 0 "
            f"WHEN contains({x}, 'photos') AND NOT contains({after}, '[]') THEN 1 "
            f"WHEN contains({x}, 'http') THEN 1 ELSE 0 END AS TINYINT)")


def served_reviews(src: str, products: str, version: str = "CAST(0 AS BIGINT)") -> str:
    """fact_reviews rows of ``src`` with vendor_id looked up from ``products``."""
    ts = f"COALESCE(date_trunc('second', r.created_at), TIMESTAMP '{DEFAULT_TIMESTAMP}')"
    d = REVIEW_DEFAULTS
    return f"""
SELECT r.review_id, r.product_id, COALESCE(p.vendor_id, 0) AS vendor_id,
       COALESCE(r.user_id, {d['user_id']}) AS user_id, COALESCE(r.star, {d['star']}) AS star,
       COALESCE(r.description, '') AS description, COALESCE(r.like_count, 0) AS like_count,
       COALESCE(r.dislike_count, 0) AS dislike_count, {has_attachment('r.attachments')} AS has_attachment,
       CAST(COALESCE(CAST(r.is_public AS TINYINT), 0) AS TINYINT) AS is_public,
       {ts} AS created_at, CAST(hour({ts}) AS TINYINT) AS created_hour,
       CAST({ts} AS DATE) AS created_day,
       COALESCE(date_trunc('second', r.updated_at), TIMESTAMP '{DEFAULT_TIMESTAMP}') AS updated_at,
       {version} AS _version, strftime({ts}, '%Y%m') AS created_month
FROM {src} r LEFT JOIN (SELECT product_id, vendor_id FROM {products}) p ON p.product_id = r.product_id"""
