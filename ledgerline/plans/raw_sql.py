"""Raw export rows (CSV header names, all text) in SQL, mirroring ``sources.raw``."""

from __future__ import annotations

from ..schemas import PRODUCT_CSV_COLUMNS, REVIEW_CSV_COLUMNS


def _pick(key: str, mod: int, cases: dict, default: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in cases.items())
    return f"(CASE ({key}) % {mod} {whens} ELSE {default} END)"


_FLAGS = {0: "True", 1: "yes", 2: "t", 3: "0", 4: "junk", 5: ""}


def _raw_select(spec, planted: dict) -> str:
    return ", ".join(f'{planted.get(dst, f"CAST({dst} AS VARCHAR)")} AS "{src}"' for src, dst, _ in spec)


_P = {
    "product_id": "(CASE WHEN product_id % 97 = 5 THEN '' ELSE CAST(product_id AS VARCHAR) END)",
    "price": _pick("product_id", 13, {1: "12.9", 2: "-3.9", 3: "1e3", 4: "1.5d", 5: "inf", 6: "nan",
                                      7: "junk", 8: "9007199254740993", 9: " 42 ", 10: "\u06f1\u06f2",
                                      11: "\u0663.\u0669", 12: "1_000"},
                   "CAST(price AS VARCHAR)"),
    "stock": "(CASE WHEN product_id % 17 = 3 THEN '3000000000' ELSE CAST(stock AS VARCHAR) END)",
    "rating_average": _pick("product_id", 19, {4: "4.555", 5: "100"}, "CAST(rating_average AS VARCHAR)"),
    "is_free_shipping": _pick("product_id", 7, _FLAGS, "CAST(is_free_shipping AS VARCHAR)"),
    "category_title": "(CASE WHEN product_id % 23 = 7 THEN repeat('x', 201) ELSE category_title END)",
}

RAW_PRODUCTS_SQL = f"SELECT {_raw_select(PRODUCT_CSV_COLUMNS, _P)} FROM v_products"

_Q = "(product_id + dislike_count)"
_DAY = "strftime(created_at, '%Y-%m-%d')"
_R = {
    "review_id": f"(CASE WHEN {_Q} % 101 = 3 THEN '' ELSE review_id END)",
    "product_id": _pick(_Q, 101, {7: "0", 11: "", 13: "1e3"}, "CAST(product_id AS VARCHAR)"),
    "star": _pick(_Q, 29, {1: "0", 2: "6", 3: "", 4: "4.0", 5: "junk"}, "CAST(star AS VARCHAR)"),
    "created_at": (f"(CASE {_Q} % 31 WHEN 1 THEN {_DAY} || 'T10:11:12Z' "
                   f"WHEN 2 THEN {_DAY} || 'T10:11:12+03:30' WHEN 3 THEN {_DAY} || 'T10:11:12-03:30' "
                   f"WHEN 4 THEN 'junk' WHEN 5 THEN strftime(created_at, '%Y%m%d') "
                   f"WHEN 6 THEN {_DAY} || ' 10:11:12.250' WHEN 7 THEN strftime(created_at, '%Y') "
                   f"WHEN 8 THEN strftime(created_at, '%Y-%m') WHEN 9 THEN strftime(created_at, '%Y-%-m-%-d') "
                   f"WHEN 10 THEN {_DAY} || 'T10:11:12 Asia/Tehran' WHEN 11 THEN {_DAY} || 'T10:11' ELSE CAST(created_at AS VARCHAR) END)"),
    "like_count": _pick(_Q, 37, {1: "", 2: "3000000000"}, "CAST(like_count AS VARCHAR)"),
    "is_public": _pick(_Q, 7, _FLAGS, "CAST(is_public AS VARCHAR)"),
}

RAW_REVIEWS_SQL = (f"SELECT {_raw_select(REVIEW_CSV_COLUMNS, _R)}, updated_at AS _load_seq1, "
                   f"product_id AS _load_seq2, _ord_supplier AS _load_seq3, _ord_amount AS _load_seq4 "
                   f"FROM v_review_log")
