"""Raw, untyped export rows derived from the driver tables.

The raw CSV exports are not part of the driver data, so these build rows in
their exact shape (CSV header names, every field text) from the adapter
views.  A fixed rule on the row key plants the malformed values a real
export holds -- empty ids, a zero product id, numbers such as '12.9',
'1e3', '1.5d', 'inf', values out of range, flag spellings, timestamps with
zone suffixes, too-long titles -- so the parsers and the quality rules run
on every row of the full tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PRODUCT_CSV_COLUMNS, REVIEW_CSV_COLUMNS
from .adapters import v_products, v_review_log


def _s(c):
    return F.col(c).cast("string")


def _pick(key, mod, cases: dict, default):
    e = None
    for k, v in cases.items():
        cond = (key % mod) == k
        e = F.when(cond, F.lit(v)) if e is None else e.when(cond, F.lit(v))
    return e.otherwise(default)


FLAG_SPELLINGS = {0: "True", 1: "yes", 2: "t", 3: "0", 4: "junk", 5: ""}


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = v_products(spark, sf_dir)
    k = F.col("product_id")
    planted = {
        "product_id": F.when(k % 97 == 5, F.lit("")).otherwise(_s("product_id")),
        "price": _pick(k, 13, {1: "12.9", 2: "-3.9", 3: "1e3", 4: "1.5d", 5: "inf", 6: "nan",
                               7: "junk", 8: "9007199254740993", 9: " 42 ", 10: "\u06f1\u06f2",
                               11: "\u0663.\u0669", 12: "1_000"}, _s("price")),
        "stock": F.when(k % 17 == 3, F.lit("3000000000")).otherwise(_s("stock")),
        "rating_average": _pick(k, 19, {4: "4.555", 5: "100"}, _s("rating_average")),
        "is_free_shipping": _pick(k, 7, FLAG_SPELLINGS, _s("is_free_shipping")),
        "category_title": F.when(k % 23 == 7, F.lit("x" * 201)).otherwise(F.col("category_title")),
    }
    return p.select(*[planted.get(dst, _s(dst)).alias(src) for src, dst, _ in PRODUCT_CSV_COLUMNS])


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw review rows: every version in the review log, with planted values.

    ``_load_seq`` columns give the load order (oldest version first).
    """
    r = v_review_log(spark, sf_dir)
    q = F.col("product_id") + F.col("dislike_count")
    day = F.date_format("created_at", "yyyy-MM-dd")
    planted = {
        "review_id": F.when(q % 101 == 3, F.lit("")).otherwise(F.col("review_id")),
        "product_id": _pick(q, 101, {7: "0", 11: "", 13: "1e3"}, _s("product_id")),
        "star": _pick(q, 29, {1: "0", 2: "6", 3: "", 4: "4.0", 5: "junk"}, _s("star")),
        "created_at": (F.when(q % 31 == 1, F.concat(day, F.lit("T10:11:12Z")))
                        .when(q % 31 == 2, F.concat(day, F.lit("T10:11:12+03:30")))
                        .when(q % 31 == 3, F.concat(day, F.lit("T10:11:12-03:30")))
                        .when(q % 31 == 4, F.lit("junk"))
                        .when(q % 31 == 5, F.date_format("created_at", "yyyyMMdd"))
                        .when(q % 31 == 6, F.concat(day, F.lit(" 10:11:12.250")))
                        .when(q % 31 == 7, F.date_format("created_at", "yyyy"))
                        .when(q % 31 == 8, F.date_format("created_at", "yyyy-MM"))
                        .when(q % 31 == 9, F.date_format("created_at", "yyyy-M-d"))
                        .when(q % 31 == 10, F.concat(day, F.lit("T10:11:12 Asia/Tehran")))
                        .when(q % 31 == 11, F.concat(day, F.lit("T10:11")))
                        .otherwise(_s("created_at"))),
        "like_count": _pick(q, 37, {1: "", 2: "3000000000"}, _s("like_count")),
        "is_public": _pick(q, 7, FLAG_SPELLINGS, _s("is_public")),
    }
    return r.select(*[planted.get(dst, _s(dst)).alias(src) for src, dst, _ in REVIEW_CSV_COLUMNS],
                    F.col("updated_at").alias("_load_seq1"), F.col("product_id").alias("_load_seq2"),
                    F.col("_ord_supplier").alias("_load_seq3"), F.col("_ord_amount").alias("_load_seq4"))
