"""The four data marts (M1-M4): builds and the reads the reports run.

Builds take the *current* serve-layer views (dim_products, fact_reviews)
and are written as whole snapshots, never truncated in place.  ``computed_at`` is the build time and is left out of
any comparison.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import exact_avg


def _computed_at():
    return F.current_timestamp().alias("computed_at")


def build_top_vendors(products: DataFrame, reviews: DataFrame | None = None) -> DataFrame:
    """M1 (A7): one row per vendor.

    The descriptive columns come from the vendor's lowest product id instead
    of an arbitrary row (T13), and ``total_reviews`` is the vendor's real count
    of current reviews rather than a constant 0 -- both stated deviations.
    Only numbers are aggregated, so the aggregates hash; the texts are fetched
    by that lowest product id afterwards.  Reviews are counted per product
    first (a map-side partial count), so the join sees one row per product.
    """
    agg = (products.groupBy("vendor_id")
           .agg(F.min("product_id").alias("_first_product"),
                F.sum("sales_count_week").cast("bigint").alias("weekly_sales"),
                exact_avg("rating_average").alias("rating_average")))
    agg = agg.join(products.select(F.col("product_id").alias("_first_product"), "vendor_name",
                                   "vendor_owner_city", "vendor_province_id"), "_first_product", "left")
    if reviews is None:
        counts = agg.withColumn("total_reviews", F.lit(0).cast("bigint"))
    else:
        per_product = reviews.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
        per_vendor = (products.select("product_id", "vendor_id")
                      .join(per_product, "product_id")
                      .groupBy("vendor_id").agg(F.sum("_n").cast("bigint").alias("total_reviews")))
        counts = (agg.join(per_vendor, "vendor_id", "left")
                  .withColumn("total_reviews", F.coalesce("total_reviews", F.lit(0).cast("bigint"))))
    return counts.select("vendor_id", "vendor_name", "vendor_owner_city", "vendor_province_id",
                         "weekly_sales", "rating_average", "total_reviews", _computed_at())


def read_top_vendors(mart: DataFrame, n: int = 10) -> DataFrame:
    """M1 report (L7): top vendors by weekly sales."""
    return (mart.select("vendor_id", "vendor_name", "weekly_sales", "rating_average")
            .orderBy(F.col("weekly_sales").desc(), F.col("vendor_id").asc()).limit(n))


def build_free_shipping(products: DataFrame) -> DataFrame:
    """M2 (P22): product-grain projection for the free-shipping analysis."""
    return products.select("product_id", "vendor_id", "preparation_days", "is_free_shipping",
                           "rating_average", "sales_count_week", _computed_at())


def read_free_shipping(mart: DataFrame) -> DataFrame:
    """M2 report (A10): by preparation days and free shipping."""
    return (mart.groupBy("preparation_days", "is_free_shipping")
            .agg(exact_avg("rating_average").alias("avg_rating"),
                 F.sum("sales_count_week").cast("bigint").alias("total_sales"))
            .orderBy("preparation_days", "is_free_shipping"))


def build_trending(products: DataFrame, reviews: DataFrame, as_of: str | dt.date,
                   days: int = 30) -> DataFrame:
    """M3 (J3, C11, A8): reviews per category and calendar month in a trailing window.

    ``as_of`` is a parameter (the reference uses today()).  Reviews in the
    window are first counted per (product, month) -- a map-side partial
    aggregate that shrinks the fact side before the join -- then joined to
    their product and rolled up per category.  ``weekly_sales`` repeats a
    product's weekly sales once per review, as the reference's join does
    (T11); ``category_weekly_sales`` counts each product once.
    """
    start = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    per_product = (reviews.filter(F.col("created_at") >= start.cast("timestamp_ntz"))
                   .groupBy("product_id", F.trunc(F.to_date("created_at"), "MM").alias("month_start"))
                   .agg(F.count(F.lit(1)).alias("_reviews")))
    return trending_of_counts(products, per_product)


def trending_of_counts(products: DataFrame, per_product: DataFrame) -> DataFrame:
    """M3 from (product_id, month_start, _reviews) counts."""
    titles = products.select("product_id", "category_id", "category_title", "sales_count_week")
    joined = per_product.join(titles, "product_id")
    agg = (joined.groupBy("category_id", "month_start")
           .agg(F.min("product_id").alias("_first_product"),
                F.sum("_reviews").cast("bigint").alias("monthly_reviews"),
                F.sum(F.col("sales_count_week") * F.col("_reviews")).cast("bigint").alias("weekly_sales"),
                F.sum("sales_count_week").cast("bigint").alias("category_weekly_sales")))
    named = agg.join(titles.select(F.col("product_id").alias("_first_product"), "category_title"),
                     "_first_product", "left")
    return named.select("category_id", "category_title", "monthly_reviews", "weekly_sales",
                        "category_weekly_sales", "month_start", _computed_at())


def read_trending(mart: DataFrame, n: int = 10) -> DataFrame:
    """M3 report (L7): top categories by reviews in the window."""
    return (mart.select("category_id", "category_title", "monthly_reviews", "weekly_sales", "month_start")
            .orderBy(F.col("monthly_reviews").desc(), F.col("category_id").asc(), F.col("month_start").asc())
            .limit(n))


def build_engagement(reviews: DataFrame) -> DataFrame:
    """M4 (P23): review-grain engagement rows; text length in UTF-8 bytes."""
    return reviews.select("review_id", "star", "has_attachment", F.col("like_count").cast("bigint").alias("like_count"),
                          F.octet_length("description").alias("description_length"),
                          F.to_date("created_at").alias("created_day"), _computed_at())


def read_engagement(mart: DataFrame) -> DataFrame:
    """M4 report (A11): average likes with and without attachments (review grain, T14)."""
    return (mart.groupBy("has_attachment")
            .agg(exact_avg("like_count").alias("avg_likes"), F.count(F.lit(1)).alias("review_count"))
            .orderBy("has_attachment"))
