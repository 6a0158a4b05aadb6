"""The analytical queries (Q1-Q9 and the benchmark variants) as operators.

Each takes the products or reviews DataFrame plus parameters and returns a
DataFrame; nothing is collected.  Ranked results always end their ordering
with the key so ties resolve the same way on every run (T18), and top-k is
``orderBy(...).limit(k)``, which Spark plans as ``TakeOrderedAndProject``:
every task keeps its own k best rows, so only k x tasks rows reach the
final merge however large the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import exact_avg, stable_avg
from ..functions.text import contains_any, split_words, text_length


def vendor_profile(products: DataFrame, vendor_id: int) -> DataFrame:
    """Q1 (D1, C1): distinct vendor attributes of one vendor."""
    return (products.filter(F.col("vendor_id") == vendor_id)
            .select("vendor_name", F.col("vendor_score").cast("double").alias("vendor_score"),
                    "vendor_status_title", "vendor_owner_id")
            .distinct())


def hourly_rating(reviews: DataFrame, ts_col: str = "created_at", star_col: str = "star",
                  integral_star: bool = True) -> DataFrame:
    """Q2 (A1, L6): average star and review count per hour of day.

    A NULL time forms its own group (hour NULL) and NULL stars are left out
    of the average but counted, as in SQL.
    """
    avg = exact_avg(star_col) if integral_star else stable_avg(star_col)
    return (reviews.groupBy(F.hour(F.col(ts_col)).alias("review_hour"))
            .agg(avg.alias("avg_rating"), F.count(F.lit(1)).alias("review_count"))
            .orderBy(F.col("review_hour").asc_nulls_first()))


def most_liked(reviews: DataFrame, n: int = 20, time_col: str = "updated_at") -> DataFrame:
    """Q3 (C4, L1): top ``n`` reviews by likes."""
    return (reviews.filter(F.col("like_count") > 0)
            .select("review_id", "product_id", "like_count", time_col)
            .orderBy(F.col("like_count").desc(), F.col("review_id").asc())
            .limit(n))


def availability(products: DataFrame, product_id: int) -> DataFrame:
    """Q4 (C2, P19): stock flags of one product and the computed saleable flag."""
    computed = F.when((F.col("stock") > 0) & F.col("is_available"), F.lit(True)).otherwise(F.lit(False))
    return (products.filter(F.col("product_id") == product_id)
            .select("product_id", "stock", "is_available", "is_saleable",
                    computed.alias("computed_saleable")))


def low_star_keywords(reviews: DataFrame, keywords: Sequence[str], max_star: int = 4,
                      n: int = 50, columns: Sequence[str] = ("review_id", "product_id", "star", "description"),
                      ) -> DataFrame:
    """Q5 (C5, C7, L5): low-star reviews mentioning any keyword, first ``n`` by id.

    The reference takes 50 rows in no order; ordering by the key makes the
    answer deterministic.
    """
    return (reviews.filter(contains_any("description", keywords) & (F.col("star") < max_star))
            .select(*columns)
            .orderBy("review_id")
            .limit(n))


def top_regions(products: DataFrame, province_rule: str = "not_null", n: int = 10) -> DataFrame:
    """Q6 (C9, A2, L2): vendor regions ranked by average vendor score, then sales.

    ``province_rule`` is ``not_null`` (row store: NULL means unknown) or
    ``positive`` (column store: unknown was stored as 0).  Averages weigh
    every product equally.
    """
    prov = F.col("vendor_province_id")
    cond = prov.isNotNull() if province_rule == "not_null" else prov > 0
    return (products.filter(cond)
            .groupBy("vendor_province_id", "vendor_owner_city")
            .agg(exact_avg("vendor_score").alias("avg_vendor_score"),
                 F.sum("sales_count_week").cast("bigint").alias("total_weekly_sales"),
                 exact_avg("rating_average").alias("avg_rating"))
            .orderBy(F.col("avg_vendor_score").desc_nulls_last(),
                     F.col("total_weekly_sales").desc_nulls_last(),
                     F.col("vendor_province_id").asc_nulls_first(),
                     F.col("vendor_owner_city").asc_nulls_first())
            .limit(n))


def top_regions_by_province(products: DataFrame, n: int = 10) -> DataFrame:
    """Q6 benchmark form (A3): by province only, no filter (NULL/0 kept as a group)."""
    return (products.groupBy("vendor_province_id")
            .agg(exact_avg("vendor_score").alias("avg_vendor_score"),
                 F.sum("sales_count_week").cast("bigint").alias("total_weekly_sales"))
            .orderBy(F.col("avg_vendor_score").desc_nulls_last(),
                     F.col("vendor_province_id").asc_nulls_first())
            .limit(n))


def word_frequency(reviews: DataFrame, star: int = 1, min_length: int = 2, unit: str = "char",
                   n: int = 10) -> DataFrame:
    """Q7 (C6, C8, C10, A4, L3): most frequent space-separated words of ``star`` reviews.

    The star filter runs before the explode (and reaches the scan); the
    length filter needs the word, so it stays after it.  The word count is a
    hash aggregate with a map-side partial count, so a very common word is
    pre-counted in every task before the shuffle.
    """
    words = (reviews.filter((F.col("star") == star) & F.col("description").isNotNull())
             .select(F.explode(split_words("description")).alias("word")))
    return (words.filter(text_length("word", unit) > min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))
            .orderBy(F.col("frequency").desc(), F.col("word").asc())
            .limit(n))


def latest_public(reviews: DataFrame, product_id: int, n: int = 10) -> DataFrame:
    """Q8 (C2, C3, L4): newest ``n`` public reviews of one product."""
    return (reviews.filter((F.col("product_id") == product_id) & F.col("is_public"))
            .select("review_id", "product_id", "user_id", "star", "description", "created_at")
            .orderBy(F.col("created_at").desc_nulls_last(), F.col("review_id").asc())
            .limit(n))


def keyword_users(reviews: DataFrame, keywords: Sequence[str], n: int = 10) -> DataFrame:
    """Q9 (C7, A5/A6, L3): users with the most reviews mentioning any keyword."""
    return (reviews.filter(contains_any("description", keywords))
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("positive_review_count"))
            .orderBy(F.col("positive_review_count").desc(), F.col("user_id").asc_nulls_first())
            .limit(n))
