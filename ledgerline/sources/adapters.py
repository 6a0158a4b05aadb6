"""Adapter views: the driver's TPC-H-like tables in the marketplace shapes.

The pipeline works on products, reviews, review texts and a change log.  The
driver supplies TPC-H-like tables instead, so these functions derive those
shapes with plain DataFrame operations (FIXTURES.md section 4 gives the
mapping).  Every view grows with the input tables; nothing here is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.versions import latest_per_key
from .tables import read_table

# Attachment texts in the shape the marketplace export uses.
EMPTY_ATTACHMENTS = "{'photos': [], 'video': None}"
PHOTO_ATTACHMENTS = "{'photos': ['https://cdn.example.com/p/1.jpg'], 'video': None}"

# Version order of the review log: newest ship date wins; the rest only
# break ties (together with the key they are unique at every scale factor).
REVIEW_LOG_ORDER = ("updated_at", "product_id", "_ord_supplier", "_ord_amount")

REVIEW_LOG_COLUMNS = (
    "review_id", "product_id", "user_id", "star", "description", "like_count",
    "dislike_count", "attachments", "is_public", "is_post", "created_at",
    "updated_at",
)


def v_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per part, with its supplier as vendor (clean-layer shape)."""
    part = read_table(spark, sf_dir, "part",
                      ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    supplier = read_table(spark, sf_dir, "supplier",
                          ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    # Supplier count as a scalar subquery: evaluated once inside the plan,
    # from Parquet metadata, instead of an eager job while building it.
    n_suppliers = supplier.select(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()

    # Sales per part: map-side partial count, so a hot part is pre-summed.
    sales = (read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_shipdate"])
             .groupBy("l_partkey")
             .agg(F.count(F.lit(1)).alias("_lines"), F.max("l_shipdate").alias("_last_ship")))
    vendors = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    p = part.withColumn("_vendor_key", F.col("p_partkey") % n_suppliers)
    joined = (p.join(vendors, F.col("_vendor_key") == F.col("s_suppkey"))
               .join(sales, F.col("p_partkey") == F.col("l_partkey"), "left"))
    size = F.col("p_size")
    acct = F.col("s_acctbal")
    return joined.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"),
        (size - 1).alias("stock"),
        F.coalesce(F.col("_lines"), F.lit(0)).cast("int").alias("sales_count_week"),
        (size.cast("decimal(4,2)") / 10).cast("decimal(4,2)").alias("rating_average"),
        size.alias("rating_count"),
        (size % 8).alias("preparation_days"),
        F.substring(F.col("p_brand"), 7, 100).cast("int").alias("category_id"),
        F.col("p_brand").alias("category_title"),
        F.col("p_type").alias("status_title"),
        (F.col("p_partkey") % 3 == 0).alias("is_free_shipping"),
        (size > 5).alias("is_available"),
        (size > 1).alias("is_saleable"),
        F.col("s_suppkey").alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        F.lower(F.col("s_name")).alias("vendor_identifier"),
        F.when(acct < 0, 2).otherwise(1).alias("vendor_status_id"),
        F.when(acct < 0, "blocked").otherwise("active").alias("vendor_status_title"),
        (F.greatest(F.lit(0), F.floor(acct / 20)) / 100).cast("decimal(4,2)").alias("vendor_score"),
        F.col("s_suppkey").alias("vendor_owner_id"),
        F.col("n_name").alias("vendor_owner_city"),
        F.nullif(F.col("s_nationkey"), F.lit(0)).alias("vendor_province_id"),
        F.col("s_nationkey").alias("vendor_city_id"),
        (F.col("s_suppkey") % 2).alias("vendor_free_shipping_to_iran"),
        (1 - F.col("s_suppkey") % 2).alias("vendor_free_shipping_to_same_city"),
        (acct > 0).alias("vendor_has_delivery"),
        (size % 7 != 0).alias("published"),
        F.col("_last_ship").alias("updated_at"),
    )


def _review_columns(li_and_orders: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return li_and_orders.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("review_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("user_id"),
        (1 + F.col("l_quantity").cast("int") % 5).cast("smallint").alias("star"),
        F.col("o_orderpriority").alias("description"),
        F.round(F.col("l_discount") * 100).cast("int").alias("like_count"),
        F.round(F.col("l_tax") * 100).cast("int").alias("dislike_count"),
        F.when(F.col("l_linestatus") == "F", F.lit(EMPTY_ATTACHMENTS))
         .otherwise(F.lit(PHOTO_ATTACHMENTS)).alias("attachments"),
        (F.col("l_returnflag") != "R").alias("is_public"),
        (F.col("l_returnflag") == "A").alias("is_post"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
        F.col("l_suppkey").alias("_ord_supplier"),
        F.col("l_extendedprice").alias("_ord_amount"),
        *keep,
    )


_LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate"]
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]


# Key and version order of the line log that the reviews come from.
LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review log before its join with orders: one row per review version."""
    return read_table(spark, sf_dir, "lineitem", _LINE_COLS)


def with_orders(spark: SparkSession, sf_dir: str, lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Line rows as reviews.  All versions of a key share its order, so lines may be ranked before."""
    orders = read_table(spark, sf_dir, "orders", _ORDER_COLS)
    return _review_columns(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")), keep)


def v_review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row as one review version (keys repeat: a version log)."""
    return with_orders(spark, sf_dir, review_lines(spark, sf_dir))


def v_reviews(spark: SparkSession, sf_dir: str, product_id: int | None = None,
              created_since: str | None = None) -> DataFrame:
    """Current reviews: the newest version of each review id.

    All versions of a key share its order key, so resolving versions on
    lineitem *before* the join with orders gives the same rows as resolving
    after it, while the join sees one row per key instead of the whole log.
    ``product_id`` returns only the current reviews of one product, resolving
    just the keys that ever referred to it (``latest_per_key(where=)``).
    ``created_since`` keeps reviews created on or after a date.  The creation
    time comes from the order, which is part of the key, so the orders are
    filtered first and only their lines are resolved -- a trailing window
    touches a window's worth of the log, not all of it.
    """
    li = read_table(spark, sf_dir, "lineitem", _LINE_COLS)
    orders = read_table(spark, sf_dir, "orders", _ORDER_COLS)
    if created_since is not None:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(created_since).cast("timestamp_ntz"))
        li = li.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    where = None if product_id is None else F.col("l_partkey") == F.lit(product_id)
    newest = latest_per_key(li, list(LINE_KEY), list(LINE_ORDER), where=where)
    return _review_columns(newest.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))


def v_texts(spark: SparkSession, sf_dir: str, with_star: bool = True) -> DataFrame:
    """Review texts from ``documents``; star from the quality label (1 / 5 / NULL).

    ``labels`` is keyed by ``doc_id``, so the left join keeps one row per
    document; callers that never look at ``star`` skip the join entirely.
    """
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    if with_star:
        labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
        docs = docs.join(labels, "doc_id", "left")
        star = (F.when(F.col("quality") == 0, F.lit(1))
                 .when(F.col("quality") == 1, F.lit(5))).cast("smallint")
    else:
        star = F.lit(None).cast("smallint")
    return docs.select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("source").alias("user_id"),
        star.alias("star"),
        F.col("text").alias("description"),
    )


def v_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review times and stars from ``events``, with planted NULLs."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    return ev.select(
        F.col("event_id"),
        F.when(F.col("event_id") % 50 == 0, F.lit(None)).otherwise(F.col("ts")).alias("created_at"),
        F.nullif(F.col("event_id") % 6, F.lit(0)).cast("smallint").alias("star"),
    )


def v_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log (audit_log shape) from ``events``."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    op = (F.when(F.col("event_type") == "signup", F.lit("I"))
           .when(F.col("event_type") == "error", F.lit("D"))
           .otherwise(F.lit("U")))
    return ev.select(
        F.col("event_id").alias("audit_id"),
        F.when(F.col("user_id") % 2 == 0, F.lit("products")).otherwise(F.lit("reviews")).alias("table_name"),
        op.alias("operation"),
        F.col("user_id").cast("string").alias("record_id"),
        F.when(op == "D", F.col("props")).alias("old_data"),
        F.when(op != "D", F.col("props")).alias("new_data"),
        F.col("ts").alias("changed_at"),
    )
