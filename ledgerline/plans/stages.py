"""Pipeline query plans: load, publish, versions, marts and change data.

Each key runs a pipeline stage over the full adapter views and returns the
stage's output (or the report read from it).  Stages that write -- the
compaction, the month-partitioned fact, the change stream -- write to a
fresh folder under the session's shared scratch root and return a read of
what they wrote.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..jobs import initial_load
from ..operators import cdc, clean, digest, load, marts
from ..operators import analytics as A
from ..operators.asof import as_of
from ..operators.publish import publish_products, publish_reviews
from ..operators.versions import compact, latest_per_key, sum_collapse
from ..schemas import AUDIT_LOG, CLEAN_PRODUCTS, CLEAN_REVIEWS, PRODUCT_CSV_COLUMNS, PRODUCT_IMAGE, REVIEW_CSV_COLUMNS
from ..session import freed_shuffles, new_scratch_dir
from ..sinks.keyed import KeyedTable
from ..sinks.parquet import read_log, stage, write_fact_by_month
from ..sources import adapters as V
from ..sources import raw as R
from ..sources.csv import read_products_csv, read_reviews_csv
from ..sources.serve import read_fact
from ..sources.tables import read_table
from ..streaming import changes
from ..streaming import serving as SP
from ..streaming.applied import read_applied
from ..streaming.changes import StreamPaths, drain, make_batch_handler, run_change_stream
from ..streaming.replay import read_mirror, run_id_of
from . import sql_rules as Q
from .analytical import PRODUCT_ID
from .registry import register
from .views_sql import with_views

# Parameters.  AS_OF stands in for "today" of the trailing-window mart: the
# latest order date in the driver tables, at every scale factor.
AS_OF = "2001-08-01"
WINDOW_DAYS = 30
MIRROR_CUTOFF = "2024-01-15 00:00:00"   # changes before this were applied earlier
BATCH_SIZE = 500                         # the reference loader's batch cap (L8)
SNAPSHOT_CUTOFF = "1998-01-01 00:00:00"  # the older snapshot of the diff
CHANGE_PAYLOAD = T.StructType([T.StructField("k", T.LongType(), True)])

REVIEW_COLS = V.REVIEW_LOG_COLUMNS
REVIEW_COLS_SQL = ", ".join(REVIEW_COLS)
LOG_ORDER_ASC_SQL = "updated_at, product_id, _ord_supplier, _ord_amount"
LOG_ORDER_DESC_SQL = "updated_at DESC, product_id DESC, _ord_supplier DESC, _ord_amount DESC"


def _dec_to_double(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles in query results (engine-neutral values)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product catalog the reviews are loaded against: published products.

    Unpublished products are absent from it, which is what gives the
    referential check orphan reviews to find; every review row is still
    checked (nothing is sampled).
    """
    return V.v_products(spark, sf_dir).filter(F.col("published"))


_CATALOG_SQL = "SELECT * FROM v_products WHERE published"


def _served_products(spark, sf_dir):
    return publish_products(V.v_products(spark, sf_dir))


def _served_reviews(spark, sf_dir):
    return publish_reviews(V.v_reviews(spark, sf_dir), V.v_products(spark, sf_dir))


_SERVED = (("s_products", Q.served_products("v_products")),
           ("s_reviews", Q.served_reviews("v_reviews", "v_products")))


# ------------------------------------------------------- versions
@register("latest_version", with_views(
    f"SELECT {REVIEW_COLS_SQL} FROM v_reviews", "v_reviews"))
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 over the line log, before its rows are joined with their orders."""
    newest = latest_per_key(V.review_lines(spark, sf_dir), list(V.LINE_KEY), list(V.LINE_ORDER))
    return V.with_orders(spark, sf_dir, newest).select(*REVIEW_COLS)


@register("compacted", with_views(
    f"SELECT {REVIEW_COLS_SQL} FROM v_reviews", "v_reviews"))
def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line log rewritten as its current view, read back and joined with the orders."""
    target = new_scratch_dir(spark, "compacted-reviews")
    compact(V.review_lines(spark, sf_dir), list(V.LINE_KEY), list(V.LINE_ORDER), target)
    return V.with_orders(spark, sf_dir, spark.read.parquet(target)).select(*REVIEW_COLS)


_FIRSTS_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY {LOG_ORDER_ASC_SQL}) AS rn
  FROM v_review_log) t WHERE rn = 1"""


@register("first_wins", with_views(
    f"SELECT {REVIEW_COLS_SQL} FROM firsts", "v_review_log", extra=(("firsts", _FIRSTS_SQL),)))
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = load.first_wins(V.review_lines(spark, sf_dir), list(V.LINE_KEY), list(V.LINE_ORDER))
    return V.with_orders(spark, sf_dir, first).select(*REVIEW_COLS)


@register("insert_or_ignore", with_views("""
SELECT review_id, product_id, updated_at, like_count FROM existing
UNION ALL
SELECT review_id, product_id, updated_at, like_count FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.review_id = f.review_id)""",
    "v_reviews", "v_products",
    extra=(("existing", f"SELECT * FROM v_reviews WHERE product_id IN (SELECT product_id FROM ({_CATALOG_SQL}))"),
           ("firsts", _FIRSTS_SQL))))
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the table lies there, bucketed by its key; first rows are ranked before their join, and met in its buckets."""
    cols = ["review_id", "product_id", "updated_at", "like_count"]
    existing, _ = load.split_by_reference(V.v_reviews(spark, sf_dir), _catalog(spark, sf_dir), "product_id")
    existing = existing.select(*cols)
    table = KeyedTable(spark, new_scratch_dir(spark, "existing"), existing.schema, "review_id", buckets=8)
    table.append(existing)
    first = load.first_wins(V.review_lines(spark, sf_dir), list(V.LINE_KEY), list(V.LINE_ORDER))
    held = table.read()
    new = load.drop_known(V.with_orders(spark, sf_dir, first).select(*cols), held, ["review_id"], table.buckets)
    return held.unionByName(new)


# ------------------------------------------------------- joins
@register("fk_semi", with_views(f"""
SELECT review_id, product_id, star, like_count, updated_at FROM v_review_log
WHERE product_id IN (SELECT product_id FROM ({_CATALOG_SQL}))""", "v_review_log", "v_products"))
def fk_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = load.split_by_reference(V.v_review_log(spark, sf_dir), _catalog(spark, sf_dir), "product_id")
    return kept.select("review_id", "product_id", "star", "like_count", "updated_at")


@register("fk_rejects", with_views(f"""
SELECT review_id, product_id, updated_at, 'orphan_product' AS reject_reason FROM v_review_log
WHERE product_id NOT IN (SELECT product_id FROM ({_CATALOG_SQL}))""", "v_review_log", "v_products"))
def fk_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, orphans = load.split_by_reference(V.v_review_log(spark, sf_dir), _catalog(spark, sf_dir), "product_id")
    return orphans.select("review_id", "product_id", "updated_at",
                          F.lit("orphan_product").alias("reject_reason"))


@register("vendor_enrich", with_views(f"""
SELECT r.review_id, r.product_id, COALESCE(c.vendor_id, 0) AS vendor_id
FROM v_reviews r LEFT JOIN ({_CATALOG_SQL}) c ON c.product_id = r.product_id""",
    "v_reviews", "v_products"))
def vendor_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.joins import lookup
    r = V.v_reviews(spark, sf_dir).select("review_id", "product_id")
    return lookup(r, _catalog(spark, sf_dir), "product_id", "vendor_id", default=0)


# A third of the changes are of one product; every second product moves to another vendor twice.
_MOVES_SQL = """
SELECT product_id, 0 AS at, vendor_id FROM v_products
UNION ALL SELECT product_id, 100 + product_id % 97, vendor_id % 7 + 1 FROM v_products WHERE product_id % 2 = 1
UNION ALL SELECT product_id, 500 + product_id % 89, NULL FROM v_products WHERE product_id % 2 = 1"""
_ASKED_SQL = """
SELECT audit_id, CASE WHEN audit_id % 3 = 0 THEN 1 ELSE audit_id % 500 + 1 END AS product_id, audit_id % 1000 - 50 AS at
FROM v_audit"""


@register("vendor_as_of", with_views("""
SELECT r.audit_id, r.product_id, r.at, v.vendor_id FROM asked r
ASOF LEFT JOIN moves v ON r.product_id = v.product_id AND r.at >= v.at""", "v_products", "v_audit",
    extra=(("moves", _MOVES_SQL), ("asked", _ASKED_SQL))))
def vendor_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor that a product had when a row of it changed."""
    p = V.v_products(spark, sf_dir).select("product_id", "vendor_id")
    odd = p.where("product_id % 2 = 1")
    moves = (p.selectExpr("product_id", "0L AS at", "vendor_id")
             .unionAll(odd.selectExpr("product_id", "100 + product_id % 97", "vendor_id % 7 + 1"))
             .unionAll(odd.selectExpr("product_id", "500 + product_id % 89", "CAST(NULL AS LONG)")))
    asked = V.v_audit(spark, sf_dir).selectExpr(
        "audit_id", "CASE WHEN audit_id % 3 = 0 THEN 1 ELSE audit_id % 500 + 1 END AS product_id",
        "audit_id % 1000 - 50 AS at")
    return as_of(asked, moves, "product_id", "at", ["vendor_id"], chunk_bits=8)


# ------------------------------------------------------- publish
@register("publish_products", with_views(
    "SELECT * REPLACE (CAST(rating_average AS DOUBLE) AS rating_average, "
    "CAST(vendor_score AS DOUBLE) AS vendor_score) FROM s_products",
    "v_products", extra=_SERVED[:1]))
def publish_products_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dec_to_double(_served_products(spark, sf_dir))


@register("publish_reviews", with_views("SELECT * FROM s_reviews", "v_reviews", "v_products",
                                        extra=_SERVED[1:]))
def publish_reviews_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served_reviews(spark, sf_dir)


@register("stock_rule_check", with_views("""
SELECT product_id, GREATEST(0, stock) AS stock_floor, GREATEST(0, stock) > 0 AS rule_available,
       COALESCE(is_available = (GREATEST(0, stock) > 0) AND is_saleable = (GREATEST(0, stock) > 0), FALSE)
         AS is_consistent
FROM v_products""", "v_products"))
def stock_rule_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = V.v_products(spark, sf_dir)
    floor = F.greatest(F.lit(0), F.col("stock"))
    rule = floor > 0
    return p.select("product_id", floor.alias("stock_floor"), rule.alias("rule_available"),
                    F.coalesce((F.col("is_available") == rule) & (F.col("is_saleable") == rule),
                               F.lit(False)).alias("is_consistent"))


# ------------------------------------------------------- clean + quality
def _raw_products_sql() -> str:
    from .raw_sql import RAW_PRODUCTS_SQL
    return RAW_PRODUCTS_SQL


def _raw_reviews_sql() -> str:
    from .raw_sql import RAW_REVIEWS_SQL
    return RAW_REVIEWS_SQL


def _assessed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.assess_products(R.raw_products(spark, sf_dir))


def _assessed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.assess_reviews(R.raw_reviews(spark, sf_dir))


_CLEAN_CTES = (("raw_products", _raw_products_sql()),
               ("raw_reviews", _raw_reviews_sql()),
               ("a_products", Q.assessed_products("raw_products")),
               ("a_reviews", Q.assessed_reviews("raw_reviews")))


@register("clean_products", with_views(
    "SELECT * EXCLUDE (reject_reason) REPLACE (CAST(rating_average AS DOUBLE) AS rating_average, "
    "CAST(vendor_score AS DOUBLE) AS vendor_score) FROM a_products WHERE reject_reason IS NULL",
    "v_products", "v_review_log", extra=_CLEAN_CTES))
def clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dec_to_double(clean.accepted(_assessed_products(spark, sf_dir)))


_REVIEW_OUT_SQL = ", ".join("CAST(star AS SMALLINT) AS star" if c == "star" else c for c in REVIEW_COLS)


@register("clean_reviews", with_views(
    f"SELECT {_REVIEW_OUT_SQL} FROM a_reviews WHERE reject_reason IS NULL",
    "v_products", "v_review_log", extra=_CLEAN_CTES))
def clean_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.accepted(_assessed_reviews(spark, sf_dir)).select(*REVIEW_COLS)


@register("reject_counts", with_views("""
SELECT 'products' AS table_name, COALESCE(reject_reason, 'loaded') AS outcome, COUNT(*) AS row_count
FROM a_products GROUP BY 2
UNION ALL
SELECT 'reviews' AS table_name, COALESCE(reject_reason, 'loaded') AS outcome, COUNT(*) AS row_count
FROM a_reviews GROUP BY 2""", "v_products", "v_review_log", extra=_CLEAN_CTES))
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = clean.reject_counts(_assessed_products(spark, sf_dir), "products")
    r = clean.reject_counts(_assessed_reviews(spark, sf_dir), "reviews")
    return p.unionByName(r)


@register("clean_first_wins", with_views(f"""
SELECT {_REVIEW_OUT_SQL} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id
      ORDER BY _load_seq1, _load_seq2, _load_seq3, _load_seq4) AS rn
  FROM a_reviews WHERE reject_reason IS NULL
    AND product_id IN (SELECT product_id FROM a_products WHERE reject_reason IS NULL)) t
WHERE rn = 1""", "v_products", "v_review_log", extra=_CLEAN_CTES))
def clean_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole initial load: clean, quarantine, FK semi join, first row wins."""
    products = clean.accepted(_assessed_products(spark, sf_dir))
    reviews = clean.accepted(_assessed_reviews(spark, sf_dir))
    kept, _ = load.split_by_reference(reviews, products, "product_id")
    order = ["_load_seq1", "_load_seq2", "_load_seq3", "_load_seq4"]
    return load.first_wins(kept, ["review_id"], order).select(*REVIEW_COLS)


# ------------------------------------------------------- marts
_TOP_VENDORS_SQL = """
SELECT p.vendor_id, arg_min(p.vendor_name, p.product_id) AS vendor_name,
       arg_min(p.vendor_owner_city, p.product_id) AS vendor_owner_city,
       arg_min(p.vendor_province_id, p.product_id) AS vendor_province_id,
       CAST(SUM(p.sales_count_week) AS BIGINT) AS weekly_sales,
       CAST(SUM(p.rating_average) AS DOUBLE) / COUNT(p.rating_average) AS rating_average,
       CAST(COALESCE(MAX(rc.n), 0) AS BIGINT) AS total_reviews
FROM s_products p
LEFT JOIN (SELECT pp.vendor_id, COUNT(*) AS n FROM s_reviews r JOIN s_products pp
           ON pp.product_id = r.product_id GROUP BY pp.vendor_id) rc ON rc.vendor_id = p.vendor_id
GROUP BY p.vendor_id"""


def _top_vendors(spark, sf_dir):
    return marts.build_top_vendors(_served_products(spark, sf_dir), _served_reviews(spark, sf_dir))


@register("dm_top_vendors", with_views("SELECT * FROM dm1", "v_reviews", "v_products",
                                       extra=_SERVED + (("dm1", _TOP_VENDORS_SQL),)))
def dm_top_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_vendors(spark, sf_dir).drop("computed_at")


def _report(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report over its mart as readers find it: written, then read."""
    build, read = MART_READS[key]
    return read(stage(build(spark, sf_dir), "mart"))


@register("dm_top_vendors_read", with_views(
    "SELECT vendor_id, vendor_name, weekly_sales, rating_average FROM dm1 "
    "ORDER BY weekly_sales DESC, vendor_id LIMIT 10", "v_reviews", "v_products",
    extra=_SERVED + (("dm1", _TOP_VENDORS_SQL),)))
def dm_top_vendors_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report("dm_top_vendors_read", spark, sf_dir)


@register("dm_free_shipping", with_views(
    "SELECT product_id, vendor_id, preparation_days, is_free_shipping, "
    "CAST(rating_average AS DOUBLE) AS rating_average, sales_count_week FROM s_products",
    "v_products", extra=_SERVED[:1]))
def dm_free_shipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dec_to_double(marts.build_free_shipping(_served_products(spark, sf_dir)).drop("computed_at"))


@register("dm_free_shipping_read", with_views("""
SELECT preparation_days, is_free_shipping,
       CAST(SUM(rating_average) AS DOUBLE) / COUNT(rating_average) AS avg_rating,
       CAST(SUM(sales_count_week) AS BIGINT) AS total_sales
FROM s_products GROUP BY 1, 2 ORDER BY 1, 2""", "v_products", extra=_SERVED[:1]))
def dm_free_shipping_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report("dm_free_shipping_read", spark, sf_dir)


_WINDOW_SQL = f"r.created_at >= CAST(DATE '{AS_OF}' - INTERVAL {WINDOW_DAYS} DAY AS TIMESTAMP)"
_TRENDING_CTES = (
    ("dm3_rows", f"""
SELECT p.category_id, p.category_title, p.product_id, p.sales_count_week,
       CAST(date_trunc('month', r.created_at) AS DATE) AS month_start
FROM s_products p JOIN s_reviews r ON r.product_id = p.product_id WHERE {_WINDOW_SQL}"""),
    ("dm3", """
SELECT a.category_id, a.category_title, a.monthly_reviews, a.weekly_sales,
       b.category_weekly_sales, a.month_start
FROM (SELECT category_id, month_start, arg_min(category_title, product_id) AS category_title,
             COUNT(*) AS monthly_reviews, CAST(SUM(sales_count_week) AS BIGINT) AS weekly_sales
      FROM dm3_rows GROUP BY category_id, month_start) a
JOIN (SELECT category_id, month_start, CAST(SUM(sales_count_week) AS BIGINT) AS category_weekly_sales
      FROM (SELECT DISTINCT category_id, month_start, product_id, sales_count_week FROM dm3_rows) d
      GROUP BY category_id, month_start) b
  ON a.category_id = b.category_id AND a.month_start = b.month_start"""),
)


def _trending(spark, sf_dir):
    # Only reviews created in the trailing window are resolved and published.
    since = (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=WINDOW_DAYS)).isoformat()
    reviews = publish_reviews(V.v_reviews(spark, sf_dir, created_since=since), V.v_products(spark, sf_dir))
    return marts.build_trending(_served_products(spark, sf_dir), reviews, AS_OF, WINDOW_DAYS)


@register("dm_trending", with_views("SELECT * FROM dm3", "v_reviews", "v_products",
                                    extra=_SERVED + _TRENDING_CTES))
def dm_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trending(spark, sf_dir).drop("computed_at")


@register("dm_trending_read", with_views(
    "SELECT category_id, category_title, monthly_reviews, weekly_sales, month_start FROM dm3 "
    "ORDER BY monthly_reviews DESC, category_id, month_start LIMIT 10", "v_reviews", "v_products",
    extra=_SERVED + _TRENDING_CTES))
def dm_trending_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report("dm_trending_read", spark, sf_dir)


_ENGAGEMENT_SQL = """
SELECT review_id, star, has_attachment, CAST(like_count AS BIGINT) AS like_count,
       CAST(strlen(description) AS INTEGER) AS description_length, CAST(created_at AS DATE) AS created_day
FROM s_reviews"""


def _engagement(spark, sf_dir):
    return marts.build_engagement(_served_reviews(spark, sf_dir))


@register("dm_engagement", with_views("SELECT * FROM dm4", "v_reviews", "v_products",
                                      extra=_SERVED + (("dm4", _ENGAGEMENT_SQL),)))
def dm_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engagement(spark, sf_dir).drop("computed_at")


@register("dm_engagement_read", with_views("""
SELECT has_attachment, CAST(SUM(like_count) AS DOUBLE) / COUNT(like_count) AS avg_likes,
       COUNT(*) AS review_count FROM dm4 GROUP BY 1 ORDER BY 1""", "v_reviews", "v_products",
    extra=_SERVED + (("dm4", _ENGAGEMENT_SQL),)))
def dm_engagement_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report("dm_engagement_read", spark, sf_dir)


@register("sum_collapse", with_views("""
SELECT created_day, star, has_attachment, CAST(SUM(like_count) AS BIGINT) AS like_count,
       CAST(SUM(description_length) AS BIGINT) AS description_length, COUNT(*) AS row_count
FROM dm4 GROUP BY 1, 2, 3""", "v_reviews", "v_products",
    extra=_SERVED + (("dm4", _ENGAGEMENT_SQL),)))
def sum_collapse_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sum_collapse(_engagement(spark, sf_dir), ["created_day", "star", "has_attachment"],
                        ["like_count", "description_length"])


@register("month_partition_counts", with_views(f"""
SELECT created_month, COUNT(*) AS review_count, CAST(SUM(like_count) AS BIGINT) AS likes
FROM s_reviews
WHERE created_at >= CAST(DATE '{AS_OF}' - INTERVAL {WINDOW_DAYS} DAY AS TIMESTAMP)
  AND created_at < CAST(DATE '{AS_OF}' + INTERVAL 1 DAY AS TIMESTAMP)
GROUP BY 1""", "v_reviews", "v_products", extra=_SERVED))
def month_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + C11: write the month-partitioned fact, read one window back with pruning."""
    path = new_scratch_dir(spark, "fact-reviews")
    write_fact_by_month(_served_reviews(spark, sf_dir), path, mode="overwrite")
    since = dt.date.fromisoformat(AS_OF) - dt.timedelta(days=WINDOW_DAYS)
    fact = read_fact(spark, path, since=since, until=AS_OF)
    return (fact.groupBy("created_month")
            .agg(F.count(F.lit(1)).alias("review_count"), F.sum("like_count").cast("bigint").alias("likes")))


# ------------------------------------------------------- change data
_MIRROR_SQL = f"SELECT * FROM v_audit WHERE changed_at < TIMESTAMP '{MIRROR_CUTOFF}'"


def _mirror(spark, sf_dir):
    log = V.v_audit(spark, sf_dir)
    return cdc.mirror_rows(log.filter(F.col("changed_at") < F.lit(MIRROR_CUTOFF).cast("timestamp_ntz")), 0)


@register("cdc_pending", with_views(f"""
SELECT audit_id, table_name, operation, record_id, changed_at FROM v_audit a
WHERE NOT EXISTS (SELECT 1 FROM mirror m WHERE m.audit_id = a.audit_id)
ORDER BY audit_id LIMIT {BATCH_SIZE}""", "v_audit", extra=(("mirror", _MIRROR_SQL),)))
def cdc_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = cdc.pending(V.v_audit(spark, sf_dir), _mirror(spark, sf_dir), BATCH_SIZE)
    return todo.select("audit_id", "table_name", "operation", "record_id", "changed_at")


_STATE_SQL = """
SELECT table_name, record_id, k, _version FROM (
  SELECT table_name, record_id, operation, CAST(json_extract(COALESCE(new_data, old_data), '$.k') AS BIGINT) AS k,
         audit_id AS _version,
         ROW_NUMBER() OVER (PARTITION BY table_name, record_id ORDER BY audit_id DESC) AS rn
  FROM v_audit WHERE operation IN {ops}) t
WHERE rn = 1 {extra}"""

_APPLY_SQL = _STATE_SQL.format(ops="('I', 'U')", extra="")
_APPLY_DELETES_SQL = _STATE_SQL.format(ops="('I', 'U', 'D')", extra="AND operation <> 'D'")


@register("cdc_apply", with_views(_APPLY_SQL, "v_audit"))
def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = cdc.state_versions(V.v_audit(spark, sf_dir), CHANGE_PAYLOAD)
    return cdc.current_state(versions).select("table_name", "record_id", "k", "_version")


@register("cdc_apply_deletes", with_views(_APPLY_DELETES_SQL, "v_audit"))
def cdc_apply_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = cdc.state_versions(V.v_audit(spark, sf_dir), CHANGE_PAYLOAD, keep_deletes=True)
    return cdc.current_state(versions, apply_deletes=True).select("table_name", "record_id", "k", "_version")


@register("cdc_mirror", with_views(
    "SELECT audit_id, table_name, operation, record_id, changed_at FROM v_audit", "v_audit"))
def cdc_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the mirror that applying the log wrote."""
    paths = _stream_log(spark, V.v_audit(spark, sf_dir))
    run_change_stream(spark, paths, CHANGE_PAYLOAD)
    return read_mirror(spark, paths.mirror).drop("loaded_at", "run_id", "batch_id")


@register("cdc_cursor", with_views(
    "SELECT COALESCE(MAX(audit_id), 0) AS last_audit_id FROM mirror", "v_audit",
    extra=(("mirror", _MIRROR_SQL),)))
def cdc_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.cursor(_mirror(spark, sf_dir))


_OLD_SNAPSHOT_SQL = f"""
SELECT {REVIEW_COLS_SQL} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY {LOG_ORDER_DESC_SQL}) AS rn
  FROM v_review_log WHERE updated_at < TIMESTAMP '{SNAPSHOT_CUTOFF}') t WHERE rn = 1"""


def _both_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews as of the cutoff (``_old``) and as of now (``_new``), resolved in one pass over the line log.

    One window ranks a key's lines newest first; the ship date leads the order,
    so the first line before the cutoff is the older snapshot's.  A key's lines and
    its order are all found by the order key, so the lines are dealt by it once, for
    the window and the join alike.
    """
    w = Window.partitionBy(*V.LINE_KEY).orderBy(*[F.col(c).desc() for c in V.LINE_ORDER])
    is_old = F.col("l_shipdate") < F.lit(SNAPSHOT_CUTOFF).cast("timestamp_ntz")
    lines = V.review_lines(spark, sf_dir).where("l_orderkey IS NOT NULL").repartition("l_orderkey")
    ranked = lines.select(
        "*", F.row_number().over(w).alias("_rank"), is_old.alias("_before"),
        F.sum(is_old.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_old_rank"))
    ranked = ranked.select("*", (F.col("_rank") == 1).alias("_new"),
                           F.coalesce(F.col("_before") & (F.col("_old_rank") == 1), F.lit(False)).alias("_old"))
    # one of the two copies of a line at most; the snapshots read the same join
    kept = V.with_orders(spark, sf_dir, ranked.where("_new or _old"), keep=("_old", "_new"))
    return kept.select(*REVIEW_COLS, "_old", "_new")


def _stage_snapshot(rows: DataFrame) -> DataFrame:
    """A snapshot that is read several times, landed once.

    Rows without a review id cannot be told apart, so which of them counts in the end follows from
    their order: they keep their place and are read in it.
    """
    at = F.when(F.col("review_id").isNull(), F.monotonically_increasing_id())
    landed = stage(rows.withColumn("_at", at), "snapshot")
    lone = landed.where("review_id IS NULL").orderBy("_at")
    return landed.where("review_id IS NOT NULL").unionAll(lone).drop("_at")


def _snapshots(spark: SparkSession, sf_dir: str, land: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """The older and the newer snapshot, from what ``land`` has written of both if it is given."""
    both = _both_snapshots(spark, sf_dir)
    if land is not None:
        both = land(both)
    return both.where("_old").select(*REVIEW_COLS), both.where("_new").select(*REVIEW_COLS)


_DIFF_SQL = """
SELECT CASE WHEN o.review_id IS NULL THEN 'I' WHEN n.review_id IS NULL THEN 'D' ELSE 'U' END AS operation,
       COALESCE(n.review_id, o.review_id) AS record_id,
       o.updated_at AS old_updated_at, n.updated_at AS new_updated_at,
       o.like_count AS old_like_count, n.like_count AS new_like_count
FROM old_snap o FULL OUTER JOIN v_reviews n ON o.review_id = n.review_id
WHERE o.review_id IS NULL OR n.review_id IS NULL
   OR NOT (o.product_id IS NOT DISTINCT FROM n.product_id AND o.user_id IS NOT DISTINCT FROM n.user_id
       AND o.star IS NOT DISTINCT FROM n.star AND o.description IS NOT DISTINCT FROM n.description
       AND o.like_count IS NOT DISTINCT FROM n.like_count AND o.dislike_count IS NOT DISTINCT FROM n.dislike_count
       AND o.attachments IS NOT DISTINCT FROM n.attachments AND o.is_public IS NOT DISTINCT FROM n.is_public
       AND o.is_post IS NOT DISTINCT FROM n.is_post AND o.created_at IS NOT DISTINCT FROM n.created_at
       AND o.updated_at IS NOT DISTINCT FROM n.updated_at)"""


@register("cdc_snapshot_diff", with_views(
    _DIFF_SQL,
    "v_reviews", extra=(("old_snap", _OLD_SNAPSHOT_SQL),)))
def cdc_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return _diff_report(cdc.snapshot_diff(old, new, ["review_id"], "reviews"))


@register("cdc_digest_diff", with_views(
    _DIFF_SQL, "v_reviews", extra=(("old_snap", _OLD_SNAPSHOT_SQL),)))
def cdc_digest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I7 over the ranges of orders whose digests differ, of two written snapshots."""
    old, new = _snapshots(spark, sf_dir, lambda both: stage(both, "snapshot"))     # no row of it is chosen by its place
    orders = F.shiftright(F.substring_index("review_id", "-", 1).try_cast("long"), 6)
    return _diff_report(cdc.snapshot_diff(*digest.rows_that_may_differ(old, new, orders), ["review_id"], "reviews"))


def _diff_report(diff: DataFrame) -> DataFrame:
    ts = T.StructType([T.StructField("updated_at", T.TimestampNTZType()),
                       T.StructField("like_count", T.IntegerType())])
    o = F.from_json("old_data", ts, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})
    n = F.from_json("new_data", ts, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})
    return diff.select("operation", "record_id",
                       o.getField("updated_at").alias("old_updated_at"),
                       n.getField("updated_at").alias("new_updated_at"),
                       o.getField("like_count").alias("old_like_count"),
                       n.getField("like_count").alias("new_like_count"))


def _stream_log(spark: SparkSession, log: DataFrame) -> StreamPaths:
    """The log as export files, in as many files as its own partitions."""
    base = new_scratch_dir(spark, "change-stream")
    paths = StreamPaths(source=f"{base}/incoming", versions=f"{base}/versions",
                        mirror=f"{base}/mirror", checkpoint=f"{base}/checkpoint")
    log.select(*AUDIT_LOG.names).write.mode("overwrite").parquet(paths.source)
    return paths


def _stream_state(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    versions = spark.read.parquet(paths.versions).drop("run_id", "batch_id")
    return cdc.current_state(versions).select("table_name", "record_id", "k", "_version")


@register("stream_apply", with_views(_APPLY_SQL, "v_audit"))
def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1-I6 end to end: the log arrives as files, a stream applies them batch by batch."""
    paths = _stream_log(spark, V.v_audit(spark, sf_dir))
    run_change_stream(spark, paths, CHANGE_PAYLOAD)
    return _stream_state(spark, paths)


@register("cdc_two_checkpoints", with_views(
    f"SELECT s.*, m.n AS mirrored FROM ({_APPLY_SQL}) s CROSS JOIN (SELECT COUNT(*) AS n FROM v_audit) m", "v_audit"))
def cdc_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second stream with a new checkpoint sees old files again, and more; nothing is lost or doubled.

    The first run gets the changes before the cutoff, the second the whole
    log; ``mirrored`` counts the mirror's rows and would show a doubled id.
    """
    log = V.v_audit(spark, sf_dir)
    first = _stream_log(spark, log.filter(F.col("changed_at") < F.lit(MIRROR_CUTOFF).cast("timestamp_ntz")))
    run_change_stream(spark, first, CHANGE_PAYLOAD)
    log.select(*AUDIT_LOG.names).write.mode("append").parquet(first.source)
    second = StreamPaths(first.source, first.versions, first.mirror, f"{first.checkpoint}-2")
    run_change_stream(spark, second, CHANGE_PAYLOAD)
    n = read_mirror(spark, first.mirror).agg(F.count(F.lit(1)).alias("mirrored"))
    return _stream_state(spark, second).withColumn("mirrored", n.scalar())


_EARLY = f"changed_at < TIMESTAMP_NTZ '{MIRROR_CUTOFF}' AND audit_id % 50 <> 7"    # gaps are planted
_ISLANDS_SQL = """
SELECT MIN(audit_id) AS lo, MAX(audit_id) AS hi FROM (
  SELECT audit_id, audit_id - ROW_NUMBER() OVER (ORDER BY audit_id) AS island
  FROM (SELECT DISTINCT audit_id FROM {log}) ids) t GROUP BY island"""


@register("cdc_applied_ranges", with_views(
    _ISLANDS_SQL.format(log=f"(SELECT * FROM v_audit WHERE {_EARLY.replace('TIMESTAMP_NTZ', 'TIMESTAMP')})"), "v_audit"))
def cdc_applied_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream applied, as intervals of audit ids broken by the planted gaps."""
    paths = _stream_log(spark, V.v_audit(spark, sf_dir).where(_EARLY))
    run_change_stream(spark, paths, CHANGE_PAYLOAD)
    return read_applied(spark, paths.mirror)


@register("cdc_late_ids", with_views(
    f"SELECT s.*, (SELECT COUNT(*) FROM v_audit) AS mirrored, "
    f"(SELECT COUNT(*) FROM ({_ISLANDS_SQL.format(log='v_audit')}) i) AS guard_rows FROM ({_APPLY_SQL}) s", "v_audit"))
def cdc_late_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that come late, below the cursor, are applied once; what was applied never again.

    The first run lacks every fiftieth id and all late changes, the second sees
    the whole log, the third sees it once more.  ``mirrored`` would show a
    doubled id, ``guard_rows`` are all rows the next batch's guard reads.
    """
    log = V.v_audit(spark, sf_dir)
    first = _stream_log(spark, log.where(_EARLY))
    run_change_stream(spark, first, CHANGE_PAYLOAD)
    log.select(*AUDIT_LOG.names).write.mode("append").parquet(first.source)
    for k in (2, 3):
        again = StreamPaths(first.source, first.versions, first.mirror, f"{first.checkpoint}-{k}")
        run_change_stream(spark, again, CHANGE_PAYLOAD)
    rows = lambda df, name: df.agg(F.count(F.lit(1)).alias(name)).scalar()
    return _stream_state(spark, first).withColumns({
        "mirrored": rows(read_mirror(spark, first.mirror), "n"),
        "guard_rows": rows(read_applied(spark, first.mirror), "n")})


@register("cdc_drain", with_views(_APPLY_SQL, "v_audit"))
def cdc_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5/K6/L8 in batch form: the log applied in capped batches until the mirror holds all of it."""
    log = V.v_audit(spark, sf_dir)
    paths = _stream_log(spark, log.limit(0))
    total = log.count()
    handle = make_batch_handler(CHANGE_PAYLOAD, paths, "drain")
    drain(spark, log.select(*AUDIT_LOG.names), paths.mirror, "drain", handle,
          batch_size=max(BATCH_SIZE, -(-total // 4)))
    return _stream_state(spark, paths)


# ------------------------------------------------------- Q10 (K1, K8)
NEW_REVIEW = {
    "review_id": "walk-in-1", "product_id": PRODUCT_ID, "user_id": 4242, "star": 5,
    "description": "arrived early, works well", "is_public": True,
    "created_at": dt.datetime(2001, 8, 2), "updated_at": dt.datetime(2001, 8, 2),
}


@register("q10_append_visible", with_views(f"""
SELECT review_id, product_id, user_id, star, description, created_at FROM (
  SELECT review_id, product_id, user_id, star, description, is_public, created_at FROM v_reviews
  UNION ALL
  SELECT 'walk-in-1', {PRODUCT_ID}, 4242, CAST(5 AS SMALLINT), 'arrived early, works well', TRUE,
         TIMESTAMP '2001-08-02 00:00:00') t
WHERE product_id = {PRODUCT_ID} AND is_public
ORDER BY created_at DESC NULLS LAST, review_id LIMIT 10""", "v_reviews"))
def q10_append_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: one row is inserted and logged, the change travels, and Q8 shows it.

    The insert checks one key and writes one row and one change-log row.  The
    change stream publishes it, and the report reads the product's reviews and
    what was published for it.
    """
    base = new_scratch_dir(spark, "insert")
    schema = T.StructType([*CLEAN_REVIEWS.fields])
    new = spark.createDataFrame([tuple(NEW_REVIEW.get(f.name) for f in schema.fields)], schema)
    same_key = V.v_review_log(spark, sf_dir).filter(F.col("review_id") == NEW_REVIEW["review_id"])
    row = load.rows_to_insert(new, same_key, ["review_id"], ["review_id"])
    row.coalesce(1).write.parquet(f"{base}/reviews")
    inserted = read_log(spark, f"{base}/reviews", schema)
    change = cdc.diff_to_log(cdc.snapshot_diff(inserted.limit(0), inserted, ["review_id"], "reviews"),
                             changed_at="2001-08-02 00:00:00")
    layout = SP.ServeLayout(f"{base}/serve")
    change.coalesce(1).write.parquet(layout.path("incoming"))
    changes.start(spark, layout.path("incoming"), layout.checkpoint,
                  SP.make_serving_handler(layout, run_id_of(spark, layout.checkpoint), AS_OF, refresh_every=None))
    columns = ["review_id", "product_id", "user_id", "star", "description", "is_public", "created_at"]
    published = SP.current_reviews(spark, layout).select(*columns).withColumn("is_public", F.col("is_public") == 1)
    current = V.v_reviews(spark, sf_dir, product_id=PRODUCT_ID).select(*columns)
    return A.latest_public(current.unionByName(published), PRODUCT_ID)


# ------------------------------------------------------- full-image round trip (I7 -> P17/P18/P11 -> D3)
@register("cdc_snapshot_apply", with_views(
    "SELECT * EXCLUDE (_version) FROM s_reviews", "v_reviews", "v_products", extra=_SERVED[1:]))
def cdc_snapshot_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish an old snapshot, derive the change log to the new one, apply it.

    The change log carries full JSON row images (as a trigger would write),
    so this runs the real decode -> route -> publish path; the current view
    afterwards must equal publishing the new snapshot directly.
    """
    old, new = _snapshots(spark, sf_dir)
    products = V.v_products(spark, sf_dir)
    changes_ = cdc.diff_to_log(cdc.snapshot_diff(old, new, ["review_id"], "reviews"),
                               changed_at=SNAPSHOT_CUTOFF)
    base = publish_reviews(old, products, version=0)
    versions = base.unionByName(cdc.review_versions(changes_, products))
    return latest_per_key(versions, ["review_id"], ["_version"]).drop("_version")


# ------------------------------------------------------- change-log quality
@register("cdc_log_check", with_views("""
SELECT table_name, operation,
       CASE WHEN table_name IS NULL OR record_id IS NULL THEN 'missing_key'
            WHEN operation IS NULL OR operation NOT IN ('I', 'U', 'D') THEN 'bad_operation'
            ELSE 'valid' END AS outcome,
       COUNT(*) AS row_count
FROM v_audit GROUP BY 1, 2, 3""", "v_audit"))
def cdc_log_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = V.v_audit(spark, sf_dir)
    return (log.groupBy("table_name", "operation",
                        F.coalesce(cdc.log_problems(log), F.lit("valid")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("row_count")))


_BAD_LOG_SQL = """
SELECT event_id AS audit_id, CASE WHEN event_id % 23 = 1 THEN NULL ELSE 'reviews' END AS table_name,
  CASE WHEN event_id % 23 = 2 THEN 'X' WHEN event_id % 23 = 3 THEN NULL ELSE 'U' END AS operation,
  CAST(user_id AS VARCHAR) AS record_id,
  CASE event_id % 23 WHEN 4 THEN '{"review_id": "cut' WHEN 5 THEN '[1, 2]' WHEN 6 THEN ''
    WHEN 7 THEN '{"product_id": "abc", "star": 1}' WHEN 8 THEN '{"star": 2}'
    ELSE '{"product_id": ' || user_id || ', "star": ' || (1 + event_id % 5) || ', "is_public": '
      || CASE event_id % 4 WHEN 0 THEN '"t"' WHEN 1 THEN '1' WHEN 2 THEN 'true' ELSE '"yes"' END
      || ', "created_at": "2024-02-03T04:05:06' || CASE event_id % 3 WHEN 0 THEN '+03:30' WHEN 1 THEN 'Z' ELSE '' END
      || '"}' END AS new_data
FROM events"""


def _bad_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log from ``events`` with planted rows that cannot be read."""
    e = read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts"])
    k, user = F.col("event_id") % 23, F.col("user_id").cast("string")
    flag = (F.when(F.col("event_id") % 4 == 0, '"t"').when(F.col("event_id") % 4 == 1, "1")
             .when(F.col("event_id") % 4 == 2, "true").otherwise('"yes"'))
    zone = F.when(F.col("event_id") % 3 == 0, "+03:30").when(F.col("event_id") % 3 == 1, "Z").otherwise("")
    good = F.concat(F.lit('{"product_id": '), user, F.lit(', "star": '), (1 + F.col("event_id") % 5).cast("string"),
                    F.lit(', "is_public": '), flag, F.lit(', "created_at": "2024-02-03T04:05:06'), zone, F.lit('"}'))
    image = (F.when(k == 4, '{"review_id": "cut').when(k == 5, "[1, 2]").when(k == 6, "")
              .when(k == 7, '{"product_id": "abc", "star": 1}').when(k == 8, '{"star": 2}').otherwise(good))
    return e.select(F.col("event_id").alias("audit_id"), F.when(k != 1, "reviews").alias("table_name"),
                    F.when(k == 2, "X").when(k != 3, "U").alias("operation"), user.alias("record_id"),
                    F.lit(None).cast("string").alias("old_data"), image.alias("new_data"),
                    F.col("ts").alias("changed_at"))


_JUDGED_SQL = """
SELECT *, CASE WHEN table_name IS NULL THEN 'missing_key'
    WHEN operation IS NULL OR operation <> 'U' THEN 'bad_operation'
    WHEN audit_id % 23 IN (4, 5, 6) THEN 'bad_image'
    WHEN audit_id % 23 IN (7, 8) THEN 'bad_product_id' END AS reason FROM bad_log"""


@register("cdc_rejects", with_views("""
SELECT 'rejected' AS outcome, reason AS detail, COUNT(*) AS row_count, CAST(NULL AS INTEGER) AS is_public,
  CAST(NULL AS TIMESTAMP) AS created_at
FROM judged WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT 'current', CAST(1 + audit_id % 5 AS VARCHAR), COUNT(*), CASE WHEN audit_id % 4 < 3 THEN 1 ELSE 0 END,
  TIMESTAMP '2024-02-03 04:05:06'
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY record_id ORDER BY audit_id DESC) AS rn
      FROM judged WHERE reason IS NULL) newest
WHERE rn = 1 GROUP BY ALL
UNION ALL
SELECT 'mirrored', NULL, COUNT(*), NULL, NULL FROM bad_log""",
    extra=(("bad_log", _BAD_LOG_SQL), ("judged", _JUDGED_SQL))))
def cdc_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C15/P12/P13/P17 in the serving stream: unreadable rows go aside and replace nothing."""
    layout = SP.ServeLayout(new_scratch_dir(spark, "serve"))
    _bad_log(spark, sf_dir).write.parquet(layout.path("incoming"))
    changes.start(spark, layout.path("incoming"), layout.checkpoint,
                  SP.make_serving_handler(layout, run_id_of(spark, layout.checkpoint), AS_OF, refresh_every=None))
    none = F.lit(None)
    rejects = spark.read.parquet(layout.rejects).groupBy(F.col("reject_reason").alias("detail")).agg(
        F.count(F.lit(1)).alias("row_count")).select(
        F.lit("rejected").alias("outcome"), "detail", "row_count", none.cast("int").alias("is_public"),
        none.cast("timestamp_ntz").alias("created_at"))
    now = (SP.current_reviews(spark, layout)
           .groupBy(F.col("star").cast("string").alias("detail"), F.col("is_public").cast("int").alias("is_public"),
                    "created_at").agg(F.count(F.lit(1)).alias("row_count"))
           .select(F.lit("current").alias("outcome"), "detail", "row_count", "is_public", "created_at"))
    mirrored = read_mirror(spark, layout.mirror).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("mirrored").alias("outcome"), none.cast("string").alias("detail"), "row_count",
        none.cast("int").alias("is_public"), none.cast("timestamp_ntz").alias("created_at"))
    return rejects.unionByName(now).unionByName(mirrored)


# ------------------------------------------------------- the whole serve side
def _write_changes(diff: DataFrame, source: str, first_id: int = 1) -> None:
    """Add a snapshot diff to the change log that a stream reads; what the diff has shuffled is freed then."""
    with freed_shuffles(diff.sparkSession):
        cdc.diff_to_log(diff, changed_at=SNAPSHOT_CUTOFF, first_id=first_id).write.mode("append").parquet(source)


def _bootstrapped(spark: SparkSession, sf_dir: str, marts: bool = False) -> tuple[SP.ServeLayout, DataFrame, DataFrame]:
    """A serve layer with the older snapshot, and both snapshots."""
    layout = SP.ServeLayout(new_scratch_dir(spark, "serve"))
    old, new = _snapshots(spark, sf_dir, _stage_snapshot)       # each is read several times
    SP.bootstrap(spark, layout, V.v_products(spark, sf_dir), old, as_of=AS_OF, marts=marts)
    return layout, old, new


def _run_serving(spark: SparkSession, sf_dir: str, marts: bool = False) -> SP.ServeLayout:
    """Bootstrap from the old snapshot and stream the change log to the new one; marts where they are read."""
    layout, old, new = _bootstrapped(spark, sf_dir, marts)
    source = layout.path("incoming")
    _write_changes(cdc.snapshot_diff(old, new, ["review_id"], "reviews"), source)
    SP.run_serving_stream(spark, layout, source, as_of=AS_OF, refresh_every=None, marts=marts)  # once, at its end
    return layout


@register("serve_stream_reviews", with_views(
    "SELECT * EXCLUDE (_version) FROM s_reviews", "v_reviews", "v_products", extra=_SERVED[1:]))
def serve_stream_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SP.current_reviews(spark, _run_serving(spark, sf_dir)).drop("_version")


@register("serve_stream_top_vendors", with_views(
    "SELECT vendor_id, vendor_name, weekly_sales, rating_average FROM dm1 "
    "ORDER BY weekly_sales DESC, vendor_id LIMIT 10", "v_reviews", "v_products",
    extra=_SERVED + (("dm1", _TOP_VENDORS_SQL),)))
def serve_stream_top_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.read_top_vendors(SP.read_mart(spark, _run_serving(spark, sf_dir, marts=True), "dm_top_vendors"))


@register("serve_marts", with_views("""
SELECT 'dm_top_vendors' AS mart, COUNT(*) AS row_count, CAST(SUM(weekly_sales) AS BIGINT) AS total FROM dm1
UNION ALL SELECT 'dm_free_shipping_analysis', COUNT(*), CAST(SUM(sales_count_week) AS BIGINT) FROM s_products
UNION ALL SELECT 'dm_trending_categories', COUNT(*), CAST(SUM(monthly_reviews) AS BIGINT) FROM dm3
UNION ALL SELECT 'dm_review_engagement', COUNT(*), CAST(SUM(like_count) AS BIGINT) FROM dm4""",
    "v_reviews", "v_products", extra=_SERVED + (("dm1", _TOP_VENDORS_SQL),) + _TRENDING_CTES
    + (("dm4", _ENGAGEMENT_SQL),)))
def serve_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: all four stored marts, refreshed by the stream's changes when it has ended."""
    layout = _run_serving(spark, sf_dir, marts=True)
    sums = {"dm_top_vendors": "weekly_sales", "dm_free_shipping_analysis": "sales_count_week",
            "dm_trending_categories": "monthly_reviews", "dm_review_engagement": "like_count"}
    out = None
    for name in SP.MART_NAMES:
        part = SP.read_mart(spark, layout, name).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(sums[name]).cast("bigint").alias("total")).select(
            F.lit(name).alias("mart"), "row_count", "total")
        out = part if out is None else out.unionByName(part)
    return out


@register("serve_stream_products", with_views(
    "SELECT * EXCLUDE (_version) REPLACE (CAST(rating_average AS DOUBLE) AS rating_average, "
    "CAST(vendor_score AS DOUBLE) AS vendor_score) FROM s_products", "v_products", extra=_SERVED[:1]))
def serve_stream_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1, product branch: every product changed after the bootstrap, and changed back by the stream."""
    layout = SP.ServeLayout(new_scratch_dir(spark, "serve"))
    now = V.v_products(spark, sf_dir).select(*[c for c in PRODUCT_IMAGE.names if c != "created_at"])
    old = now.withColumns({"price": F.col("price") + 1, "stock": F.lit(None).cast("int"),
                           "is_available": ~F.col("is_available"), "vendor_name": F.lit("before")})
    SP.bootstrap(spark, layout, old, V.v_reviews(spark, sf_dir).select(*REVIEW_COLS).limit(0), as_of=AS_OF,
                 marts=False)
    source = layout.path("incoming")
    _write_changes(cdc.snapshot_diff(old, now, ["product_id"], "products"), source)
    SP.run_serving_stream(spark, layout, source, as_of=AS_OF, marts=False)
    return _dec_to_double(SP.current_products(spark, layout).drop("_version"))


@register("serve_stream_deletes", with_views(f"""
SELECT review_id, product_id, like_count, 'kept' AS view FROM s_reviews
UNION ALL SELECT review_id, product_id, like_count, 'applied' FROM s_reviews WHERE product_id % 3 <> 0""",
    "v_reviews", "v_products", extra=_SERVED[1:]))
def serve_stream_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: reviews of every third product are deleted; the default view keeps them, the other drops them."""
    layout = SP.ServeLayout(new_scratch_dir(spark, "serve"))
    now = V.v_reviews(spark, sf_dir).select(*REVIEW_COLS)
    SP.bootstrap(spark, layout, V.v_products(spark, sf_dir), now, as_of=AS_OF, marts=False)
    source = layout.path("incoming")
    _write_changes(cdc.snapshot_diff(now, now.where("product_id % 3 <> 0"), ["review_id"], "reviews"), source)
    SP.run_serving_stream(spark, layout, source, as_of=AS_OF, marts=False)
    SP.compact_serve(spark, layout)
    columns = ["review_id", "product_id", "like_count"]
    return SP.current_reviews(spark, layout).select(*columns, F.lit("kept").alias("view")).unionByName(
        SP.current_reviews(spark, layout, apply_deletes=True).select(*columns, F.lit("applied").alias("view")))


@register("serve_rebootstrap", with_views(
    "SELECT * EXCLUDE (_version) FROM s_reviews", "v_reviews", "v_products", extra=_SERVED[1:]))
def serve_rebootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: changes are streamed, then a full sync of the newer snapshot replaces the base.

    The old base has reviews under other months and the stream has undone the
    newer ones; the sync, at the log's high-water mark, outranks both.
    """
    layout, old, new = _bootstrapped(spark, sf_dir)
    source = layout.path("incoming")
    undo = old.withColumns({"like_count": F.col("like_count") + 100, "created_at": F.lit("1990-01-01").cast("timestamp_ntz")})
    _write_changes(cdc.snapshot_diff(old, undo, ["review_id"], "reviews"), source)
    SP.run_serving_stream(spark, layout, source, as_of=AS_OF, marts=False)
    SP.bootstrap(spark, layout, V.v_products(spark, sf_dir), old, as_of=AS_OF)      # there is a base: nothing happens
    SP.bootstrap(spark, layout, V.v_products(spark, sf_dir), new, as_of=AS_OF,
                 high_water=SP.high_water(read_mirror(spark, layout.mirror)), again=True, marts=False)
    return SP.current_reviews(spark, layout).drop("_version")


@register("serve_compacted", with_views(
    "SELECT * EXCLUDE (_version) FROM s_reviews", "v_reviews", "v_products", extra=_SERVED[1:]))
def serve_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 in the pipeline: the stream's batches folded into a base of one row per key."""
    layout = _run_serving(spark, sf_dir)
    SP.compact_serve(spark, layout)
    return SP.current_reviews(spark, layout).drop("_version")


# ------------------------------------------------------- marts by deltas
# Products move to another vendor and some move back; their sales change; then reviews change.
_MOVED = "vendor_id % 7 + 1"
_DELTA_PRODUCTS_SQL = f"""
SELECT * REPLACE (CASE WHEN product_id % 5 = 0 AND product_id % 10 <> 0 THEN {_MOVED} ELSE vendor_id END AS vendor_id,
  CAST(CASE WHEN product_id % 3 = 0 THEN sales_count_week + 3 ELSE sales_count_week END AS INTEGER) AS sales_count_week)
FROM v_products"""
_DELTA_SERVED = (("l_products", _DELTA_PRODUCTS_SQL), ("s_products", Q.served_products("l_products")),
                 ("s_reviews", Q.served_reviews("v_reviews", "l_products")))


def _refreshed_by_deltas(spark: SparkSession, sf_dir: str) -> SP.ServeLayout:
    """Marts of the older snapshot, brought up by three streams of changes, a refresh after each."""
    layout, old, new = _bootstrapped(spark, sf_dir, marts=True)
    products = stage(V.v_products(spark, sf_dir).select(*[c for c in PRODUCT_IMAGE.names if c != "created_at"]), "snapshot")
    sales = F.when(F.col("product_id") % 3 == 0, F.col("sales_count_week") + 3).otherwise(F.col("sales_count_week"))
    moved = lambda cond: products.withColumns({
        "vendor_id": F.when(F.expr(cond), F.expr(_MOVED)).otherwise(F.col("vendor_id")),
        "sales_count_week": sales.cast("int")})
    away, final = moved("product_id % 5 = 0"), moved("product_id % 5 = 0 AND product_id % 10 <> 0")
    diffs = [cdc.snapshot_diff(products, away, ["product_id"], "products"),
             cdc.snapshot_diff(old, new, ["review_id"], "reviews"),
             cdc.snapshot_diff(away, final, ["product_id"], "products")]
    for k, diff in enumerate(diffs):
        _write_changes(diff, layout.path("incoming"), first_id=1 + (k << 48))
        SP.run_serving_stream(spark, layout, layout.path("incoming"), as_of=AS_OF, refresh_every=None)
    return layout


@register("serve_delta_vendors", with_views("SELECT * FROM dm1", "v_reviews", "v_products",
                                            extra=_DELTA_SERVED + (("dm1", _TOP_VENDORS_SQL),)))
def serve_delta_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 after refreshes by deltas: vendors that lost their lowest product, or gained one, included."""
    return SP.read_mart(spark, _refreshed_by_deltas(spark, sf_dir), "dm_top_vendors").drop("computed_at")


@register("serve_delta_trending", with_views("SELECT * FROM dm3", "v_reviews", "v_products",
                                             extra=_DELTA_SERVED + _TRENDING_CTES))
def serve_delta_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 after refreshes by deltas, from the review days of the window."""
    return SP.read_mart(spark, _refreshed_by_deltas(spark, sf_dir), "dm_trending_categories").drop("computed_at")


@register("serve_delta_grains", with_views("""
SELECT 'product' AS grain, CAST(product_id AS VARCHAR) AS key, vendor_id AS a, CAST(sales_count_week AS BIGINT) AS b,
       CAST(rating_average AS DOUBLE) AS c, CAST(NULL AS DATE) AS d FROM s_products
UNION ALL SELECT 'review', review_id, like_count, CAST(description_length AS BIGINT), CAST(star AS DOUBLE), created_day
FROM dm4""", "v_reviews", "v_products", extra=_DELTA_SERVED + (("dm4", _ENGAGEMENT_SQL),)))
def serve_delta_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 and M4 after refreshes by deltas, row by row."""
    layout = _refreshed_by_deltas(spark, sf_dir)
    p, r = (SP.read_mart(spark, layout, n) for n in ("dm_free_shipping_analysis", "dm_review_engagement"))
    return p.select(F.lit("product").alias("grain"), F.col("product_id").cast("string").alias("key"),
                    F.col("vendor_id").alias("a"), F.col("sales_count_week").cast("bigint").alias("b"),
                    F.col("rating_average").cast("double").alias("c"), F.lit(None).cast("date").alias("d")).unionAll(
        r.select(F.lit("review"), "review_id", "like_count", F.col("description_length").cast("bigint"),
                 F.col("star").cast("double"), "created_day"))


# ------------------------------------------------------- raw exports as files
def _exported(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The raw product and review rows as header CSV files: quoted newlines, quotes and all."""
    base = new_scratch_dir(spark, "csv-export")
    for name, rows, columns in (("products", R.raw_products(spark, sf_dir), PRODUCT_CSV_COLUMNS),
                                ("reviews", R.raw_reviews(spark, sf_dir), REVIEW_CSV_COLUMNS)):
        with freed_shuffles(spark):
            (rows.select(*[F.col(f"`{c}`") for c, _, _ in columns]).write.option("header", True)
             .option("quote", '"').option("escape", '"').csv(f"{base}/{name}"))
    return f"{base}/products", f"{base}/reviews"


@register("load_csv_products", with_views(
    "SELECT * EXCLUDE (reject_reason) REPLACE (CAST(rating_average AS DOUBLE) AS rating_average, "
    "CAST(vendor_score AS DOUBLE) AS vendor_score) FROM a_products WHERE reject_reason IS NULL",
    "v_products", "v_review_log", extra=_CLEAN_CTES))
def load_csv_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products export, read back from its files."""
    products, _ = _exported(spark, sf_dir)
    return _dec_to_double(clean.accepted(clean.assess_products(read_products_csv(spark, products))).select(
        *[f.name for f in CLEAN_PRODUCTS.fields]))


@register("load_csv_reviews", with_views(
    f"SELECT {_REVIEW_OUT_SQL} FROM a_reviews WHERE reject_reason IS NULL",
    "v_products", "v_review_log", extra=_CLEAN_CTES))
def load_csv_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews export, its records found in parallel."""
    _, reviews = _exported(spark, sf_dir)
    return clean.accepted(clean.assess_reviews(read_reviews_csv(spark, reviews))).select(*REVIEW_COLS)


@register("load_csv_counts", with_views("""
SELECT 'products' AS table_name, 'loaded' AS outcome, COUNT(DISTINCT product_id) AS row_count
FROM a_products WHERE reject_reason IS NULL
UNION ALL SELECT 'products', 'ignored_duplicate', COUNT(*) - COUNT(DISTINCT product_id)
FROM a_products WHERE reject_reason IS NULL
UNION ALL SELECT 'products', reject_reason, COUNT(*) FROM a_products WHERE reject_reason IS NOT NULL GROUP BY 2
UNION ALL SELECT 'reviews', 'loaded', COUNT(DISTINCT review_id) FROM known
UNION ALL SELECT 'reviews', 'ignored_duplicate', COUNT(*) - COUNT(DISTINCT review_id) FROM known
UNION ALL SELECT 'reviews', COALESCE(reject_reason, 'orphan_product'), COUNT(*) FROM a_reviews
WHERE reject_reason IS NOT NULL OR product_id NOT IN (SELECT product_id FROM a_products WHERE reject_reason IS NULL)
GROUP BY 2""", "v_products", "v_review_log", extra=_CLEAN_CTES + (("known", """
SELECT * FROM a_reviews WHERE reject_reason IS NULL
AND product_id IN (SELECT product_id FROM a_products WHERE reject_reason IS NULL)"""),)))
def load_csv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole initial load of both exports, counted by outcome."""
    products, reviews = _exported(spark, sf_dir)
    out = initial_load(spark, products, reviews, new_scratch_dir(spark, "csv-loaded"))
    return spark.createDataFrame([(t, o, n) for t, counts in out.items() for o, n in counts.items()],
                                 "table_name string, outcome string, row_count long")


# The mart reports as (build, read): what their keys do in one go.
MART_READS = {
    "dm_top_vendors_read": (_top_vendors, marts.read_top_vendors),
    "dm_free_shipping_read": (lambda spark, sf_dir: marts.build_free_shipping(_served_products(spark, sf_dir)),
                              marts.read_free_shipping),
    "dm_trending_read": (_trending, marts.read_trending),
    "dm_engagement_read": (_engagement, marts.read_engagement),
}
