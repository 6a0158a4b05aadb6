"""Fixed schemas of every layer (nothing is inferred or evolved).

Clean layer: typed, NULL-preserving (the row store).  Serve layer: typed,
NULL-free, versioned (the column store).  Plus the change log and its mirror.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, SH, B, TI = (T.StringType(), T.LongType(), T.IntegerType(), T.ShortType(),
                      T.BooleanType(), T.ByteType())
TS = T.TimestampNTZType()
DEC42 = T.DecimalType(4, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw CSV header -> clean column, with the parser kind, for the
# product and review exports (column names as published in the raw files).
PRODUCT_CSV_COLUMNS = (
    ("_id", "product_id", "bigint"),
    ("name", "name", "text"),
    ("price", "price", "bigint"),
    ("stock", "stock", "int"),
    ("sales_count_week", "sales_count_week", "int"),
    ("rating_average", "rating_average", "decimal"),
    ("rating_count", "rating_count", "int"),
    ("preparationDays", "preparation_days", "int"),
    ("categoryId", "category_id", "int"),
    ("categoryTitle", "category_title", "text"),
    ("status_title", "status_title", "text"),
    ("isFreeShipping", "is_free_shipping", "bool"),
    ("IsAvailable", "is_available", "bool"),
    ("IsSaleable", "is_saleable", "bool"),
    ("vendor_id", "vendor_id", "bigint"),
    ("vendor_name", "vendor_name", "text"),
    ("vendor_identifier", "vendor_identifier", "text"),
    ("vendor_status_id", "vendor_status_id", "int"),
    ("vendor_status_title", "vendor_status_title", "text"),
    ("vendor_score", "vendor_score", "decimal"),
    ("vendor_owner_id", "vendor_owner_id", "bigint"),
    ("vendor_owner_city", "vendor_owner_city", "text"),
    ("vendor_provinceId", "vendor_province_id", "int"),
    ("vendor_cityId", "vendor_city_id", "int"),
    ("vendor_freeShippingToIran", "vendor_free_shipping_to_iran", "bigint"),
    ("vendor_freeShippingToSameCity", "vendor_free_shipping_to_same_city", "bigint"),
    ("vendor_has_delivery", "vendor_has_delivery", "bool"),
    ("published", "published", "bool"),
)

REVIEW_CSV_COLUMNS = (
    ("_id", "review_id", "text"),
    ("productId", "product_id", "bigint"),
    ("user_id", "user_id", "bigint"),
    ("star", "star", "smallint"),
    ("description", "description", "text"),
    ("likeCount", "like_count", "int0"),
    ("dislikeCount", "dislike_count", "int0"),
    ("attachments", "attachments", "text"),
    ("isPublic", "is_public", "bool"),
    ("isPost", "is_post", "bool"),
    ("createdAt", "created_at", "ts"),
    ("updatedAt", "updated_at", "ts"),
)

# Text length limits of the row store (VARCHAR(n)).
TEXT_LIMITS = {
    "category_title": 200, "status_title": 100, "vendor_identifier": 100,
    "vendor_status_title": 100, "vendor_owner_city": 100, "review_id": 50,
}

_KIND_TYPE = {"bigint": L, "int": I, "int0": I, "smallint": SH, "decimal": DEC42,
              "text": S, "bool": B, "ts": TS}

CLEAN_PRODUCTS = _struct(*[(n, _KIND_TYPE[k]) for _, n, k in PRODUCT_CSV_COLUMNS])
CLEAN_REVIEWS = _struct(*[(n, _KIND_TYPE[k]) for _, n, k in REVIEW_CSV_COLUMNS])

# The row-store products table also has load-time created_at/updated_at
# columns (not in the export); change images carry them.
PRODUCT_IMAGE = _struct(*[(f.name, f.dataType) for f in CLEAN_PRODUCTS.fields],
                        ("created_at", TS), ("updated_at", TS))

DIM_PRODUCTS = _struct(
    ("product_id", L), ("name", S), ("price", L), ("stock", I), ("sales_count_week", I),
    ("rating_average", DEC42), ("rating_count", I), ("preparation_days", I),
    ("category_id", I), ("category_title", S), ("status_title", S),
    ("is_free_shipping", TI), ("is_available", TI), ("is_saleable", TI),
    ("vendor_id", L), ("vendor_name", S), ("vendor_identifier", S),
    ("vendor_status_id", I), ("vendor_status_title", S), ("vendor_score", DEC42),
    ("vendor_owner_id", L), ("vendor_owner_city", S), ("vendor_province_id", I),
    ("vendor_city_id", I), ("vendor_has_delivery", TI), ("published", TI),
    ("updated_at", TS), ("_version", L),
)

FACT_REVIEWS = _struct(
    ("review_id", S), ("product_id", L), ("vendor_id", L), ("user_id", L), ("star", SH),
    ("description", S), ("like_count", I), ("dislike_count", I), ("has_attachment", TI),
    ("is_public", TI), ("created_at", TS), ("created_hour", TI), ("created_day", T.DateType()),
    ("updated_at", TS), ("_version", L), ("created_month", S),
)

# The stored version logs also keep deletes, as rows marked ``_deleted``.
DIM_PRODUCTS_LOG = T.StructType([*DIM_PRODUCTS.fields, T.StructField("_deleted", TI, True)])
FACT_REVIEWS_LOG = T.StructType([*FACT_REVIEWS.fields, T.StructField("_deleted", TI, True)])

AUDIT_LOG = _struct(
    ("audit_id", L), ("table_name", S), ("operation", S), ("record_id", S),
    ("old_data", S), ("new_data", S), ("changed_at", TS),
)

AUDIT_MIRROR = _struct(
    ("audit_id", L), ("table_name", S), ("operation", S), ("record_id", S),
    ("changed_at", TS), ("loaded_at", T.TimestampType()), ("run_id", S), ("batch_id", L),
)
