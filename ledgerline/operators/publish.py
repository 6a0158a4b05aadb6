"""Clean layer -> serve layer (P9-P16, J2, K3 columns).

The serve layer is NULL-free: numbers default to 0, text to '', flags become
0/1, timestamps default to 2000-01-01 and are cut to whole seconds.  Every
row carries ``_version``; a current view is the newest version per key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import serve as S
from ..schemas import DIM_PRODUCTS, FACT_REVIEWS
from .joins import lookup

# Numeric and text columns of dim_products and their stand-in for "missing".
PRODUCT_DEFAULTS = {
    "name": "", "price": 0, "stock": 0, "sales_count_week": 0, "rating_average": 0,
    "rating_count": 0, "category_id": 0, "category_title": "", "status_title": "",
    "vendor_id": 0, "vendor_name": "", "vendor_identifier": "", "vendor_status_id": 0,
    "vendor_status_title": "", "vendor_score": 0, "vendor_owner_id": 0,
    "vendor_owner_city": "", "vendor_province_id": 0, "vendor_city_id": 0,
}
PRODUCT_FLAGS = ("is_free_shipping", "is_available", "is_saleable",
                 "vendor_has_delivery", "published")

REVIEW_DEFAULTS = {"user_id": 0, "star": 0, "description": "", "like_count": 0,
                   "dislike_count": 0}

#: Columns that follow from ``created_at``.
CREATED_PARTS = {"created_hour": S.created_hour, "created_day": S.created_day, "created_month": S.created_month}


def fill_defaults(df: DataFrame, defaults: Mapping[str, object],
                  timestamps: Iterable[str] = ()) -> DataFrame:
    """Replace NULLs by per-column defaults; ``timestamps`` get the serve-layer rule."""
    repl: dict[str, Column] = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()
                               if c in df.columns}
    for c in timestamps:
        repl[c] = S.ts_or_default(c)
    return df.withColumns(repl) if repl else df


def _version(version: Column | str | int | None) -> Column:
    if version is None:
        return F.lit(0).cast("bigint")
    if isinstance(version, int):
        return F.lit(version).cast("bigint")
    return (F.col(version) if isinstance(version, str) else version).cast("bigint")


def publish_products(products: DataFrame, version: Column | str | int | None = None,
                     extra: Iterable[str] = ()) -> DataFrame:
    """Typed clean products -> dim_products rows.

    ``version`` is the change's ``audit_id`` for CDC rows and 0 for the
    bootstrap snapshot, so versions are deterministic and never tie (T7).
    ``extra`` columns are carried along as they are.
    """
    cols = []
    for f in DIM_PRODUCTS.fields:
        n = f.name
        if n == "product_id":
            e = F.col(n)
        elif n == "preparation_days":
            e = S.preparation_days(n)
        elif n in PRODUCT_FLAGS:
            e = S.flag01(n)
        elif n == "updated_at":
            e = S.ts_or_default(n)
        elif n == "_version":
            e = _version(version)
        else:
            e = S.or_default(n, PRODUCT_DEFAULTS[n])
        cols.append(e.cast(f.dataType).alias(n))
    return products.select(*cols, *extra)


def publish_reviews(reviews: DataFrame, products: DataFrame | None = None,
                    version: Column | str | int | None = None, extra: Iterable[str] = ()) -> DataFrame:
    """P11/P14/P16 + J2: typed clean reviews -> fact_reviews rows.

    ``vendor_id`` is looked up from ``products`` as of publish time (T19); a
    review whose product is unknown, or has no vendor, gets vendor 0.  The
    lookup side is just (product_id, vendor_id); AQE broadcasts it when it is
    small and uses a shuffle join otherwise.  Rows are published before the
    lookup, so that a shuffle moves their short form.
    """
    extra = list(extra)
    known = "vendor_id" in reviews.columns
    cols = []
    for f in FACT_REVIEWS.fields:
        n = f.name
        if n in CREATED_PARTS or (n == "vendor_id" and not known):
            continue
        elif n in ("review_id", "product_id"):
            e = F.col(n)
        elif n == "vendor_id":
            e = F.coalesce(F.col(n), F.lit(0))
        elif n == "has_attachment":
            e = S.has_attachment("attachments")
        elif n == "is_public":
            e = S.flag01(n)
        elif n in ("created_at", "updated_at"):
            e = S.ts_or_default(n)
        elif n == "_version":
            e = _version(version)
        else:
            e = S.or_default(n, REVIEW_DEFAULTS[n])
        cols.append(e.cast(f.dataType).alias(n))
    out = reviews.select(*cols, *extra)
    if not known:
        out = (out.withColumn("vendor_id", F.lit(0).cast("bigint")) if products is None
               else lookup(out, products, "product_id", "vendor_id", default=0))
    return with_created_parts(out).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_REVIEWS.fields], *extra)


def with_created_parts(rows: DataFrame) -> DataFrame:
    """Published rows with those of ``CREATED_PARTS`` that they lack: shuffles need not carry them."""
    kinds = {f.name: f.dataType for f in FACT_REVIEWS.fields}
    return rows.withColumns({n: of("created_at").cast(kinds[n]) for n, of in CREATED_PARTS.items() if n not in rows.columns})
