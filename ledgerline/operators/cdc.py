"""Change data: decode, route, apply, mirror and snapshot diff.

A change log row carries a table name, an operation (I/U/D), the record key
as text and JSON before/after images.  Applying a set of changes never
mutates anything: each I/U becomes a new version row (``_version`` =
``audit_id``, so versions are total and deterministic), the mirror records
which log rows were applied, and a current view is the newest version per
key.  Applying the same changes twice, in any split into batches or in any
arrival order, gives the same current view.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse, serve
from ..schemas import CLEAN_REVIEWS, PRODUCT_IMAGE
from .asof import as_of
from .joins import drop_matching
from .publish import CREATED_PARTS, publish_products, publish_reviews, with_created_parts
from .versions import latest_per_key

OPERATIONS = ("I", "U", "D")
IMAGE = "map<string,string>"
PARSED = "_image"
TEXTS = "_texts"
IMAGES = {"products": PRODUCT_IMAGE, "reviews": CLEAN_REVIEWS}
UPSERTS = ("I", "U")
STATE_KEYS = ("table_name", "record_id")


def log_problems(log: DataFrame) -> Column:
    """Why a log row is invalid (NULL when it is valid)."""
    return (F.when(F.col("table_name").isNull() | F.col("record_id").isNull(), F.lit("missing_key"))
             .when(~F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False)), F.lit("bad_operation")))


def with_image(log: DataFrame) -> DataFrame:
    """Log rows with ``_image``: the after image, or the before image when there is none, as name -> value text.

    NULL unless a JSON object.  Every step reads the image from this column, so
    rows that were given it keep it, and a text is parsed once however many steps
    and values are taken from it.
    """
    if PARSED in log.columns:
        return log
    return log.withColumn(PARSED, F.from_json(F.coalesce(F.col("new_data"), F.col("old_data")), IMAGE))


def with_texts(rows: DataFrame) -> DataFrame:
    """Rows of the routed tables with the values of their image as a struct of texts in place of ``_image``.

    What to write when rows are read more than once: a column a value is short in
    Parquet and read apart, where a map repeats the names in every row.  A value
    that only the other table has is NULL.
    """
    tables: dict[str, list[str]] = {}
    for table, image in IMAGES.items():
        for n in image.names:
            tables.setdefault(n, []).append(table)
    text = lambda n: F.try_element_at(PARSED, F.lit(n))
    texts = F.struct(*[(text(n) if len(some) == len(IMAGES) else F.when(F.col("table_name") == some[0], text(n))).alias(n)
                       for n, some in tables.items()])
    return with_image(rows).withColumn(TEXTS, texts).drop(PARSED)


def _with_product(rows: DataFrame) -> DataFrame:
    """Rows with ``_product``, the product id of their image; its text is looked up once, in a step of its own."""
    if TEXTS in rows.columns:
        return rows.withColumn("_product", _long(F.col(f"{TEXTS}.product_id")))
    text = with_image(rows).withColumn("_product", F.try_element_at(PARSED, F.lit("product_id")))
    return text.withColumn("_product", _long(F.col("_product")))


def image_problems() -> Column:
    """Why the image of an insert or update cannot be published (NULL when it can); reads ``_image`` and ``_product``.

    A row image must be a JSON object, and a product id must be readable: from
    the image, or for products from the record key.
    """
    upsert = F.col("operation").isin(*UPSERTS)
    product = F.col("_product")
    return (F.when(upsert & F.col(PARSED).isNull(), F.lit("bad_image"))
             .when(upsert & (F.col("table_name") == "products")
                   & F.coalesce(product, _long(F.col("record_id"))).isNull(), F.lit("bad_product_id"))
             .when(upsert & (F.col("table_name") == "reviews") & product.isNull(), F.lit("bad_product_id")))


def judge(log: DataFrame, routed: bool = True) -> DataFrame:
    """Log rows with ``reject_reason`` and their ``_image``; ``routed`` rows must fit the product or review tables.

    The texts of the images stay with the rejected rows alone: the others are
    read from ``_image``.
    """
    reason = F.coalesce(F.when(F.col("audit_id").isNull(), F.lit("missing_key")), log_problems(log),
                        image_problems() if routed else
                        F.when(F.col("operation").isin(*UPSERTS) & F.col(PARSED).isNull(), F.lit("bad_image")))
    judged = (_with_product(log) if routed else with_image(log)).withColumn("reject_reason", reason).drop("_product")
    return judged.withColumns({c: F.when(F.col("reject_reason").isNotNull(), F.col(c)) for c in ("old_data", "new_data")})


def rejects(judged: DataFrame) -> DataFrame:
    """The rows that cannot be applied, as the log has them, with the reason."""
    return judged.where("reject_reason is not null").drop(PARSED, TEXTS)


def _long(text: Column) -> Column:
    return parse.parse_bigint(text)


def _typed(text: Column, kind: T.DataType) -> Column:
    """An image value under the serve layer's text rules."""
    if isinstance(kind, T.BooleanType):
        return serve.flag_text(text)
    if isinstance(kind, T.TimestampNTZType):
        return serve.ts_text(text)
    if isinstance(kind, T.DecimalType):
        return parse.parse_decimal(text, kind.precision, kind.scale)
    if isinstance(kind, T.IntegralType):
        return _long(text).try_cast(kind)
    return text


def decode(log: DataFrame, payload: T.StructType) -> DataFrame:
    """The image's values as struct ``data``; values a column cannot hold become NULL.

    The image is parsed once, as text values, so flags and times keep their
    spelling until the serve layer's rules read them.  The texts are taken out
    first, by name: the rules refer to a text several times.  The one-row
    ``inline`` is a fence: a filter on a value stays above it, where the texts are
    at hand, and does not look them up again.
    """
    others = [c for c in log.columns if c not in (PARSED, TEXTS)]
    if TEXTS in log.columns:
        texts = log.select(*others, *[F.col(f"{TEXTS}.{f.name}").alias(f"_text_{f.name}") for f in payload.fields])
    else:
        texts = with_image(log).select(*others, F.inline(F.array(F.struct(
            *[F.try_element_at(PARSED, F.lit(f.name)).alias(f"_text_{f.name}") for f in payload.fields]))))
    data = F.struct(*[_typed(F.col(f"_text_{f.name}"), f.dataType).alias(f.name) for f in payload.fields])
    return texts.select(*others, data.alias("data"))


def pending(log: DataFrame, mirror: DataFrame, batch_size: int | None = None) -> DataFrame:
    """Log rows not yet applied, oldest first, at most ``batch_size``.

    "Applied" means "present in the mirror", not "below a cursor", so a
    change whose id was assigned early but committed late is not lost (T16).
    Without ``batch_size`` all of them; ``streaming.changes.drain`` applies
    them batch after batch until none is left.
    """
    todo = drop_matching(log, mirror.select("audit_id"), "audit_id")
    if batch_size:
        todo = todo.orderBy("audit_id").limit(batch_size)
    return todo


def mirror_rows(log: DataFrame, batch_id: int | Column | None = None) -> DataFrame:
    """K5: the mirror entries of applied log rows (every operation is mirrored)."""
    b = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return log.select("audit_id", "table_name", "operation", "record_id", "changed_at",
                      F.current_timestamp().alias("loaded_at"), b.cast("bigint").alias("batch_id"))


def cursor(mirror: DataFrame) -> DataFrame:
    """The highest applied audit id, 0 when nothing was applied."""
    return mirror.agg(F.coalesce(F.max("audit_id"), F.lit(0).cast("bigint")).alias("last_audit_id"))


def state_versions(log: DataFrame, payload: T.StructType, keep_deletes: bool = False) -> DataFrame:
    """I1 in generic form: one version row per routed change.

    Output: table_name, record_id, operation, the payload fields,
    ``_version`` (= audit_id) and changed_at.  Deletes are dropped unless
    ``keep_deletes`` (then they are tombstones for ``current_state``).
    """
    ops = OPERATIONS if keep_deletes else UPSERTS
    decoded = decode(log.filter(F.col("operation").isin(*ops)), payload)
    return decoded.select("table_name", "record_id", "operation",
                          *[F.col("data").getField(f.name).alias(f.name) for f in payload.fields],
                          F.col("audit_id").alias("_version"), "changed_at")


def current_state(versions: DataFrame, keys: Sequence[str] = STATE_KEYS,
                  apply_deletes: bool = False) -> DataFrame:
    """D3 over a version log; with ``apply_deletes`` a key whose newest change is D disappears (I8)."""
    cur = latest_per_key(versions, list(keys), ["_version"])
    if apply_deletes:
        cur = cur.filter(F.col("operation") != "D")
    return cur


def _routed(log: DataFrame, table: str, payload: T.StructType, keep_deletes: bool) -> DataFrame:
    """Decoded changes of one table; with ``keep_deletes`` its deletes too, marked ``_deleted``."""
    ops = OPERATIONS if keep_deletes else UPSERTS
    rows = decode(log.filter((F.col("table_name") == table) & F.col("operation").isin(*ops)), payload)
    return rows.select("audit_id", "record_id", "data.*",
                       (F.col("operation") == "D").cast("tinyint").alias("_deleted"))


def product_versions(log: DataFrame, keep_deletes: bool = False) -> DataFrame:
    """P18 + P9: product changes -> dim_products version rows."""
    flat = _routed(log, "products", PRODUCT_IMAGE, keep_deletes)
    flat = flat.withColumn("product_id", F.coalesce(F.col("product_id"), _long(F.col("record_id"))))
    return publish_products(flat, version="audit_id", extra=["_deleted"] if keep_deletes else [])


def review_versions(log: DataFrame, products: DataFrame | None, keep_deletes: bool = False,
                    history: DataFrame | None = None) -> DataFrame:
    """P18 + P11: review changes -> fact_reviews version rows (vendor looked up, J2).

    With ``history``, the versions of the products, the vendor is the one that was
    valid when the review changed (T19); that of ``products`` stands in where the
    history begins later, as after a compaction.
    """
    flat = _routed(log, "reviews", CLEAN_REVIEWS, keep_deletes)
    flat = flat.withColumn("review_id", F.coalesce(F.col("review_id"), F.col("record_id")))
    extra = ["_deleted"] if keep_deletes else []
    if history is None:
        return publish_reviews(flat, products, version="audit_id", extra=extra)
    # published first: the lookup moves the short form of the rows
    ready = publish_reviews(flat, None, version="audit_id", extra=extra)
    now = products.select("product_id", "vendor_id")
    dealt = as_of(ready.drop("vendor_id", *CREATED_PARTS), history, "product_id", "_version", ["vendor_id"],
                  versions_at="_version", otherwise=now)
    return with_created_parts(dealt.withColumn("vendor_id", F.coalesce("vendor_id", F.lit(0).cast("bigint")))).select(*ready.columns)


def review_product_ids(log: DataFrame) -> DataFrame:
    """Products that the review changes of a log refer to."""
    return (_with_product(log.filter(F.col("table_name") == "reviews"))
            .select(F.col("_product").alias("product_id")).filter(F.col("product_id").isNotNull()))


def diff_to_log(diff: DataFrame, changed_at: str | Column | None = None,
                first_id: int = 1) -> DataFrame:
    """Give a snapshot diff the change-log shape (audit ids, change time).

    Each key occurs once in a diff, so its ids only need to be unique and
    above the versions already published: pass ``first_id`` = the cursor + 1
    when other changes were published before.  Write the log before it is used:
    the ids need not be the same when it is computed again.
    """
    ts = (F.current_timestamp() if changed_at is None
          else changed_at if isinstance(changed_at, Column) else F.lit(changed_at))
    return diff.select((F.monotonically_increasing_id() + F.lit(first_id)).alias("audit_id"),
                       "table_name", "operation", "record_id", "old_data", "new_data",
                       ts.cast("timestamp_ntz").alias("changed_at"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  table_name: str, emit_deletes: bool = True) -> DataFrame:
    """Derive a change log by comparing two snapshots of a table.

    Full outer join on the key: a key only in ``new`` is an insert, a key in
    both whose row differs (NULL-safe) is an update, a key only in ``old`` a
    delete.  Images are JSON text with NULL fields kept (T21).  Coarser than
    row triggers: several updates between snapshots collapse into one.
    """
    cols = [c for c in new.columns]
    o = old.select(*[F.col(c).alias(f"o_{c}") for c in cols], F.lit(True).alias("_in_old"))
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in cols], F.lit(True).alias("_in_new"))
    cond = None
    for k in keys:
        c = F.col(f"o_{k}") == F.col(f"n_{k}")
        cond = c if cond is None else cond & c
    j = o.join(n, cond, "full_outer")
    same = None
    for c in cols:
        e = F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
        same = e if same is None else same & e
    op = (F.when(F.col("_in_old").isNull(), F.lit("I"))
           .when(F.col("_in_new").isNull(), F.lit("D"))
           .when(~same, F.lit("U")))
    opts = {"ignoreNullFields": "false"}
    old_img = F.to_json(F.struct(*[F.col(f"o_{c}").alias(c) for c in cols]), opts)
    new_img = F.to_json(F.struct(*[F.col(f"n_{c}").alias(c) for c in cols]), opts)
    key_text = F.concat_ws("|", *[F.coalesce(F.col(f"n_{k}"), F.col(f"o_{k}")).cast("string") for k in keys])
    out = j.select(
        F.lit(table_name).alias("table_name"), op.alias("operation"), key_text.alias("record_id"),
        F.when(op != "I", old_img).alias("old_data"),
        F.when(op != "D", new_img).alias("new_data"))
    out = out.filter(F.col("operation").isNotNull())
    if not emit_deletes:
        out = out.filter(F.col("operation") != "D")
    return out
