"""What the serve side leaves on disk: shuffles are freed, rows that are read often are landed short."""

import os

from pyspark.sql import functions as F

from ledgerline.operators import cdc
from ledgerline.operators.publish import CREATED_PARTS, publish_reviews
from ledgerline.plans import stages
from ledgerline.schemas import AUDIT_LOG, CLEAN_REVIEWS
from ledgerline.session import CLEANUP_CONF
from ledgerline.sinks.parquet import stage
from ledgerline.streaming.serving import ServeLayout, current_reviews, make_serving_handler


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_staged_tables_shuffle_is_freed(spark, monkeypatch):
    seen, (name, value) = [], *CLEANUP_CONF.items()
    writer = type(spark.range(1).write)
    monkeypatch.setattr(writer, "parquet", lambda self, *a, f=writer.parquet, **b: (seen.append(spark.conf.get(name, None)),
                                                                                    f(self, *a, **b))[1])
    before = spark.conf.get(name, None)
    assert stage(spark.range(100).groupBy(F.col("id") % 7).count(), "test").count() == 7
    assert seen == [value] and spark.conf.get(name, None) == before


def _log(spark):
    rows = [(1, "reviews", "U", "a", None, '{"review_id": "a", "product_id": 7, "star": 4, "is_public": "true"}', None),
            (2, "reviews", "U", "b", None, '{"review_id": "cut', None),
            (3, "products", "U", "8", None, '{"product_id": 8, "name": "x", "price": null, "is_available": "t"}', None),
            (4, "reviews", "D", "a", '{"review_id": "a", "product_id": 7}', None, None)]
    return spark.createDataFrame(rows, AUDIT_LOG)


def test_texts_in_columns_decode_as_the_parsed_image_does(spark, tmp_dir):
    _log(spark).write.parquet(f"{tmp_dir}/log")
    judged = cdc.judge(spark.read.schema(AUDIT_LOG).parquet(f"{tmp_dir}/log"))
    short = cdc.with_texts(judged)
    assert _optimized(short).count("from_json(") == 1 and cdc.PARSED not in short.columns
    landed = stage(short, "test")
    for of in (lambda rows: cdc.product_versions(rows, keep_deletes=True),
               lambda rows: cdc.review_versions(rows, None, keep_deletes=True), cdc.review_product_ids):
        good = [rows.where("reject_reason is null").drop("reject_reason") for rows in (judged, landed)]
        was, now = (of(rows) for rows in good)
        assert was.schema == now.schema and sorted(map(str, was.collect())) == sorted(map(str, now.collect()))
        assert was.count() > 0
    assert cdc.rejects(landed).schema.names == cdc.rejects(judged).schema.names
    assert [r["audit_id"] for r in cdc.rejects(landed).collect()] == [2]


def test_a_batch_is_not_held_in_memory_and_leaves_no_copy(spark, tmp_dir):
    layout = ServeLayout(f"{tmp_dir}/serve")
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    make_serving_handler(layout, "r", refresh_every=None)(_log(spark), 0)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held
    scratch = os.path.dirname(tmp_dir.removeprefix("file:"))
    assert not [d for d in os.listdir(scratch) if d.startswith("changes-")]
    assert [(r["review_id"], r["star"], r["is_public"]) for r in current_reviews(spark, layout).collect()] == [("a", 4, 1)]


def test_the_vendor_lookup_moves_published_rows(spark):
    """Neither the attachment texts nor what follows from the creation time is shuffled."""
    text = "{'photos': ['https://cdn.example.com/p/1.jpg'], 'video': None}"
    reviews = spark.range(50).select(*[
        (F.col("id") if f.name == "product_id" else F.when(F.col("id") >= 0, F.lit(text) if f.name == "attachments" else None))
        .cast(f.dataType).alias(f.name) for f in CLEAN_REVIEWS.fields]).repartition(3)
    products = spark.range(0, 50, 2).selectExpr("id AS product_id", "id + 1000 AS vendor_id").repartition(3)
    out = publish_reviews(reviews, products)
    below = _optimized(out).split("Join", 1)
    assert all(f"AS {c}" not in below[1] for c in CREATED_PARTS) and "AS has_attachment" in below[1]
    got = {r["product_id"]: (r["vendor_id"], r["has_attachment"], r["created_month"]) for r in out.collect()}
    assert got == {i: (i + 1000 if i % 2 == 0 else 0, 1, "200001") for i in range(50)}


def test_a_staged_snapshot_keeps_rows_without_a_key_in_their_order(spark):
    rows = spark.range(0, 4000, 1, 7).selectExpr("IF(id % 3 = 0, NULL, CAST(id AS STRING)) AS review_id", "id AS v")
    got = stages._stage_snapshot(rows)
    assert got.columns == rows.columns and got.count() == 4000
    assert [r["v"] for r in got.where("review_id IS NULL").collect()] == list(range(0, 4000, 3))
