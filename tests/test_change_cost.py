"""What a change costs: its image is parsed once, and only repeated ids shuffle whole rows."""

from pyspark.sql import functions as F

from ledgerline.operators import cdc
from ledgerline.operators.asof import as_of
from ledgerline.schemas import AUDIT_LOG
from ledgerline.streaming.replay import unseen


def _log(spark):
    rows = [(1, "reviews", "U", "a", None, '{"review_id": "a", "product_id": 7, "star": 4}', None),
            (2, "reviews", "U", "b", None, '{"review_id": "cut', None),
            (3, "reviews", "D", "a", '{"review_id": "a", "product_id": 7}', None, None)]
    return spark.createDataFrame(rows, AUDIT_LOG)


def _analyzed(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_image_is_parsed_once(spark, tmp_dir):
    _log(spark).write.parquet(f"{tmp_dir}/log")
    judged = cdc.judge(spark.read.schema(AUDIT_LOG).parquet(f"{tmp_dir}/log"))
    assert _analyzed(judged).count("from_json(") == 1
    kept = judged.persist()
    try:
        good = kept.where("reject_reason is null").drop("reject_reason")
        versions = cdc.review_versions(good, None, keep_deletes=True)
        # what is persisted stands in the plan once; nothing above it parses
        assert _analyzed(versions).split("InMemoryRelation")[0].count("from_json(") == 0
        got = {r["_version"]: (r["review_id"], r["product_id"], r["star"], r["_deleted"]) for r in versions.collect()}
        assert got == {1: ("a", 7, 4, 0), 3: ("a", 7, 0, 1)}
        bad = cdc.rejects(kept).collect()
        assert [(r["audit_id"], r["new_data"], r["reject_reason"]) for r in bad] == [(2, '{"review_id": "cut', "bad_image")]
        assert bad[0].asDict().keys() == {*AUDIT_LOG.names, "reject_reason"}
    finally:
        kept.unpersist()


def test_rows_are_dealt_by_id_only_when_ids_repeat(spark, tmp_dir):
    _log(spark).write.parquet(f"{tmp_dir}/log")
    log = spark.read.schema(AUDIT_LOG).parquet(f"{tmp_dir}/log")
    assert "row_number" not in _analyzed(unseen(log, f"{tmp_dir}/mirror", "r", 0))
    twice = log.unionAll(log.where("audit_id = 1").withColumn("record_id", F.lit("z")))
    got = sorted((r["audit_id"], r["record_id"]) for r in unseen(twice, f"{tmp_dir}/mirror", "r", 0).collect())
    assert got == [(1, "a"), (2, "b"), (3, "a")]


def test_as_of_otherwise_stands_in_for_missing_values(spark):
    rows = spark.createDataFrame([(1, 5), (1, 20), (2, 5), (3, 5), (None, 5), (2, None)], "k long, at long")
    versions = spark.createDataFrame([(1, 10, 100), (3, 1, None)], "k long, at long, v long")
    now = spark.createDataFrame([(1, 101), (2, 200), (3, 300)], "k long, v long")
    got = {(r["k"], r["at"]): r["v"] for r in as_of(rows, versions, "k", "at", ["v"], otherwise=now).collect()}
    assert got == {(1, 5): 101, (1, 20): 100, (2, 5): 200, (3, 5): 300, (None, 5): None, (2, None): 200}
