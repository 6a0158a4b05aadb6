"""Change application invariants: replay-safe, split-invariant, stream == batch."""

import json

from pyspark.sql import functions as F

from ledgerline.operators import cdc, publish
from ledgerline.operators.versions import latest_per_key
from ledgerline.schemas import AUDIT_LOG, PRODUCT_IMAGE
from ledgerline.streaming.changes import StreamPaths, make_batch_handler, run_change_stream
from pyspark.sql import types as T

PAYLOAD = T.StructType([T.StructField("k", T.LongType(), True)])


def _log(spark, rows):
    return spark.createDataFrame(rows, AUDIT_LOG)


def _rows():
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    mk = lambda a, tab, op, rec, k: (a, tab, op, rec, json.dumps({"k": k}) if op == "D" else None,
                                     None if op == "D" else json.dumps({"k": k}), t + dt.timedelta(minutes=a))
    return [mk(1, "products", "I", "1", 10), mk(2, "products", "U", "1", 11), mk(3, "reviews", "I", "a", 5),
            mk(4, "products", "I", "2", 20), mk(5, "reviews", "D", "a", 5), mk(6, "products", "U", "2", 21),
            mk(7, "reviews", "I", "b", 7), mk(8, "products", "D", "2", 21), mk(9, "products", "U", "1", 12),
            mk(10, "orders", "I", "x", 1)]


def _state(df):
    return sorted((r["table_name"], r["record_id"], r["k"], r["_version"]) for r in df.collect())


def test_apply_latest_and_deletes(spark):
    log = _log(spark, _rows())
    cur = cdc.current_state(cdc.state_versions(log, PAYLOAD))
    assert _state(cur) == [("orders", "x", 1, 10), ("products", "1", 12, 9), ("products", "2", 21, 6),
                           ("reviews", "a", 5, 3), ("reviews", "b", 7, 7)]
    cur_d = cdc.current_state(cdc.state_versions(log, PAYLOAD, keep_deletes=True), apply_deletes=True)
    assert _state(cur_d) == [("orders", "x", 1, 10), ("products", "1", 12, 9), ("reviews", "b", 7, 7)]


def test_apply_twice_and_any_split_is_same(spark):
    log = _log(spark, _rows())
    once = _state(cdc.current_state(cdc.state_versions(log, PAYLOAD)))
    twice = cdc.current_state(cdc.state_versions(log.unionByName(log), PAYLOAD))
    assert _state(twice) == once
    for n in (2, 3, 5):
        parts = [log.filter(F.col("audit_id") % n == i) for i in range(n)]
        versions = None
        for p in reversed(parts):     # batches applied out of order
            v = cdc.state_versions(p, PAYLOAD)
            versions = v if versions is None else versions.unionByName(v)
        assert _state(cdc.current_state(versions)) == once


def test_pending_uses_mirror_membership(spark):
    log = _log(spark, _rows())
    mirror = cdc.mirror_rows(log.filter(F.col("audit_id").isin(1, 2, 4)), 0)   # 3 committed late
    todo = [r["audit_id"] for r in cdc.pending(log, mirror, batch_size=3).collect()]
    assert todo == [3, 5, 6]
    assert cdc.cursor(mirror).collect()[0][0] == 4
    assert cdc.cursor(mirror.limit(0)).collect()[0][0] == 0


def test_batch_handler_replay_is_idempotent(spark, tmp_dir):
    paths = StreamPaths(source=f"{tmp_dir}/in", versions=f"{tmp_dir}/v", mirror=f"{tmp_dir}/m",
                        checkpoint=f"{tmp_dir}/c")
    log = _log(spark, _rows())
    handle = make_batch_handler(PAYLOAD, paths, "run-a")
    handle(log.filter("audit_id <= 5"), 0)
    handle(log.filter("audit_id > 5"), 1)
    handle(log.filter("audit_id > 5"), 1)          # crash after write, batch 1 replayed
    v = spark.read.parquet(paths.versions)
    assert v.count() == log.filter("operation <> 'D'").count()
    assert spark.read.parquet(paths.mirror).count() == 10
    assert _state(cdc.current_state(v.drop("run_id", "batch_id"))) == \
        _state(cdc.current_state(cdc.state_versions(log, PAYLOAD)))


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    paths = StreamPaths(source=f"{tmp_dir}/in", versions=f"{tmp_dir}/v", mirror=f"{tmp_dir}/m",
                        checkpoint=f"{tmp_dir}/c")
    log = _log(spark, _rows())
    log.repartitionByRange(3, "audit_id").write.parquet(paths.source)
    run_change_stream(spark, paths, PAYLOAD, max_files_per_trigger=1)
    first = spark.read.parquet(paths.versions)
    assert first.select("batch_id").distinct().count() == 3
    n = first.count()
    run_change_stream(spark, paths, PAYLOAD, max_files_per_trigger=1)   # restart: nothing new
    again = spark.read.parquet(paths.versions)
    assert again.count() == n
    assert _state(cdc.current_state(again.drop("run_id", "batch_id"))) == \
        _state(cdc.current_state(cdc.state_versions(log, PAYLOAD)))


def test_snapshot_diff_then_apply_reproduces_new(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "product_id long, name string, stock int")
    new = spark.createDataFrame([(1, "a", 10), (2, "b", 25), (4, "d", None)], "product_id long, name string, stock int")
    diff = cdc.snapshot_diff(old, new, ["product_id"], "products")
    ops = sorted((r["operation"], r["record_id"]) for r in diff.collect())
    assert ops == [("D", "3"), ("I", "4"), ("U", "2")]
    ins = [r for r in diff.collect() if r["operation"] == "I"][0]
    assert json.loads(ins["new_data"]) == {"product_id": 4, "name": "d", "stock": None}   # NULL kept
    # apply the diff to the old snapshot: latest image per key, deletes applied
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in new.schema.fields])
    log = diff.withColumn("audit_id", F.monotonically_increasing_id() + 100).withColumn(
        "changed_at", F.current_timestamp().cast("timestamp_ntz"))
    applied = cdc.state_versions(log, schema, keep_deletes=True)
    base = old.select(F.lit("products").alias("table_name"), F.col("product_id").cast("string").alias("record_id"),
                      F.lit("I").alias("operation"), "product_id", "name", "stock",
                      F.lit(0).cast("bigint").alias("_version"), F.current_timestamp().cast("timestamp_ntz").alias("changed_at"))
    cur = cdc.current_state(base.unionByName(applied), apply_deletes=True)
    got = sorted((r["product_id"], r["name"], r["stock"]) for r in cur.collect())
    assert got == sorted(tuple(r) for r in new.collect())


def test_product_versions_from_json_images(spark):
    import datetime as dt
    image = {"product_id": 5, "name": "x", "price": 100, "stock": None, "preparation_days": 0,
             "is_available": True, "updated_at": "2024-01-02T10:11:12", "vendor_score": 4.5}
    log = _log(spark, [(42, "products", "U", "5", None, json.dumps(image), dt.datetime(2024, 1, 2))])
    row = cdc.product_versions(log).collect()[0]
    assert row["product_id"] == 5 and row["_version"] == 42 and row["stock"] == 0
    assert row["preparation_days"] == 1 and row["is_available"] == 1 and row["is_saleable"] == 0
    assert row["updated_at"] == dt.datetime(2024, 1, 2, 10, 11, 12) and row["category_title"] == ""
    assert [f.name for f in publish.publish_products(
        spark.createDataFrame([], PRODUCT_IMAGE)).schema.fields][-1] == "_version"


def test_latest_per_key_plans_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted((r["k"], r["v"]) for r in out.collect()) == [(k, 994 + k if 994 + k < 1000 else 987 + k) for k in range(7)]


def test_polling_trigger_processes_new_files(spark, tmp_dir):
    """A processing-time trigger picks up files that arrive while it runs."""
    paths = StreamPaths(source=f"{tmp_dir}/in", versions=f"{tmp_dir}/v", mirror=f"{tmp_dir}/m",
                        checkpoint=f"{tmp_dir}/c")
    log = _log(spark, _rows())
    log.filter("audit_id <= 4").write.parquet(paths.source)
    q = run_change_stream(spark, paths, PAYLOAD, available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        log.filter("audit_id > 4").write.mode("append").parquet(paths.source)
        q.processAllAvailable()
    finally:
        q.stop()
    v = spark.read.parquet(paths.versions).drop("run_id", "batch_id")
    assert _state(cdc.current_state(v)) == _state(cdc.current_state(cdc.state_versions(log, PAYLOAD)))


def test_latest_per_key_where_matches_filter_after(spark):
    # key 1: newest version has p=7 (match); key 2: an old version has p=7, newest not;
    # key 3: never p=7; key 4: only version p=7
    rows = [(1, 1, 5), (1, 2, 7), (2, 1, 7), (2, 2, 5), (3, 1, 5), (4, 9, 7)]
    df = spark.createDataFrame(rows, "k long, v long, p long")
    full = latest_per_key(df, ["k"], ["v"]).filter("p = 7")
    fast = latest_per_key(df, ["k"], ["v"], where=F.col("p") == 7)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, full.collect())) == [(1, 2, 7), (4, 9, 7)]


def test_a_new_checkpoint_and_overlapping_files_lose_and_double_nothing(spark, tmp_dir):
    log = _log(spark, _rows())
    first = StreamPaths(f"{tmp_dir}/in", f"{tmp_dir}/v", f"{tmp_dir}/m", f"{tmp_dir}/c1")
    log.filter("audit_id <= 6").write.parquet(first.source)
    run_change_stream(spark, first, PAYLOAD, max_files_per_trigger=1)
    log.filter("audit_id >= 4").write.mode("append").parquet(first.source)
    log.filter("audit_id = 9").write.mode("append").parquet(first.source)
    second = StreamPaths(first.source, first.versions, first.mirror, f"{tmp_dir}/c2")
    run_change_stream(spark, second, PAYLOAD)
    mirror = [r["audit_id"] for r in spark.read.parquet(first.mirror).collect()]
    assert sorted(mirror) == list(range(1, 11))
    v = spark.read.parquet(first.versions)
    assert v.count() == log.filter("operation <> 'D'").count()
    assert v.select("run_id").distinct().count() == 2
    assert _state(cdc.current_state(v.drop("run_id", "batch_id"))) == \
        _state(cdc.current_state(cdc.state_versions(log, PAYLOAD)))


def test_unreadable_rows_go_to_the_reject_table(spark, tmp_dir):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    bad = [(20, None, "I", "1", None, "{}", t), (21, "products", "X", "1", None, "{}", t),
           (22, "products", "U", "1", None, "not json", t), (23, "products", "U", "1", None, "[1]", t),
           (None, "products", "U", "1", None, '{"k": 1}', t), (None, "products", "U", "2", None, '{"k": 1}', t)]
    log = _log(spark, _rows() + bad)
    paths = StreamPaths(f"{tmp_dir}/in", f"{tmp_dir}/v", f"{tmp_dir}/m", f"{tmp_dir}/c")
    log.write.parquet(paths.source)
    run_change_stream(spark, paths, PAYLOAD)
    rejects = sorted((r["audit_id"] or 0, r["reject_reason"]) for r in spark.read.parquet(paths.rejects).collect())
    assert rejects == [(0, "missing_key"), (0, "missing_key"), (20, "missing_key"), (21, "bad_operation"),
                       (22, "bad_image"), (23, "bad_image")]
    v = spark.read.parquet(paths.versions).drop("run_id", "batch_id")
    assert _state(cdc.current_state(v)) == _state(cdc.current_state(cdc.state_versions(_log(spark, _rows()), PAYLOAD)))


def test_drain_applies_all_batches(spark, tmp_dir):
    from ledgerline.streaming.changes import drain
    log = _log(spark, _rows())
    paths = StreamPaths(f"{tmp_dir}/in", f"{tmp_dir}/v", f"{tmp_dir}/m", f"{tmp_dir}/c")
    handle = make_batch_handler(PAYLOAD, paths, "drain")
    assert drain(spark, log, paths.mirror, "drain", handle, batch_size=3) == 4
    assert drain(spark, log, paths.mirror, "drain", handle, batch_size=3) == 0
    v = spark.read.parquet(paths.versions).drop("run_id", "batch_id")
    assert _state(cdc.current_state(v)) == _state(cdc.current_state(cdc.state_versions(log, PAYLOAD)))


def test_image_values_follow_the_text_rules(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    image = lambda **kv: json.dumps({"review_id": "r", "product_id": 1} | kv)
    rows = [(1, "reviews", "U", "a", None, image(is_public="t", created_at="2024-02-03T04:05:06+03:30"), t),
            (2, "reviews", "U", "b", None, image(is_public=1, created_at="2024-02-03T04:05:06.75Z", star="4"), t),
            (3, "reviews", "U", "c", None, image(is_public="yes", created_at="junk", product_id="7", star=None), t),
            (4, "reviews", "U", "d", None, image(is_public=True, like_count="abc", user_id=2**53 + 1), t)]
    got = {r["_version"]: r for r in cdc.review_versions(_log(spark, rows), None).collect()}
    at = dt.datetime(2024, 2, 3, 4, 5, 6)
    assert [got[i]["is_public"] for i in (1, 2, 3, 4)] == [1, 1, 0, 1]
    assert [got[i]["created_at"] for i in (1, 2, 3)] == [at, at, dt.datetime(2000, 1, 1)]
    assert got[2]["star"] == 4 and got[3]["product_id"] == 7 and got[4]["like_count"] == 0
    assert got[4]["user_id"] == 2**53 + 1
