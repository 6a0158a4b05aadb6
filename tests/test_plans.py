"""Physical-plan properties that matter at scale (pushdown, pruning, pre-aggregation)."""

import __spark_entry__ as E

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    return df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted") and \
        df._jdf.queryExecution().explainString(
            df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_q2_reads_two_columns(spark):
    text = _formatted(E.queries()["q2_hourly_rating"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_keyword_filter_reaches_scan(spark):
    text = _formatted(E.queries()["q9_keyword_users"](spark, SF_SMALL))
    assert "StringContains(text,the)" in text
    assert "labels" not in text            # star not needed: no join


def test_word_count_is_pre_aggregated(spark):
    plan = _plan(E.queries()["q7_word_freq_bytes"](spark, SF_SMALL))
    assert plan.count("HashAggregate") >= 2     # partial (map side) + final
    assert "TakeOrderedAndProject" in plan


def test_latest_version_limits_before_shuffle(spark):
    plan = _plan(E.queries()["latest_version"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_point_lookup_pushed(spark):
    text = _formatted(E.queries()["q1_vendor_profile"](spark, SF_SMALL))
    assert "EqualTo(s_suppkey,7)" in text
    assert "ReadSchema: struct<p_partkey:bigint>" in text   # sales join pruned away


def test_month_pruning(spark, tmp_dir):
    import datetime as dt
    from ledgerline.operators.publish import publish_reviews
    from ledgerline.sinks.parquet import write_fact_by_month
    from ledgerline.sources.adapters import v_reviews
    from ledgerline.sources.serve import read_fact
    write_fact_by_month(publish_reviews(v_reviews(spark, SF_SMALL)), tmp_dir, mode="overwrite")
    df = read_fact(spark, tmp_dir, since=dt.date(2001, 7, 2), until=dt.date(2001, 8, 1))
    text = _formatted(df)
    assert "PartitionFilters: [isnotnull(created_month" in text
    assert df.count() > 0
    assert df.filter("created_month < '200107'").count() == 0


def test_compact_partitioned_and_append(spark, tmp_dir):
    from pyspark.sql import functions as F
    from ledgerline.operators.versions import compact
    from ledgerline.sinks.parquet import append
    log = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"),
                                   (F.col("id") % 3).cast("string").alias("part"))
    target = f"{tmp_dir}/compacted"
    compact(log, ["k"], ["v"], target, partition_by=["part"])
    got = spark.read.parquet(target)
    assert got.count() == 50
    assert sorted(r["v"] for r in got.collect()) == list(range(950, 1000))
    append(got.select("k", "v"), f"{tmp_dir}/appended")
    append(got.select("v", "k"), f"{tmp_dir}/appended")
    assert spark.read.parquet(f"{tmp_dir}/appended").count() == 100


def test_new_files_are_seen_and_nothing_is_dealt_round_robin(spark, tmp_dir):
    import os
    import shutil
    from ledgerline.operators import cdc
    from ledgerline.sources import adapters as V
    # contents only: the tables' folder may be read-only, and the copy must not be
    os.makedirs(f"{tmp_dir}/sf")
    for name in os.listdir(SF_SMALL):
        if name != "events.parquet":
            shutil.copyfile(f"{SF_SMALL}/{name}", f"{tmp_dir}/sf/{name}")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.write.parquet(f"{tmp_dir}/sf/events.parquet")
    n = events.count()
    assert V.v_audit(spark, f"{tmp_dir}/sf").count() == n
    assert E.queries()["cdc_mirror"](spark, f"{tmp_dir}/sf").count() == n
    events.withColumn("event_id", events["event_id"] + 10**6).write.mode("append").parquet(f"{tmp_dir}/sf/events.parquet")
    assert V.v_audit(spark, f"{tmp_dir}/sf").count() == 2 * n
    assert cdc.mirror_rows(V.v_audit(spark, f"{tmp_dir}/sf"), 0).count() == 2 * n
    assert "RoundRobin" not in _plan(E.queries()["latest_version"](spark, SF_SMALL))


def test_queries_leave_the_session_settings_alone(spark):
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        E.queries()["latest_version"](spark, SF_SMALL)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def test_read_fact_bounds_match_plain_filter(spark, tmp_dir):
    import datetime as dt
    from pyspark.sql import functions as F
    from ledgerline.operators.publish import publish_reviews
    from ledgerline.sinks.parquet import write_fact_by_month
    from ledgerline.sources.adapters import v_reviews
    from ledgerline.sources.serve import read_fact
    write_fact_by_month(publish_reviews(v_reviews(spark, SF_SMALL)), tmp_dir, mode="overwrite")
    everything = read_fact(spark, tmp_dir)
    since = dt.date(2000, 1, 15)
    until = dt.date(2000, 3, 10)
    for kwargs, cond in [
        ({"since": since}, F.col("created_at") >= F.lit("2000-01-15").cast("timestamp_ntz")),
        ({"until": until}, F.col("created_at") < F.lit("2000-03-11").cast("timestamp_ntz")),
        ({"since": since, "until": until},
         (F.col("created_at") >= F.lit("2000-01-15").cast("timestamp_ntz"))
         & (F.col("created_at") < F.lit("2000-03-11").cast("timestamp_ntz"))),
    ]:
        assert read_fact(spark, tmp_dir, **kwargs).count() == everything.filter(cond).count()


def test_top_vendors_hash_aggregates_and_snapshots_scan_once(spark):
    plan = _plan(E.queries()["dm_top_vendors"](spark, SF_SMALL))
    assert "SortAggregate" not in plan
    from ledgerline.plans.stages import _snapshots
    old, new = _snapshots(spark, SF_SMALL)
    both = old.join(new, "review_id", "full_outer")
    both.collect()
    final = _plan(both)
    assert final.count("ReusedExchange") >= 1
