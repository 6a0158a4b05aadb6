"""What a batch costs at size: rows are read once by the as-of lookup, methods stay small, lines are dealt once."""

from pyspark.sql import functions as F

from ledgerline.operators.asof import as_of
from ledgerline.plans import stages
from ledgerline.session import CODEGEN_CONF, small_methods
from ledgerline.streaming.serving import ServeLayout, make_serving_handler
from ledgerline.schemas import AUDIT_LOG


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_as_of_reads_the_rows_once_for_windows_and_once_for_keys(spark, tmp_dir):
    rows = [(1, 5, "a"), (1, None, "b"), (None, 5, "c"), (None, None, "d"), (2, 9, "e"), (2, None, "f")]
    spark.createDataFrame(rows, "k long, at long, wide string").write.parquet(f"{tmp_dir}/rows")
    rows = spark.read.parquet(f"{tmp_dir}/rows")
    versions = spark.createDataFrame([(1, 2, 10), (2, 20, 20)], "k long, at long, v long")
    now = spark.createDataFrame([(1, 11), (2, 21)], "k long, v long")
    out = as_of(rows, versions, "k", "at", ["v"], otherwise=now)
    assert _plan(out).count("wide#") and _plan(out).count("Relation [") == 2
    got = {r["wide"]: (r["k"], r["at"], r["v"]) for r in out.collect()}
    assert got == {"a": (1, 5, 10), "b": (1, None, 11), "c": (None, 5, None), "d": (None, None, None),
                   "e": (2, 9, 21), "f": (2, None, 21)}


def test_rows_without_key_do_not_gather(spark):
    rows = spark.range(2000).select(F.lit(None).cast("long").alias("k"), F.lit(None).cast("long").alias("at"), "id")
    versions = spark.createDataFrame([(1, 2, 10)], "k long, at long, v long")
    out = as_of(rows, versions, "k", "at", ["v"])
    assert out.count() == 2000 and out.where("v IS NOT NULL").count() == 0


def test_small_methods_are_set_for_a_batch_only(spark, tmp_dir):
    (name, value), = CODEGEN_CONF.items()
    mine = spark.conf.get(name)
    spark.conf.set(name, "65000")
    try:
        with small_methods(spark):
            assert spark.conf.get(name) == value
        assert spark.conf.get(name) == "65000"
        make_serving_handler(ServeLayout(tmp_dir), "r", refresh_every=None)(spark.createDataFrame([], AUDIT_LOG), 0)
        assert spark.conf.get(name) == "65000"
    finally:
        spark.conf.set(name, mine)


def test_lines_are_dealt_once_for_window_and_join(spark, tmp_dir):
    for table, rows, schema in (
            ("lineitem", [(1, 1, 7, 3, 2.0, 9.0, 0.0, 0.0, "N", "F", "2000-01-01 00:00:00"),
                          (1, 1, 8, 3, 2.0, 9.0, 0.0, 0.0, "N", "F", "1990-01-01 00:00:00"),
                          (None, 1, 8, 3, 2.0, 9.0, 0.0, 0.0, "N", "F", "1990-01-01 00:00:00")],
             "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"),
            ("orders", [(1, 5, "1990-01-01 00:00:00", "LOW")],
             "o_orderkey long, o_custkey long, o_orderdate string, o_orderpriority string")):
        df = spark.createDataFrame(rows, schema)
        for c in [c for c in df.columns if c.endswith("date")]:
            df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
        df.write.parquet(f"{tmp_dir}/{table}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        old, new = stages._snapshots(spark, tmp_dir)
        for side in (old, new):
            plan = side._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
            assert plan.count("Exchange ") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(r["review_id"], r["product_id"]) for r in old.collect()] == [("1-1", 8)]
    assert [(r["review_id"], r["product_id"]) for r in new.collect()] == [("1-1", 7)]
