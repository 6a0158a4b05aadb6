"""Tables bucketed by key: loads meet them in place."""

import pytest

from ledgerline.operators import load
from ledgerline.sinks.keyed import MARK, KeyedTable, is_keyed
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def frame(spark, n, start=0):
    return spark.range(start, start + n).selectExpr("concat('k', id) AS k", "id AS v")


def test_append_and_read(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    assert is_keyed(spark, path)
    table = KeyedTable(spark, path, SCHEMA, "k", buckets=4)
    assert table.read().count() == 0
    table.append(frame(spark, 100))
    table.append(frame(spark, 50, 100))
    assert sorted(r["v"] for r in table.read().collect()) == list(range(150))
    assert spark.read.parquet(path).count() == 150 and is_keyed(spark, path)
    assert len(spark.read.parquet(path).inputFiles()) == 8          # one a bucket and load
    # another session has to find the same buckets, whatever it asks for
    table.forget()
    again = KeyedTable(spark, path, SCHEMA, "k", buckets=99)
    assert again.buckets == 4 and again.read().count() == 150
    again.append(frame(spark, 1, 150))
    assert again.read().where("k = 'k150'").count() == 1
    with pytest.raises(ValueError):
        KeyedTable(spark, path, SCHEMA, "v")
    assert spark.read.json(f"{path}/{MARK}").count() == 1


def test_a_folder_written_otherwise_is_left_as_it_is(spark, tmp_dir):
    frame(spark, 3).write.parquet(f"{tmp_dir}/plain")
    assert not is_keyed(spark, f"{tmp_dir}/plain")


def test_the_table_is_not_shuffled(spark, tmp_dir):
    """Anti join (insert-or-ignore) and semi join (known keys): exchanges on the new side only."""
    table = KeyedTable(spark, f"{tmp_dir}/t", SCHEMA, "k", buckets=4)
    table.append(frame(spark, 1000))
    new = frame(spark, 300, 900).withColumn("pos", load.F.lit(1))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df, n in ((load.rows_to_insert(new, table.read(), ["k"], ["pos"], table.buckets), 200),
                      (load.split_by_reference(new, table.read(), "k")[0], 100)):
            assert df.count() == n
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            final = plan.split("== Initial Plan ==")[0]
            lines = final.split("\n")
            scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x)
            assert "Bucketed: true" in lines[scan]
            # walk up from the scan to the other side of the join: sorts and projections, no exchange
            for x in reversed(lines[:scan]):
                if ":" in x[:len(x) - len(x.lstrip(" :+-"))]:
                    break
                assert "Exchange" not in x and "ShuffleQueryStage" not in x, final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
