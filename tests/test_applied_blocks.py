"""A row meets a bounded number of applied intervals."""

from pyspark.sql import functions as F

from ledgerline.streaming import applied as A


def test_a_block_has_few_intervals(spark):
    n = 1 << 14
    applied = A.ranges_of(spark.range(0, n, 2).withColumnRenamed("id", "audit_id"))
    most = applied.groupBy(A._block("lo")).count().agg(F.max("count")).first()[0]
    assert most <= 512
    left = A.drop_applied(spark.range(n).withColumnRenamed("id", "audit_id"), applied)
    assert sorted(r["audit_id"] for r in left.collect()) == list(range(1, n, 2))
