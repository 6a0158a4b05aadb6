"""Snapshot diff by digests: equal to the full join, over the differing ranges alone."""

import random

from pyspark.sql import functions as F

from ledgerline.operators import cdc, digest

ROWS = "id long, name string, note string, stock int"


def snapshots(spark, seed=1, n=4000, changed=range(1000, 1040)):
    r = random.Random(seed)
    old = [(k, f"n{k}", r.choice([None, "", "x"]), r.choice([None, 0, 1])) for k in range(n)]
    new = []
    for row in old:
        if row[0] in changed:
            kind = row[0] % 4
            if kind == 0:
                continue                                       # deleted
            row = (row[0], *([row[2], row[1], row[3]] if kind == 1 else [row[1], "" if row[2] is None else None, row[3]]))
        new.append(row)
    new += [(n + 5, "new", None, 1)]
    return spark.createDataFrame(old, ROWS), spark.createDataFrame(new, ROWS)


def ids_of_64():
    return F.shiftright("id", 6)


def diff(old, new):
    return sorted(tuple(r) for r in cdc.snapshot_diff(old, new, ["id"], "t").collect())


def test_equals_the_full_join(spark):
    for seed, changed in ((1, range(1000, 1040)), (2, range(0, 4000, 97)), (3, [])):
        old, new = snapshots(spark, seed, changed=changed)
        a, b = digest.rows_that_may_differ(old.repartition(5), new.repartition(3), ids_of_64())
        assert diff(a, b) == diff(old, new)
        assert a.columns == old.columns


def test_only_differing_ranges_are_joined(spark):
    old, new = snapshots(spark)                                # one per cent, next to each other, and one new row
    a, b = digest.rows_that_may_differ(old, new, ids_of_64())
    assert a.count() <= 3 * 64 and b.count() <= 3 * 64
    same, _ = digest.rows_that_may_differ(old, old.repartition(7), ids_of_64())
    assert same.count() == 0


def test_no_row_is_shuffled_for_a_digest(spark):
    old, _ = snapshots(spark)
    plan = digest.digests(old, ids_of_64(), old.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bit_xor" in plan


def test_levels_agree_and_null_ranges_count(spark):
    old, new = snapshots(spark, 4, changed=[5, 3000])
    none = lambda df, k: df.withColumn("id", F.when(F.col("id") != k, F.col("id")))
    leaves = [digest.digests(none(x, 7), ids_of_64(), x.columns) for x in (old, new)]
    got = [sorted(r["range"] for r in digest.differing_ranges(*leaves, levels=n, bits=3).collect()) for n in (0, 1, 3)]
    assert got[0] == got[1] == got[2] == sorted({5 >> 6, 3000 >> 6, 4005 >> 6})
    other = digest.digests(none(old, 8), ids_of_64(), old.columns)
    assert None in [r["range"] for r in digest.differing_ranges(leaves[0], other).collect()]


def test_values_in_turn_do_not_hash_alike(spark):
    a = spark.createDataFrame([(1, "x", None, 1), (2, None, "x", 1)], ROWS)
    b = spark.createDataFrame([(1, None, "x", 1), (2, "x", None, 1)], ROWS)
    assert digest.differing_ranges(*[digest.digests(x, ids_of_64(), x.columns) for x in (a, b)]).count() == 1
