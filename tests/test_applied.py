"""Applied ids as intervals: gaps, late ids, duplicates, replays, and what the guard reads."""

import random

from ledgerline.streaming import applied as A
from ledgerline.streaming.replay import unseen

LOG = "audit_id long, operation string, new_data string"


def ids_frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "audit_id long")


def islands(ids):
    out = []
    for i in sorted({i for i in ids if i is not None}):
        if out and i == out[-1][1] + 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return [tuple(x) for x in out]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_ranges_of_ids_within_and_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_BITS", 3)
    r = random.Random(1)
    for n in (0, 1, 40):
        ids = [r.randrange(-30, 90) for _ in range(n)] + [None] * (n > 1) + list(range(100, 100 + n))
        assert rows(A.ranges_of(ids_frame(spark, ids))) == islands(ids)


def test_merge_of_overlapping_touching_and_nested_ranges(spark):
    cases = [(1, 5), (3, 4), (6, 9), (11, 11), (20, 30), (25, 40), (20, 22), (-5, -1), (0, 0)]
    got = rows(A.merge_ranges(spark.createDataFrame(cases, A.RANGES)))
    assert got == islands([i for lo, hi in cases for i in range(lo, hi + 1)])
    assert A.merge_ranges(spark.createDataFrame([], A.RANGES)).count() == 0


def test_drop_applied_by_blocks(spark, monkeypatch):
    """Intervals within a block, over its edge, and over many whole blocks."""
    monkeypatch.setattr(A, "BLOCK_BITS", 3)
    r = random.Random(2)
    for k in range(4):
        taken = {i for i in range(-40, 200) if (i // (3 + 29 * (k % 2))) % 2 and r.random() < 0.97}
        ranges = spark.createDataFrame(islands(taken), A.RANGES)
        ids = [r.randrange(-60, 220) for _ in range(150)] + [None, None]
        got = [x["audit_id"] for x in A.drop_applied(ids_frame(spark, ids), ranges).collect()]
        assert sorted(got, key=str) == sorted((i for i in ids if i not in taken), key=str)


def test_no_nested_loop(spark):
    plan = A.drop_applied(ids_frame(spark, [1, 2]), spark.createDataFrame([(1, 1)], A.RANGES))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def log_frame(spark, ids):
    return spark.createDataFrame([(i, "U", f"{{\"k\": {i}}}") for i in ids], LOG)


def guard(spark, mirror):
    return rows(A.read_applied(spark, mirror))


def test_batches_runs_and_replays(spark, tmp_dir):
    mirror = f"{tmp_dir}/mirror"
    assert guard(spark, mirror) == []
    first = [i for i in range(1, 101) if i % 10]
    fresh = unseen(log_frame(spark, first), mirror, "a", 0)
    assert sorted(r["audit_id"] for r in fresh.collect()) == first
    A.write_applied(spark, mirror, log_frame(spark, first), "a", 0)
    assert guard(spark, mirror) == islands(first) and len(guard(spark, mirror)) == 10

    # late ids in gaps, ids that were applied, and new ones
    second = [5, 10, 20, 20, 99, 101, 102, 150]
    fresh = [r["audit_id"] for r in unseen(log_frame(spark, second), mirror, "a", 1).collect()]
    assert sorted(fresh) == [10, 20, 101, 102, 150]
    A.write_applied(spark, mirror, ids_frame(spark, fresh), "a", 1)
    # the batch runs again: it doesn't see its own attempt
    again = [r["audit_id"] for r in unseen(log_frame(spark, second), mirror, "a", 1).collect()]
    assert sorted(again) == sorted(fresh)
    A.write_applied(spark, mirror, ids_frame(spark, again), "a", 1)
    done = set(first) | set(fresh)
    assert guard(spark, mirror) == islands(done)

    # another run sees all of it, and holds what the first one applied
    everything = list(range(1, 161))
    late = [r["audit_id"] for r in unseen(log_frame(spark, everything), mirror, "b", 0).collect()]
    assert sorted(late) == sorted(set(everything) - done)
    A.write_applied(spark, mirror, ids_frame(spark, late), "b", 0)
    assert guard(spark, mirror) == [(1, 160)]
    assert unseen(log_frame(spark, everything), mirror, "a", 2).count() == 0


def test_the_guard_is_bounded_by_the_gaps(spark, tmp_dir):
    """Many batches leave one interval, and no more than two snapshots of a run are kept."""
    mirror = f"{tmp_dir}/mirror"
    for b in range(6):
        A.write_applied(spark, mirror, ids_frame(spark, range(b * 100, b * 100 + 100)), "a", b)
    stored = spark.read.parquet(A.ranges_path(mirror))
    assert guard(spark, mirror) == [(0, 599)]
    assert sorted(r["batch_id"] for r in stored.select("batch_id").distinct().collect()) == [4, 5]
    assert stored.count() == 2


def test_rows_that_share_an_id_are_picked_in_order(spark, tmp_dir):
    data = [(7, "U", "b"), (7, "U", "a"), (7, "D", None), (8, "I", "x"), (8, "I", "x"), (None, "U", "c"), (None, "U", "c")]
    for k in range(3):
        batch = spark.createDataFrame(data[k:] + data[:k], LOG).repartition(k + 1)
        got = sorted((tuple(r) for r in unseen(batch, f"{tmp_dir}/none", "a", 0).collect()), key=str)
        assert got == sorted([(7, "D", None), (8, "I", "x"), (None, "U", "c"), (None, "U", "c")], key=str)
