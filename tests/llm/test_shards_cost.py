"""Token shards at size: the staged ids are packed tighter, and records are filled document by document."""

import numpy as np
import pyarrow as pa

from ledgerline.llm import common, shards

from .helpers import docs_of


def test_records_of_fills_sequences():
    docs = [np.arange(1, 6, dtype="<u2"), np.array([7], "<u2"), np.arange(10, 18, dtype="<u2")]
    row, sequence, out = shards.records_of(pa.array([3, None, 5], pa.int64()), pa.array([d.tobytes() for d in docs]), 4)
    assert row.tolist() == [0, 0, 1, 2, 2] and sequence.tolist() == [0, 1, 0, 0, 1]
    assert out["ids"].tolist() == [[1, 2, 3, 4], [5, 0, 0, 0], [7, 0, 0, 0], [10, 11, 12, 13], [14, 15, 16, 17]]
    assert out["length"].tolist() == [4, 1, 1, 4, 4]
    assert out["doc_id"].tolist() == [3, 3, shards.NULL_ID, 5, 5] and not out["end"].any()


def test_token_ids_are_staged_at_a_higher_level(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(shards, "staged", lambda df, *a: kept.append(a) or common.staged(df, *a))
    assert shards.shard_digest(docs_of(spark, [(1, "a b c")])).count() == 1
    assert ("tokens", "zstd", 6) in kept


def test_staged_level_packs_tighter(spark, tmp_dir):
    rng = np.random.RandomState(1)
    words = rng.zipf(1.3, 400_000).astype("<u2").tobytes()
    df = spark.createDataFrame([(bytearray(words),)], "ids binary").coalesce(1)
    sizes = []
    for level in (1, 12):
        back = common.staged(df, "level", "zstd", level)
        assert bytes(back.first()["ids"]) == words
        sizes.append(back.selectExpr("max(_metadata.file_size)").first()[0])
    assert sizes[1] < sizes[0]
