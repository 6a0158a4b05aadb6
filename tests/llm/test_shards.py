import zlib

import numpy as np
import pytest

from ledgerline.llm.queries import QUERIES
from ledgerline.llm.shards import permute, shard_digest
from ledgerline.llm.tokens import default_path, encode, word_ids

from ..conftest import SF_SMALL
from .helpers import AWKWARD, docs_of, empty_docs


def expected(docs, length):
    ids = word_ids(default_path())
    out = []
    for doc_id, text in docs:
        data = np.append(np.frombuffer(encode((text or "").encode(), ids), "<u4"), np.uint32(2))
        out += [(doc_id, k, len(data[s:s + length]), zlib.crc32(data[s:s + length].astype("<u4").tobytes()))
                for k, s in enumerate(range(0, len(data), length))]
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000, 4097])
def test_permutation_is_a_bijection(n):
    slots = permute(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    if n >= 1000:
        assert abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.15
        assert (permute(np.arange(n), n, key=1) != slots).mean() > 0.9


def check(rows, docs, length, shard_records):
    want = expected(docs, length)
    key = lambda x: (x[0] is None, *[v if v is not None else 0 for v in x])
    assert sorted(((r["doc_id"], r["sequence"], r["length"], r["ids_crc32"]) for r in rows), key=key) \
        == sorted(want, key=key)
    assert sorted(r["slot"] for r in rows) == list(range(len(want)))
    for r in rows:
        assert r["shard"] == r["slot"] // shard_records
        assert r["byte_offset"] == (r["slot"] % shard_records) * (17 + 2 * length)


def test_awkward_rows(spark):
    rows = shard_digest(docs_of(spark, AWKWARD), length=64, shard_records=32).collect()
    check(rows, AWKWARD, 64, 32)


def test_empty_table(spark):
    assert shard_digest(empty_docs(spark)).count() == 0


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(QUERIES["op8_token_shards"](spark, SF_SMALL).collect(), docs, 512, 4096)


def test_order_is_the_permutation(spark):
    """One task numbers the sequences in the order of the rows."""
    docs = [(i, f"text number {i}") for i in range(500)]
    rows = shard_digest(docs_of(spark, docs).coalesce(1).orderBy("doc_id").coalesce(1),
                        length=16, shard_records=64).collect()
    slots = permute(np.arange(500), 500)
    assert {r["doc_id"]: r["slot"] for r in rows} == {i: int(s) for i, s in enumerate(slots)}
