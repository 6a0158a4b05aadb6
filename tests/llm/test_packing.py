import zlib

import numpy as np
import pytest

from ledgerline.llm.packing import knapsack, pack, plan_patterns, solve_cutting_stock
from ledgerline.llm.queries import QUERIES
from ledgerline.llm.tokens import default_path

from ..conftest import SF_SMALL
from .helpers import AWKWARD, docs_of, empty_docs


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check_packing(rows, docs, tokenizer, capacity=4096):
    """Every id lies in one piece, pieces in one sequence, sequences gapless from 0."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    wanted = {}
    for doc_id, text in docs:
        ids = ids_of(tokenizer, text)
        wanted.setdefault((doc_id, len(ids)), []).append(ids)
    assert set(by_doc) == set(wanted)
    for key, texts in wanted.items():
        pieces = sorted((r["start"], r["length"], r["ids_crc32"]) for r in by_doc[key])
        expected = sorted(
            (s, min(capacity, len(ids) - s), zlib.crc32(np.array(ids[s:s + capacity], "<u4").tobytes()))
            for ids in texts for s in range(0, len(ids), capacity))
        assert pieces == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in rows)


def test_awkward_rows(spark, tokenizer):
    check_packing(pack(docs_of(spark, AWKWARD)).collect(), AWKWARD, tokenizer)


def test_empty_table(spark):
    df = pack(empty_docs(spark))
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert df.count() == 0


def test_query_against_brute_force(spark, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    n, used = check_packing(QUERIES["op10_packing"](spark, SF_SMALL).collect(), docs, tokenizer)
    # within 4 % of no padding at all, on 200 documents
    assert n <= -(-used // 4096) * 1.04 + 1


def test_hot_length(spark, tokenizer):
    """A third of all pieces of one length still get one slot each."""
    rows = [(i, "one two three" if i % 3 == 0 else " ".join(["word"] * (i % 57))) for i in range(600)]
    check_packing(pack(docs_of(spark, rows)).collect(), rows, tokenizer)


def test_knapsack_and_program():
    value, counts = knapsack(np.array([0.34, 0.5]), np.array([3, 5]), 10)
    assert value == pytest.approx(1.02) and counts.tolist() == [3, 0]
    sizes, demand = np.array([3, 4, 5]), np.array([20.0, 10, 30])
    patterns, x = solve_cutting_stock(sizes, demand, 10)
    assert np.allclose(patterns.T @ x, demand)
    # the optimum: no room is lost but 1 in each pattern of three 3s
    assert x.sum() == pytest.approx(25.0, abs=0.4)


def test_plan_holds_every_piece():
    counts = {1: 1, 7: 13, 100: 500, 129: 77, 255: 9, 256: 3}
    held = {}
    for classes, copies, times in plan_patterns(counts, 256):
        assert (classes * copies).sum() <= 256
        for c, k in zip(classes.tolist(), copies.tolist(), strict=True):
            held[c] = held.get(c, 0) + k * times
    assert held == counts


def test_word_cache_equals_whole_text(tokenizer):
    from ledgerline.llm.tokens import encode, word_ids
    for text in [t for _, t in AWKWARD if t] + ["don't <|endoftext|> x<|startoftext|>y I'LL á e f   Σ ΟΔΟΣ",
                                               "a\x1cb c İ ﬁ ≠ ≠"]:
        ids = np.frombuffer(encode(text.encode(), word_ids(default_path())), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
