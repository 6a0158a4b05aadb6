import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import common, lm_score
from ledgerline.llm.lm_score import (
    PAIR_SHARE, Gaps, LogFrequencyFilter, count_at, levels_of, places, score,
)
from ledgerline.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .helpers import AWKWARD, docs_of, empty_docs, prose


def tokens_of(text):
    return [*(text or "").encode().lower().split(), None]


def brute(rows):
    """Exact base values, and the model's score with exact membership."""
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    train = [tokens_of(t) for (d, t), h in zip(rows, held, strict=True) if d is not None and not h]
    one = Counter(x for t in train for x in t)
    two = Counter(p for t in train for p in zip([None, *t[:-1]], t, strict=True))
    n, v = sum(one.values()), len(one)
    quantised = lambda c: float(count_at(levels_of(np.array([c])))[0]) if c else 0.0
    out = []
    for (d, t), h in zip(rows, held, strict=True):
        tokens = tokens_of(t)
        base = sum(math.log10((one[x] + 1) / (n + 1 * (v + 1))) for x in tokens)
        model = 0.0
        for before, x in zip([None, *tokens[:-1]], tokens, strict=True):
            both = quantised(two[before, x])
            p = PAIR_SHARE * both / max(quantised(one[before]), both, 1) \
                + (1 - PAIR_SHARE) * (quantised(one[x]) + 1) / (n + v + 1)
            model += math.log10(min(p, 1.0))
        out.append((d, h, len(tokens), sum(one[x] > 0 for x in tokens), n, base, model if n else 0.0))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[2], round(r[5], 6))


def check(df, rows):
    got = sorted((tuple(r) for r in df.collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    # false positives of the filter move a score a little
    off = [abs(g[6] - w[6]) / max(1.0, abs(w[6])) for g, w in zip(got, want, strict=True)]
    assert np.mean(off) < 0.02 and max(off) < 0.2


def test_awkward_rows(spark):
    df = score(docs_of(spark, AWKWARD))
    assert df.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(df, AWKWARD)


def test_empty_table_and_no_training(spark):
    assert score(empty_docs(spark)).count() == 0
    row, = score(docs_of(spark, [(None, "some words")])).collect()
    assert tuple(row) == (None, False, 3, 0, 0, 0.0, 0.0)


def test_made_corpus(spark):
    rows = [(i, " ".join(prose(i % 40, 30 + i % 50))) for i in range(150)]
    check(score(docs_of(spark, rows).repartition(6)), rows)


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(QUERIES["op9_lm_score"](spark, SF_SMALL), rows)


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(4)
    keys, counts = rng.integers(0, 2**63, 5000).astype(np.uint64), rng.integers(1, 500, 5000)
    levels = levels_of(counts)
    size = int(levels.sum()) * 12 // 64 * 64
    bits = np.zeros(size, np.uint8)
    for k in range(1, levels.max() + 1):
        bits[places(keys[levels >= k], k, size).ravel()] = 1
    made = LogFrequencyFilter(np.packbits(bits, bitorder="little"), size, 1)
    none = np.zeros(5000, np.int64)
    assert (made.levels(keys, none) >= levels).all()
    assert (made.levels(keys, none) != levels).mean() < 0.02
    assert (made.levels(rng.integers(0, 2**63, 5000).astype(np.uint64), none) > 0).mean() < 0.02


def test_gaps_round_trip():
    for keys in ([5 << 16], [1 << 16, 2 << 16, (1 << 63)], list(range(0, 1 << 24, 1 << 16))):
        a = np.array(keys, np.uint64)
        assert Gaps.unpack(*Gaps.pack(a)).tolist() == a.tolist()


def test_tokens_are_ranked_by_one_sort():
    rng = np.random.RandomState(3)
    for size, span in ((0, 1), (1, 1), (500, 40), (500, 10**9)):
        values = rng.randint(0, span, size).astype(np.uint64)
        distinct, at = common.ranked(values)
        want, inverse = np.unique(values, return_inverse=True)
        assert (distinct == want).all() and (at == inverse).all()
        learned = rng.rand(size) < 0.5
        keys, count = lm_score.learned_counts(values, learned)
        assert (keys == want).all() and count.tolist() == [int(learned[values == k].sum()) for k in want]


def test_pairs_of_several_texts_at_once():
    texts = [lm_score.tokens_of(t) for t in (b"a b a b", None, b"a", b"b a")]
    lengths = np.array([len(t) for t in texts])
    got = lm_score.text_pairs(np.concatenate(texts), np.cumsum(lengths) - lengths)
    assert (got == np.concatenate([lm_score.pairs_of(t) for t in texts])).all()
