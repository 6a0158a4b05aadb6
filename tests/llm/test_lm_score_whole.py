"""The filter follows its input and holds every pair: scores depend on no bound and no least count."""

import math
import zlib
from collections import Counter

import numpy as np

from ledgerline.llm.lm_score import PAIR_SHARE, count_at, levels_of, score

from .helpers import docs_of, prose
from .test_lm_score import tokens_of


def scores(df):
    return np.array([r["score"] for r in sorted(df.collect(), key=lambda r: r["doc_id"])])


def test_scores_do_not_depend_on_the_bound(spark):
    rows = [(i, " ".join(prose(i % 40, 30 + i % 50))) for i in range(150)]
    docs = docs_of(spark, rows).repartition(6)
    whole, parts = scores(score(docs)), scores(score(docs, max_bits=1 << 10))
    off = np.abs(parts - whole) / np.maximum(1, np.abs(whole))
    assert off.mean() < 0.02 and off.max() < 0.2


def exact(rows):
    """The model's score with exact membership, pairs seen once counted like all others."""
    train = [tokens_of(t) for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    one = Counter(x for t in train for x in t)
    two = Counter(p for t in train for p in zip([None, *t[:-1]], t, strict=True))
    n, v = sum(one.values()), len(one)
    quantised = lambda c: float(count_at(levels_of(np.array([c])))[0]) if c else 0.0
    out = []
    for _, t in sorted(rows):
        tokens = tokens_of(t)
        model = 0.0
        for before, x in zip([None, *tokens[:-1]], tokens, strict=True):
            both = quantised(two[before, x])
            p = PAIR_SHARE * both / max(quantised(one[before]), both, 1) \
                + (1 - PAIR_SHARE) * (quantised(one[x]) + 1) / (n + v + 1)
            model += math.log10(min(p, 1.0))
        out.append(model)
    return np.array(out)


def test_pairs_seen_once_count(spark):
    rows = [(i, " ".join(prose(i, 40))) for i in range(100)]
    got, want = scores(score(docs_of(spark, rows).repartition(6))), exact(rows)
    off = np.abs(got - want) / np.maximum(1, np.abs(want))
    assert off.mean() < 0.02 and off.max() < 0.2
