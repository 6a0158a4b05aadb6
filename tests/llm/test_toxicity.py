import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm.queries import QUERIES
from ledgerline.llm.toxicity import (
    Model, fit, held_out_rows, marginals, pair_marginals, score, spans_of, train, without_toxic, words_of,
)

from ..conftest import SF_SMALL
from .helpers import AWKWARD, docs_of, empty_docs, prose


def test_marginals_against_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        scores, transitions = rng.normal(size=(1, 6)), rng.normal(size=(2, 2))
        weights = {}
        for y in itertools.product((0, 1), repeat=n):
            weights[y] = np.exp(sum(scores[0, i] * y[i] for i in range(n))
                                + sum(transitions[a, b] for a, b in zip(y, y[1:])))
        z = sum(weights.values())
        want = [sum(w for y, w in weights.items() if y[i]) / z for i in range(n)]
        lengths = np.array([n])
        assert np.allclose(marginals(scores, lengths, transitions)[0, :n], want)
        _, pairs = pair_marginals(scores, lengths, transitions)
        for a in (0, 1):
            for b in (0, 1):
                assert pairs[a, b] == pytest.approx(sum(
                    w * sum(p == (a, b) for p in zip(y, y[1:])) for y, w in weights.items()) / z)


def made(n, seed):
    r = random.Random(seed)
    bad = ["vilest", "cursed", "grumdrop"]
    out = {0: [], 1: []}
    for i in range(n):
        words = prose(seed * 1000 + i, 40 + i % 30)
        if i % 2:
            for _ in range(3):
                words[r.randrange(len(words))] = r.choice([*bad, "blorx" + r.choice(["ing", "ed", "able", "ier"])])
        out[i % 2].append([w.encode() for w in words])
    return out


def test_learns_words_and_beginnings():
    words = made(400, 1)
    model = fit(words[1], words[0])
    from ledgerline.llm.toxicity import Emissions, analyse
    emissions = Emissions(model)
    held = made(200, 9)
    right = [analyse(model, emissions, [b" ".join(d)])[0][0] >= 0.7 for d in held[1]]
    wrong = [analyse(model, emissions, [b" ".join(d)])[0][0] >= 0.7 for d in held[0]]
    assert np.mean(right) > 0.97 and np.mean(wrong) < 0.01
    text = "Élan fine words and BLORXishly, vilest then more fine words".encode()
    (s, p), = analyse(model, emissions, [text])
    assert s > 0.7
    covered = " ".join(text.decode()[x["start"]:x["end"]] for x in spans_of(text, p))
    assert "vilest" in covered and "BLORXishly" in covered and "Élan" not in covered


def test_awkward_rows(spark):
    words = made(200, 2)
    model = fit(words[1], words[0])
    rows = score(docs_of(spark, AWKWARD), model).collect()
    assert len(rows) == len(AWKWARD)
    assert all(0 <= r["score"] < 0.7 and r["predicted"] == 0 for r in rows)
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    assert score(empty_docs(spark), model).count() == 0
    docs = docs_of(spark, AWKWARD)
    assert without_toxic(docs, model).schema == docs.schema
    assert without_toxic(docs, model).count() == len(AWKWARD)


def test_no_labels(spark):
    docs = docs_of(spark, AWKWARD)
    labels = spark.createDataFrame([(None, 1), (5, None), (999, 1)], "doc_id long, toxic int")
    model = train(docs, labels, held_out_rows())
    assert model.curve is None
    assert {r["score"] for r in score(docs, model).collect()} == {0.0}
    assert Model().emission(b"word") == 0


def test_query_on_held_out_labels(spark):
    got = QUERIES["op4_toxicity"](spark, SF_SMALL)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    rows = got.join(labels, "doc_id").where("toxic is not null").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert {r["held_out"] for r in got.select(
        (F.col("held_out") == (F.crc32(F.col("doc_id").cast("string")) % 3 == 1)).alias("held_out")).collect()} == {True}
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(clean) < 0.05


def test_held_out_accuracy_on_a_larger_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = train(docs, labels, held_out_rows())
    held = labels.where(held_out_rows() & F.col("toxic").isNotNull())
    rows = score(docs.join(held.select("doc_id"), "doc_id", "left_semi"), model).join(held, "doc_id").collect()
    hit = [r["predicted"] for r in rows if r["toxic"] == 1]
    false = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(hit) > 0.75 and np.mean(false) < 0.02     # some 300 toxic documents to learn from
    assert words_of(None) == []


def test_segments_are_chosen_from_both_labels(monkeypatch):
    """Long toxic documents, whose segments come first, leave room for clean ones."""
    from ledgerline.llm import toxicity
    assert toxicity.spread(5, 9) == [0, 1, 2, 3, 4] and toxicity.spread(0, 9) == []
    some = toxicity.spread(100_000, 20_000)
    assert len(some) == len(set(some)) == 20_000 and some == toxicity.spread(100_000, 20_000)
    assert all(3500 < sum(a <= i < a + 20_000 for i in some) < 4500 for a in range(0, 100_000, 20_000))
    monkeypatch.setattr(toxicity, "SAMPLE_SEGMENTS", 200)
    filler = [w.encode() for w in prose(1, 60)]
    toxic = [[b"vileword", *filler[k % 50:k % 50 + 9]] * 60 for k in range(60)]         # over 700 segments
    clean = [[*filler[k % 40:k % 40 + 15], b"vileword"] if k < 3 else filler[k % 40:] for k in range(300)]
    model = toxicity.fit(toxic, clean)
    assert model.weights and all(np.isfinite(list(model.weights.values())))
