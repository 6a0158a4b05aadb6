import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import phrases as P
from ledgerline.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .helpers import AWKWARD, docs_of, empty_docs, prose


def brute_rows(rows):
    first = {}
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - 49):
            if d is not None:
                k = tuple(w[i:i + 50])
                first[k] = min(d, first.get(k, d))
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if d is not None and first[tuple(w[i:i + 50])] < d:
                gone[i:i + 50] = [True] * 50
        yield d, w, gone


def brute(rows):
    return Counter((d, len(w), sum(gone), hashlib.sha256(" ".join(
        x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()) for d, w, gone in brute_rows(rows))


def check(df, rows):
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    got, want = Counter(tuple(r) for r in df.collect()), brute(rows)
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def made(seed=1, n=90):
    """A passage that a third of the documents hold, parts of it, copies, near copies and repeated words."""
    r = random.Random(seed)
    passages = [prose(500 + k, m) for k, m in enumerate((60, 49, 50, 130, 400))]
    rows = []
    for d in range(n):
        w = prose(d, r.choice([3, 40, 120, 600]))
        if d % 3 == 0:
            w[5:5] = passages[0]
        for _ in range(r.randrange(3)):
            p = r.choice(passages)
            a = r.randrange(len(p) // 2)
            at = r.randrange(len(w) + 1)
            w[at:at] = p[a:a + r.choice([49, 50, 55, 200])]
        rows.append((r.randrange(60) if d % 4 else 100 + d, r.choice([" ", "\n", " \t "]).join(w)))
    rows += [(300 + d, rows[d][1]) for d in range(8)] + [(320, rows[3][1] + " tail"), (321, "head " + rows[3][1])]
    rows += [(400, "a " * 120), (401, "a " * 49), (402, "b " + "a " * 50 + "c"), (403, "a b " * 70), (404, "a b " * 25)]
    return rows


def test_awkward_rows(spark):
    rows = [*AWKWARD, (12, "Word " + "word " * 60), (-3, "word " * 50), (13, "x" * 40 + " y" * 49)]
    check(P.phrase_digest(docs_of(spark, rows)), rows)


def test_empty_table(spark):
    assert P.phrase_digest(empty_docs(spark)).count() == 0


@pytest.mark.parametrize("share", [P.SHARE, 2, 5])
def test_made_passages(spark, share):
    """A low share makes many anchors hot, so that their parts go to copies of a shard."""
    rows = made()
    check(P.phrase_digest(docs_of(spark, rows).repartition(7), share=share), rows)


def passages(n, words=80):
    texts = [" ".join(prose(k, words)).encode() for k in range(n)]
    return texts, [(k, t, np.arange(words - 49, dtype=np.uint32)) for k, t in enumerate(texts)]


def test_automata_that_are_full_go_on_in_another(monkeypatch):
    monkeypatch.setattr(P, "MAX_WINDOWS", 60)
    texts, rows = passages(5)
    automata = P.compiled(rows)
    assert len(automata) == 3 and P.compiled([]) == []
    docs = np.array([9, 0, 9, 3, 9])
    around = [b"x " * 7 + t + b" y" for t in texts]
    got = sorted(x for a in automata for x in a.spans(docs, around))
    assert got == [(k, 7, 87) for k in range(5) if docs[k] > k]


def test_windows_of_all_ways_to_cut_and_parts_of_passages():
    texts, rows = passages(3, 140)
    automaton = P.PhraseAutomaton([(o, t, p[20:60]) for o, t, p in rows])
    words = [t.split() for t in texts]
    made = [words[0][a:a + 50] for a in range(91)] + [words[1][10:130], words[2][:49], [], words[2][25:75] + words[0][25:75]]
    got = sorted(automaton.spans(np.full(len(made), 9), [b" ".join(w) for w in made]))
    want = [(a, 0, 50) for a in range(20, 60)] + [(91, 10, 99), (94, 0, 50), (94, 50, 100)]
    assert got == want


def test_hashes_that_meet_are_told_apart(monkeypatch):
    """With hashes of no use every window is a hit; only equal words are removed."""
    texts, rows = passages(2, 60)
    monkeypatch.setattr(P, "run_hashes", lambda h, n: np.zeros(max(len(h) - n + 1, 0), np.uint64))
    automaton = P.PhraseAutomaton([(o, t, p[:1]) for o, t, p in rows])
    got = sorted(automaton.spans(np.array([9, 9]), [texts[1], b" ".join([b"a"] * 70)]))
    assert got == [(0, 0, 50)]


def test_many_letters():
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(59)).encode(), np.arange(10, dtype=np.uint32)) for k in range(1400)]
    automaton = P.PhraseAutomaton(rows)
    assert len(automaton.phrases) == 1400 * 50
    assert sorted(automaton.spans(np.full(1400, 5000), [t for _, t, _ in rows])) == [(k, 0, 59) for k in range(1400)]
    s = P.spelled(np.array([0, 1, 2, 128, 129, 2 ** 21]))
    assert len(s) == 18 and s[:3] == "\0\0\0" and len({s[k:k + 3] for k in range(0, 18, 3)}) == 6


def test_words_are_those_of_the_rule():
    texts = [b"", b"one", b" \ta\x0b\x0c b\r\nc ", "ä\u00a0ü \x00 x".encode(), b"   ", b"w" * 3000 + b" a", b"one a"]
    words = P.Words(texts)
    split = [re.findall(rb"[^\x20\x09-\x0D]+", t) for t in texts]
    assert [texts[t][a:b] for t, a, b in zip(words.text, words.begins, words.ends)] == [w for s in split for w in s]
    assert words.first.tolist() == [0, 0, 1, 4, 7, 7, 9] and words.text.tolist() == [1, 2, 2, 2, 3, 3, 3, 5, 5, 6, 6]
    flat = [w for s in split for w in s]
    by = {}
    for w, h in zip(flat, words.hashes.tolist()):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)
    assert len(P.Words([]).hashes) == 0 and len(P.Words([b""]).hashes) == 0


def test_run_hashes_do_not_depend_on_the_place():
    r = random.Random(9)
    h = np.array([r.randrange(1 << 64) for _ in range(130)], np.uint64)
    for n in (1, 2, 3, 10, 16, 50, 63, 64, 130):
        a = P.run_hashes(h, n)
        assert len(a) == 131 - n and len(set(a.tolist())) == len(a)
        assert a[-1] == P.run_hashes(h[130 - n:], n)[0] and a[0] == P.run_hashes(h[:n], n)[0]
        # it is the polynomial of the words, so that any run of them gives the same
        want = 0
        for x in h[:n].tolist():
            want = (want * int(P.MULTIPLIER) + x) % (1 << 64)
        assert P.mix(np.array([want], np.uint64))[0] == a[0]
    assert len(P.run_hashes(h, 131)) == 0


def test_equal_windows_have_equal_anchors():
    r = random.Random(3)
    h = np.array([r.randrange(1 << 63) for _ in range(400)], np.uint64)
    least = P.least_hashes(h)
    assert len(least) == 351 and len(P.least_hashes(h[:49])) == 0
    for a, b in ((0, 60), (17, 67), (200, 400)):
        assert P.least_hashes(h[a:b]).tolist() == least[a:b - 49].tolist()
    g = P.run_hashes(h, P.ANCHOR)
    assert least.tolist() == [int(min(g[s:s + 35]).view(np.int64)) for s in range(351)]


def test_texts_and_spans(spark):
    rows = made(5, 30)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], tuple((s["start"], s["stop"]) for s in r["spans"]), r["text"])
                  for r in P.remove_phrases(docs_of(spark, rows)).collect())
    want = Counter()
    for d, w, gone in brute_rows(rows):
        edge = [False, *gone, False]
        turn = [i for i in range(len(edge) - 1) if edge[i] != edge[i + 1]]
        want[(d, len(w), sum(gone), tuple(zip(turn[::2], turn[1::2])),
              " ".join(x for x, g in zip(w, gone, strict=True) if not g))] += 1
    assert got == want


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(QUERIES["op13_phrase_dedup"](spark, SF_SMALL), rows)
