import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import resample as R

from .helpers import AWKWARD, docs_of, empty_docs, prose


def features(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(rows, target):
    docs = [(d, *features(t)) for d, t in rows]
    s, t = Counter(b for *_, f in docs for b in f), Counter(b for x in target for b in features(x)[1])
    total, goal = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = []
    for d, n, f in docs:
        each = [math.floor(1000 * math.log((t[b] + 1) * total / ((s[b] + 1) * goal))) for b in f]
        weight = sum(each) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    got = []
    for k, r in enumerate(able):
        got.append((r[0], *r[2:], k + 1 if k < 25 * len(able) // 100 else None))
    got += [(r[0], *r[2:], None) for r in out if r[1] < 20]
    return Counter(got)


def target_of(spark, texts):
    return spark.createDataFrame([(i, x, 1.0) for i, x in enumerate(texts)], "item_id long, text string, score double")


def check(spark, rows, target, parts=3):
    df = R.resample(docs_of(spark, rows).repartition(parts), target_of(spark, target))
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in df.collect()) == brute(rows, target)


def made(seed=1, n=120):
    r = random.Random(seed)
    line = " ".join(prose(900, 12))
    rows = []
    for d in range(n):
        lines = [" ".join(prose(d * 10 + k, r.choice([1, 3, 9, 40]))) for k in range(r.randrange(4))]
        if d % 3 == 0:                                  # a line that a third of the documents hold, some twice
            lines[1:1] = [line.upper() if d % 2 else line] * (1 + d % 2)
        rows.append((d // 2 if d % 10 == 0 else d, ("\n\n" if d % 4 else " \n ; \n").join(lines)))
    return rows


def test_made_corpus(spark):
    check(spark, made(), [" ".join(prose(3, 50)), None, "", "alpha1 beta2\ngamma3"])


def test_awkward_rows(spark):
    rows = [*AWKWARD, (20, ("ab" * 50 + " c " + "ü" * 80 + " ") * 9), (21, "A-b_C.d\ta\x0bb\x00c\x7fd" * 5), (22, "\n\nx\n\n")]
    check(spark, rows, ["the quick brown fox", "a b c d"])


def test_empty_tables(spark):
    assert R.resample(empty_docs(spark), target_of(spark, ["a b"])).count() == 0
    check(spark, made(2, 12), [])


def test_draw_of_few_and_other_settings(spark):
    rows = made(3, 60)
    df = R.resample(docs_of(spark, rows), target_of(spark, ["alpha1"]), percent=100, min_words=1, buckets=7)
    got = sorted(r["rank"] for r in df.collect() if r["rank"])
    assert got == list(range(1, len([1 for _, t in rows if features(t)[0]]) + 1))
    with pytest.raises(ValueError):
        R.resample(docs_of(spark, rows), target_of(spark, []), buckets=1 << 17)


def test_rank_is_by_score_over_many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 37)
        check(spark, made(4, 200), [" ".join(prose(8, 80))], parts=9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_pair_sums_of_words():
    lines = [b"a", b"x yy zzz", ("w" * 64 + " " + "v" * 65 + " u").encode(), "ä 中文 b".encode()]
    n, found = R.line_features(lines, 1 << 16)
    want = []
    for line in lines:
        w = line.split()
        want += [zlib.crc32(x) % (1 << 16) for x in w + [a + b" " + b for a, b in zip(w, w[1:])]]
    assert n.tolist() == [1, 3, 3, 3] and found.tolist() == want
    assert R.line_features([], 7)[1].tolist() == [] and np.array_equal(R.crossing(lines[:2], 9), [zlib.crc32(b"a x") % 9])


def test_lines_are_counted_once(spark):
    rows = docs_of(spark, [(1, "Same line\nother"), (2, "same, LINE!\nsame line"), (3, None)])
    got = {bytes(r["line"]): r["n"] for r in R.distinct_lines(rows).collect()}
    assert got == {b"same line": 2, b"same  line": 1, b"other": 1}
