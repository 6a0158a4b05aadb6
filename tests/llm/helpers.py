"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

LONG = "word " * 30_000

AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog and the cat of the house in the garden"),
    (2, None),
    (3, ""),
    (4, "  \t\n \r "),
    (None, "a text without an id that is long enough to be cut into several shingles of five words"),
    (6, "the quick brown fox jumps over the lazy dog and the cat of the house in the garden"),
    (6, "the quick brown fox jumps over the lazy dog and the cat of the house in the garden"),
    (7, "Äther été ñandú 中文 \U0001f600 words"),
    (8, LONG),
    (9, "one two three"),
    (10, "one two three"),
    (None, None),
    (11, "x" * 50_000),
]


def docs_of(spark, rows):
    """(doc_id, text) rows with more columns, whose names clash with those that operators return."""
    data = [(d, t, None, "src", len(t or ""), "clash", 1.5, 7, True) for d, t in rows]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, labels string, score double, "
              "component_id int, kept boolean")


def empty_docs(spark):
    return docs_of(spark, [])


def prose(seed, n, words=("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho "
                          "sigma tau upsilon phi chi psi omega").split()):
    r = random.Random(seed)
    return [r.choice(words) + str(r.randrange(40)) for _ in range(n)]
