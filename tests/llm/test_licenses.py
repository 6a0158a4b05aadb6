import random
import re

from ledgerline.llm.licenses import TEMPLATES, Automaton, license_words, parse, scan_licenses

from .helpers import AWKWARD, docs_of, empty_docs


def spelled(template):
    """Every wording of a template, with replaceable regions as lists of lengths."""
    out = [[]]
    for kind, *rest in parse(template):
        if kind == "word":
            out = [w + [rest[0]] for w in out]
        elif kind == "optional":
            out = [w + extra for w in out for extra in ([], rest[0])]
        else:
            out = [w + ["anything"] * n for w in out for n in range(rest[0], rest[1] + 1)]
    return out


def test_every_wording_is_accepted_and_nothing_near_it():
    for _, template in TEMPLATES:
        automaton = Automaton(template)
        wordings = {tuple(w) for w in spelled(template)}
        for words in wordings:
            tokens = [w.encode() for w in words]
            assert automaton.match(tokens, 0) == len(tokens)
            for k in range(0 if "<<var" in template else len(tokens)):     # another word in one place
                other = tokens[:k] + [b"otherword"] + tokens[k + 1:]
                shorter = any(tuple(x.decode() for x in other[:n]) in wordings for n in range(len(other)))
                assert shorter or automaton.match(other, 0) is None


def test_against_regular_expressions():
    r = random.Random(5)
    words = "a b c d".split()
    template = "a <<optional>> b c <</optional>> <<var 1 2>> d"
    regex = re.compile("a( b c)?( [a-d]){1,2} d")
    automaton = Automaton(template)
    for _ in range(3000):
        text = [r.choice(words) for _ in range(r.randrange(1, 9))]
        spans = [e for e in range(len(text) + 1) if regex.fullmatch(" ".join(text[:e]))]
        assert automaton.match([w.encode() for w in text], 0) == (max(spans) if spans else None)


def test_awkward_rows(spark):
    rows = scan_licenses(docs_of(spark, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert (r["n_base"], r["first_word"], r["base_labels"], r["labels"], r["score"]) == (0, None, "", "", 0.0)
    counts = {r["doc_id"]: r["n_words"] for r in rows}
    assert counts[2] == 0 and counts[8] == 30_000 and counts[11] == 1
    assert scan_licenses(empty_docs(spark)).count() == 0


def test_base_and_template_labels(spark):
    text = ("Licensed under CC BY-NC 4.0. x all rights RESERVED all rights reserved.\n"
            "This work is licensed under the GNU General Public License, version 3.")
    row = scan_licenses(docs_of(spark, [(1, text), (2, "cc by"), (3, "Licensed under the Apache License, 2.0")])
                        ).orderBy("doc_id").collect()
    assert row[0]["labels"] == "cc-by,cc-by-nc-4.0,gpl,gpl-3.0,reserved"
    assert row[0]["base_labels"] == "cc-by,gpl,reserved"
    assert (row[0]["n_base"], row[0]["first_word"], row[0]["last_word"]) == (4, 2, 21)
    assert row[1]["labels"] == "cc-by" and row[1]["score"] == 0.5
    assert row[2]["labels"] == "apache-2.0" and row[2]["n_base"] == 0 and row[2]["first_word"] is None


def test_words():
    assert license_words("Ab\x7fc-D[e]`f{g} été 中".encode()) == [
        b"ab", b"c", b"d", b"e", b"f", b"g", "été".encode(), "中".encode()]
