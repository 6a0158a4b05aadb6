"""License scans: template markup compiled into token automata.

A template is wording with two kinds of markup:

    <<optional>> words <</optional>>    these words may be missing
    <<var 1 6>>                         replaceable: one to six words of any kind

Everything else is mandatory and must stand in the text word by word.  A
template becomes a nondeterministic automaton over words whose state sets are
determined lazily and remembered, so a scan takes one dictionary look-up a word
from each place where a template can begin.

Beside the templates, three base phrases are counted at every place.

Defined results
* null or empty text: no words, no labels (empty strings), score 0, places null;
* rows are independent: repeated rows and null ids give one result per row;
* other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bodies, rows_of

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Wording of public license notices, by label.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license <<optional>> version <</optional>> 2 0"),
    ("mit", "released under <<optional>> the terms of <</optional>> the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of <<var 1 6>> "
            "<<optional>> and associated documentation files <</optional>>"),
    ("gpl-3.0", "licensed under the <<optional>> terms of the <</optional>> <<optional>> gnu <</optional>> "
                "general public license <<optional>> as published by the free software foundation <</optional>> "
                "version 3"),
    ("gpl-2.0", "licensed under the <<optional>> terms of the <</optional>> <<optional>> gnu <</optional>> "
                "general public license <<optional>> as published by the free software foundation <</optional>> "
                "version 2"),
    ("cc-by-4.0", "licensed under <<optional>> a <</optional>> cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under <<optional>> a <</optional>> cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under <<optional>> a <</optional>> cc by nc 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("copyright", "copyright <<optional>> c <</optional>> <<var 1 6>> all rights reserved"),
)
TEMPLATE_SCORE, BASE_SCORE = 1.0, 0.5

ANY = None      # an edge that any word takes


def parse(template: str) -> list[tuple]:
    """("word", w), ("var", low, high) and ("optional", [words]) in order."""
    parts: list[tuple] = []
    optional: list[str] | None = None
    for mark, low, high, word in re.findall(r"<<(/?optional|var (\d+) (\d+))>>|([0-9a-z\x80-\U0010ffff]+)", template):
        if mark == "optional":
            optional = []
        elif mark == "/optional":
            parts.append(("optional", optional or []))
            optional = None
        elif mark:
            parts.append(("var", int(low), int(high)))
        elif optional is not None:
            optional.append(word)
        else:
            parts.append(("word", word))
    if not parts or parts[0][0] != "word":
        raise ValueError("a template begins with a mandatory word")
    return parts


class Automaton:
    """The words a template accepts, as a lazily determined automaton."""

    def __init__(self, template: str) -> None:
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]
        self.skips: list[list[int]] = [[]]
        at = 0
        for kind, *rest in parse(template):
            if kind == "word":
                at = self._word(at, rest[0].encode())
            elif kind == "optional":
                before = at
                for w in rest[0]:
                    at = self._word(at, w.encode())
                self.skips[before].append(at)
            else:
                low, high = rest
                marks = [at]
                for _ in range(high):
                    at = self._word(at, ANY)
                    marks.append(at)
                for m in marks[low:-1]:
                    self.skips[m].append(at)
        self.accepts = at
        self.first = self.edges[0][0][0]
        self.start = self._closure({0})
        self.known = {w for edges in self.edges for w, _ in edges if w is not ANY}
        self.steps: dict[tuple[frozenset, bytes | None], frozenset] = {}

    def _word(self, at: int, word: bytes | None) -> int:
        self.edges.append([])
        self.skips.append([])
        self.edges[at].append((word, len(self.edges) - 1))
        return len(self.edges) - 1

    def _closure(self, states: set[int]) -> frozenset:
        todo, out = list(states), set(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return frozenset(out)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        key = (states, word if word in self.known else ANY)
        if key not in self.steps:
            self.steps[key] = self._closure(
                {to for s in states for w, to in self.edges[s] if w is ANY or w == word})
        return self.steps[key]

    def match(self, words: list[bytes], at: int) -> int | None:
        """End of the longest accepted wording that begins at ``at``; None if there is none."""
        states, end = self.start, None
        while True:
            if self.accepts in states:
                end = at
            if at >= len(words):
                return end
            states = self.step(states, words[at])
            if not states:
                return end
            at += 1


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> None:
        self.automata = [(label, Automaton(t)) for label, t in templates]
        self.by_first: dict[bytes, list[tuple[str, Automaton]]] = {}
        for label, a in self.automata:
            self.by_first.setdefault(a.first, []).append((label, a))
        self.phrases: dict[bytes, list[tuple[str, list[bytes]]]] = {}
        for phrase, label in BASE_PHRASES.items():
            words = phrase.encode().split()
            self.phrases.setdefault(words[0], []).append((label, words))
        self.starts = set(self.by_first) | set(self.phrases)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int]], list[tuple[str, int, int]]]:
        """(base label, start) of each phrase, (label, start, end) of each template match."""
        base, matches = [], []
        starts = self.starts
        for i in [i for i, w in enumerate(words) if w in starts]:
            for label, phrase in self.phrases.get(words[i], ()):
                if words[i:i + len(phrase)] == phrase:
                    base.append((label, i))
            for label, automaton in self.by_first.get(words[i], ()):
                end = automaton.match(words, i)
                if end is not None:
                    matches.append((label, i, end))
        return base, matches


def license_words(body: bytes | None) -> list[bytes]:
    return WORD.findall(body.lower()) if body else []


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, *,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts and places of base phrases, labels, score, and the template spans."""
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(span))])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        out: list[dict] = []
        for doc_id, body in rows_of(batches):
            words = license_words(body)
            base, matches = scanner.scan(words)
            labels = {label for label, _ in base}
            found = {label for label, _, _ in matches}
            at = [i for _, i in base]
            out.append({
                "doc_id": doc_id, "n_words": len(words), "n_base": len(base),
                "first_word": min(at, default=None), "last_word": max(at, default=None),
                "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | found)),
                "score": TEMPLATE_SCORE if found else BASE_SCORE if labels else 0.0,
                "spans": [{"label": x, "start": s, "end": e} for x, s, e in matches]})
            if len(out) >= 2000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return bodies(docs, id_col, text_col).mapInArrow(
        rows, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, spans array<struct<label string, start long, end long>>")
