"""Substring dedup by words: passages of 50 words that an earlier document has too are removed.

A word goes when a window of 50 consecutive words that covers it also starts in a
document with a smaller id.  Windows are judged on the input and never cross
documents; words are compared as they are.

Steps
1. *Which passages may recur.*  Of any 35 consecutive 16-word runs the one with
   the smallest hash is an *anchor*; a window of 50 words holds 35 of them, so
   equal windows have equal anchors.  Anchors that several documents have are
   found by grouping their hashes.
2. *Confirm recurring passages.*  Only windows of such anchors are grouped, by
   hash: the smallest id of those that several documents have is the owner.
   The owner's text gives the passage.
3. *Automata.*  Passages are dealt to shards by anchor.  Each shard compiles an
   Aho-Corasick automaton whose letters are phrases of ten words: a window is a
   word of five letters.
4. *Stream.*  Every part of every document that holds a recurring anchor goes
   through the automaton of that anchor's shard, in each of the ten ways to cut
   it into phrases.  A window found that has a smaller owner is compared with
   its passage byte by byte, and removed if it is the same.

An anchor that more than ``SHARE`` documents have is a hot one: its parts are
spread over several copies of its shard, which hold its passages each.  A
passage that a third of the corpus shares has one owner, so that little is
copied; only windows that recur are passages.

64-bit hashes select anchors and windows; a collision can only lose a window of
50 words that shares its hash with another one of the same 16 words, or cost a
useless look-up.  What is removed was equal word by word.

Defined results
* null or empty text: 0 words, nothing removed, the hash of no bytes;
* texts under 50 words keep all words;
* rows with the same id are the same document: none is earlier than the other;
* rows with a null id are no source and lose nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MULTIPLIER, blocks_of, bodies, bucket_of, lean, mix, run_lengths, staged, starts_of

LENGTH = 50
ANCHOR = 16
SPAN = LENGTH - ANCHOR + 1          # 16-word runs in a window
#: Words of a phrase, the letter of the automata; a divisor of LENGTH.
PHRASE = 10
#: Documents whose parts around one anchor meet in one copy of a shard.
SHARE = 4096
#: Parts of documents that a shard is made for.
SHARD_PARTS = 20_000
#: Windows of one automaton, and the code points that each of a letter's three characters can be.
MAX_WINDOWS = 200_000
DIGITS = 128
#: Bytes of text whose words a task holds at a time, and windows.
BATCH_BYTES = 2 << 20
BATCH_WINDOWS = 1_000_000
PASSAGE, PART = 0, 1

ANCHORS = "array<struct<anchor: long, n: long>>"


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in order of position, put together from runs of powers of two."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out, power, size, done, factor = None, hashes, 1, 0, MULTIPLIER
    while True:
        if n & size:
            # the words from ``done`` on, behind those that are there
            part = power[done:]
            out = part if out is None else out[:len(part)] * factor + part[:len(out)]
            done += size
        if done == n:
            return mix(out[:len(hashes) - n + 1])
        power = power[:-size] * factor + power[size:]
        factor, size = np.uint64(int(factor) ** 2 & 0xFFFFFFFFFFFFFFFF), size * 2


#: A value for each byte, 0 for those that separate words, and the powers of a base by place in a word.
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
_VALUES[list(b" \t\n\v\f\r")] = 0
_IN_WORD = _VALUES != 0
_POWERS = np.cumprod(np.full(256, 0xD6E8FEB86659FD93, np.uint64))


def byte_hashes(data: np.ndarray, at: np.ndarray, begins: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each word: the polynomial of its bytes, which lie at ``at``."""
    place = at - np.repeat(begins, size)
    longest = int(size.max())
    powers = _POWERS if longest <= len(_POWERS) else np.cumprod(np.full(longest, _POWERS[0], np.uint64))
    return mix(np.add.reduceat(_VALUES[data[at]] * powers[place], np.cumsum(size) - size))


class Words:
    """The words of some texts in one row: their hashes, the text of each, and where each lies in it."""

    __slots__ = ("begins", "ends", "first", "hashes", "text")

    def __init__(self, bodies_: list[bytes]) -> None:
        offset = np.cumsum([0] + [len(b) + 1 for b in bodies_])
        data = np.frombuffer(b" ".join(bodies_), np.uint8)
        inside = np.concatenate([[False], _IN_WORD[data], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        begins, ends = edge[::2], edge[1::2]
        self.hashes = byte_hashes(data, np.flatnonzero(inside[1:-1]), begins, ends - begins) if len(begins) else (
            np.empty(0, np.uint64))
        self.text = np.searchsorted(offset, begins, side="right") - 1
        self.begins, self.ends = begins - offset[self.text], ends - offset[self.text]
        self.first = np.searchsorted(self.text, np.arange(len(bodies_)))

    def starts(self, n: int) -> np.ndarray:
        """Where runs of ``n`` words of one text begin."""
        return np.flatnonzero(self.text[:-n + 1] == self.text[n - 1:]) if len(self.text) >= n else np.empty(0, np.int64)


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The anchor hash of each window of 50 words, by its first word."""
    if len(hashes) < LENGTH:
        return np.empty(0, np.int64)
    out, size = run_hashes(hashes, ANCHOR), 1
    while size * 2 <= SPAN:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:len(hashes) - LENGTH + 1], out[SPAN - size:]).view(np.int64)


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(anchor, doc_id): the anchors of each document, one for each run of windows that have it."""
    @lean
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            block = [(d, b) for d, b in block if d is not None and b]
            words = Words([b for _, b in block])
            at = words.starts(LENGTH)
            least = least_hashes(words.hashes)[at]
            doc = np.array([d for d, _ in block], np.int64)[words.text[at]] if len(at) else at
            runs = starts_of(least, doc)
            yield pa.RecordBatch.from_arrays([pa.array(least[runs]), pa.array(doc[runs])], ["anchor", "doc_id"])

    return bodies(docs).mapInArrow(find, "anchor long, doc_id long")


def with_anchors(docs: DataFrame, found: DataFrame, texts: bool) -> DataFrame:
    """(doc_id, n_words, whole_sha256, words, anchors): each document with its recurring anchors.

    ``words`` are the words joined by one space; only of documents that have
    recurring anchors, or of all for ``texts``.
    """
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                n, sha, kept = [], [], []
                for body, some in zip(part.column(1).to_pylist(), part.column(2).is_valid().to_pylist(), strict=True):
                    words = (body or b"").split()
                    line = b" ".join(words)
                    n.append(len(words))
                    sha.append(hashlib.sha256(line).hexdigest())
                    kept.append(line if some or texts else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(sha), pa.array(kept, pa.binary()), part.column(2)],
                    ["doc_id", "n_words", "whole_sha256", "words", "anchors"])

    mine = found.groupBy("doc_id").agg(F.collect_set(F.struct("anchor", "n")).alias("anchors"))
    return bodies(docs).join(mine, "doc_id", "left").mapInArrow(
        lean(counted), f"doc_id long, n_words long, whole_sha256 string, words binary, anchors {ANCHORS}"
    ).withColumn("row", F.monotonically_increasing_id())


def lists_of(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """For each row, its list of structs as one array a field (empty for null)."""
    end = column.offsets.to_numpy()
    fields = [column.values.field(k).to_numpy(zero_copy_only=False) for k in range(column.values.type.num_fields)]
    for a, b in zip(end[:-1], end[1:]):
        yield [f[a:b] for f in fields]


def together(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """All structs of a column's lists, as one array a field, and the row of each."""
    end = column.offsets.to_numpy()
    fields = [column.values.field(k).to_numpy(zero_copy_only=False)[end[0]:end[-1]]
              for k in range(column.values.type.num_fields)]
    return fields, np.repeat(np.arange(len(column)), np.diff(end))


def in_batches(batches: Iterable[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of some ``BATCH_BYTES`` of text at most; a longer text makes one by itself."""
    for batch in batches:
        size = pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(size[at:]), BATCH_BYTES)))
            yield batch.slice(at, n)
            at += n


def window_rows(some: DataFrame) -> DataFrame:
    """(w, lo, hi): hashes of the windows of recurring anchors, with their smallest and largest document."""
    def merged(w: list[np.ndarray], doc: list[np.ndarray]) -> pa.RecordBatch:
        w, doc = np.concatenate(w), np.concatenate(doc)
        order = np.lexsort((doc, w))
        w, doc = w[order], doc[order]
        first = starts_of(w)
        last = first + run_lengths(first, len(w)) - 1
        return pa.RecordBatch.from_arrays([pa.array(w[first]), pa.array(doc[first]), pa.array(doc[last])], ["w", "lo", "hi"])

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size = [], [], 0
        for batch in in_batches(batches, 1):
            words = Words(batch.column(1).to_pylist())
            at = words.starts(LENGTH)
            # an anchor that recurs anywhere is in the list of every document that has it
            (anchor, _), _ = together(batch.column(2))
            at = at[np.isin(least_hashes(words.hashes)[at], anchor)]
            held.append(run_hashes(words.hashes, LENGTH).view(np.int64)[at])
            docs.append(batch.column(0).to_numpy()[words.text[at]])
            size += len(at)
            if size >= BATCH_WINDOWS:
                yield merged(held, docs)
                held, docs, size = [], [], 0
        if size:
            yield merged(held, docs)

    return some.select("doc_id", "words", "anchors").mapInArrow(lean(find), "w long, lo long, hi long")


def sent_parts(some: DataFrame, owned: DataFrame, shards: int, share: int) -> DataFrame:
    """(shard, copy, kind, row, doc_id, start, words, places): parts around recurring anchors, and passages.

    A part holds the windows of one anchor that follow each other; a passage is
    a part, with the places of the windows that its document owns.
    """
    names = ["shard", "copy", "kind", "row", "doc_id", "start", "words", "places"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds)))

    def parts(batch: pa.RecordBatch) -> Iterator[tuple]:
        row, doc = (batch.column(k).to_numpy() for k in (0, 1))
        texts = batch.column(2).to_pylist()
        words = Words(texts)
        at = words.starts(LENGTH)
        if not len(at):
            return
        least, text = least_hashes(words.hashes)[at], words.text[at]
        (anchor, n), _ = together(batch.column(3))
        anchor, first_of = np.unique(anchor, return_index=True)
        n = n[first_of]
        first = starts_of(least, text)
        count = run_lengths(first, len(at))
        which = np.minimum(np.searchsorted(anchor, least[first]), len(anchor) - 1)
        recurs = anchor[which] == least[first]
        first, count, which = first[recurs], count[recurs], which[recurs]
        home = bucket_of(least[first].view(np.uint64) * MULTIPLIER, shards)
        copies = -(-n[which] // share)
        # windows that a document of this batch owns
        owners = batch.column(4)
        end = owners.offsets.to_numpy()
        own = owners.values.to_numpy(zero_copy_only=False)[end[0]:end[-1]]
        mine = np.zeros(len(at), bool)
        if len(own):
            by = np.repeat(doc, np.diff(end))
            order = np.argsort(own, kind="stable")
            own, by = own[order], by[order]
            w = run_hashes(words.hashes, LENGTH).view(np.int64)[at]
            found = np.minimum(np.searchsorted(own, w), len(own) - 1)
            mine = (own[found] == w) & (by[found] == doc[text])
        a = at[first]
        begin, stop = words.begins[a].tolist(), words.ends[a + count + LENGTH - 2].tolist()
        start = (a - words.first[text[first]]).tolist()
        whose = text[first].tolist()
        for k, (t, shard, many, i, m) in enumerate(zip(whose, home.tolist(), copies.tolist(), first.tolist(),
                                                       count.tolist(), strict=True)):
            body, r, d = texts[t][begin[k]:stop[k]], int(row[t]), int(doc[t])
            # copy 0 is of all anchors that are not hot, copies from 1 on of the hot ones
            yield shard, 0 if many <= 1 else 1 + r % many, PART, r, d, start[k], body, b""
            if mine[i:i + m].any():
                places = np.flatnonzero(mine[i:i + m]).astype(np.uint32).tobytes()
                for copy in [0] if many <= 1 else range(1, many + 1):
                    yield shard, copy, PASSAGE, r, d, start[k], body, places

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in in_batches(batches, 2):
            for out in parts(batch):
                held.append(out)
                size += len(out[6])
                if size >= 2 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], schema=schema)

    rows = some.select("row", "doc_id", "words", "anchors").join(owned, "doc_id", "left")
    return rows.select("row", "doc_id", "words", "anchors", "own").mapInArrow(
        lean(send), "shard int, copy int, kind int, row long, doc_id long, start long, words binary, places binary")


def spelled(numbers: np.ndarray) -> str:
    """Letters 1, 2... as three characters each, of alphabets of their own; 0 is in no window.

    A match can't begin within a letter, and no node of an automaton has more
    than ``DIGITS`` children, through which it looks one by one.
    """
    digits = np.stack([numbers % DIGITS, DIGITS + numbers // DIGITS % DIGITS, 2 * DIGITS + numbers // DIGITS ** 2], 1) + 1
    return np.where(numbers[:, None] > 0, digits, 0).astype("<u4").tobytes().decode("utf-32-le")


class PhraseAutomaton:
    """An Aho-Corasick automaton of the windows of some passages; its letters are phrases of ten words."""

    def __init__(self, passages: list[tuple[int, bytes, np.ndarray]]) -> None:
        """``passages``: (owner, words joined by one space, first words of windows)."""
        self.texts = [text for _, text, _ in passages]
        words = Words(self.texts)
        sizes = [len(p) for *_, p in passages]
        self.text = np.repeat(np.arange(len(passages)), sizes)
        at = np.concatenate([p for *_, p in passages]).astype(np.int64) + words.first[self.text]
        self.owner = np.array([o for o, *_ in passages], np.int64)[self.text]
        self.word = at
        self.begin, self.end = words.begins[at], words.ends[at + LENGTH - 1]
        keys = run_hashes(words.hashes, PHRASE)[at[:, None] + np.arange(0, LENGTH, PHRASE)]
        self.phrases, letter = np.unique(keys, return_inverse=True)
        spelling = spelled(letter.ravel() + 1)
        size = 3 * LENGTH // PHRASE
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k in range(len(at)):
            self.automaton.add_word(spelling[k * size:(k + 1) * size], k)
        self.automaton.make_automaton()

    def spans(self, docs: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(text, first word, end) of what documents with smaller ids own in some texts."""
        words = Words(texts)
        at = words.starts(PHRASE)
        if not len(at):
            return
        place = at - words.first[words.text[at]]
        # a text in the ten ways to cut it into phrases, one after the other, each followed by a 0
        at = at[np.lexsort((place, place % PHRASE, words.text[at]))]
        hashes = run_hashes(words.hashes, PHRASE)[at]
        found = np.minimum(np.searchsorted(self.phrases, hashes), len(self.phrases) - 1)
        letter = np.where(self.phrases[found] == hashes, found + 1, 0)
        begins = np.ones(len(at), bool)
        begins[1:] = at[1:] != at[:-1] + PHRASE
        line = np.zeros(len(at) + int(begins.sum()), np.int64)
        slot = np.arange(len(at)) + np.cumsum(begins)
        line[slot] = letter
        # of several 0 in a row one is enough
        kept = np.flatnonzero((line > 0) | np.append(True, line[:-1] > 0))
        first = np.zeros(len(line), np.int64)
        first[slot] = at
        first = first[kept]
        hits = list(self.automaton.iter(spelled(line[kept])))
        if not hits:
            return
        hits = np.array(hits, np.int64)
        where = first[(hits[:, 0] + 1) // 3 - LENGTH // PHRASE]
        which = hits[:, 1]
        smaller = self.owner[which] < docs[words.text[where]]
        where, which = where[smaller], which[smaller]
        order = np.argsort(where, kind="stable")
        where, which = where[order], which[order]
        # windows that follow each other in both texts are compared at once
        same = (where[1:] == where[:-1] + 1) & (self.word[which[1:]] == self.word[which[:-1]] + 1) & (
            words.text[where[1:]] == words.text[where[:-1]]) & (self.text[which[1:]] == self.text[which[:-1]])
        cut = np.flatnonzero(~same) + 1 if len(where) else np.empty(0, np.int64)
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(where)]):
            if a == b:
                continue
            t = int(words.text[where[a]])
            here = texts[t][words.begins[where[a]]:words.ends[where[b - 1] + LENGTH - 1]]
            if here == self.texts[self.text[which[a]]][self.begin[which[a]]:self.end[which[b - 1]]]:
                yield t, int(where[a] - words.first[t]), int(where[b - 1] - words.first[t]) + LENGTH
            else:
                # hashes met that shouldn't: window by window
                for k in range(a, b):
                    here = texts[t][words.begins[where[k]]:words.ends[where[k] + LENGTH - 1]]
                    if here == self.texts[self.text[which[k]]][self.begin[which[k]]:self.end[which[k]]]:
                        yield t, int(where[k] - words.first[t]), int(where[k] - words.first[t]) + LENGTH


def compiled(passages: list[tuple[int, bytes, np.ndarray]]) -> list[PhraseAutomaton]:
    """Automata of a shard's passages, of ``MAX_WINDOWS`` windows or a passage more each."""
    out, held, size = [], [], 0
    for p in passages:
        held.append(p)
        size += len(p[2])
        if size >= MAX_WINDOWS:
            out.append(PhraseAutomaton(held))
            held, size = [], 0
    return [*out, PhraseAutomaton(held)] if held else out


def located(parts: DataFrame) -> DataFrame:
    """(row, start, stop): words that recurring passages cover, each shard's parts through its automata."""
    def locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, passages, automata = None, [], None
        for batch in in_batches(batches, 6):
            shard, copy, kind, row, doc, start = (batch.column(k).to_numpy() for k in range(6))
            texts, places = batch.column(6).to_pylist(), batch.column(7).to_pylist()
            runs = starts_of(shard, copy, kind)
            held: list[tuple[int, int, int]] = []
            for a, b in zip(runs.tolist(), [*runs[1:].tolist(), batch.num_rows]):
                if (shard[a], copy[a]) != now:
                    now, passages, automata = (shard[a], copy[a]), [], None
                if kind[a] == PASSAGE:
                    passages += [(int(doc[k]), texts[k], np.frombuffer(places[k], np.uint32)) for k in range(a, b)]
                    continue
                if automata is None:
                    automata, passages = compiled(passages), []
                for automaton in automata:
                    held += [(int(row[a + t]), int(start[a + t]) + x, int(start[a + t]) + y)
                             for t, x, y in automaton.spans(doc[a:b], texts[a:b])]
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], ["row", "start", "stop"])

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (parts.repartition(n, "shard", "copy").sortWithinPartitions("shard", "copy", "kind")
            .mapInArrow(lean(locate), "row long, start long, stop long"))


def _cut(docs: DataFrame, texts: bool, share: int) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_sha256, kept): documents without what recurs."""
    anchors = staged(anchor_rows(docs), "phrase-anchors", "zstd")
    often = anchors.groupBy("anchor").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    found = staged(anchors.join(often.select("anchor", "n"), "anchor"), "phrase-recurring", "zstd")
    every = staged(with_anchors(docs, found, texts), "phrase-documents", "zstd")
    some = every.where("anchors IS NOT NULL")
    owned = (window_rows(some).groupBy("w").agg(F.min("lo").alias("doc_id"), F.max("hi").alias("hi"))
             .where("doc_id < hi").groupBy("doc_id").agg(F.collect_list("w").alias("own")))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(4 * n, found.count() // SHARD_PARTS)
    spans = located(sent_parts(some, owned, shards, share))
    gone = staged(spans, "phrase-spans").groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("found"))

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 512) for k in range(0, batch.num_rows, 512)):
                removed, runs, sha, left = [], [], [], []
                for body, (start, stop) in zip(part.column(2).to_pylist(), lists_of(part.column(3)), strict=True):
                    words = body.split(b" ") if body else []
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, stop, -1)
                    out = np.cumsum(edge)[:-1] > 0
                    line = b" ".join(w for w, x in zip(words, out.tolist(), strict=True) if not x)
                    turn = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]]).astype(np.int8))).reshape(-1, 2)
                    removed.append(int(out.sum()))
                    runs.append([{"start": a, "stop": b} for a, b in turn.tolist()])
                    sha.append(hashlib.sha256(line).hexdigest())
                    left.append(line if texts else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(removed, pa.int64()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                     pa.array(sha), pa.array(left, pa.binary())],
                    ["doc_id", "n_words", "n_removed", "spans", "kept_sha256", "kept"])

    hit = some.join(gone, "row").select("doc_id", "n_words", "words", "found").mapInArrow(
        lean(kept), "doc_id long, n_words long, n_removed long, spans array<struct<start: long, stop: long>>, "
                    "kept_sha256 string, kept binary")
    # the others keep all; those that only share an anchor are told apart by the rows that were hit
    rest = every.drop("anchors").join(gone.select("row"), "row", "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start: long, stop: long>>").alias("spans"), F.col("whole_sha256").alias("kept_sha256"),
        (F.col("words") if texts else F.lit(None).cast("binary")).alias("kept"))
    return hit.unionAll(rest)


def remove_phrases(docs: DataFrame, *, share: int = SHARE) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, text): documents without passages of earlier ones.

    ``spans`` are the removed words, as first and end; ``text`` the others joined by one space.
    """
    out = _cut(docs, True, share)
    return out.select("doc_id", "n_words", "n_removed", "spans", F.col("kept").cast("string").alias("text"))


def phrase_digest(docs: DataFrame, *, share: int = SHARE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): the same with the hash of the text instead."""
    return _cut(docs, False, share).select("doc_id", "n_words", "n_removed", "kept_sha256")
