"""Language-model scoring with a log-frequency Bloom filter (Talbot & Osborne, 2007).

Counting
    Documents are dealt out by id.  Each bucket counts its training tokens and
    token pairs and deals the counts out by hash, those it only scores with a
    count of 0; there, counts of one token or pair from all buckets are added up.
    All tokens and pairs with a count go into the filter.

The filter
    An n-gram of count c is put in ``1 + floor(log2 c)`` times, with the level as
    part of the key.  A query probes level after level until one is missing: the
    levels found give the quantised count.  The filter is cut into segments of
    the buckets of hashes, each made and probed by the task that adds the counts
    up: it probes every n-gram that a bucket of documents asked for and sends the
    levels back, with the exact counts of tokens (for the base score).  A segment
    has ``BITS`` bits for each level put in, whatever the corpus; one of more than
    ``PART_BITS`` is made and probed in parts, so what a task holds of it is bounded.
    Nothing of the filter is broadcast.

The model
    P(w | v) = ``PAIR_SHARE`` * c(v w) / c(v) + (1 - ``PAIR_SHARE``) * P(w), where
    P(w) = (c(w) + 1) / (N + V + 1); all c are quantised counts from probes, N and
    V are exact.  A text begins after an end token.

Tokens are compared by 64-bit hashes, pairs by 48 bits.

Defined results
* null or empty text: the end token alone;
* a null id is not learned from, and ``held_out`` is false for it;
* repeated rows are learned from and scored once each; other columns are ignored;
* without training tokens N = V = 0 and every score is 0 (log10 of 1).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    MULTIPLIER, bodies, bucket_of, deal_rows, dealt, dealt_rows, lean, mix, n_buckets, ranked, staged, starts_of,
    word_hashes, words_of,
)

HOLD_OUT, MODULUS = 2, 7
PAIR_SHARE = 0.6
#: Bits of the filter for each level put in, and about how many a task makes at a time.
BITS = 12
PART_BITS = 1 << 24
PROBES = 4
#: Tokens that are scored at a time.
CHUNK_TOKENS = 200_000
#: Rows of one kind each in the tables that are dealt out.
TOKENS, REPLIES, PAIRS, SUMS, ROWS, PAIR_REPLIES = range(6)

U64, U32 = np.dtype("<u8"), np.dtype("<u4")
#: The end token, which is no hash of a word that the tests know of: a fixed value.
END = np.uint64(0x5EED0E4D5EED0E4D)
TOKEN_SALT = np.uint64(0x7E57AB1E0FF1CE55)
KEEP48 = np.uint64(0xFFFF_FFFF_FFFF_0000)
SCHEMA = "kind int, bucket int, part int, a binary, b binary, n1 long, n2 long"


def tokens_of(body: bytes | None) -> np.ndarray:
    return np.append(word_hashes(words_of(body)), END)


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """Each token with the one before it; the first follows an end."""
    return text_pairs(tokens, np.zeros(1, np.int64))


def text_pairs(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The pairs of several texts, whose tokens begin at ``first``."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first] = END
    return mix(before * MULTIPLIER + tokens) & KEEP48


def learned_counts(keys: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and how often each is learned from: 0 for those only scored."""
    order = np.argsort(keys)
    keys = keys[order]
    at = starts_of(keys)
    return keys[at], np.add.reduceat(learned[order], at, dtype=np.int64)


def remainder(doc_id: int | None) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % MODULUS


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1


def _counts() -> np.ndarray:
    levels = np.arange(65)
    return np.where(levels > 0, np.floor((np.exp2(levels - 1) + np.exp2(levels) - 1) / 2), 0.0)


#: By number of levels.
COUNTS = _counts()


def count_at(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a number of levels; 0 for none."""
    return COUNTS[levels]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = starts_of(keys)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


class Gaps:
    """Sorted 48-bit keys of one bucket as gaps of four bytes, or eight where one needs it."""

    @staticmethod
    def pack(keys: np.ndarray) -> tuple[int, bytes]:
        small = keys >> np.uint64(16)
        gaps = np.diff(small, prepend=np.uint64(0))
        gaps[0] = 0
        wide = bool((gaps >> np.uint64(32)).any())
        return int(small[0]) * 2 + wide, gaps.astype(U64 if wide else U32).tobytes()

    @staticmethod
    def unpack(first: int, data: bytes) -> np.ndarray:
        gaps = np.frombuffer(data, U64 if first & 1 else U32).astype(U64)
        gaps[0] = first >> 1
        return np.cumsum(gaps, dtype=U64) << np.uint64(16)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      ["kind", "bucket", "part", "a", "b", "n1", "n2"])


def _blobs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def local_counts(dealt_docs: DataFrame, buckets: int) -> DataFrame:
    """Counts of one bucket of documents, dealt by hash of token and pair."""
    @lean
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, learn, bucket = [], [], None
        for batch in batches:
            for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("a").to_pylist(), strict=True):
                bucket = b
                table = dealt_rows(blob)
                for doc_id, body in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True):
                    tokens.append(tokens_of(body))
                    learn.append(remainder(doc_id) not in (None, HOLD_OUT))
        if bucket is None:
            return
        lengths = np.array([len(t) for t in tokens])
        every, learned = np.concatenate(tokens), np.repeat(learn, lengths)
        tokens.clear()
        token, count = learned_counts(every, learned)
        bounds = np.searchsorted(bucket_of(token, buckets), np.arange(buckets + 1))
        for w in range(buckets):
            s, e = bounds[w], bounds[w + 1]
            if s < e:
                yield _batch([(TOKENS, w, bucket, token[s:e].tobytes(), count[s:e].astype(U32).tobytes(), 0, 0)])
        key, n = learned_counts(text_pairs(every, np.cumsum(lengths) - lengths), learned)
        bounds = np.searchsorted(bucket_of(key, buckets), np.arange(buckets + 1))
        for w in range(buckets):
            s, e = bounds[w], bounds[w + 1]
            if s < e:
                first, gaps = Gaps.pack(key[s:e])
                yield _batch([(PAIRS, w, bucket, gaps, n[s:e].astype(U32).tobytes(), first, 0)])

    return dealt(dealt_docs, buckets).mapInArrow(rows, SCHEMA)


def total_counts(local: DataFrame, buckets: int, part_bits: int) -> DataFrame:
    """Replies to the buckets of documents: exact counts of tokens, and levels found in the filter.

    REPLIES rows: ``a`` counts, ``b`` levels of the tokens that ``bucket`` asked
    for; PAIR_REPLIES: ``b`` levels of its pairs.  SUMS rows: ``n1`` the training
    tokens N and ``n2`` the distinct V.
    """
    @lean
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, keys, counts, bucket = {TOKENS: [], PAIRS: []}, {TOKENS: [], PAIRS: []}, {TOKENS: [], PAIRS: []}, None
        for kind, w, part, a, b, first, _ in _blobs(batches):
            bucket = w
            asked[kind].append(part)
            keys[kind].append(np.frombuffer(a, U64) if kind == TOKENS else Gaps.unpack(first, a))
            counts[kind].append(np.frombuffer(b, U32).astype(np.int64))
        if bucket is None:
            return
        if keys[TOKENS]:
            token, count = summed(np.concatenate(keys[TOKENS]), np.concatenate(counts[TOKENS]))
            found = probed(mix(token ^ TOKEN_SALT), count, part_bits)
            for part, key in zip(asked[TOKENS], keys[TOKENS], strict=True):
                at = np.searchsorted(token, key)
                yield _batch([(REPLIES, part, bucket, count[at].astype(U64).tobytes(), found[at].tobytes(), 0, 0)])
            yield _batch([(SUMS, bucket, 0, b"", b"", int(count.sum()), int((count > 0).sum()))])
        if keys[PAIRS]:
            pair, count = summed(np.concatenate(keys[PAIRS]), np.concatenate(counts[PAIRS]))
            found = probed(pair, count, part_bits)
            for part, key in zip(asked[PAIRS], keys[PAIRS], strict=True):
                yield _batch([(PAIR_REPLIES, part, bucket, b"", found[np.searchsorted(pair, key)].tobytes(), 0, 0)])

    return dealt(local, buckets).mapInArrow(rows, SCHEMA)


def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bits of keys at one level within a segment: one row a probe."""
    h = mix(keys + np.uint64(level * int(MULTIPLIER) % 2**64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((h & np.uint64(0xFFFFFFFF)) + np.uint64(i) * step) % np.uint64(size) for i in range(PROBES)])


def _runs(sizes: list[int], most: int) -> Iterator[list[int]]:
    """Positions in runs of about ``most`` in all; a larger one makes a run by itself."""
    run, held = [], 0
    for i, size in enumerate(sizes):
        run.append(i)
        held += size
        if held >= most:
            yield run
            run, held = [], 0
    if run:
        yield run


class LogFrequencyFilter:
    """Segments of ``size`` bits, one a bucket of hashes."""

    def __init__(self, bits: np.ndarray, size: int, buckets: int) -> None:
        self.bits, self.size, self.buckets = bits, size, buckets

    def levels(self, keys: np.ndarray, segments: np.ndarray) -> np.ndarray:
        """Levels found of each key: probes go on while the level before was there."""
        found = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        level = 1
        while len(left) and level < 64:
            at = places(keys[left], level, self.size) + (segments[left] * self.size).astype(np.uint64)
            there = np.ones(len(left), bool)
            for row in at:
                there &= (self.bits[row >> np.uint64(3)] >> (row & np.uint64(7)).astype(np.uint8)) & 1 == 1
            left = left[there]
            found[left] = level
            level += 1
        return found


def made_filter(keys: np.ndarray, levels: np.ndarray) -> LogFrequencyFilter:
    """One segment that holds the keys at all of their levels, sized by them."""
    size = max(64, -(-BITS * int(levels.sum()) // 64) * 64)
    bits = np.zeros(size, np.uint8)
    for k in range(1, int(levels.max(initial=0)) + 1):
        bits[places(keys[levels >= k], k, size).ravel()] = 1
    return LogFrequencyFilter(np.packbits(bits, bitorder="little"), size, 1)


def probed(keys: np.ndarray, counts: np.ndarray, part_bits: int) -> np.ndarray:
    """Levels found of each key in the filter of those with a count, in parts of about ``part_bits`` bits."""
    levels = np.where(counts > 0, levels_of(counts), 0)
    found = np.zeros(len(keys), np.uint8)
    # parts end by the bits before them, and by keys too where few have a count
    part = np.maximum((np.cumsum(levels) - levels) * BITS // part_bits, np.arange(len(keys)) * BITS // part_bits)
    starts = np.append(starts_of(part), len(keys))
    for s, e in zip(starts[:-1], starts[1:], strict=True):
        put = levels[s:e] > 0
        made = made_filter(keys[s:e][put], levels[s:e][put])
        found[s:e] = made.levels(keys[s:e], np.zeros(e - s, np.int64))
    return found


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_bits: int = PART_BITS) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    buckets = n_buckets(docs)
    texts = deal_rows(bodies(docs, id_col, text_col), buckets, ROWS)
    totals = staged(total_counts(local_counts(texts, buckets), buckets, max_bits), "counts")
    sums = totals.where(F.col("kind") == SUMS).agg(F.sum("n1"), F.sum("n2")).first()
    n, v = int(sums[0] or 0), int(sums[1] or 0)

    @lean
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, tokens, replies, levels, pair_levels = [], [], {}, {}, {}
        for kind, _, part, a, b, _, _ in _blobs(batches):
            if kind == REPLIES:
                replies[part], levels[part] = np.frombuffer(a, U64), np.frombuffer(b, np.uint8)
                continue
            if kind == PAIR_REPLIES:
                pair_levels[part] = np.frombuffer(b, np.uint8)
                continue
            table = dealt_rows(a)
            ids += table.column(0).to_pylist()
            tokens += [tokens_of(b) for b in table.column(1).to_pylist()]
        if not ids:
            return
        lengths = np.array([len(t) for t in tokens])
        every = np.concatenate(tokens)
        tokens.clear()
        ends = np.cumsum(lengths)
        token, token_at = ranked(every)
        # replies come in the order of the buckets of hashes, which is the order of the tokens
        count = np.concatenate([replies[w] for w in sorted(replies)]).astype(np.float64)
        base = np.log10((count + 1) / (n + (v + 1)))
        quantised = count_at(np.concatenate([levels[w] for w in sorted(levels)]))
        # so do those for pairs
        pair_at = ranked(text_pairs(every, ends - lengths))[1]
        pair_level = np.concatenate([pair_levels[w] for w in sorted(pair_levels)])
        out = []
        end = int(np.searchsorted(token, END))
        for some in _runs(lengths.tolist(), CHUNK_TOKENS):
            s, e = ends[some[0]] - lengths[some[0]], ends[some[-1]]
            first = (ends - lengths)[some] - s
            at = token_at[s:e]
            before = np.append(end, at[:-1])
            before[first] = end
            both = count_at(pair_level[pair_at[s:e]])
            single = (quantised[at] + 1) / (n + v + 1)
            p = PAIR_SHARE * both / np.maximum(np.maximum(quantised[before], both), 1) + (1 - PAIR_SHARE) * single
            known = np.add.reduceat((count[at] > 0).astype(np.int64), first)
            sums = np.add.reduceat(base[at], first)
            scores = np.add.reduceat(np.log10(np.minimum(p, 1.0)), first)
            out += [(ids[i], remainder(ids[i]) == HOLD_OUT, int(k), int(a), n, float(x), float(y) if n else 0.0)
                    for i, k, a, x, y in zip(some, lengths[some], known, sums, scores, strict=True)]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                         ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    none = [F.lit(None).cast(t).alias(c) for c, t in (("b", "binary"), ("n1", "long"), ("n2", "long"))]
    meeting = texts.select("kind", "bucket", F.lit(0).alias("part"), "a", *none).unionAll(
        totals.where(F.col("kind").isin(REPLIES, PAIR_REPLIES)))
    return dealt(meeting, buckets).mapInArrow(
        rows, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double")
