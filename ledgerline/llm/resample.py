"""Importance resampling towards a target: documents whose features look like a target corpus are drawn.

Features are all runs of one and two consecutive words, hashed to a fixed number
of buckets by CRC-32.  A bucket's gain is the log ratio of its share in the
target and in the corpus (both smoothed by one a bucket); a document's weight is
the mean gain of its features.  Weights get Gumbel noise from a hash of the id,
and the highest scores are drawn: a draw without replacement in proportion to
the importance of each document.

Segments
    A newline separates words, so texts are cut into lines and no word is cut.
    Equal lines meet by their text (after lower-casing, and with everything that
    separates words as a space); the features of each different line are computed
    once, in one task, and count as often as the line occurs.  Pairs of words on
    either side of a newline belong to no line and are added for each document.
    The gains of a line's features are summed once too and go back to the
    documents by the line's 128-bit hash.

    Two different lines share a hash with a chance of some 1e-13 among 1e13 lines.

What meets where: lines by their text, pre-summed in each block of texts, so that
a line that a third of the documents share is one row a block; the references to
lines by line hash, where Spark splits a hot one; the bucket counts, at most
``buckets`` numbers, on the driver and in every task.  The ranks come from a
range partitioning by score and the counts of its partitions.

Defined results
* null or empty text, or one without words: no features, weight 0, never drawn;
* rows with equal ids are documents of their own with equal noise; ties of score
  go to the smaller id (null ids first), then to fewer features;
* a null id has the noise of the empty id; an empty target leaves smoothing alone;
* an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import CACHE_WORDS, MEMORIES, blocks_of, bodies, lean, staged

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Feature buckets that a task holds at a time.
BATCH_WORDS = 400_000
#: Words of up to so many bytes have their pairs hashed from the hashes of the words.
SHORT = 64
U16 = np.dtype("<u2")

_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz\n") | frozenset(range(0x80, 0x100))
#: A-Z to a-z; what is in no word to a space; newlines stay.
_FOLD = bytes(c if (c := b | 0x20 if 0x41 <= b <= 0x5A else b) in _WORD_BYTES else 0x20 for b in range(256))


class WordSums(dict):
    """word -> its CRC-32, and its length from bit 32 on; remembered up to ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word) | len(word) << 32
        return value


WORD_SUMS = WordSums()
MEMORIES["word sums"] = WORD_SUMS.clear


def lines_of(body: bytes | None) -> list[bytes]:
    """The lines that have words, folded, in order."""
    if not body:
        return []
    return [x for line in body.translate(_FOLD).split(b"\n") if (x := line.strip(b" "))]


def line_key(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(line)


def _extend_tables() -> np.ndarray:
    """[n, k, b]: what n zero bytes make of byte k of a CRC.  The CRC is linear, so four look-ups extend it."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    out = np.empty((SHORT + 1, 4, 256), np.uint32)
    out[0] = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
    for n in range(1, SHORT + 1):
        out[n] = step[out[n - 1] & 0xFF] ^ (out[n - 1] >> np.uint32(8))
    return out


_EXTEND = _extend_tables()
_SPACE = np.uint32(zlib.crc32(b" "))


def _extended(crc: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    out = _EXTEND[n, 0, crc & 0xFF]
    for k in range(1, 4):
        out = out ^ _EXTEND[n, k, (crc >> np.uint32(8 * k)) & 0xFF]
    return out


def line_features(lines: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each line; buckets of its features, a line's words first and then its pairs of words."""
    words = [line.split() for line in lines]
    n = np.fromiter(map(len, words), np.int64, len(words))
    flat = [w for ws in words for w in ws]
    sums = np.fromiter(map(WORD_SUMS.__getitem__, flat), np.uint64, len(flat))
    crc, size = sums.astype(np.uint32), (sums >> np.uint64(32)).astype(np.int64)
    follows = np.ones(len(flat), bool)
    start = np.cumsum(n) - n
    follows[start] = False
    second = np.flatnonzero(follows)
    pair = _extended(_extended(crc[second - 1], 1) ^ _SPACE, np.minimum(size[second], SHORT)) ^ crc[second]
    for at in np.flatnonzero(size[second] > SHORT):
        pair[at] = zlib.crc32(flat[second[at] - 1] + b" " + flat[second[at]])
    out = np.empty(len(flat) + len(second), np.uint32)
    begin = 2 * start - np.arange(len(n))       # a line of n words has 2 n - 1 features
    line = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(flat)) - start[line]
    out[begin[line] + place] = crc
    out[begin[line[second]] + n[line[second]] + place[second] - 1] = pair
    return n, out % np.uint32(buckets)


def crossing(lines: list[bytes], buckets: int) -> np.ndarray:
    """Buckets of the pairs of words that a newline parts."""
    return np.fromiter((zlib.crc32(a[a.rfind(b" ") + 1:] + b" " + b.split(b" ", 1)[0]) % buckets
                        for a, b in zip(lines, lines[1:])), U16, max(len(lines) - 1, 0))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(line, n): each different line that has words, with its occurrences."""
    @lean
    def lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            count: Counter[bytes] = Counter()
            for _, body in block:
                count.update(lines_of(body))
            yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.binary()),
                                              pa.array(count.values(), pa.int64())], ["line", "n"])

    return bodies(docs).mapInArrow(lines, "line binary, n long").groupBy("line").agg(F.sum("n").alias("n"))


def segments(docs: DataFrame, buckets: int) -> DataFrame:
    """(k1, k2, n, n_words, buckets): the features of each different line, by the line's hash."""
    names = ["k1", "k2", "n", "n_words", "buckets"]

    def batch_of(lines: list[bytes], n: list[int]) -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(map(line_key, lines)), np.int64).reshape(-1, 2)
        words, found = line_features(lines, buckets)
        data, end = found.astype(U16).tobytes(), np.concatenate([[0], np.cumsum(2 * words - 1)]) * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(n, pa.int64()), pa.array(words),
             pa.array([data[a:b] for a, b in zip(end, end[1:])], pa.binary())], names)

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        count: list[int] = []
        size = 0
        for batch in batches:
            for line, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append(line)
                count.append(n)
                size += len(line)
                if size >= 4 * BATCH_WORDS:
                    yield batch_of(held, count)
                    held, count, size = [], [], 0
        if held:
            yield batch_of(held, count)

    return distinct_lines(docs).mapInArrow(
        lean(features, "word sums"), "k1 long, k2 long, n long, n_words long, buckets binary")


def references(docs: DataFrame, buckets: int) -> DataFrame:
    """(row, doc_id, keys, times, crossing): the lines of every document and its features between lines."""
    @lean
    def refer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            keys, times, cross = [], [], []
            for _, body in block:
                lines = lines_of(body)
                count = Counter(map(line_key, lines))
                keys.append(b"".join(count))
                times.append(np.fromiter(count.values(), np.int64, len(count)).tobytes())
                cross.append(crossing(lines, buckets).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in block], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(times, pa.binary()), pa.array(cross, pa.binary())],
                ["doc_id", "keys", "times", "crossing"])

    found = bodies(docs).mapInArrow(refer, "doc_id long, keys binary, times binary, crossing binary")
    return found.withColumn("row", F.monotonically_increasing_id())


def _counted(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, c) of (buckets binary, n) rows: each task sums its own, at most ``buckets`` rows."""
    @lean
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data = [np.frombuffer(x, U16) for x in batch.column(0).to_pylist()]
            if data:
                n = np.repeat(np.array(batch.column(1).to_pylist(), np.int64), [len(x) for x in data])
                total += np.bincount(np.concatenate(data), weights=n, minlength=buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "c"])

    return rows.mapInArrow(count, "bucket int, c long")


def bucket_counts(lines: DataFrame, refs: DataFrame, buckets: int) -> np.ndarray:
    """How many features of the whole corpus fall in each bucket; ``buckets`` numbers."""
    rows = _counted(lines.select("buckets", "n"), buckets).unionAll(
        _counted(refs.select("crossing", F.lit(1).cast("long")), buckets))
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("c").alias("c")).collect():
        out[r["bucket"]] = r["c"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the corpus), by bucket."""
    n = len(corpus)
    a, b = float(corpus.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * a / ((s + 1.0) * b)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _sums(data: list[bytes], gain: np.ndarray) -> np.ndarray:
    """The gains of each row's buckets added up."""
    n = np.array([len(x) // 2 for x in data], np.int64)
    total = np.concatenate([[0], np.cumsum(gain[np.frombuffer(b"".join(data), U16)])])
    end = np.cumsum(n)
    return total[end] - total[end - n]


def weights(lines: DataFrame, refs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of each document's features."""
    @lean
    def of_line(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(_sums(batch.column(3).to_pylist(), gain))], ["k1", "k2", "n_words", "gain"])

    @lean
    def of_row(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(_sums(batch.column(2).to_pylist(), gain))], ["row", "doc_id", "crossing_gain"])

    @lean
    def unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_pylist()
            key = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            times = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
            row = np.repeat(batch.column(0).to_numpy(), [len(x) // 16 for x in keys])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(times)], ["row", "k1", "k2", "times"])

    by_line = lines.select("k1", "k2", "n_words", "buckets").mapInArrow(
        of_line, "k1 long, k2 long, n_words long, gain long")
    used = refs.select("row", "keys", "times").mapInArrow(unpacked, "row long, k1 long, k2 long, times long")
    inside = used.join(by_line, ["k1", "k2"]).groupBy("row").agg(
        F.sum(F.col("times") * F.col("n_words")).alias("words"), F.sum(F.col("times") * F.col("gain")).alias("line_gain"))
    every = refs.select("row", "doc_id", "crossing").mapInArrow(of_row, "row long, doc_id long, crossing_gain long")
    n_words = F.coalesce("words", F.lit(0))
    out = every.join(inside, "row", "left").select(
        "doc_id", n_words.alias("n_words"), F.greatest(2 * n_words - 1, F.lit(0)).alias("n_features"),
        (F.coalesce("line_gain", F.lit(0)) + F.col("crossing_gain")).alias("gain"))
    mean = F.expr("(gain - pmod(gain, n_features)) div n_features")
    return out.select("doc_id", "n_words", "n_features",
                      F.when(F.col("n_features") > 0, mean).otherwise(0).cast("long").alias("weight"))


def noise(id_col: Column, seed: int) -> Column:
    """floor(1000 times a Gumbel variate) from the first 32 bits of a SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, percent: int) -> DataFrame:
    """The rows with ``rank`` 1, 2, 3... by score, for the first ``percent`` of them; others null.

    ``scored`` must be a table that reads the same each time.  Rows go to range
    partitions by score; a row's rank is its place in its partition and the rows
    of the partitions before, which only the number of partitions bounds.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "n_features"]
    n = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(scored.repartitionByRange(n, *order).sortWithinPartitions(*order)
                    .withColumn("place", F.monotonically_increasing_id()), "resample-order")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
        F.sum("rows").over(Window.partitionBy()).alias("total"))
    rank = F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(1) + F.col("offset")
    drawn = F.expr(f"({percent} * total) div 100")
    return placed.join(parts, "part").withColumn("rank", F.when(rank <= drawn, rank)).drop("part", "place", "offset", "total")


def resample(docs: DataFrame, target: DataFrame, *, target_id: str = "item_id", buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every document's weight and score, and its rank if it is drawn.

    Of the documents with at least ``min_words`` words the ``percent`` with the
    highest scores are drawn.  Returns doc_id, n_features, weight, score, rank.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets: 1 to 65536")
    wanted = target.select(F.col(target_id).cast("long").alias("doc_id"), "text")
    sides = []
    for side, name in ((docs, "documents"), (wanted, "target")):
        lines = staged(segments(side, buckets), f"resample-lines-{name}", "zstd")
        refs = staged(references(side, buckets), f"resample-rows-{name}", "zstd")
        sides.append((lines, refs, bucket_counts(lines, refs, buckets)))
    (lines, refs, corpus), (_, _, wanted_counts) = sides
    scored = weights(lines, refs, gains(corpus, wanted_counts)).withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = staged(scored, "resample-scored")
    enough = F.col("n_words") >= min_words
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked(scored.where(enough), percent).select(out).unionAll(
        scored.where(~enough).withColumn("rank", F.lit(None).cast("long")).select(out))
