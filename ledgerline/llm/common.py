"""Helpers that several operators share: word hashes, blocks of texts, staged tables, components."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch_dir, ship_package

#: Texts that one task holds at a time while it builds a block.
BLOCK_BYTES = 3 << 20
#: Words whose hashes a worker remembers; the memory is emptied when full.
CACHE_WORDS = 250_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to ``CACHE_WORDS`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


WORD_HASHES = WordHashes()


def words_of(body: bytes | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; other bytes stay as they are."""
    return body.lower().split() if body else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits of the input."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words, in order of position."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:m].copy()
    for j in range(1, n):
        out *= MULTIPLIER
        out += hashes[j:j + m]
    return mix(out)


def shingles(words: list[bytes], n: int = 5) -> np.ndarray:
    """The set of n-word shingle hashes, sorted; fewer words make one shingle, none make none."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(ngram_hashes(word_hashes(words), min(n, len(words))))


Task = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


#: Memories of words that a worker holds, by name: how to empty them.
MEMORIES: dict[str, Callable[[], None]] = {"word hashes": WORD_HASHES.clear}


def forget(but: str | None) -> None:
    """Empty this worker's memories.  A function of the module, so that it is the worker's own ones."""
    for name, empty in MEMORIES.items():
        if name != but:
            empty()


@functools.cache
def settled() -> None:
    """Once a worker: what its modules hold stays, so no later collection looks through it."""
    gc.collect()
    gc.freeze()


def lean(task: Task, keep: str | None = None) -> Task:
    """Give a task's memory back at its end: workers are reused, and allocators keep what was freed.

    ``keep`` names the memory that tasks of this kind pass on to the next of
    them; tasks of other kinds empty it when they begin.
    """
    @functools.wraps(task)
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled()
        forget(keep)
        yield from task(batches)
        forget(keep)
        gc.collect()
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)
    return run


def bodies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, body binary): the whole text as UTF-8 bytes; other columns are dropped."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").cast("binary").alias("body"))


def whole_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, row): the other columns of a row go along as one struct."""
    ship_package(docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").cast("binary").alias("body"), F.struct(*rest).alias("row"))


def unwrapped(df: DataFrame, columns: list[str], text_col: str, text: str) -> DataFrame:
    """The columns of whole rows again, with column ``text`` as their text."""
    return df.select(*[F.col(text).alias(c) if c == text_col else F.col(f"row.`{c}`") for c in columns])


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes | None]]:
    """The (doc_id, body) rows of Arrow batches, a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)


def blocks_of(batches: Iterable[pa.RecordBatch], size: int = BLOCK_BYTES
              ) -> Iterator[list[tuple[int | None, bytes | None]]]:
    """Rows in blocks of about ``size`` bytes of text; a longer text makes a block by itself."""
    block: list = []
    held = 0
    for row in rows_of(batches):
        block.append(row)
        held += len(row[1] or b"") + 64
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def n_buckets(docs: DataFrame) -> int:
    """Buckets to deal out by hash: the shuffle partitions set, and at least one for each input split."""
    conf = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(conf, docs.rdd.getNumPartitions())


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket 0..n-1 by the upper half of the hash."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def dealt(blobs: DataFrame, n: int) -> DataFrame:
    """Rows to the partition that their ``bucket`` names, so that a partition holds one whole bucket."""
    return blobs.repartitionById(n, F.col("bucket").cast("int"))


def by_bucket(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) of each bucket that has any."""
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(n + 1))
    for b in range(n):
        if bounds[b] < bounds[b + 1]:
            yield b, order[bounds[b]:bounds[b + 1]]


def joined(batches: Iterable[pa.RecordBatch], columns: list[tuple[str, type]]) -> dict[str, list[np.ndarray]]:
    """The binary columns of all rows as arrays: name -> one array a row."""
    out: dict[str, list[np.ndarray]] = {name: [] for name, _ in columns}
    for batch in batches:
        for name, kind in columns:
            out[name] += [np.frombuffer(x, kind) for x in batch.column(name).to_pylist()]
    return out


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal rows in sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    if len(new):
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def run_lengths(starts: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(starts, total))


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and of each value its place among them."""
    order = np.argsort(values)
    new = starts_of(values[order])
    rank = np.empty(len(values), np.int64)
    rank[order] = np.repeat(np.arange(len(new)), run_lengths(new, len(values)))
    return values[order[new]], rank


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(values, kind="stable")
    count = run_lengths(starts_of(values[order]), len(values))
    out = np.empty(len(values), bool)
    out[order] = np.repeat(count > 1, count)
    return out


def staged(df: DataFrame, purpose: str, compression: str = "snappy", level: int | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost executors.

    ``level`` is that of zstd, where the default of 3 packs too little.
    """
    spark: SparkSession = df.sparkSession
    path = f"{new_scratch_dir(spark, purpose)}/table"
    w = df.write.option("compression", compression)
    if level is not None:
        w = w.option("parquet.compression.codec.zstd.level", level)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus


def components(edges: DataFrame, purpose: str = "components", max_rounds: int = 50) -> DataFrame:
    """Connected components of (a, b) edges: (node, root), root the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each
    joins every node to the smallest node near it, until nothing changes.
    Minima are pre-aggregated map-side; a node with very many edges is a hot
    join key, which AQE splits.  Only nodes with an edge are returned.
    """
    def canonical(e: DataFrame) -> DataFrame:
        return (e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where("a <> b").distinct())

    now = staged(canonical(edges), purpose)
    size = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
    for _ in range(max_rounds):
        if not size[0]:
            break
        # large star: every larger neighbour of a node goes to the smallest node near it
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(low, both["a"] == low["k"]).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        large = canonical(large)
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        pairs = large.join(low, large["a"] == low["k"])
        small = pairs.select(F.explode(F.array(
            F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e")).select(
            F.col("e.b").alias("a"), F.col("e.m").alias("b"))
        now = staged(canonical(small), purpose)
        before, size = size, now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        # a forest of stars is a fixed point: every node has one edge, to its root
        if size == before:
            break
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def id_hashes(ids: list[int | None]) -> np.ndarray:
    """Document ids spread over 64 bits; rows without an id are spread by their place."""
    return mix(np.array([d if d is not None else ~i for i, d in enumerate(ids)], np.int64).view(np.uint64))


def deal_rows(rows: DataFrame, n: int, kind: int,
              home: Callable[[pa.Table], np.ndarray] | None = None) -> DataFrame:
    """Whole rows, whose first columns are doc_id and body, to their bucket of ``n``: by document id, or ``home``.

    (kind, bucket, a): ``a`` holds the rows of one block and bucket as one
    compressed Arrow stream, so that texts shuffle at the size of their
    compressed form.
    """
    out = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("a", pa.binary())])
    if home is None:
        home = lambda t: bucket_of(id_hashes(t.column(0).to_pylist()), n)

    @lean
    def blobs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            for b, at in by_bucket(home(table), n):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind], pa.int32()), pa.array([b], pa.int32()),
                     pa.array([packed(table.take(pa.array(at)))], pa.binary())], schema=out)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                held.append(part)
                size += sum(len(b.as_buffer()) if b.is_valid else 0 for b in part.column(1)) + 64 * part.num_rows
                if size >= BLOCK_BYTES:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return rows.mapInArrow(blobs, "kind int, bucket int, a binary")


def packed(table: pa.Table, level: int = 3) -> bytes:
    """Rows as one compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    # small streams: handing their buffers to threads costs more than packing them
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level), use_threads=False)
    with pa.ipc.new_stream(sink, table.schema, options=options) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def dealt_rows(blob: bytes) -> pa.Table:
    """The rows that ``packed`` took."""
    return pa.ipc.open_stream(blob, options=pa.ipc.IpcReadOptions(use_threads=False)).read_all()


def low_bytes(values: np.ndarray, n: int) -> bytes:
    """The low ``n`` bytes of 64-bit values."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :n].tobytes()


def from_low_bytes(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, n)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :n] = raw
    return out.view("<u8").ravel()
