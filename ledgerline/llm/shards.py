"""Token-id shards in training order: a keyed permutation deals every sequence a global slot.

Texts become token ids, cut into sequences of at most ``length`` ids.  The i-th
sequence goes to slot ``permute(i)``: a balanced Feistel network over the
smallest even number of bits that holds all indices, walked along its cycle
until the slot lies below their number.  So slots are a bijection that needs no
sort and no table, and the order is fixed by the key.

A shard holds ``shard_records`` consecutive slots as records of one fixed
stride, so any slot is found by seek alone and a reader resumes at any of them:

    slot = shard * shard_records + position;  byte = position * stride
    record: doc_id int64, sequence uint32, length uint32, ids uint16[length],
            one line feed; little-endian, ids past the length are 0,
            a null doc_id is the smallest int64

Spark's text writer puts the records down (its row separator is the record's
last byte), so shards are committed as any Spark output: into whatever store the
cluster uses, safe against lost executors and repeated tasks.

Sequence indices need no shuffle: a map task numbers its own sequences, and the
counts of the tasks, one row each, are summed up before them.

Defined results
* null or empty text: the end id alone, one sequence;
* repeated rows get a slot each; a null id comes back null;
* an empty table writes no shard and reads back empty; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_scratch_dir
from .common import bodies, by_bucket, dealt, dealt_rows, lean, mix, packed, staged
from .tokens import WORD_MEMORY, default_path, encode_rows, word_ids

SEQUENCE_LENGTH = 512
SHARD_RECORDS = 4096
END_ID = 2
KEY = 20240607
ROUNDS = 6
#: Words a worker remembers here, where it holds little else.
REMEMBERED = 1_200_000
NULL_ID = -2**63
HEADER = np.dtype([("doc_id", "<i8"), ("sequence", "<u4"), ("length", "<u4")])


def record_type(length: int) -> np.dtype:
    return np.dtype([*HEADER.descr, ("ids", "<u2", (length,)), ("end", "u1")])


def permute(index: np.ndarray, n: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """Slots of ``index`` (values below n): a keyed bijection of 0..n-1."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix(np.uint64(key) + np.arange(1, rounds + 1, dtype=np.uint64))
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> np.uint64(half), out[walking] & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        out[walking] = (left << np.uint64(half)) | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def token_rows(docs: DataFrame, *, length: int, end_id: int, tokenizer: str | None,
               id_col: str, text_col: str) -> DataFrame:
    """(task, first, doc_id, ids): each document's ids, and the place of its first sequence within its task."""
    path = tokenizer or default_path()
    end = np.array([end_id], "<u4").astype("<u2").tobytes()

    @partial(lean, keep=WORD_MEMORY)
    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, task, n = word_ids(path, REMEMBERED), TaskContext.get().partitionId(), 0
        held: list[tuple[int, int | None, bytes]] = []

        def flush() -> pa.RecordBatch:
            first, doc, data = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([task] * len(held), pa.int32()), pa.array(first, pa.int64()), pa.array(doc, pa.int64()),
                 pa.array(data, pa.binary())], ["task", "first", "doc_id", "ids"])

        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), encode_rows(batch.column(1), ids), strict=True):
                data = found.astype("<u2").tobytes() + end
                held.append((n, doc_id, data))
                n += -(-len(data) // (2 * length))
                if len(held) >= 1000:
                    yield flush()
                    held = []
        if held:
            yield flush()

    return bodies(docs, id_col, text_col).mapInArrow(encoded, "task int, first long, doc_id long, ids binary")


def records_of(doc_ids: pa.Array, ids: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, sequence, record) of every sequence of some documents."""
    data = [np.frombuffer(x, "<u2") for x in ids.to_pylist()]
    sizes = np.array([len(x) for x in data])
    counts = -(-sizes // length)
    row = np.repeat(np.arange(len(data)), counts)
    sequence = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    # a document's sequences are consecutive rows, all but the last one full: its ids lie there in one piece
    filled = np.zeros((len(row), length), "<u2")
    places = filled.reshape(-1)
    for first, ids_of in zip(((np.cumsum(counts) - counts) * length).tolist(), data, strict=True):
        places[first:first + len(ids_of)] = ids_of
    out = np.zeros(len(row), record_type(length))
    out["doc_id"] = doc_ids.fill_null(NULL_ID).to_numpy()[row]
    out["sequence"] = sequence
    out["length"] = np.minimum(length, sizes[row] - sequence * length)
    out["ids"] = filled
    return row, sequence, out


def write_shards(docs: DataFrame, path: str, *, length: int = SEQUENCE_LENGTH, shard_records: int = SHARD_RECORDS,
                 end_id: int = END_ID, key: int = KEY, tokenizer: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> int:
    """Write all sequences as shards under ``path/shard=<n>``; returns their number."""
    rows = staged(token_rows(docs, length=length, end_id=end_id, tokenizer=tokenizer,
                             id_col=id_col, text_col=text_col), "tokens", "zstd", 6)
    # one row a map task: what came before each of them
    n = F.ceil(F.octet_length("ids") / F.lit(2 * length))
    tasks = rows.groupBy("task").agg(F.sum(n).alias("n"))
    before = staged(tasks.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"), "n"),
                    "tasks")
    total = before.agg(F.sum("n")).first()[0] or 0
    if not total:
        return 0
    shards = -(-total // shard_records)
    parts = min(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    indexed = rows.join(before, "task").select((F.col("before") + F.col("first")).alias("index"), "doc_id", "ids")
    stride = record_type(length).itemsize

    @lean
    def slots(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records to the ranges of shards, those of some documents and one range as one compressed row."""
        for batch in batches:
            row, sequence, records = records_of(batch.column(1), batch.column(2), length)
            slot = permute(batch.column(0).to_numpy()[row] + sequence, total, key)
            # the writer adds the record's last byte
            body = records.view(np.uint8).reshape(-1, stride)[:, :-1].tobytes()
            raw = pa.Array.from_buffers(pa.binary(stride - 1), len(records), [None, pa.py_buffer(body)])
            table = pa.table([pa.array(slot), raw], ["slot", "record"])
            for b, at in by_bucket(slot // shard_records * parts // shards, parts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([packed(table.take(pa.array(at)), 6)], pa.binary())],
                    ["bucket", "a"])

    @lean
    def unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("a").to_pylist():
                table = dealt_rows(blob)
                yield pa.RecordBatch.from_arrays(
                    [table.column("slot").combine_chunks(),
                     table.column("record").cast(pa.binary()).combine_chunks()], ["slot", "record"])

    placed = dealt(indexed.mapInArrow(slots, "bucket int, a binary"), parts).mapInArrow(
        unpacked, "slot long, record binary")
    (placed.withColumn("shard", F.expr(f"slot div {shard_records}").cast("int"))
     .sortWithinPartitions("shard", "slot")     # the order the writer wants, so it sorts no more
     .select("shard", F.col("record").cast("string").alias("value"))
     .write.partitionBy("shard").option("lineSep", "\n").text(path))
    return total


def read_shards(spark: SparkSession, path: str, *, length: int = SEQUENCE_LENGTH,
                shard_records: int = SHARD_RECORDS) -> DataFrame:
    """What the shards hold, a row a record: slot, shard, byte_offset, doc_id, sequence, length, ids_crc32."""
    kind = record_type(length)
    names = ["slot", "shard", "byte_offset", "doc_id", "sequence", "length", "ids_crc32"]

    @lean
    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = np.frombuffer(content.as_buffer(), kind)
                at = np.arange(len(rows))
                wide = rows["ids"].astype("<u4")
                crc = [zlib.crc32(r[:n]) for r, n in zip(wide, rows["length"].tolist(), strict=True)]
                ids = np.ascontiguousarray(rows["doc_id"])
                columns = [pa.array(at + shard * shard_records), pa.array(np.full(len(rows), shard)),
                           pa.array(at * kind.itemsize), pa.array(ids, mask=ids == NULL_ID),
                           pa.array(rows["sequence"].astype(np.int64)), pa.array(rows["length"].astype(np.int64)),
                           pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("int").alias("shard"), "content")
            .mapInArrow(parse, ", ".join(f"{n} long" for n in names)))


def shard_digest(docs: DataFrame, **options) -> DataFrame:
    """Write the shards of ``docs`` to a scratch folder and describe every record read back from them."""
    spark = docs.sparkSession
    path = f"{new_scratch_dir(spark, 'shards')}/shards"
    if not write_shards(docs, path, **options):
        return spark.createDataFrame([], "slot long, shard long, byte_offset long, doc_id long, sequence long, "
                                         "length long, ids_crc32 long")
    reading = {k: v for k, v in options.items() if k in ("length", "shard_records")}
    return read_shards(spark, path, **reading)
