"""Packing: cutting-stock column generation over the histogram of piece lengths.

A document's ids (with an end id) are cut into pieces of ``capacity`` tokens and
one rest.  The rests' lengths, rounded up to a grid, make a histogram of at most
``capacity / grid`` classes; a linear program chooses how often to use which
pattern of classes, and a knapsack dynamic program prices new patterns from the
program's dual values.  The histogram is the only thing the driver sees: its
size does not depend on the number of documents.  Rounded-down patterns become
sequences, what is left of the demand goes best-fit into more of them, and the
pieces of a class take its slots by rank.

Ranks come from counts per (class, bucket of documents): a class that holds a
third of all pieces is ranked in as many tasks as there are buckets.

Defined results
* null or empty text: the end id alone, one piece of length 1;
* repeated rows are packed once each; a null id is kept as null;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bodies, lean, rows_of, staged
from .tokens import WORD_MEMORY, default_path, encode, word_ids

CAPACITY = 4096
GRID = 16
END_ID = 2
#: Pivots of the linear program; a stop before the optimum still gives a valid packing.
MAX_PIVOTS = 5_000


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of items that fits: (value, count of each item); sizes ascend."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for u in range(1, capacity + 1):
        best[u] = best[u - 1]
        m = np.searchsorted(sizes, u, side="right")
        if m:
            gains = best[u - sizes[:m]] + values[:m]
            k = int(gains.argmax())
            if gains[k] > best[u] + 1e-12:
                best[u], choice[u] = gains[k], k
    counts = np.zeros(len(sizes), np.int64)
    u = capacity
    while u > 0:
        if choice[u] < 0:
            u -= 1
        else:
            counts[choice[u]] += 1
            u -= sizes[choice[u]]
    return float(best[capacity]), counts


def solve_cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                        max_pivots: int = MAX_PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Column generation: (patterns as rows, how often each is used in the linear program)."""
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)     # columns are patterns
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ demand
    for _ in range(max_pivots):
        value, pattern = knapsack(inverse.sum(axis=0), sizes, capacity)
        if value <= 1 + 1e-9:
            break
        step = inverse @ pattern
        positive = np.flatnonzero(step > 1e-9)
        if not len(positive):
            break
        leaves = positive[np.argmin(x[positive] / step[positive])]
        basis[:, leaves] = pattern
        pivot = inverse[leaves] / step[leaves]
        x = x - step * (x[leaves] / step[leaves])
        x[leaves] = pivot @ demand
        inverse -= np.outer(step, pivot)
        inverse[leaves] = pivot
    return basis.T.round().astype(np.int64), np.maximum(x, 0)[:m]


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Whole patterns that hold every piece: (classes, copies of each, number of sequences)."""
    if not counts:
        return []
    sizes = np.array(sorted(counts))
    left = np.array([counts[int(s)] for s in sizes], np.int64)
    patterns, x = solve_cutting_stock(sizes, left.astype(float), capacity)
    plan = []

    def use(pattern: np.ndarray, times: int) -> None:
        at = np.flatnonzero(pattern)
        plan.append((sizes[at], pattern[at], times))

    for pattern, times in zip(patterns, np.floor(x + 1e-9).astype(np.int64), strict=True):
        held = pattern > 0
        times = min(int(times), int((left[held] // pattern[held]).min())) if held.any() else 0
        if times:
            use(pattern, times)
            left -= pattern * times
    # what rounding left: fill one pattern after another, largest first
    while left.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for k in range(len(sizes) - 1, -1, -1):
            fits = min(int(left[k]), room // int(sizes[k]))
            pattern[k] = fits
            room -= fits * int(sizes[k])
        held = pattern > 0
        times = int((left[held] // pattern[held]).min())
        use(pattern, times)
        left -= pattern * times
    return plan


def cut(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, start, length, ids_crc32, doc_tokens."""
    path = tokenizer or default_path()
    end = end_id.to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    @partial(lean, keep=WORD_MEMORY)
    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        out: list[tuple] = []
        for doc_id, body in rows_of(batches):
            data = memoryview(encode(body, ids) + end)
            n = len(data) // 4
            out += [(doc_id, s, min(capacity, n - s), zlib.crc32(data[4 * s:4 * (s + capacity)]), n)
                    for s in range(0, n, capacity)]
            if len(out) >= 5000:
                yield _batch(out, names)
                out = []
        if out:
            yield _batch(out, names)

    return bodies(docs, id_col, text_col).mapInArrow(pieces, ", ".join(f"{n} long" for n in names))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rank`` 0.. of each row within its group, in no task more than a bucket of a group.

    Rows go to buckets by a hash of ``order``; a row's rank is the count of its
    group in earlier buckets and its place in its own.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = (df.groupBy(group, "bucket").agg(F.count("*").alias("n"))
              .select(group, "bucket", (F.sum("n").over(
                  Window.partitionBy(group).orderBy("bucket")) - F.col("n")).alias("before")))
    place = F.row_number().over(Window.partitionBy(group, "bucket").orderBy(*order))
    return (df.withColumn("place", place).join(before, [group, "bucket"])
            .withColumn("rank", F.col("before") + F.col("place") - 1).drop("bucket", "before", "place"))


def pack(docs: DataFrame, *, capacity: int = CAPACITY, grid: int = GRID, end_id: int = END_ID,
         tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with their sequence and their place in it: ``cut`` and sequence_id, offset."""
    pieces = staged(cut(docs, capacity=capacity, end_id=end_id, tokenizer=tokenizer,
                        id_col=id_col, text_col=text_col), "pieces")
    pieces = pieces.withColumn("class", F.ceil(F.col("length") / grid).cast("int"))
    counts = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count("*").alias("n")).collect()}
    plan = plan_patterns(counts, capacity // grid)

    # the slots of a class, in order: pattern after pattern, each with its copies in each sequence
    slots: dict[int, list[tuple[int, int, int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for classes, copies, times in plan:
        for c, k in zip(classes.tolist(), copies.tolist(), strict=True):
            slots.setdefault(c, []).append((given.get(c, 0), k, sequence))
            given[c] = given.get(c, 0) + k * times
        sequence += times
    tables = {c: np.array(v, np.int64).T for c, v in slots.items()}

    @lean
    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            klass, rank = (batch.column(n).to_numpy() for n in ("class", "rank"))
            ids = np.empty(len(rank), np.int64)
            for c in np.unique(klass):
                at = np.flatnonzero(klass == c)
                first, copies, base = tables[int(c)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                ids[at] = base[k] + (rank[at] - first[k]) // copies[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(ids)], [*names, "sequence_id"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    placed = ranked(pieces, "class", ["doc_id", "start", "length", "ids_crc32"]).select(*names, "class", "rank").mapInArrow(
        assign, ", ".join(f"{n} long" for n in [*names, "sequence_id"]))
    before = Window.partitionBy("sequence_id").orderBy(
        F.desc("length"), "doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
