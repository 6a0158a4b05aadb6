"""Benchmark decontamination: size-partitioned MinHash containment search.

A document is contaminated by a test item when it holds 80 % of the item's
distinct 5-word shingles, wherever they stand in it.  Plain MinHash compares
whole sets and is blind to a short item in a long document; containment needs
only values of the *item* to be found among the document's shingles.

Items are partitioned by set size (powers of two).  A partition's items keep a
MinHash sketch of their smallest shingle hashes, one more than the shingles
that a contaminated document may lack at the partition's largest size.  So a
document that holds 80 % of an item shares at least one value of its sketch: no
item is missed, and small items need only small sketches.  A document that
shares a value is a candidate, verified by the exact set of the item's shingles,
compared as words.

The items are the stated query set.  They go to the tasks in blocks of at most
``BLOCK_SHINGLES`` shingles, and the documents are read once for each block, so
what is broadcast is bounded however many items there are.

Defined results
* items with fewer than five words have no shingle and match nothing, as do null
  and empty ones; repeated item ids are searched one by one;
* documents with null or empty text match nothing; repeated rows give repeated
  results; a null id is kept;
* other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bodies, lean, ngram_hashes, rows_of, unwrapped, whole_rows, word_hashes, words_of

CONTAINMENT = 80        # per cent
SHINGLE_WORDS = 5
#: Shingles of the items of one block: about 100 bytes each, so at most some 40 MB a task.
BLOCK_SHINGLES = 400_000


def word_shingles(words: list[bytes]) -> set[bytes]:
    return {b" ".join(words[i:i + SHINGLE_WORDS]) for i in range(len(words) - SHINGLE_WORDS + 1)}


def sketch_size(n: int) -> int:
    """Values of the sketch of an item of ``n`` shingles, by the largest size of its partition."""
    largest = 1 << (n - 1).bit_length()
    return largest - -(-CONTAINMENT * largest // 100) + 1


class ItemIndex:
    """The sketches of a block of items, and their shingles for verification."""

    def __init__(self, items: list[tuple[int, bytes]]) -> None:
        self.ids: list[int] = []
        self.shingles: list[frozenset[bytes]] = []
        values, owners = [], []
        for item_id, body in items:
            words = words_of(body)
            if len(words) < SHINGLE_WORDS:
                continue
            hashes = np.unique(ngram_hashes(word_hashes(words), SHINGLE_WORDS))
            sketch = hashes[:sketch_size(len(hashes))]
            values.append(sketch)
            owners.append(np.full(len(sketch), len(self.ids)))
            self.ids.append(item_id)
            self.shingles.append(frozenset(word_shingles(words)))
        value = np.concatenate(values) if values else np.empty(0, np.uint64)
        owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(value, kind="stable")
        self.owner = owner[order]
        # each value once, with the range of its owners
        self.value, self.first = np.unique(value[order], return_index=True)
        self.last = np.append(self.first[1:], len(value))

    def search(self, body: bytes | None) -> list[tuple[int, int, int]]:
        """(item id, shingles shared, shingles of the item) of each item that the text holds."""
        words = words_of(body)
        hashes = ngram_hashes(word_hashes(words), SHINGLE_WORDS)
        if not len(hashes) or not len(self.value):
            return []
        at = np.minimum(np.searchsorted(self.value, hashes), len(self.value) - 1)
        hits = np.unique(at[self.value[at] == hashes])
        if not len(hits):
            return []
        found = []
        own = word_shingles(words)
        for k in sorted({int(o) for h in hits for o in self.owner[self.first[h]:self.last[h]]}):
            shared, n = len(self.shingles[k] & own), len(self.shingles[k])
            if 100 * shared >= CONTAINMENT * n:
                found.append((self.ids[k], shared, n))
        return found


def item_blocks(items: DataFrame, id_col: str, text_col: str, block: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of bounded size, streamed through the driver one partition at a time."""
    out: list[tuple[int, bytes]] = []
    held = 0
    for row in items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").cast("binary")
                            .alias("t")).where("t is not null").toLocalIterator():
        n = len(row["t"].split())
        if out and held + n > block:
            yield out
            out, held = [], 0
        out.append((row["i"], bytes(row["t"])))
        held += n
    if out:
        yield out


def find_items(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text",
               block: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles): every item that a document holds."""
    names = ["doc_id", "item_id", "shared", "item_shingles"]
    schema = ", ".join(f"{n} long" for n in names)

    def search(some: list[tuple[int, bytes]]) -> DataFrame:
        @lean
        def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(some)
            for doc_id, body in rows_of(batches):
                found = index.search(body)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in ([doc_id] * len(found), *zip(*found, strict=True))], names)

        return bodies(docs, id_col, text_col).mapInArrow(rows, schema)

    out = None
    for some in item_blocks(items, item_id_col, item_text_col, block):
        part = search(some)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_items(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text",
                  block: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no item."""
    out = docs
    for some in item_blocks(items, item_id_col, item_text_col, block):
        rows = whole_rows(out, id_col, text_col)

        @lean
        def free(batches: Iterable[pa.RecordBatch], some=some) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(some)
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    keep = [not index.search(b) for b in part.column("body").to_pylist()]
                    yield part.select(["body", "row"]).filter(pa.array(keep, pa.bool_()))

        kept = rows.mapInArrow(free, rows.select("body", "row").schema)
        out = unwrapped(kept.withColumn("text", F.col("body").cast("string")), docs.columns, text_col, "text")
    return out
