"""Conversation prefix trie: the shared beginnings of all conversations, as a tree of turns.

A turn becomes an id of fixed width (16 bytes of a SHA-256 of role and text, then
the text's length in UTF-8 bytes, big-endian), a conversation the string of its
turns' ids.  The strings go into adaptive radix trees: nodes branch on one byte,
grow through layouts of 4, 16, 48 and 256 children, and hold the bytes that do
not branch as one compressed path.  Only byte depths that end a turn are nodes of
the result.  Two different turns share an id with a chance below 1e-18 among 1e10.

How trees of parts become one
    Conversations are range partitioned and sorted by their string (its first
    ``ORDER_TURNS`` turns, then the conversation's id, so that a string which a
    third of the conversations share is spread as well), and each run of
    ``BLOCK_KEYS`` of them grows one tree.  A node lies in several runs only if
    the smallest or the largest string of a run begins with it.  Such *border*
    nodes are sent with what the run knows of them and are added up by a
    128-bit hash of their path; all others are complete.  Totals of the
    subtrees of border nodes come from pointer doubling among border nodes
    alone.  The ids of the conversations that end at a border node are hashed in
    order, chunk by chunk, and are never gathered.

A task holds one run of strings.  A conversation's ids meet in one row, 20 bytes
a turn; texts never leave the rows that they come in.

Defined results
* turns go by ``turn`` (nulls first), then by their id: repeated rows are turns
  of their own; a null role or text is the empty one;
* a row without ``conv_id`` belongs to no conversation and is left out;
* a conversation without turns is a member of the root alone;
* an empty table gives no rows, not even the root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, lean, ship_package, staged

DIGEST = 16
#: Bytes of a turn's id: digest and length.
WIDTH = DIGEST + 4
#: Turns of a string that range partitions go by.
ORDER_TURNS = 64
#: Strings, and their bytes, that grow one tree.
BLOCK_KEYS = 20_000
BLOCK_BYTES = 4 << 20
#: Conversations take the beginning of the one whose id is the next lower multiple of this.
GROUP = 5
#: Up to one turn less than this is taken.
HEADS = 9

LOWEST = np.int64(-1 << 63)
NO_IDS = hashlib.sha256(b"").hexdigest()
SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string, node binary, parent binary, last_bytes long, ends binary")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class Node:
    """A node of an adaptive radix tree: the bytes of ``key`` up to ``stop`` lead to it."""

    __slots__ = ("ends", "index", "key", "kids", "layout", "least", "leaves", "n", "saved", "stop", "tops")

    def __init__(self, key: bytes, stop: int) -> None:
        self.key, self.stop = key, stop
        self.layout = 4
        self.index: bytearray | None = bytearray()
        self.kids: list[Node | None] = []
        self.ends: list[int] = []

    def find(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = self.index.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == 48:
            return self.kids[self.index[byte] - 1] if self.index[byte] else None
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> None:
        """Add a child, or replace that of the same byte."""
        if self.layout <= 16:
            at = self.index.find(byte)
            if at >= 0:
                self.kids[at] = kid
            elif len(self.kids) < self.layout:
                self.index.append(byte)
                self.kids.append(kid)
            else:
                self._grow()
                self.put(byte, kid)
        elif self.layout == 48:
            if self.index[byte]:
                self.kids[self.index[byte] - 1] = kid
            elif len(self.kids) < 48:
                self.kids.append(kid)
                self.index[byte] = len(self.kids)
            else:
                self._grow()
                self.put(byte, kid)
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        """The next larger layout: byte list, slot of each byte, child of each byte."""
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            slots = bytearray(256)
            for slot, byte in enumerate(self.index, 1):
                slots[byte] = slot
            self.layout, self.index = 48, slots
        else:
            kids: list[Node | None] = [None] * 256
            for byte, slot in enumerate(self.index):
                if slot:
                    kids[byte] = self.kids[slot - 1]
            self.layout, self.index, self.kids = 256, None, kids

    def children(self) -> Iterator[Node]:
        return (k for k in self.kids if k is not None)


def common_length(a: bytes, b: bytes, start: int = 0) -> int:
    """Bytes that two strings share at their beginning, known to be at least ``start``."""
    n = min(len(a), len(b))
    while start < n and a[start:start + WIDTH] == b[start:start + WIDTH]:
        start += WIDTH
    while start < n and a[start] == b[start]:
        start += 1
    return min(start, n)


def insert(root: Node, key: bytes, conv: int) -> None:
    above, node, depth = None, root, 0
    while True:
        if node.key[depth:node.stop] != key[depth:node.stop]:
            # the compressed path parts here: a node between takes both sides
            at = common_length(key, node.key, depth)
            between = Node(key, at)
            between.put(node.key[at], node)
            above.put(key[above.stop], between)
            node = between
        if len(key) == node.stop:
            node.ends.append(conv)
            return
        kid = node.find(key[node.stop])
        if kid is None:
            kid = Node(key, len(key))
            kid.ends.append(conv)
            node.put(key[node.stop], kid)
            return
        above, node, depth = node, kid, node.stop


def turn_depths(start: int, stop: int) -> range:
    """The byte depths after ``start`` and up to ``stop`` at which a turn ends."""
    return range((start // WIDTH + 1) * WIDTH, stop + 1, WIDTH)


def text_bytes(key: bytes, depth: int) -> int:
    """Bytes of the text of the turn that ends at a depth; the root has none."""
    return int.from_bytes(key[depth - WIDTH + DIGEST:depth], "big") if depth else 0


def sum_up(root: Node) -> None:
    """Members, smallest member and totals of every node, children first.

    ``tops`` counts the children in turns of the last turn on the node's path,
    ``leaves`` and ``saved`` hold the node's whole path and all below it.
    """
    order = [(root, -1)]
    for node, _ in order:
        order += [(kid, node.stop) for kid in node.children()]
    while order:
        node, start = order.pop()
        kids = list(node.children())
        node.n = len(node.ends) + sum(k.n for k in kids)
        node.least = min([k.least for k in kids] + node.ends[:1])
        node.tops = sum(1 if turn_depths(node.stop, k.stop) else k.tops for k in kids)
        own = turn_depths(start, node.stop)
        node.leaves = sum(k.leaves for k in kids) + (1 if own and not node.tops else 0)
        node.saved = sum(k.saved for k in kids) + (node.n - 1) * sum(text_bytes(node.key, d) for d in own)


def ends_hash(ids: Iterable[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def packed_ids(ids: list[int]) -> bytes:
    """Ids as bytes that sort as they do."""
    return (np.array(ids, np.int64) ^ LOWEST).astype(">i8").tobytes()


def unpacked_ids(data: bytes) -> list[int]:
    return (np.frombuffer(data, ">i8").astype(np.int64) ^ LOWEST).tolist()


def rows_of_tree(root: Node, low: bytes, high: bytes) -> Iterator[tuple]:
    """Rows of a summed tree, as ``SCHEMA`` says; ``low`` and ``high``: its border strings."""
    whole = ORDER_TURNS * WIDTH
    border: list[list] = []
    # node, byte depth of its parent, conv_id of the parent turn, the parent's entry in border, hash of the path
    todo = [(root, -1, None, None, hashlib.blake2b(digest_size=DIGEST))]
    while todo:
        node, start, parent, entry, path = todo.pop()
        key, saved = node.key, node.saved
        reach = -1                                  # depth to which the path is that of a border string
        if entry is not None or node is root:
            reach = node.stop if key[:whole] in (low, high) and len(key) > whole else max(
                common_length(key, low), common_length(key, high))
        depths = turn_depths(start, node.stop)
        for d in depths:
            children = node.tops if d == depths[-1] else 1
            ends = node.ends if d == node.stop else []
            if d <= reach:
                path = path.copy()
                path.update(key[d - WIDTH:d] if d else b"")
                above = border[entry][8] if entry is not None else None
                border.append([node.least, d // WIDTH, None, node.n, 0, 0, 0, None, path.digest(), above,
                               text_bytes(key, d), packed_ids(ends) if ends else None])
                entry = len(border) - 1
            else:
                above = None
                if entry is not None:
                    up = border[entry]
                    up[4], up[5], up[6] = up[4] + 1, up[5] + node.leaves, up[6] + saved
                    above, parent = up[8], None
                yield (node.least, d // WIDTH, parent, node.n, children, node.leaves, saved,
                       ends_hash(ends) if ends else NO_IDS, None, above, None, None)
                entry = None
            parent = node.least
            saved -= (node.n - 1) * text_bytes(key, d)
        todo += [(kid, node.stop, parent, entry, path) for kid in node.children()]
    yield from map(tuple, border)


def tree_rows(keys: list[tuple[bytes, int]]) -> Iterator[tuple]:
    """Rows of the tree of some (string, conv_id) pairs, sorted as the partitions are."""
    root = Node(b"", 0)
    for key, conv in keys:
        insert(root, key, conv)
    sum_up(root)
    whole = ORDER_TURNS * WIDTH
    return rows_of_tree(root, keys[0][0][:whole], keys[-1][0][:whole])


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, key): every conversation as the string of its turns' ids, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(text)
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    ids = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.concat(F.substring(digest, 1, 2 * DIGEST), F.lpad(F.hex(size), 8, "0"))).alias("id"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "id")))
    return ids.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("key"))


def with_shared_heads(seqs: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Conversations rebuilt: the first turns of another conversation, then their own after as many.

    Conversation c takes its first crc32(c) % ``heads`` turns from conversation
    c - c % ``group`` (the remainder has the sign of c); those that are missing there are left out.
    """
    head = seqs.select(F.col("conv_id").alias("base"), F.substring("key", 1, (heads - 1) * WIDTH).alias("head"))
    taken = (crc_mod(F.col("conv_id"), heads) * WIDTH).cast("int")
    own = seqs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "taken": taken})
    return own.join(head, "base", "left").select("conv_id", F.expr(
        "concat(substring(coalesce(head, X''), 1, taken), substring(key, taken + 1))").alias("key"))


def _grown(seqs: DataFrame) -> DataFrame:
    """The rows of the trees of all runs of sorted strings."""
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t])
                        for n, t in (c.split() for c in SCHEMA.split(", "))])

    def batches_of(keys: list[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in tree_rows(keys):
            held.append(row)
            if len(held) == 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    @lean
    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple[bytes, int]] = []
        size = 0
        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys.append((key, conv))
                size += len(key)
                if len(keys) >= BLOCK_KEYS or size >= BLOCK_BYTES:
                    yield from batches_of(keys)
                    keys, size = [], 0
        if keys:
            yield from batches_of(keys)

    n = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.substring("key", 1, ORDER_TURNS * WIDTH), F.col("conv_id")]
    return seqs.select("key", "conv_id").repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(grow, SCHEMA)


def _hashed_ends(chunks: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, ends): chunks of ids that follow each other."""
    @lean
    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])],
                                              ["node", "ends_sha256"])
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                ids = ",".join(map(str, unpacked_ids(batch.column(1)[i].as_py()))).encode()
                if name != node:
                    if state:
                        yield row()
                    node, state = name, hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
        if state:
            yield row()

    return (chunks.repartition("node").sortWithinPartitions("node", "ends")
            .mapInArrow(hashed, "node binary, ends_sha256 string"))


def _merged(border: DataFrame) -> DataFrame:
    """Border nodes with the sums of all runs and of their subtrees."""
    nodes = border.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("kids"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("last_bytes").alias("last_bytes"))
    nodes = staged(nodes, "trie-border")
    more = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    now = nodes.join(more, "node", "left").withColumn("n_children", F.expr("kids + coalesce(more, 0)"))
    now = staged(now.select(
        "node", "parent", "conv_id", "depth", "n_convs", "n_children", F.col("parent").alias("above"),
        F.expr("n_leaves + if(n_children = 0, 1, 0)").alias("n_leaves"),
        F.expr("saved_tokens + (n_convs - 1) * last_bytes").alias("saved_tokens")), "trie-border")
    # pointer doubling: each round adds the sums of the nodes that are 1, 2, 4... turns below
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        below = now.where("above IS NOT NULL").groupBy(F.col("above").alias("node")).agg(
            F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        higher = now.select(F.col("node").alias("above"), F.col("above").alias("next"))
        now = staged(now.join(below, "node", "left").join(higher, "above", "left").select(
            "node", "parent", "conv_id", "depth", "n_convs", "n_children", F.col("next").alias("above"),
            F.expr("n_leaves + coalesce(leaves, 0)").alias("n_leaves"),
            F.expr("saved_tokens + coalesce(saved, 0)").alias("saved_tokens")), "trie-border")
    return now


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row for each node of the trie of (conv_id, key) strings of turn ids.

    conv_id is the smallest member of the node, parent_conv_id that of its
    parent (null for the root); n_leaves and saved_tokens cover the subtree;
    ends_sha256 is of the ids of the conversations that end at the node.
    """
    ship_package(seqs.sparkSession)
    # written first: range partitioning reads its input twice
    found = staged(_grown(staged(seqs, "trie-strings", "zstd")), "trie-rows", "zstd")
    border = found.where("node IS NOT NULL")
    merged = _merged(border)
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("above_conv"))
    ends = _hashed_ends(border.where("ends IS NOT NULL").select("node", "ends"))
    inner = found.where("node IS NULL")
    parts = [
        inner.where("parent IS NULL"),
        inner.where("parent IS NOT NULL").drop("parent_conv_id").join(above, "parent")
        .withColumnRenamed("above_conv", "parent_conv_id"),
        merged.join(above, "parent", "left").join(ends, "node", "left")
        .withColumnRenamed("above_conv", "parent_conv_id")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS))),
    ]
    return parts[0].select(COLUMNS).unionAll(parts[1].select(COLUMNS)).unionAll(parts[2].select(COLUMNS))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of all conversations, rebuilt with shared heads."""
    return prefix_trie(with_shared_heads(sequences(turns)))
