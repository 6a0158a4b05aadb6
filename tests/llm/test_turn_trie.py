import hashlib
import math
import random
import zlib
from collections import Counter

import pytest

from ledgerline.llm import turn_trie as T


def brute(rows, rebuilt=True):
    """Nodes of (conv_id, turn, role, text) rows; all turns of a conversation must have different numbers."""
    convs = {}
    for c, n, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    if rebuilt:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
        convs = {c: convs.get(c - int(math.fmod(c, 5)), [])[:h[c]] + t[h[c]:] for c, t in convs.items()}
    members, ends, kids = {}, {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
            if d:
                kids.setdefault(tuple(turns[:d - 1]), set()).add(tuple(turns[:d]))
        ends.setdefault(tuple(turns), []).append(c)
    total = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        below = [total[k] for k in kids.get(path, ())]
        total[path] = (sum(b[0] for b in below) or 1, sum(b[1] for b in below) + own)
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, ())), *total[p],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                   for p, m in members.items())


def turns_of(spark, rows):
    data = [(c, n, r, t, 7, "clash", 1.5) for c, n, r, t in rows]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, depth int, node string, key double")


def check(spark, rows, parts=3):
    df = T.conversation_trie(turns_of(spark, rows).repartition(parts))
    assert df.columns == T.COLUMNS
    got, want = Counter(tuple(r) for r in df.collect()), brute(rows)
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def made(seed=1, n=120, long=0):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        same = c % 3 == 0                               # a third of the conversations are equal
        size = 4 if same else r.randrange(1, 12)
        for k in range(size):
            who = ("user", "assistant")[k % 2]
            rows.append((c, k, who, f"same {k}" if same or r.random() < 0.6 else f"text é {r.randrange(4)} {c if k > 5 else ''}"))
    rows += [(n + 5, k, "user", f"long {k}") for k in range(long)]
    rows += [(n + 6, k, "user", f"long {k}") for k in range(long)]
    return rows


def test_made_conversations(spark):
    check(spark, made())


def test_rows_beyond_the_order_of_ranges(spark):
    """Strings longer than what range partitions go by, and copies of them."""
    rows = made(2, 20, 150)
    rows += [(c, k, "user", f"long {k}" if k < 100 else f"end {c} {k}") for c in range(200, 210) for k in range(130)]
    check(spark, rows)


@pytest.mark.parametrize("block", [1, 2, 7])
def test_any_block_size_gives_the_same_nodes(spark, block, monkeypatch):
    rows = made(3, 40)
    df = turns_of(spark, rows)
    seqs = T.with_shared_heads(T.sequences(df)).collect()
    whole = T.ORDER_TURNS * T.WIDTH
    keys = sorted(((bytes(r["key"]), r["conv_id"]) for r in seqs), key=lambda k: (k[0][:whole], k[1]))
    rows_ = [x for i in range(0, len(keys), block) for x in T.tree_rows(keys[i:i + block])]
    inner = [x for x in rows_ if x[8] is None]
    assert all(x[0] is not None and x[11] is None for x in inner)
    n = spark.createDataFrame(rows_, T.SCHEMA)
    merged = T._merged(n.where("node IS NOT NULL")).collect()
    want = brute(rows)
    got = Counter((x[0], x[1], x[3], x[4], x[5], x[6]) for x in inner)
    got += Counter((r["conv_id"], r["depth"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in merged)
    short = Counter()
    for w, c in want.items():
        short[(w[0], w[1], w[3], w[4], w[5], w[6])] += c
    assert got == short


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "no conversation"), (1, None, "user", "first"), (1, 0, None, None), (1, 1, "", ""),
            (5, 0, "user", "x" * 100_000), (6, 0, "user", "alone"), (7, 3, "user", "gap"), (-4, 0, "a", "below zero"),
            (-5, 0, "a", "below zero"), (10, 0, "u:", "a"), (11, 0, "u", ":a"), (2, 9, "user", "\x00\n,")]
    check(spark, rows)
    check(spark, rows, 1)
    assert T.conversation_trie(turns_of(spark, [])).count() == 0
    assert T.conversation_trie(turns_of(spark, [(None, 1, "user", "x")])).count() == 0


def test_ties_of_turns_are_ordered_by_id(spark):
    rows = [(5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "user", "a"), (5, None, "user", "c")]
    seqs = T.sequences(turns_of(spark, rows)).collect()
    again = T.sequences(turns_of(spark, rows[::-1]).repartition(4)).collect()
    assert len(seqs) == 1 and len(seqs[0]["key"]) == 4 * T.WIDTH and seqs == again


def test_layouts_grow_and_keep_every_child():
    r = random.Random(4)
    root, keys = T.Node(b"", 0), []
    sizes = set()
    for k in range(400):
        turns = [bytes([k % 256, k // 256]) + bytes(14) + (k % 7).to_bytes(4, "big") for _ in range(1 + k % 3)]
        keys.append((b"".join(turns), k))
    r.shuffle(keys)
    for key, c in keys:
        T.insert(root, key, c)
        sizes.add(root.layout)
    assert sizes == {4, 16, 48, 256}
    node_of = {}
    todo = [root]
    while todo:
        node = todo.pop()
        for c in node.ends:
            node_of[c] = node.key[:node.stop]
        todo += node.children()
    assert node_of == {c: key for key, c in keys}


def test_paths_are_compressed():
    root = T.Node(b"", 0)
    key = bytes(range(1, 1 + T.WIDTH)) * 50
    T.insert(root, key, 1)
    T.insert(root, key[:30 * T.WIDTH], 2)
    T.insert(root, key[:-1] + b"\xff", 3)
    nodes, todo = 0, [root]
    while todo:
        nodes += 1
        todo += todo.pop().children()
    assert nodes == 5
    T.sum_up(root)
    assert len(list(T.rows_of_tree(root, b"", b""))) == 52


def test_chunks_of_ids_are_hashed_in_order(spark):
    ids = [-9, -1, 0, 3, 2 ** 40, 2 ** 62]
    rows = [(b"n", T.packed_ids(ids[:1])), (b"n", T.packed_ids(ids[4:])), (b"n", T.packed_ids(ids[1:4])),
            (b"m", T.packed_ids([5]))]
    df = spark.createDataFrame(rows, "node binary, ends binary").repartition(3)
    got = {bytes(r["node"]): r["ends_sha256"] for r in T._hashed_ends(df).collect()}
    assert got == {b"n": T.ends_hash(ids), b"m": T.ends_hash([5])}
