import random

import pytest

from ledgerline.llm.decontaminate import find_items, sketch_size, without_items
from ledgerline.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .helpers import AWKWARD, docs_of, empty_docs, prose


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    out = []
    for d, t in docs:
        own = shingle_set(t)
        for i, x in items:
            s = shingle_set(x)
            if s and 100 * len(s & own) >= 80 * len(s):
                out.append((d, i, len(s & own), len(s)))
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, doc_id string")


def found(df):
    return sorted(((r["doc_id"], r["item_id"], r["shared"], r["item_shingles"]) for r in df.collect()), key=str)


def planted(seed=1):
    r = random.Random(seed)
    items = [(i, " ".join(prose(9000 + i, r.choice([5, 6, 9, 17, 33, 70])))) for i in range(25)]
    docs = []
    for d in range(60):
        words = prose(d, r.choice([3, 50, 900]))
        if d % 2:
            item = r.choice(items)[1].split()
            for _ in range(r.randrange(4)):
                item[r.randrange(len(item))] = "changed"
            at = r.randrange(len(words) + 1)
            words[at:at] = [w.upper() for w in item] if d % 4 == 1 else item
        docs.append((d, " \n".join(words)))
    return docs, items


@pytest.mark.parametrize("block", [400_000, 40])
def test_planted_items(spark, block):
    docs, items = planted()
    want = brute(docs, items)
    assert want
    assert found(find_items(docs_of(spark, docs), items_of(spark, items), block=block)) == want
    kept = without_items(docs_of(spark, docs), items_of(spark, items), block=block)
    assert kept.schema == docs_of(spark, docs).schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({d for d, _ in docs} - {x[0] for x in want})


def test_awkward_rows(spark):
    items = [(1, None), (2, ""), (3, "one two three"), (None, "jumps over the lazy dog and the"), (5, "word " * 9),
             (5, "word word word word word")]
    docs = docs_of(spark, AWKWARD)
    assert found(find_items(docs, items_of(spark, items))) == brute(AWKWARD, items)
    assert found(find_items(docs, items_of(spark, []))) == []
    assert found(find_items(empty_docs(spark), items_of(spark, items))) == []
    assert without_items(docs, items_of(spark, [])).count() == len(AWKWARD)
    assert without_items(docs, items_of(spark, items)).where("text is null").count() == 2


def test_a_sketch_cannot_be_missed():
    """A set that lacks a fifth of an item still holds one value of any sketch of that size."""
    for n in range(1, 3000):
        assert n - -(-80 * n // 100) < sketch_size(n) 


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert found(QUERIES["op3_benchmark_decontamination"](spark, SF_SMALL)) == brute(docs, items)
