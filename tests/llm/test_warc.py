import random

from pyspark.sql import functions as F

from ledgerline.llm.queries import QUERIES
from ledgerline.llm.warc import PERMITTED, canonical_url, records_of_pages, resolve_revisits

from ..conftest import SF_SMALL

SCHEMA = "record_id long, url string, ts long, kind string, headers map<string,string>, digest string, status string, key int"


def brute(records):
    """revisit id -> (status, response id, digest, headers), from (id, key, ts, kind, headers, digest) rows."""
    out = {}
    for rid, key, ts, kind, headers, _ in records:
        if kind != "revisit":
            continue
        headers = headers or {}
        earlier = [r for r in records if r[3] == "response" and key is not None and ts is not None
                   and r[1] == key and r[2] is not None and r[2] < ts]
        best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        if best is None:
            out[rid] = ("orphan", None, None, None)
            continue
        old = best[4] or {}
        weak = lambda t: t.strip().removeprefix("W/") if t is not None else None
        if headers.get("etag") is not None:
            ok = old.get("etag") is not None and weak(headers["etag"]) == weak(old["etag"])
        else:
            ok = headers.get("last-modified") is not None and headers["last-modified"] == old.get("last-modified")
        merged = old | {k: v for k, v in headers.items() if k in PERMITTED}
        out[rid] = ("resolved", best[0], best[5], "\n".join(f"{k}: {merged[k]}" for k in sorted(merged))) if ok \
            else ("mismatch", best[0], None, None)
    return out


def result(df):
    return {r["revisit_id"]: (r["status"], r["response_id"], r["payload_digest"], r["merged_headers"])
            for r in df.collect()}


def test_canonical_url(spark):
    same = ["http://www.Example.com/a/b/?utm_source=x&b=2&a=1#top", "https://example.com:443/a/b?a=1&b=2",
            "  example.com/a/b/?b=2&ref=q&a=1 "]
    rows = spark.createDataFrame([(u,) for u in [*same, "http://example.com/A/b?a=1&b=2", "https://x.org", None, ""]],
                                 "url string").select(canonical_url(F.col("url")).alias("u")).collect()
    assert [r["u"] for r in rows] == ["example.com/a/b?a=1&b=2"] * 3 + ["example.com/A/b?a=1&b=2", "x.org", None, ""]


def test_against_brute_force_with_a_hot_url(spark):
    r = random.Random(3)
    rows = []
    for i in range(600):
        key = "hot.org/x" if i % 3 == 0 else f"u{r.randrange(60)}.org/p" if i % 50 else None
        headers = {k: v for k, v in {
            "etag": r.choice([None, '"a"', 'W/"a"', '"b"']), "last-modified": r.choice([None, "mon", "tue"]),
            "date": str(i), "content-type": f"t{i}", "vary": r.choice([None, "accept"])}.items() if v}
        rows.append((i, key, r.randrange(150) if i % 41 else None, r.choice(["response", "revisit"]),
                     headers if i % 37 else None, f"d{i}"))
    df = spark.createDataFrame([(a, f"https://www.{b}/#f" if b else None, c, d, e, f, "x", 1)
                                for a, b, c, d, e, f in rows], SCHEMA).repartition(7)
    assert result(resolve_revisits(df)) == brute(rows)


def test_empty_table_and_strange_kinds(spark):
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "http://a.org", 1, None, None, None, "x", 1), (2, "http://a.org", 2, "request", None, None, "x", 1),
            (3, None, None, "revisit", None, None, "x", 1), (3, None, None, "revisit", None, None, "x", 1)]
    got = resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r["status"] == "orphan" for r in got) and len([r for r in got if r["revisit_id"] == 3]) == 2


def test_query_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    records = [(r["record_id"], r["k"], r["ts"], r["kind"], r["headers"], r["digest"])
               for r in records_of_pages(pages).withColumn("k", canonical_url(F.col("url"))).collect()]
    got = result(QUERIES["op6_warc_revisits"](spark, SF_SMALL))
    assert got == brute(records)
    assert len(got) == pages.count() and {v[0] for v in got.values()} >= {"resolved", "mismatch"}
