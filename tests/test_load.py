"""Initial load from hand-written CSV exports: parse, quarantine, FK check, first wins."""

import os

from pyspark.sql import functions as F

from ledgerline.operators import clean, load
from ledgerline.schemas import PRODUCT_CSV_COLUMNS, REVIEW_CSV_COLUMNS
from ledgerline.sources.csv import LOAD_ORDER, read_products_csv, read_reviews_csv

P_HEADER = ",".join(c for c, _, _ in PRODUCT_CSV_COLUMNS)
R_HEADER = ",".join(c for c, _, _ in REVIEW_CSV_COLUMNS)


def _product(pid, price="1000", stock="5", rating="4.5", title="cat", free="True", prep="2"):
    vals = {c: "" for c, _, _ in PRODUCT_CSV_COLUMNS}
    vals.update({"_id": pid, "name": f"p{pid}", "price": price, "stock": stock, "rating_average": rating,
                 "categoryTitle": title, "isFreeShipping": free, "preparationDays": prep,
                 "vendor_id": "7", "vendor_name": "v7", "vendor_score": "3.5"})
    return ",".join(vals[c] for c, _, _ in PRODUCT_CSV_COLUMNS)


PRODUCTS_CSV = "\n".join([
    P_HEADER,
    _product("1"),
    _product("2", price="12.9", free="yes"),
    _product("3", price="9007199254740993", free="junk", prep="0"),
    _product("", price="5"),                        # missing id -> rejected
    _product("4", stock="3000000000"),              # out of range -> rejected
    _product("5", rating="100"),                    # NUMERIC(4,2) overflow -> rejected
    _product("6", title="x" * 201),                 # VARCHAR(200) -> rejected
    _product("1", price="777"),                     # duplicate id: first row wins
    _product("7", price="1e3", rating="4.555"),
]) + "\n"

REVIEWS_CSV = R_HEADER + "\n" + "\n".join([
    # embedded newline, doubled quote, literal backslash, Persian text
    'r1,1,10,5,"خوب\nline two ""quoted"" back\\slash",3,,"{\'photos\': [], \'video\': None}",True,,2024-01-02T10:11:12Z,2024-01-02',
    'r2,1,11,4.0,عالی ارسال,,,,yes,,2024-01-02T10:11:12+03:30,',
    'r3,2,12,0,bad star,,,,t,,2024-01-02,',                 # star 0 -> rejected
    'r4,2,12,6,bad star,,,,t,,2024-01-02,',                 # star 6 -> rejected
    'r5,2,13,,no star,1,2,,0,,20240102,',                   # empty star ok; compact date -> NULL
    'r6,0,13,3,product zero,,,,junk,,junk,',                 # product 0 -> rejected
    ',1,13,3,no id,,,,,,,',                                  # missing id -> rejected
    'r7,999,14,3,orphan,,,,,,,',                             # unknown product -> FK reject
    'r1,2,15,1,duplicate id later,,,,,,,',                   # duplicate id: first row wins
    'r8,1,16,2,"with, comma",3000000000,,,,,,',               # like count out of range
]) + "\n"


def _write(tmp_dir, name, text):
    path = os.path.join(tmp_dir.replace("file:", ""), name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_products_assess_and_counts(spark, tmp_dir):
    raw = read_products_csv(spark, _write(tmp_dir, "products.csv", PRODUCTS_CSV))
    assessed = clean.assess_products(raw).cache()
    reasons = {r["product_id"]: r["reject_reason"] for r in assessed.collect()}
    assert reasons[1] is None and reasons[2] is None and reasons[3] is None
    assert reasons[4] == "out_of_range" and reasons[5] == "out_of_range" and reasons[6] == "too_long"
    assert reasons[None] == "missing_key"
    counts = {r["outcome"]: r["row_count"] for r in clean.reject_counts(assessed, "products").collect()}
    assert counts == {"loaded": 5, "missing_key": 1, "out_of_range": 2, "too_long": 1}
    assert sum(counts.values()) == raw.count()   # accepted + rejected = input

    ok = load.first_wins(clean.accepted(assessed), ["product_id"], list(LOAD_ORDER))
    rows = {r["product_id"]: r for r in ok.collect()}
    assert sorted(rows) == [1, 2, 3, 7]
    assert rows[1]["price"] == 1000                       # first row of id 1 wins
    assert rows[2]["price"] == 12 and rows[2]["is_free_shipping"] is True
    assert rows[3]["price"] == 9007199254740993 and rows[3]["is_free_shipping"] is False
    assert rows[3]["preparation_days"] == 0               # clean layer keeps a real 0
    assert rows[7]["price"] == 1000 and str(rows[7]["rating_average"]) == "4.56"


def test_reviews_load(spark, tmp_dir):
    products = clean.accepted(clean.assess_products(
        read_products_csv(spark, _write(tmp_dir, "products.csv", PRODUCTS_CSV))))
    raw = read_reviews_csv(spark, _write(tmp_dir, "reviews.csv", REVIEWS_CSV))
    assert raw.count() == 10
    assessed = clean.assess_reviews(raw).cache()
    by_reason = {}
    for r in assessed.collect():
        by_reason.setdefault(r["reject_reason"], []).append(r["review_id"])
    assert sorted(by_reason["bad_star"]) == ["r3", "r4"]
    assert by_reason["missing_product"] == ["r6"]
    assert by_reason["missing_key"] == [None]
    assert by_reason["out_of_range"] == ["r8"]

    kept, orphans = load.split_by_reference(clean.accepted(assessed), products, "product_id")
    assert [r["review_id"] for r in orphans.collect()] == ["r7"]
    final = load.first_wins(kept, ["review_id"], list(LOAD_ORDER))
    rows = {r["review_id"]: r for r in final.collect()}
    assert sorted(rows) == ["r1", "r2", "r5"]
    r1 = rows["r1"]
    assert r1["description"] == 'خوب\nline two "quoted" back\\slash'
    assert r1["product_id"] == 1 and r1["like_count"] == 3 and r1["dislike_count"] == 0
    assert rows["r2"]["star"] == 4 and rows["r2"]["is_public"] is True
    assert rows["r5"]["star"] is None and rows["r5"]["created_at"] is None
    assert rows["r5"]["is_public"] is False


def test_insert_or_ignore_existing_wins(spark):
    existing = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 20, 1), ("c", 30, 2), ("c", 31, 1)], "k string, v int, pos int")
    out = load.insert_or_ignore(new, existing, ["k"], ["pos"])
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 2), ("c", 31)]


def test_limit_keeps_first_rows(spark, tmp_dir):
    raw = read_reviews_csv(spark, _write(tmp_dir, "reviews.csv", REVIEWS_CSV), limit=3)
    assert [r["_id"] for r in raw.orderBy(*LOAD_ORDER).collect()] == ["r1", "r2", "r3"]
    assert raw.filter(F.col("_id") == "r1").count() == 1


def test_initial_load_job_twice(spark, tmp_dir):
    from ledgerline.jobs import initial_load
    p = _write(tmp_dir, "products.csv", PRODUCTS_CSV)
    r = _write(tmp_dir, "reviews.csv", REVIEWS_CSV)
    root = f"{tmp_dir}/clean"
    first = initial_load(spark, p, r, root)
    assert first["products"] == {"loaded": 4, "ignored_duplicate": 1, "missing_key": 1,
                                 "out_of_range": 2, "too_long": 1}
    assert first["reviews"] == {"loaded": 3, "ignored_duplicate": 1, "bad_star": 2, "missing_product": 1,
                                "missing_key": 1, "out_of_range": 1, "orphan_product": 1}
    again = initial_load(spark, p, r, root)
    assert again["products"]["loaded"] == 0 and again["reviews"]["loaded"] == 0
    assert spark.read.parquet(f"{root}/products").count() == 4
    assert spark.read.parquet(f"{root}/reviews").count() == 3
    assert spark.read.parquet(f"{root}/rejects_reviews").filter("reject_reason = 'orphan_product'").count() == 1


def test_initial_load_with_row_cap(spark, tmp_dir):
    from ledgerline.jobs import initial_load
    p = _write(tmp_dir, "products.csv", PRODUCTS_CSV)
    r = _write(tmp_dir, "reviews.csv", REVIEWS_CSV)
    out = initial_load(spark, p, r, f"{tmp_dir}/capped", limit=3)
    # the first three rows of each file: products 1, 2, 3; reviews r1, r2, r3 (r3 has star 0)
    assert out["products"] == {"loaded": 3, "ignored_duplicate": 0}
    assert out["reviews"] == {"loaded": 2, "ignored_duplicate": 0, "bad_star": 1}


def test_columns_are_taken_by_header_name(spark, tmp_dir):
    """Shuffled, extra and missing columns, in files of different order in one load."""
    import csv as pycsv

    import pytest
    from ledgerline.sources.csv import read_raw_csv
    names = [c for c, _, _ in REVIEW_CSV_COLUMNS]
    rows = [{c: f"{c}-{i}\nline \"two\"" if c == "description" else f"{c}-{i}" for c in names} for i in range(9)]

    def write(name, header, some):
        path = os.path.join(tmp_dir, name)
        with open(path, "w", newline="", encoding="utf-8") as f:
            w = pycsv.DictWriter(f, header, extrasaction="ignore")
            w.writeheader()
            w.writerows([r | {"extra": "e"} for r in some])
        return path

    paths = [write("a.csv", names, rows[:3]), write("b.csv", ["extra", *reversed(names)], rows[3:6]),
             write("c.csv", ["productId", "_id"], rows[6:])]
    got = {r["_id"]: r for r in read_raw_csv(spark, paths, names).collect()}
    assert len(got) == 9
    for i, r in enumerate(rows):
        for c in names:
            present = i < 6 or c in ("productId", "_id")
            assert got[f"_id-{i}"][c] == (r[c] if present else None)
    first = read_raw_csv(spark, paths, names, limit=5)
    assert sorted(r["_id"] for r in first.collect()) == [f"_id-{i}" for i in range(5)]
    with pytest.raises(ValueError):
        read_raw_csv(spark, [*paths, write("d.csv", ["productId", "star"], rows)], names)


def test_read_errors_are_not_taken_for_a_first_load(spark, tmp_dir):
    import pytest
    from ledgerline.jobs import _existing
    from ledgerline.schemas import CLEAN_REVIEWS
    assert _existing(spark, f"{tmp_dir}/none", CLEAN_REVIEWS).count() == 0
    with pytest.raises(Exception):
        _existing(spark, "nosuchstore://x/y", CLEAN_REVIEWS)


def test_scratch_needs_a_shared_folder_off_local(spark):
    import pytest
    from ledgerline import session

    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key, default)

        def set(self, key, value):
            self.values[key] = value

    class Fake:
        def __init__(self, master):
            self.conf = Conf(master)

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x", ""):
        with pytest.raises(RuntimeError):
            session.scratch_root(Fake(master))
    fake = Fake("local[4]")
    assert session.scratch_root(fake) == session.scratch_root(fake)
