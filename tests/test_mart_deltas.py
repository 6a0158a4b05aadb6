"""Marts refreshed by deltas equal a full rebuild after any sequence of changes."""

import datetime as dt
import random

import pytest

from ledgerline.operators import marts
from ledgerline.operators.versions import latest_per_key
from ledgerline.schemas import DIM_PRODUCTS_LOG, FACT_REVIEWS_LOG
from ledgerline.sinks.parquet import list_batches
from ledgerline.streaming import mart_state as M

AS_OF = "2024-03-10"


def product(r, pid, version, deleted=0):
    row = dict.fromkeys(DIM_PRODUCTS_LOG.names)
    row |= {"product_id": pid, "vendor_id": r.randrange(4), "sales_count_week": r.randrange(50), "_version": version,
            "rating_average": r.choice([None, 0, 1, 2]) or 0, "vendor_name": f"v{r.randrange(9)}", "vendor_owner_city": "c",
            "vendor_province_id": r.randrange(5), "category_id": r.randrange(3), "category_title": f"t{r.randrange(3)}",
            "preparation_days": 1, "is_free_shipping": r.randrange(2), "_deleted": deleted}
    return row


def review(r, rid, version, deleted=0):
    row = dict.fromkeys(FACT_REVIEWS_LOG.names)
    at = dt.datetime(2024, 1, 20) + dt.timedelta(days=r.randrange(50), hours=r.randrange(24))
    row |= {"review_id": f"r{rid}", "product_id": r.randrange(14), "vendor_id": 0, "star": r.randrange(6), "like_count": r.randrange(9),
            "has_attachment": r.randrange(2), "description": "é" * r.randrange(4), "created_at": at, "created_day": at.date(),
            "created_month": at.strftime("%Y%m"), "_version": version, "_deleted": deleted}
    return row


def frame(spark, rows, schema):
    import decimal
    fix = lambda x, f: decimal.Decimal(x).quantize(decimal.Decimal("0.01")) if f.name == "rating_average" else x
    return spark.createDataFrame([tuple(fix(x[f.name], f) for f in schema.fields) for x in rows], schema)


def plain(df):
    return sorted((tuple(r) for r in df.drop("computed_at").collect()), key=str)


def expected(spark, products, reviews):
    """The four marts built in full from all versions so far."""
    p = latest_per_key(frame(spark, products, DIM_PRODUCTS_LOG), ["product_id"], ["_version"]).where("_deleted = 0")
    v = latest_per_key(frame(spark, reviews, FACT_REVIEWS_LOG), ["review_id"], ["_version"]).where("_deleted = 0")
    return {M.VENDORS: marts.build_top_vendors(p, v), M.PRODUCTS: marts.build_free_shipping(p),
            M.TRENDING: marts.build_trending(p, v, AS_OF), M.REVIEWS: marts.build_engagement(v)}


def same(spark, root, products, reviews, only=M.MART_NAMES):
    store = M.MartStore(spark, root)
    for name, want in expected(spark, products, reviews).items():
        if name in only:
            got = store.read(name)
            assert got.columns == want.columns
            assert plain(got) == plain(want), name


def versions_of(spark, log, run):
    def versions(r, after, last):
        assert r == run
        p = [x for b, ps, _ in log if after < b <= last for x in ps]
        v = [x for b, _, vs in log if after < b <= last for x in vs]
        return frame(spark, p, DIM_PRODUCTS_LOG), frame(spark, v, FACT_REVIEWS_LOG)
    return versions


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_changes_equals_a_full_rebuild(spark, tmp_dir, seed):
    """Inserts, updates, moves, deletes, late versions, ties of batches, and a refresh that skips a batch."""
    r = random.Random(seed)
    products = [product(r, p, 0) for p in range(10)]
    reviews = [review(r, k, 0) for k in range(30)]
    root = f"{tmp_dir}/marts"
    M.build_marts(spark, root, frame(spark, products, DIM_PRODUCTS_LOG), frame(spark, reviews, FACT_REVIEWS_LOG), AS_OF, [])
    same(spark, root, products, reviews)
    log, version = [], 1
    for b in range(3):
        some = list(range(version, version + 20))
        r.shuffle(some)                                  # versions arrive out of order
        version += 14                                    # and overlap those of the next batch
        ps = [product(r, r.randrange(14), v * 10 + b, int(r.random() < 0.25)) for v in some[:7]]
        vs = [review(r, r.randrange(40), v * 10 + b, int(r.random() < 0.2)) for v in some[7:]]
        if b == 1:
            ps += [product(r, p, (30 + p) * 10 + 7, 1) for p in range(0, 14, 3)]       # lowest products of vendors go
        if b == 2:
            ps, vs = ps[:3], []
        log.append((b, ps, vs))
        products, reviews = products + ps, reviews + vs
        if b == 0:
            continue                                     # batches 0 and 1 are refreshed together
        done = M.refresh_marts(spark, root, versions_of(spark, log, "run"), AS_OF, [("run", x) for x in range(b + 1)])
        assert done == ["run"]
        same(spark, root, products, reviews)
    assert M.refresh_marts(spark, root, versions_of(spark, log, "run"), AS_OF, [("run", x) for x in range(3)]) == []


def test_a_refresh_that_was_cut_off_is_made_good(spark, tmp_dir):
    from ledgerline.session import delete_dir
    r = random.Random(5)
    products, reviews = [product(r, p, 0) for p in range(8)], [review(r, k, 0) for k in range(20)]
    root = f"{tmp_dir}/marts"
    M.build_marts(spark, root, frame(spark, products, DIM_PRODUCTS_LOG), frame(spark, reviews, FACT_REVIEWS_LOG), AS_OF, [])
    log = [(0, [product(r, p, 5, p % 2) for p in range(6)], [review(r, k, 6) for k in range(25)])]
    refresh = lambda: M.refresh_marts(spark, root, versions_of(spark, log, "run"), AS_OF, [("run", 0)])
    refresh()
    # the day counts are written last: without them the refresh has not ended, and other tables hold its rows
    delete_dir(spark, f"{root}/{M.DAYS}/run_id=run/batch_id=0")
    refresh()
    same(spark, root, products + log[0][1], reviews + log[0][2])
    # the same versions under another run change nothing
    M.refresh_marts(spark, root, versions_of(spark, log, "twice"), AS_OF, [("run", 0), ("twice", 0)])
    same(spark, root, products + log[0][1], reviews + log[0][2])


def test_a_rebuild_takes_the_place_of_all_before(spark, tmp_dir):
    r = random.Random(6)
    root = f"{tmp_dir}/marts"
    products, reviews = [product(r, p, 0) for p in range(8)], [review(r, k, 0) for k in range(20)]
    build = lambda p, v, b: M.build_marts(spark, root, frame(spark, p, DIM_PRODUCTS_LOG),
                                          frame(spark, v, FACT_REVIEWS_LOG), AS_OF, b)
    build(products, reviews, [])
    build(products[:3], reviews[:5], [("run", 0), ("run", 1)])
    same(spark, root, products[:3], reviews[:5])
    assert {x for x, _ in list_batches(spark, f"{root}/{M.PRODUCTS}")} == {"build-000000002"}
    # refreshes go on after the batches that the build contains
    log = [(2, [product(r, 1, 9)], [])]
    assert M.refresh_marts(spark, root, versions_of(spark, log, "run"), AS_OF, [("run", 0), ("run", 1), ("run", 2)]) == ["run"]
    same(spark, root, products[:3] + log[0][1], reviews[:5])


def test_empty_marts_and_an_empty_window(spark, tmp_dir):
    root = f"{tmp_dir}/marts"
    M.build_marts(spark, root, frame(spark, [], DIM_PRODUCTS_LOG), frame(spark, [], FACT_REVIEWS_LOG), AS_OF, [])
    store = M.MartStore(spark, root)
    assert all(store.read(n).count() == 0 for n in M.MART_NAMES)
    r = random.Random(7)
    log = [(0, [product(r, p, 1) for p in range(4)], [review(r, k, 2) for k in range(9)])]
    M.refresh_marts(spark, root, versions_of(spark, log, "run"), AS_OF, [("run", 0)])
    same(spark, root, log[0][1], log[0][2])
    # the window moves on: nothing is left in it
    log.append((1, [product(r, 3, 7)], []))
    M.refresh_marts(spark, root, versions_of(spark, log, "run"), "2030-01-01", [("run", 1)])
    assert store.read(M.TRENDING).count() == 0
    same(spark, root, log[0][1] + log[1][1], log[0][2], only=(M.VENDORS, M.PRODUCTS, M.REVIEWS))


def test_a_refresh_writes_only_what_changed(spark, tmp_dir):
    r = random.Random(8)
    root = f"{tmp_dir}/marts"
    products, reviews = [product(r, p, 0) for p in range(400)], [review(r, k, 0) for k in range(900)]
    for k, p in enumerate(products):
        p["vendor_id"] = k // 4
    M.build_marts(spark, root, frame(spark, products, DIM_PRODUCTS_LOG), frame(spark, reviews, FACT_REVIEWS_LOG), AS_OF, [])
    moved = product(r, 399, 3) | {"vendor_id": 0}
    M.refresh_marts(spark, root, versions_of(spark, [(0, [moved], [review(r, 1, 4)])], "run"), AS_OF, [("run", 0)])
    written = {n: spark.read.parquet(f"{root}/{n}/run_id=run").count() for n in (M.PRODUCTS, M.REVIEWS, M.VENDORS, M.DAYS)}
    assert written[M.PRODUCTS] == 1 and written[M.REVIEWS] == 1 and written[M.VENDORS] <= 4 and written[M.DAYS] <= 2
    same(spark, root, [*products, moved], reviews, only=(M.PRODUCTS,))
