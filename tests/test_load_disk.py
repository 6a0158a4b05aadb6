"""What a load costs on disk: keys tell orphans from others, rows that lie in buckets are not dealt again."""

from ledgerline import jobs
from ledgerline.operators import load
from ledgerline.plans import stages
from ledgerline.sinks.keyed import KeyedTable

from .test_keyed import SCHEMA, frame


def test_orphans_are_split_as_by_reference(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "v string, k string").selectExpr(
        "k", "CAST(v AS LONG) AS p")
    known = spark.createDataFrame([(1,), (3,), (3,), (None,)], "p long")
    keys = load.orphan_keys(rows, known, "p")
    assert [r["p"] for r in keys.collect()] == [2]
    for was, now in zip(load.split_by_reference(rows, known, "p"), load.split_by_orphans(rows, keys, "p")):
        assert sorted(r["k"] for r in was.collect()) == sorted(r["k"] for r in now.select(*was.columns).collect())


def test_rows_landed_in_buckets_are_appended_without_a_shuffle(spark, tmp_dir, monkeypatch):
    table = KeyedTable(spark, f"{tmp_dir}/t", SCHEMA, "k", buckets=4)
    landed = KeyedTable(spark, f"{tmp_dir}/new", SCHEMA, "k", buckets=4)
    landed.append(frame(spark, 100).repartition(4, "k"), dealt=True)
    monkeypatch.setattr(type(landed.read()), "repartition", None)
    table.append(landed.read(), dealt=True)
    monkeypatch.undo()
    assert table.read().count() == 100 and len(spark.read.parquet(f"{tmp_dir}/t").inputFiles()) == 4
    table.append(frame(spark, 20, 100))
    joined = table.read().join(frame(spark, 120), "k")
    assert joined.count() == 120
    for t in (table, landed):
        t.forget()


def test_a_load_leaves_no_name_in_the_catalog_but_its_tables(spark, tmp_dir):
    names = lambda: {t.name for t in spark.catalog.listTables() if t.name.startswith("ledgerline_")}
    for name, columns in (("p", stages.PRODUCT_CSV_COLUMNS), ("r", stages.REVIEW_CSV_COLUMNS)):
        values = {"_id": "1", "productId": "1", "star": "5"}
        spark.createDataFrame([tuple(values.get(c, "") for c, _, _ in columns)] * 2, [c for c, _, _ in columns]).write.option(
            "header", True).csv(f"{tmp_dir}/{name}")
    before = names()
    out = jobs.initial_load(spark, f"{tmp_dir}/p", f"{tmp_dir}/r", f"{tmp_dir}/clean")
    assert out == {"products": {"loaded": 1, "ignored_duplicate": 1}, "reviews": {"loaded": 1, "ignored_duplicate": 1}}
    assert len(names() - before) == 2
