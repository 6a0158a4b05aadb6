"""Multi-line CSV cut into byte ranges: any cut gives the records of a one-task read."""

import contextlib
import csv as pycsv
import io
import os
import random

import pyarrow as pa
import pytest

from ledgerline.jobs import initial_load
from ledgerline.operators import clean
from ledgerline.schemas import PRODUCT_CSV_COLUMNS, REVIEW_CSV_COLUMNS
from ledgerline.sources import records as R
from ledgerline.sources.csv import BROKEN, LOAD_FILE, LOAD_ROW, read_raw_csv, read_reviews_csv

COLUMNS = ["_id", "a", "b", "c"]


@contextlib.contextmanager
def ranges_of(spark, size):
    """Byte ranges of about ``size`` bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1",
            "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def field(r):
    return r.choice([
        "", "plain", "é ü 中文", "with, comma", 'a "quoted" word', 'two ""', '"', '""', "back\\slash \\", "\\\"", "line\nline",
        "\n", "a\n\nb", ",\n,", "\"\n\"", "x" * r.randrange(90), "long\n" * r.randrange(12), " lead", "trail ", "'single'",
        '5" wide', " ", "tab\there"])


def made(seed, n, newline="\n", header=COLUMNS):
    r = random.Random(seed)
    out = io.StringIO()
    w = pycsv.writer(out, lineterminator=newline)
    w.writerow(header)
    for i in range(n):
        w.writerow([f"{seed}-{i}", *[field(r) for _ in header[1:]]])
    return out.getvalue()


def write(tmp_dir, name, text, encoding="utf-8"):
    path = os.path.join(tmp_dir, name)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def one_task(spark, path, names=COLUMNS):
    schema = ", ".join(f"`{c}` string" for c in names)
    rows = (spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
            .schema(schema).csv(path).collect())
    return [tuple(r) for r in rows]


def split_rows(spark, path, columns=COLUMNS, limit=None):
    rows = read_raw_csv(spark, path, columns, limit).orderBy(LOAD_FILE, LOAD_ROW).collect()
    assert all(r[BROKEN] is None for r in rows)
    return [tuple(r[c] for c in columns) for r in rows], [r[LOAD_ROW] for r in rows]


@pytest.mark.parametrize(("size", "newline"), [(150, "\n"), (400, "\n"), (250, "\r\n"), (1 << 20, "\n")])
def test_any_cut_equals_the_one_task_read(spark, tmp_dir, size, newline):
    path = write(tmp_dir, "e.csv", made(size, 150, newline))
    want = one_task(spark, path)
    assert len(want) == 150
    with ranges_of(spark, size):
        got, numbers = split_rows(spark, path)
        tasks = R._lines(spark, [path]).rdd.getNumPartitions()
    assert got == want and numbers == list(range(1, 151))
    assert tasks > (9 if size < 1000 else 0)


def test_one_field_over_many_ranges(spark, tmp_dir):
    body = "\n".join(f"line {i} of \"\"many\"\"" for i in range(200))
    text = f'_id,a,b,c\n1,x,"{body}",y\n2,,,\n3,"{body}","{body}",z\n'
    path = write(tmp_dir, "long.csv", text)
    with ranges_of(spark, 64):
        got, _ = split_rows(spark, path)
    whole = body.replace('""', '"')
    assert got == [("1", "x", whole, "y"), ("2", None, None, None), ("3", whole, whole, "z")]


def test_blank_lines_missing_newline_mark_and_many_files(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "many")
    os.makedirs(folder)
    write(folder, "a.csv", "﻿_id,a,b,c\n\n1,x,\"\n\n\",y\n\n\r\n2,,,last")
    write(folder, "b.csv", "")
    write(folder, "c.csv", "_id,a,b,c\n")
    write(folder, "d.csv", made(7, 40))
    for size in (64, 1 << 20):
        with ranges_of(spark, size):
            got, numbers = split_rows(spark, folder)
            first, _ = split_rows(spark, folder, limit=12)
        assert got[:2] == [("1", "x", "\n\n", "y"), ("2", None, None, "last")]
        assert got[2:] == one_task(spark, os.path.join(folder, "d.csv")) and numbers == [1, 2, *range(1, 41)]
        assert first == got[:12]


def test_empty_export(spark, tmp_dir):
    path = write(tmp_dir, "empty.csv", "")
    df = read_raw_csv(spark, path, COLUMNS)
    assert df.count() == 0 and df.columns == [*COLUMNS, LOAD_FILE, LOAD_ROW, BROKEN]
    with pytest.raises(Exception, match="nothing"):
        read_raw_csv(spark, f"{tmp_dir}/nothing*.csv", COLUMNS)


def test_ends_inside_follows_the_quoting_rules():
    cases = {b'a,b': False, b'"a': True, b'"a"': False, b'"a""': True, b'"a""b"': False, b'a"b': False, b'a,"': True,
             b'"a"b"c': False, b',"",': False, b'"",""",': True, b'"\\"': False, b'x,"y""z,""': True, b'': False}
    for line, want in cases.items():
        assert R.ends_inside(line, False) is want, line
    inside = {b'a': True, b'a"': False, b'a""': True, b'",b': False, b'","': True, b'""",x': False, b'': True, b'x",y"z': False}
    for line, want in inside.items():
        assert R.ends_inside(line, True) is want, line


def test_states_of_lines_compose():
    r = random.Random(5)
    lines = [r.choice([b'a,b', b'"x', b'y"', b'z",""', b'', b'"a""b"', b'q"r']) for _ in range(300)]
    for inside in (False, True):
        whole, last = R.states(pa.array(lines, pa.binary()), inside)
        cut = r.randrange(300)
        a, mid = R.states(pa.array(lines[:cut], pa.binary()), inside)
        b, end = R.states(pa.array(lines[cut:], pa.binary()), mid)
        assert whole.tolist() == [*a, *b] and end == last


def test_changed_ranges_are_an_error(spark, tmp_dir):
    path = write(tmp_dir, "changed.csv", made(3, 60))
    with ranges_of(spark, 100):
        df = read_raw_csv(spark, path, COLUMNS)
    with ranges_of(spark, 77), pytest.raises(Exception, match="changed between the two passes"):
        df.count()


def test_broken_records_are_quarantined_and_counted(spark, tmp_dir):
    p_names = [c for c, _, _ in PRODUCT_CSV_COLUMNS]
    r_names = [c for c, _, _ in REVIEW_CSV_COLUMNS]
    products = ",".join(p_names) + "\n" + ",".join(["1", *[""] * (len(p_names) - 1)]) + "\n" + "2,short\n"
    good = [f"r{i},1,5,4,\"text\nof {i}\",1,,,t,,2024-01-02," for i in range(30)]
    bad = ["r90,1,5,4", "r91,1,5,4,text,1,,,t,,2024-01-02,,surplus", "r92,1,5,4,\"a\nb\",1,,,t,,2024-01-02,,x,y,z"]
    text = ",".join(r_names) + "\n" + "\n".join([*good[:10], bad[0], *good[10:20], bad[1], bad[2], *good[20:]]) + "\n"
    p, r = write(tmp_dir, "p.csv", products), write(tmp_dir, "r.csv", text)
    with ranges_of(spark, 120):
        rows = clean.assess_reviews(read_reviews_csv(spark, r)).collect()
        broken = {x["review_id"]: x[BROKEN] for x in rows if x["reject_reason"] == "broken_record"}
        assert broken == {"r90": bad[0], "r91": bad[1], "r92": bad[2]}
        out = initial_load(spark, p, r, f"{tmp_dir}/clean")
    assert out["products"] == {"loaded": 1, "ignored_duplicate": 0, "broken_record": 1}
    assert out["reviews"] == {"loaded": 30, "ignored_duplicate": 0, "broken_record": 3}
    kept = spark.read.parquet(f"{tmp_dir}/clean/rejects_reviews")
    assert sorted(x[BROKEN] for x in kept.collect()) == sorted(bad)
