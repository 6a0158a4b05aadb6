"""Rule tables: each value rule against hand-written input -> expected output."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import parse as P
from ledgerline.functions import serve as S
from ledgerline.functions.text import contains_any, split_words, text_length


def _apply(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


BOOL_CASES = [(None, None), ("", None), ("True", True), ("yes", True), ("t", True), ("1", True),
              (" TRUE ", True), ("0", False), ("junk", False), ("false", False), ("  ", False)]


def test_parse_bool(spark):
    ins, outs = zip(*BOOL_CASES)
    assert _apply(spark, list(ins), P.parse_bool) == list(outs)


BIGINT_CASES = [
    (None, None), ("", None), ("42", 42), (" 42 ", 42), ("12.9", 12), ("-3.9", -3), ("1e3", 1000),
    ("1.5d", None), ("inf", None), ("nan", None), ("junk", None), ("1_000", None),
    ("9007199254740993", 9007199254740993), ("+7", 7), (".5", 0), ("99999999999999999999", None),
]


def test_parse_bigint(spark):
    ins, outs = zip(*BIGINT_CASES)
    assert _apply(spark, list(ins), P.parse_bigint) == list(outs)


def test_parse_int_range(spark):
    assert _apply(spark, ["3000000000", "2147483647", "-2147483648", "12.9"], P.parse_int) == \
        [None, 2147483647, -2147483648, 12]


def test_parse_decimal(spark):
    got = _apply(spark, ["4.555", "100", "4.1", "junk", "", "0.125", "1e-1"], P.parse_decimal)
    assert got == [Decimal("4.56"), None, Decimal("4.10"), None, None, Decimal("0.13"), Decimal("0.10")]


def test_parse_ts(spark):
    got = _apply(spark, ["2024-01-02T10:11:12Z", "2024-01-02T10:11:12+03:30", "2024-01-02T10:11:12-03:30",
                         "2024-01-02 10:11:12.250", "junk", "20240102", None], P.parse_ts)
    t = dt.datetime(2024, 1, 2, 10, 11, 12)
    assert got == [t, t, t, dt.datetime(2024, 1, 2, 10, 11, 12, 250000), None, None, None]


def test_flags(spark):
    assert _apply(spark, [True, False, None], S.flag01, "boolean") == [1, 0, 0]
    assert _apply(spark, ["true", "t", "1", "True", "yes", None], S.flag01_text) == [1, 1, 1, 0, 0, 0]


def test_preparation_days(spark):
    assert _apply(spark, [None, 0, 3], S.preparation_days, "int") == [1, 1, 3]


def test_ts_defaults(spark):
    d = dt.datetime(2000, 1, 1)
    assert _apply(spark, [None, "2024-01-02T10:11:12Z", "2024-01-02T10:11:12+03:30", "junk"],
                  S.ts_text_or_default) == [d, dt.datetime(2024, 1, 2, 10, 11, 12),
                                            dt.datetime(2024, 1, 2, 10, 11, 12), d]
    got = _apply(spark, [None, dt.datetime(2024, 1, 2, 10, 11, 12, 999)], S.ts_or_default, "timestamp_ntz")
    assert got == [d, dt.datetime(2024, 1, 2, 10, 11, 12)]


ATTACHMENT_CASES = [
    (None, 0), ("", 0),
    ("{'photos': [], 'video': None}", 0),
    ("{'photos': ['https://x/p.jpg'], 'video': None}", 1),
    ("{'photos': None}", 1),                        # no '[]' within 20 chars (T6)
    ("{'photos': [], 'video': 'https://x/v.mp4'}", 1),  # falls through to 'http'
    ("{'video': None}", 0),
    ("{'photos': [1], 'photos': []}", 1),           # only text up to the 2nd 'photos' counts
]


def test_has_attachment(spark):
    ins, outs = zip(*ATTACHMENT_CASES)
    assert _apply(spark, list(ins), S.has_attachment) == list(outs)


def test_text_helpers(spark):
    assert _apply(spark, ["ab", "ثب", "abc"], lambda c: text_length(c, "char")) == [2, 2, 3]
    assert _apply(spark, ["ab", "ثب", "abc"], lambda c: text_length(c, "byte")) == [2, 4, 3]
    assert _apply(spark, ["a.b c", " x "], lambda c: F.size(split_words(c))) == [2, 3]
    assert _apply(spark, ["a|b", "ab"], lambda c: F.size(split_words(c, "|"))) == [2, 1]
    assert _apply(spark, ["foo bar", "baz", None], lambda c: contains_any(c, ["bar", "baz"])) == [True, True, None]
    with pytest.raises(ValueError):
        contains_any("x", [])


def test_timestamps_need_a_full_date(spark):
    assert _apply(spark, ["2024", "2024-01", "2024-1-5", "2024-01-02T10:11:12 Asia/Tehran", "2024-01-02 10",
                          "2024-13-01", " 2024-01-02"], P.parse_ts) == [None] * 7
    assert _apply(spark, ["2024-01-02", "2024-01-02T10:11"], P.parse_ts) == [
        dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 10, 11)]


def test_digits_of_the_exports_scripts(spark):
    assert _apply(spark, ["۱۲", "٣.٩", "-۷", "१२"], P.parse_bigint) == [12, 3, -7, None]
