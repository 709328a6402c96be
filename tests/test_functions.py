import datetime as dt

import pytest
from pyspark.sql import functions as F

from namewire.functions.numbers import decode_long, encode_long, round_to
from namewire.functions.text import (
    clean_utf8, leading_number, line_field, mention_name, parse_record_id, record_key,
)
from namewire.functions.times import (
    interval_floor, next_boundary, publish_date, publish_day, publish_time, segment_name, segment_start,
)


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_leading_number(spark):
    texts = ["8 GiB", "1,952 GiB", "Variable", "26.5", "", "..5", ".5 x", "7.", "12,34"]
    assert apply(spark, texts, leading_number) == [8.0, 1952.0, None, 26.5, None, None, 0.5, 7.0, 12.0]


def test_parse_record_id(spark):
    texts = ["20150218230000-12", "a-1", "1", "1-2-3", "1-2-", "-5", "99999999999999999999-1", "", " 1-2", "+1-2", None]
    zero = (0, 0)
    assert [tuple(r) for r in apply(spark, texts, parse_record_id)] == [
        (20150218230000, 12), zero, zero, zero, (1, 2), zero, zero, zero, zero, (1, 2), zero]


def test_line_parts(spark):
    assert apply(spark, ["k\tb\tc", "", "x"], record_key) == ["k", "", "x"]
    assert apply(spark, ["k\tb\tc", "k\t\tc"], lambda c: line_field(c, 1)) == ["b", ""]
    assert apply(spark, ["Bob, Ross,3", "Ann", ",", ",4"], mention_name) == ["Bob", "Ann", "", ""]


def test_round_to(spark):
    values = [0.12345, 0.0125, 2.0, -0.0007]
    expected = [round(0.001 * round(v / 0.001), 3) for v in values]
    assert apply(spark, values, round_to, "double") == pytest.approx(expected)


def test_long_codec(spark):
    values = [0, 1, 255, 2**40 + 7, -1, 2**63 - 1]
    assert apply(spark, values, lambda c: decode_long(encode_long(c)), "bigint") == values
    assert bytes(apply(spark, [258], encode_long, "bigint")[0]) == b"\0\0\0\0\0\0\1\2"


def test_clean_utf8(spark):
    raw = [b"Bob\xff Ross", "Zoë".encode(), b"\xe2\x82", "�x".encode()]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, v binary")
    out = df.orderBy("i").select(clean_utf8(F.col("v").cast("string"))).collect()
    assert [r[0] for r in out] == ["Bob Ross", "Zoë", "", "x"]


def test_publish_dates(spark):
    stamps = ["20240105235959", "0", "20241305000000", "", None, "2024010"]
    assert apply(spark, stamps, publish_day) == ["20240105"] + [None] * 5
    assert apply(spark, stamps[:2], publish_date) == [dt.date(2024, 1, 5), None]
    text = lambda c: publish_time(c, "minute").cast("string")
    assert apply(spark, stamps[:2], text) == ["2024-01-05 23:59:00", None]


def test_boundaries(spark):
    times = ["2024-01-05 10:14:59", "2024-01-05 10:15:00", "2024-01-05 23:50:00", "2024-01-05 10:58:00"]
    def shown(fn):
        return apply(spark, times, lambda c: fn(F.col(c).cast("timestamp")).cast("string"))
    assert shown(next_boundary) == [
        "2024-01-05 10:15:00", "2024-01-05 10:30:00", "2024-01-06 00:00:00", "2024-01-05 11:00:00"]
    assert shown(lambda c: next_boundary(c, 7))[3] == "2024-01-05 11:03:00"
    assert shown(interval_floor)[:2] == ["2024-01-05 10:00:00", "2024-01-05 10:15:00"]
    assert shown(segment_name)[0] == "20240105101400.gkg.csv"


def test_segment_start(spark):
    start = lambda c: segment_start(c).cast("string")
    assert apply(spark, ["20240105101559-3", "bad"], start) == ["2024-01-05 10:15:00", None]
