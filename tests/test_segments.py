import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import article, rows
from namewire.operators.event_time import assign_event_time
from namewire.plans.daily import replay_segments
from namewire.sources.articles import read_placed_lines
from namewire.sources.segments import (
    expected_segments, list_segments, manifest_files, missing_segments, new_segments,
)


def clock(spark, *times):
    return spark.createDataFrame([(dt.datetime.fromisoformat(t + "+00:00"),) for t in times], "now timestamp")


def names(df):
    return [r.file_name for r in df.orderBy("file_name").collect()]


def test_expected(spark):
    got = names(expected_segments(clock(spark, "2024-01-05 00:20:31")))
    assert got == [f"2024010{d}.gkg.csv" for d in ("4231500", "4233000", "4234500", "5000000")]
    assert names(expected_segments(clock(spark, "2024-01-05 10:15:00"), window_minutes=15)) == ["20240105100000.gkg.csv"]
    assert names(expected_segments(clock(spark, "2024-01-05 10:15:00"), window_minutes=0)) == []


def test_new_and_missing(spark, tmp_path):
    for name in ("20240105100000.gkg.csv", "20240105103000.gkg.csv", "20150218230000.gkg.csv"):
        (tmp_path / name).write_text("x\n")
    arrived = list_segments(spark, str(tmp_path))
    assert arrived.count() == 3
    expected = expected_segments(clock(spark, "2024-01-05 11:00:00"))
    assert names(missing_segments(expected, arrived)) == ["20240105101500.gkg.csv", "20240105104500.gkg.csv"]
    assert [r.file_name for r in new_segments(arrived.union(arrived)).collect()] == [
        "20150218230000.gkg.csv", "20240105100000.gkg.csv", "20240105103000.gkg.csv"]
    assert names(new_segments(arrived, "20240105100000.gkg.csv")) == ["20240105103000.gkg.csv"]


def test_manifest(spark, tmp_path):
    lines = [f"{i} hash{i} http://host/v2/gkg/2024010510{i:02d}00.gkg.csv" for i in (45, 30, 15, 0)]
    path = tmp_path / "manifest.txt"
    path.write_text("\n".join([*lines[:1], "no segment here", *lines[1:]]) + "\n")
    got = rows(manifest_files(spark, str(path), 3, "/data"))
    assert got == [(f"/v2/gkg/{n}", n, f"/data/{n}") for n in ("20240105103000.gkg.csv", "20240105104500.gkg.csv")]


@pytest.fixture()
def segments(tmp_path):
    """Three files, one of them much larger than a read split."""
    folder = tmp_path / "segments"
    folder.mkdir()
    sizes = {"202401051000": 3, "202401051015": 700, "202401051030": 1}
    for start, n in sizes.items():
        (folder / f"{start}00.gkg.csv").write_text("".join(
            article(start + "59", "Ann,1", serial=i) + f"{'x' * (i % 50)}\n" for i in range(n)))
    (folder / "20240105104500.gkg.csv").write_text("")
    return str(folder), sizes


@pytest.mark.parametrize("consecutive", [True, False])
def test_event_time(spark, segments, consecutive):
    folder, sizes = segments
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        placed = read_placed_lines(spark, folder)
        assert placed.select("file", "block").distinct().count() > 10
        timed = assign_event_time(placed, consecutive=consecutive)
        got = rows(timed.select("value", "position", F.unix_millis("event_time")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = []
    for start, n in sizes.items():
        at = int(dt.datetime.strptime(start + "+0000", "%Y%m%d%H%M%z").timestamp() * 1000)
        for i in range(n):
            line = article(start + "59", "Ann,1", serial=i) + "x" * (i % 50)
            expected.append((line, i, at + i * (900_000 // n)))
    assert got == sorted(expected)


def test_replay(spark, segments, tmp_path):
    folder, sizes = segments
    replay_segments(spark, folder, str(tmp_path / "topic"))
    back = spark.read.parquet(str(tmp_path / "topic"))
    assert back.columns == ["key", "value", "event_time"] and back.count() == sum(sizes.values())
    assert back.where("key <> split(value, '\t')[0]").count() == 0
