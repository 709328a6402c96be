"""Work in steps equals work at once: days kept up to date, counts on the way, state and its changes."""

import os
import random
import time

from pyspark.sql import Observation, functions as F

from conftest import article, rows
from namewire.operators.bounded import bounded_topk, buffer_state
from namewire.operators.names import name_counts, names_by_date
from namewire.operators.rows import quality_rows, row_quality
from namewire.plans.daily import daily_top_names
from namewire.sinks import days
from namewire.sinks.days import add_segments, read_days
from namewire.sources.articles import read_articles
from namewire.streaming.buffer import live_bounded_topk
from namewire.streaming.feeding import feed_and_read, read_epochs
from namewire.streaming.mentions import live_minute_counts, stream_mentions
from namewire.streaming.snapshots import buffer_at, state_at, state_changes, state_changes_kept, state_from


def segment_lines(spark, numbers):
    """Lines of some segments: eight a segment, four segments a day."""
    out = []
    for number in numbers:
        draw = random.Random(number)
        for k in range(8):
            names = "".join(f"{draw.choice('abcdefghijklmn')},{j};" for j in range(6))
            stamp = f"202401{1 + number // 4:02d}{number % 4 * 6:02d}0000"
            out.append((f"s{number}", article(stamp, names, k, fields=26 if k == 7 else 27)))
    return spark.createDataFrame(out, "segment string, value string")


def files(root):
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                found[path] = os.stat(path).st_mtime_ns
    return found


def of_day(paths, day):
    return {p: t for p, t in paths.items() if f"publish_date={day}" in p}


def test_days_are_kept_up_to_date(spark, tmp_path):
    root, whole = str(tmp_path / "steps"), str(tmp_path / "whole")
    everything = segment_lines(spark, range(12))
    assert add_segments(segment_lines(spark, [0, 1, 2, 3, 4, 5, 8, 9, 10, 11]), root, k=3) == ["20240101", "20240102", "20240103"]
    before = files(root)
    time.sleep(0.02)
    # late segments of the second day, one of which was there before
    assert add_segments(segment_lines(spark, [5, 6, 7]), root, k=3) == ["20240102"]
    after = files(root)
    for day in ("20240101", "20240103"):
        assert of_day(before, day) == of_day(after, day) != {}
    assert not set(of_day(before, "20240102").items()) & set(of_day(after, "20240102").items())
    add_segments(everything, whole, k=3)
    assert rows(read_days(spark, root)) == rows(read_days(spark, whole)) == rows(daily_top_names(everything.select("value"), 3))
    add_segments(segment_lines(spark, [5, 6, 7]), root, k=3)  # again: nothing is added
    assert rows(read_days(spark, root)) == rows(read_days(spark, whole))
    assert add_segments(everything.limit(0), root) == []


def test_merged_counts_are_written_once(spark, tmp_path, monkeypatch):
    made = []
    path = days.scratch_path
    monkeypatch.setattr(days, "scratch_path", lambda session, label: made.append(label) or path(session, label))
    weights = []
    by_date = days.names_by_date
    monkeypatch.setattr(days, "names_by_date", lambda *a, **b: weights.append(b.get("weight")) or by_date(*a, **b))
    root = str(tmp_path / "steps")
    add_segments(segment_lines(spark, [0, 1, 2, 4]), root, k=3)
    add_segments(segment_lines(spark, [2, 3, 5]), root, k=3)
    assert made == ["new-counts"] * 2 and None not in weights
    store = spark.read.schema(days.COUNTS).parquet(f"{root}/counts")
    once = segment_lines(spark, range(6)).select("segment", "value")
    every = name_counts(names_by_date(once, keep=["segment"]), ["publish_date", "segment", "name"])
    assert rows(store) == rows(every.select(*store.columns))


def test_quality_in_the_same_pass(spark, tmp_path):
    lines = segment_lines(spark, range(3)).select("value").unionByName(spark.createDataFrame(
        [(article("0", "Ann,1"),), (article("20240105120000", ""),), (None,), ("",)], "value string"))
    lines.where("value is not null").write.text(str(tmp_path / "lines"))
    read = read_articles(spark, str(tmp_path / "lines"))
    seen = Observation("quality")
    ranking = daily_top_names(read, observed=seen)
    plan = ranking._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "CollectMetrics" in plan
    assert rows(ranking) == rows(daily_top_names(read))
    assert rows(quality_rows(spark, seen.get)) == rows(row_quality(read))
    # and in a stream, micro-batch by micro-batch
    parts = [lines.where("value is not null").where(F.pmod(F.xxhash64("value"), F.lit(2)) == k) for k in range(2)]
    _, runs = feed_and_read(parts, str(tmp_path / "stream"),
                            lambda v: live_minute_counts(stream_mentions(v, observed="quality"), late="60 days"))
    counts = [p.observedMetrics["quality"].asDict() for r in runs for p in r.recentProgress if "quality" in (p.observedMetrics or {})]
    assert len(counts) >= 2 and rows(quality_rows(spark, *counts)) == rows(row_quality(read))


def test_snapshot_and_changes(spark, tmp_path):
    draw = random.Random(1)
    parts = [spark.createDataFrame([(draw.choice("abcdef")[: 1 + k], k) for _ in range(9)], "name string, n int") for k in range(4)]
    with state_changes_kept(spark):
        feed_and_read(parts, str(tmp_path), lambda v: v.groupBy("name").agg(F.sum("n").alias("total")))
    checkpoint = f"{tmp_path}/checkpoint"
    final = rows(state_at(spark, checkpoint))
    for batch in range(3):
        snapshot, changes = state_at(spark, checkpoint, batch), state_changes(spark, checkpoint, batch)
        assert rows(changes.select("batch").distinct()) == [(k,) for k in range(batch + 1, 4)]
        assert rows(state_from(snapshot, changes, ["name"])) == final
    assert rows(state_changes(spark, checkpoint, 0, 1).select("batch").distinct()) == [(1,)]


def test_buffer_in_the_state_store(spark, tmp_path):
    draw = random.Random(7)
    log = [(k, f"n{draw.randrange(12)}", draw.randrange(30)) for k in range(90)]
    frame = spark.createDataFrame(log, "seq bigint, name string, cnt bigint")
    parts = [frame.where(F.floor(F.col("seq") / 30) == k) for k in range(3)]
    out, _ = feed_and_read(parts, str(tmp_path), lambda u: live_bounded_topk(u, 3, 2))
    for batch in range(3):
        so_far = bounded_topk(frame.where(F.col("seq") < 30 * (batch + 1)), capacity=3, buckets=2)
        assert rows(buffer_at(spark, f"{tmp_path}/checkpoint", batch).select("name", "cnt")) == rows(buffer_state(so_far))
    assert rows(buffer_state(read_epochs(spark, out))) == rows(buffer_at(spark, f"{tmp_path}/checkpoint").select("name", "cnt"))
