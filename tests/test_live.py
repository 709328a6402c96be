"""Stateful streams: counts that fall, the buffer, windows of windows, repeated and late rows."""

import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import article, rows
from namewire.operators.bounded import bounded_topk
from namewire.operators.windows import hopping_counts
from namewire.sinks.topics import sink_changelog
from namewire.streaming.buffer import live_bounded_topk, live_top_of_hour
from namewire.streaming.feeding import feed, feed_and_read, read_epochs
from namewire.streaming.late import mark_late, split_late
from namewire.streaming.live import BoundedTopK
from namewire.streaming.mentions import distinct_lines, live_hopping_counts, live_window_of_windows
from namewire.streaming.trailing import live_trailing_counts

START = dt.datetime(2024, 1, 1)
MENTIONS = "ts timestamp, name string"


def minute(m, s=0):
    return START + dt.timedelta(minutes=m, seconds=s)


def mentions(spark, some):
    return spark.createDataFrame(some, MENTIONS)


def pieces(spark, seed=5):
    """Three pieces in time order, quiet names among them, with nulls and one mention that is too late."""
    draw = random.Random(seed)
    out = []
    for piece in range(3):
        some = [(minute(200 * piece + draw.randrange(120), draw.randrange(60)), draw.choice("aaab")) for _ in range(60)]
        out.append(some + [(minute(200 * piece + 5), "once" + str(piece)), (None, "a"), (minute(200 * piece + 1), None)])
    out[2].append((minute(2), "late"))
    return out


def trailing(some, until):
    """(name, tick, cnt) where the count of the last hour changes, minute by minute."""
    out = []
    for name in sorted({n for _, n in some}):
        told = 0
        for m in range(0, until + 1):
            cnt = sum(minute(m - 60) <= ts < minute(m) for ts, n in some if n == name)
            if cnt != told:
                out.append((name, minute(m), cnt))
            told = cnt
    return out


def on_time(some):
    return [(ts, n) for piece in some for ts, n in piece if ts and n and n != "late"]


def test_trailing_counts_fall(spark, tmp_path):
    some = pieces(spark)
    some.append([(minute(1000), "end")])
    out, runs = feed_and_read([mentions(spark, p) for p in some], str(tmp_path), live_trailing_counts, "append")
    log = read_epochs(spark, out)
    assert log.select("epoch").distinct().count() >= 3
    want = trailing(on_time(some), 990)
    assert sorted(tuple(r) for r in log.select("name", "tick", "cnt").collect()) == want
    last = {}
    for name, tick, cnt in want:
        last[name] = cnt
    assert {"a", "b", "once0", "once1", "once2"} <= last.keys() and set(last.values()) == {0}
    # only the name of the last mention has any state left
    assert sum(o["numRowsTotal"] for o in runs[-1].recentProgress[-1]["stateOperators"]) == 1


def test_trailing_counts_check_their_windows(spark):
    with pytest.raises(ValueError):
        live_trailing_counts(mentions(spark, []), size=100, slide=60)


def changelog(seed, n, names):
    draw = random.Random(seed)
    return [(k, f"n{draw.randrange(names)}", draw.choice([0, draw.randrange(40)])) for k in range(n)]


def test_buffer_over_restarts(spark, tmp_path):
    log = changelog(3, 240, 30)
    frame = spark.createDataFrame(log, "seq bigint, name string, cnt bigint")
    parts = [frame.where(F.floor(F.col("seq") / 60) == k) for k in range(4)]
    several, _ = feed_and_read(parts, str(tmp_path / "several"), lambda u: live_bounded_topk(u, 4, 3))
    once, _ = feed_and_read([frame], str(tmp_path / "once"), lambda u: live_bounded_topk(u, 4, 3))
    columns = ["bucket", "seq", "step", "name", "cnt", "evicted"]
    batch = rows(bounded_topk(frame, capacity=4, buckets=3).select(*columns))
    assert rows(read_epochs(spark, several).select(*columns)) == batch == rows(read_epochs(spark, once).select(*columns))
    assert any(r[-1] for r in batch)


def test_top_of_hour_in_one_query(spark, tmp_path):
    some = pieces(spark)
    out, _ = feed_and_read([mentions(spark, p) for p in some], str(tmp_path), lambda m: live_top_of_hour(m, 2, 2), "append")
    got = rows(read_epochs(spark, out).select("bucket", "seq", "step", "name", "cnt", "evicted"))
    newest = max(ts for piece in some for ts, n in piece if ts and n)
    told = [(int((tick - START).total_seconds()), name, cnt) for name, tick, cnt in trailing(on_time(some), 2000)
            if tick <= newest - dt.timedelta(minutes=10)]
    epoch = int(spark.sql("select unix_seconds(timestamp '2024-01-01 00:00:00')").first()[0])
    updates = spark.createDataFrame([(s + epoch, n, c) for s, n, c in told], "seq bigint, name string, cnt bigint")
    assert got == rows(bounded_topk(updates, capacity=2, buckets=2).select("bucket", "seq", "step", "name", "cnt", "evicted"))


def test_old_folders_go(spark, tmp_path):
    frame = spark.createDataFrame(changelog(3, 50, 9), "seq bigint, name string, cnt bigint")
    parts = [frame.where(F.floor(F.col("seq") / 10) == k) for k in range(5)]
    feed(parts, f"{tmp_path}/in", lambda u: sink_changelog(u, f"{tmp_path}/c", f"{tmp_path}/out", trigger={"availableNow": True},
                                                          output_mode="append", keep=2))
    assert rows(read_epochs(spark, f"{tmp_path}/out").select("epoch").distinct()) == [(3,), (4,)]
    buffer = BoundedTopK(f"{tmp_path}/buffer", capacity=2, buckets=2, keep=3)
    for epoch, part in enumerate(parts):
        buffer.apply(part, epoch)
    for kind in ("changes", "state", "messages"):
        assert {p.name for p in (tmp_path / "buffer" / kind).iterdir()} == {"epoch=2", "epoch=3", "epoch=4"}
    assert buffer.newest(spark) == 4
    held, since = buffer.snapshot_and_delta(spark, 2)
    assert {r.epoch for r in since.collect()} <= {3, 4} and held.count() > 0


def test_windows_of_minutes(spark, tmp_path):
    draw = random.Random(2)
    some = [(minute(draw.randrange(180), draw.randrange(60)), draw.choice("ab")) for _ in range(300)]
    frame = mentions(spark, sorted(some))
    end = mentions(spark, [(minute(5000), None)])
    out, runs = feed_and_read([frame, end], str(tmp_path / "w"), live_window_of_windows, "append")
    assert rows(read_epochs(spark, out).where("name is not null").drop("epoch")) == rows(hopping_counts(frame))
    _, direct = feed_and_read([frame], str(tmp_path / "d"), live_hopping_counts)

    def held(query):
        return sum(o["numRowsTotal"] for o in query.recentProgress[0]["stateOperators"])

    assert held(runs[0]) < held(direct[0])


def test_redelivered_lines_count_once(spark, tmp_path):
    def lines(*numbers, hour=10):
        return spark.createDataFrame([(article(f"2024010{5 + k // 10}{hour:02d}0000", "Ann,1", k),) for k in numbers], "value string")

    bad = spark.createDataFrame([(article("20240105100000", "Ann,1", 77, fields=26),), (article("0", "Ann,1", 78, key="x-78"),)], "value string")
    sent = [lines(1, 2).unionByName(bad), lines(2, 3, 11), lines(1, 12), lines(4), lines(41)]
    out, _ = feed_and_read(sent, str(tmp_path), lambda v: distinct_lines(v, late="2 days"), "append")
    got = [r.record_id for r in read_epochs(spark, out).collect()]
    # the fourth came in order of days; a file of the first days drops out once the watermark is past it
    assert sorted(got) == sorted({r.value.split("\t")[0] for d in sent[:4] for r in d.collect() if len(r.value.split("\t")) == 27
                                  and not r.value.startswith("x-")} | {sent[4].first().value.split("\t")[0]})
    out, _ = feed_and_read([lines(41), lines(1)], str(tmp_path / "late"), lambda v: distinct_lines(v, late="1 day"), "append")
    assert [r.record_id[:8] for r in read_epochs(spark, out).collect()] == ["20240109"]


def test_late_rows_are_kept_aside(spark, tmp_path):
    draw = random.Random(4)
    some = [[(k * 100 + i, minute(600 * k + draw.randrange(-900, 500)) if draw.random() < 0.9 else None, "x" * (i % 3)) for i in range(50)]
            for k in range(3)]
    frames = [spark.createDataFrame(p, "id long, ts timestamp, _key string") for p in some]
    feed(frames, f"{tmp_path}/in", lambda found: split_late(mark_late(found, late="3 hours"), f"{tmp_path}/out", f"{tmp_path}/c", {"availableNow": True}))
    on, behind = (read_epochs(spark, f"{tmp_path}/out/{f}").select("id", "ts", "_key") for f in ("on_time", "late"))
    assert rows(on.unionByName(behind).select("id")) == sorted((r[0],) for p in some for r in p)
    newest, want = START - dt.timedelta(days=900), set()
    for p in some:
        want |= {r[0] for r in p if r[1] is not None and r[1] < newest - dt.timedelta(hours=3)}
        newest = max([newest, *(r[1] for r in p if r[1] is not None)])
    assert {r.id for r in behind.collect()} == want and 10 < len(want) < 100


@pytest.fixture
def made_elsewhere(spark):
    """Settings as Spark has them, not as the library sets them."""
    names = ["spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"]
    before = {name: spark.conf.get(name) for name in names}
    spark.conf.set(names[0], "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    spark.conf.set(names[1], "50")
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def test_late_rows_on_a_session_made_elsewhere(made_elsewhere, tmp_path):
    spark = made_elsewhere
    events = spark.sql("select id, timestamp_seconds(id * 100000) as ts from range(4)")
    pieces = [events.where("id > 1"), events.where("id <= 1")]
    feed(pieces, f"{tmp_path}/in", lambda found: split_late(
        mark_late(found), f"{tmp_path}/out", f"{tmp_path}/checkpoint", {"availableNow": True}))
    assert rows(read_epochs(spark, f"{tmp_path}/out/late").select("id")) == [(0,), (1,)]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "50"


def test_buffer_on_a_session_made_elsewhere(made_elsewhere, tmp_path):
    spark = made_elsewhere
    updates = spark.sql("select id as seq, cast(id % 3 as string) as name, id as cnt from range(6)")
    out, _ = feed_and_read([updates], str(tmp_path), lambda found: live_bounded_topk(found, capacity=2, buckets=1))
    assert read_epochs(spark, out).where("evicted").count() > 0


def test_lines_stay_behind_where_they_are_not_wanted(spark, tmp_path):
    lines = spark.createDataFrame([(article("20240101100000", "Ann,1", key="a-1"),)] * 2 + [(article("20240101110000", "Bob,1", key="b-1"),)], "value string")
    out, runs = feed_and_read([lines], str(tmp_path), lambda found: distinct_lines(found, keep_value=False), "append")
    found = read_epochs(spark, out)
    assert "value" not in found.columns and rows(found.select("record_id")) == [("a-1",), ("b-1",)]


def test_pieces_are_packed(spark, tmp_path):
    lines = spark.range(1).select(F.repeat(F.lit("x"), 1000).alias("value"))
    feed_and_read([lines], str(tmp_path), lambda found: found, "append")
    assert any(".zstd." in f.name for f in (tmp_path / "in").iterdir())


def test_window_counts_lie_in_rocksdb(made_elsewhere, tmp_path):
    events = made_elsewhere.sql("select timestamp_seconds(id) as ts, 'a' as name from range(3)")
    out, _ = feed_and_read([events], str(tmp_path), live_hopping_counts)
    assert "RocksDB" in made_elsewhere.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert read_epochs(made_elsewhere, out).agg(F.max("cnt")).first()[0] == 3
