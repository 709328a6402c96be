import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from namewire.operators.bounded import bounded_topk, buffer_state
from namewire.operators.changelog import (
    bounded_message, conflate, fold_changelog, json_message, last_key, snapshot_and_delta,
)
from namewire.operators.ranking import histogram_view, topk_snapshot


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(11)
    data = [(i, f"n{rng.randrange(40) if rng.random() < .67 else 0}", rng.choice([0, rng.randrange(1, 60)]))
            for i in range(900)]
    df = spark.createDataFrame(data, "seq bigint, name string, cnt bigint")
    return df.withColumn("ts", F.timestamp_millis(F.col("seq") * 130)).repartition(5).cache()


def replay(updates, capacity, held=None):
    """Brute force of the bounded buffer: (changes, state)."""
    held, changes = dict(held or {}), []
    for seq, name, cnt in updates:
        if name not in held and len(held) >= capacity:
            low = min(sorted(held), key=lambda n: held[n])
            if cnt <= held[low]:
                continue
            del held[low]
            changes.append((low, 0))
        held[name] = cnt
        changes.append((name, cnt))
    return changes, held


def test_fold(log):
    state = {}
    for r in sorted(log.collect(), key=lambda r: r.seq):
        state[r.name] = r.cnt
    assert dict(rows(fold_changelog(log))) == {k: v for k, v in state.items() if v}
    assert dict(rows(fold_changelog(log, keep_deleted=True))) == state


def test_snapshot_plus_delta_is_state(log):
    for at in (-1, 0, 450, 899):
        snapshot, delta = snapshot_and_delta(log, F.lit(at))
        both = snapshot.select(F.lit(-1).cast("bigint").alias("seq"), "name", "cnt").union(delta)
        assert rows(fold_changelog(both)) == rows(fold_changelog(log))


def test_conflate(log):
    expected = {}
    for r in sorted(log.collect(), key=lambda r: r.seq):
        expected[(r.seq * 130 // 1000, r.name)] = r.cnt
    got = conflate(log).select(F.unix_seconds("tick"), "name", "cnt")
    assert {(r[0], r[1]): r[2] for r in got.collect()} == expected


def test_topk_and_view(log):
    state = fold_changelog(log)
    best = sorted(rows(state), key=lambda r: (-r[1], r[0]))
    assert [tuple(r) for r in topk_snapshot(state, 5).collect()] == best[:5]
    view = histogram_view(state, "cnt", ascending=False).collect()
    assert [r.cnt for r in view] == [c for _, c in best] and {r.axis_max for r in view} == {best[0][1]}
    assert [r.name for r in histogram_view(state).collect()] == sorted(n for n, _ in best)


def test_messages(spark):
    updates = spark.createDataFrame(
        [(t, f'n"{i}\\', i) for t in (1, 2) for i in range(30 * t)], "tick int, name string, cnt bigint")
    messages = json_message(updates, ["tick"], max_entries=10).collect()
    sent = sorted((m.tick, e["name"], e["count"]) for m in messages for e in json.loads(m.message))
    assert sent == rows(updates)
    assert max(len(json.loads(m.message)) for m in messages) < 30
    one = bounded_message(updates.where("tick = 1").limit(3)).first().message
    assert one.startswith('[{"name":"n\\"') and len(json.loads(one)) == 3


def test_last_key(spark):
    records = spark.createDataFrame([(0, 5, "a"), (0, 7, "b"), (1, 9, "c")], "partition int, offset bigint, key string")
    assert rows(last_key(records, ["partition"])) == [(0, "b"), (1, "c")]
    assert rows(last_key(records)) == [("c",)]
    assert rows(last_key(records.where("false"))) == [("20150218230000-0",)]


@pytest.mark.parametrize("capacity", [1, 3, 10, 100])
def test_bounded_brute_force(log, capacity):
    updates = sorted((r.seq, r.name, r.cnt) for r in log.collect())
    changes, _ = replay(updates, capacity)
    got = bounded_topk(log, capacity=capacity, buckets=1).orderBy("seq", "step")
    assert [(r.name, r.cnt) for r in got.collect()] == changes


def test_bounded_buckets_and_state(log):
    """Two steps with the state between them give what one replay per bucket gives."""
    bucket_of = dict(rows(log.select("name", F.pmod(F.xxhash64("name"), F.lit(3))).distinct()))
    updates = sorted((r.seq, r.name, r.cnt) for r in log.collect())
    changes, state = [], {}
    for b in range(3):
        mine, held = replay([u for u in updates if bucket_of[u[1]] == b], 4)
        changes += mine
        state.update(held)
    one = bounded_topk(log.where("seq < 400"), capacity=4, buckets=3)
    between = buffer_state(one)
    two = bounded_topk(log.where("seq >= 400"), between, capacity=4, buckets=3)
    got = [(r.name, r.cnt) for r in one.collect() + two.collect()]
    assert sorted(got) == sorted(changes)
    assert dict(rows(buffer_state(two, between))) == state
