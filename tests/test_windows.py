import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from namewire.operators.windows import (
    hopping_counts, latest_window_counts, newest_counts, trailing_hour_count, trailing_totals,
)

BASE = 1_704_067_200  # 2024-01-01 00:00:00 UTC


@pytest.fixture(scope="module")
def events(spark):
    """A third of the events have one name; some share an instant; some sit on boundaries."""
    rng = random.Random(5)
    data = [(rng.randrange(0, 4 * 3600) * 1000 + rng.choice([0, 0, 500]),
             rng.choice(["hot", "hot", "a", "b", "c", "d"])) for _ in range(600)]
    data += [(0, "a"), (3_600_000, "a"), (3_600_000, "a"), (3_600_001, "a"), (7_200_000, "a")]
    rows_ = [(i, BASE * 1000 + ms, name) for i, (ms, name) in enumerate(data)]
    df = spark.createDataFrame(rows_, "event_id int, ms bigint, name string")
    return df.withColumn("ts", F.timestamp_millis("ms")).cache()


def test_hopping_brute_force(events):
    expected = Counter()
    for r in events.collect():
        minute = r.ms // 60_000
        for i in range(60):
            expected[((minute - i) * 60, r.name)] += 1
    got = hopping_counts(events).select(F.unix_seconds("window_start"), "name", "cnt")
    assert {(r[0], r[1]): r[2] for r in got.collect()} == dict(expected)
    assert got.agg(F.sum("cnt")).first()[0] == 60 * events.count()


def test_hopping_other_sizes(events):
    with pytest.raises(ValueError):
        hopping_counts(events, size=100, slide=60)
    tumbling = hopping_counts(events, size=900, slide=900)
    direct = events.groupBy(F.window("ts", "15 minutes"), "name").count()
    assert rows(tumbling) == rows(direct.select("window.start", "window.end", "name", "count"))


def test_trailing_brute_force(events):
    data = events.collect()
    expected = {r.event_id: sum(1 for o in data if o.name == r.name and r.ms - 3_600_000 <= o.ms <= r.ms)
                for r in data}
    got = trailing_hour_count(events).select("event_id", "trailing_cnt")
    assert {r[0]: r[1] for r in got.collect()} == expected


def test_newest_windows(events):
    as_of = events.select(F.max("ts")).scalar()
    for complete in (True, False):
        picked = latest_window_counts(hopping_counts(events), as_of, complete)
        direct = newest_counts(events, complete=complete)
        assert rows(picked) == rows(direct) and picked.count() > 0
    newest = events.agg(F.max("ms")).first()[0] // 60_000 * 60
    end = newest_counts(events).select(F.unix_seconds("window_end")).first()[0]
    assert end == newest
    assert dt.datetime.fromtimestamp(end, dt.timezone.utc).second == 0


def test_counts_fall_as_time_goes_on(events):
    """With no new mention, the count of the last hour falls, and a name leaves in the end."""
    data = events.collect()
    for minutes in (200, 230, 260, 290, 320):
        end = BASE + minutes * 60
        expected = Counter(r.name for r in data if end * 1000 - 3_600_000 <= r.ms < end * 1000)
        at = F.timestamp_seconds(F.lit(end))
        direct = newest_counts(events, as_of=at)
        assert dict(rows(direct.select("name", "cnt"))) == expected
        assert rows(latest_window_counts(hopping_counts(events), at)) == rows(direct)


def test_hot_name_is_in_many_tasks(spark):
    """One name, one hour: running totals are made a minute at a time."""
    events = spark.range(20_000).select(F.lit("hot").alias("name"), F.timestamp_millis(F.lit(BASE * 1000) + F.col("id") * 180).alias("ts"))
    totals = trailing_totals(events)
    assert totals.count() == 20_000 and totals.agg(F.max("cnt")).first()[0] == 20_000
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    running = [spec for spec in re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", plan) if "at#" in spec]
    assert running and all("_block" in spec for spec in running)  # never a whole name
