"""As-of joins and integrals of step functions, against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from namewire.operators.asof import asof_join, integrate_over
from namewire.operators.runs import cost_at_start, cost_over_prices

START = dt.datetime(2024, 1, 1)
POINTS = "kind string, zone string, ts timestamp, price double, number long"


def moment(draw, hours=60):
    return START + dt.timedelta(seconds=draw.choice([draw.randrange(hours * 3600), 3600 * draw.randrange(hours)]))


def points(seed, n, kinds="aab"):
    draw = random.Random(seed)
    rows = [(draw.choice(kinds), draw.choice("xy"), moment(draw), round(draw.uniform(1, 9), 2), k) for k in range(n)]
    rows += [(k, z, t, p + 1, n + 1) for k, z, t, p, _ in rows[:5]]  # equal times: the later number counts
    return rows + [(None, "x", START, 1.0, 0), ("a", "x", None, 1.0, 0), ("a", "x", START, None, 0)]


def held(rows, kind, zone, at):
    mine = [(t, n, p) for k, z, t, p, n in rows if (k, z) == (kind, zone) and t is not None and p is not None and t <= at]
    return max(mine)[2] if mine else None


def facts(seed, n):
    draw = random.Random(seed)
    rows = []
    for k in range(n):
        low = moment(draw)
        rows.append((k, draw.choice("abc"), draw.choice("xy"), low, low + dt.timedelta(seconds=draw.choice([0, 7, 3600, 7200, draw.randrange(200_000)]))))
    return rows + [(n, None, "x", START, START), (n + 1, "a", "x", None, None), (n + 2, "a", "y", START - dt.timedelta(days=9), START)] + rows[:2]


FACTS = "id long, kind string, zone string, at timestamp, till timestamp"


@pytest.mark.parametrize("width", [600, 3600, 1_000_000])
def test_asof(spark, width):
    series, rows = points(1, 80), facts(2, 120)
    got = asof_join(spark.createDataFrame(rows, FACTS), spark.createDataFrame(series, POINTS), ["kind", "zone"], "at",
                    tie="number", width=width).collect()
    assert len(got) == len(rows)
    for r in got:
        want = held(series, r.kind, r.zone, r.at) if r.kind and r.at else None
        assert r.price == want, r


@pytest.mark.parametrize("width", [1800, 3600, 86_400])
def test_integral(spark, width):
    series, rows = points(3, 60), facts(4, 80)
    got = integrate_over(spark.createDataFrame(rows, FACTS), spark.createDataFrame(series, POINTS), ["kind", "zone"], "at", "till",
                         tie="number", width=width).collect()
    assert len(got) == len(rows)
    for r in got:
        area = length = 0.0
        if r.kind and r.at:
            marks = sorted({r.at, r.till, *(t for k, z, t, p, _ in series if (k, z) == (r.kind, r.zone) and t and p and r.at < t < r.till)})
            for low, high in zip(marks, marks[1:]):
                price = held(series, r.kind, r.zone, low)
                if price is not None:
                    hours = (high - low).total_seconds() / 3600
                    area, length = area + price * hours, length + hours
        assert r.price_hours == pytest.approx(area) and r.covered_hours == pytest.approx(length), r


def test_no_points_and_no_facts(spark):
    nothing, none = spark.createDataFrame([], POINTS), spark.createDataFrame([], FACTS)
    some = spark.createDataFrame(facts(5, 6), FACTS)
    assert [r.price for r in asof_join(some, nothing, ["kind", "zone"], "at").collect()] == [None] * some.count()
    assert {r.price_hours for r in integrate_over(some, nothing, ["kind", "zone"], "at", "till").collect()} == {0.0}
    assert asof_join(none, spark.createDataFrame(points(6, 5), POINTS), ["kind", "zone"], "at").count() == 0
    assert integrate_over(none, nothing, ["kind", "zone"], "at", "till").count() == 0


def test_a_hot_series_is_in_many_tasks(spark):
    """One key holds every point; a block of an hour is all that meets, and no window or join lacks the block."""
    n = 20_000
    series = spark.range(n).select(F.lit("a").alias("kind"), F.lit("x").alias("zone"), F.timestamp_seconds(F.col("id") * 60).alias("ts"),
                                   F.col("id").cast("double").alias("price"), "id")
    rows = spark.range(n).select("id", F.lit("a").alias("kind"), F.lit("x").alias("zone"),
                                 F.timestamp_seconds(F.col("id") * 60 + 30).alias("at"))
    joined = asof_join(rows, series, ["kind", "zone"], "at")
    assert joined.where("price <> id").count() == 0 and joined.count() == n
    plan = joined._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert any("_block" in line.split("], [")[1] for line in windows)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    runs = rows.withColumn("till", F.col("at") + F.expr("interval 3 hours"))
    summed = integrate_over(runs, series, ["kind", "zone"], "at", "till")
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    row = summed.where("id = 600").first()
    assert row.covered_hours == pytest.approx(3.0) and row.price_hours == pytest.approx((300 + sum(range(601, 780)) * 1.0 + 390) / 60)


def test_costs(spark):
    prices = spark.createDataFrame([("c1", "z", START, 2.0, 0), ("c1", "z", START + dt.timedelta(hours=1), 4.0, 1)],
                                   "instance_type string, zone string, ts timestamp, price double, number long")
    runs = spark.createDataFrame([(1, "c1", "z", 3, 120.0, START + dt.timedelta(minutes=30), START + dt.timedelta(minutes=150))],
                                 "run_id long, instance_type string, zone string, instances int, runtime_min double, started timestamp, ended timestamp")
    assert cost_at_start(runs, prices).first().cost == 12.0
    row = cost_over_prices(runs, prices).first()
    assert row.cost == pytest.approx(3 * (0.5 * 2 + 1.5 * 4)) and row.covered_hours == pytest.approx(2.0)
