import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from namewire.operators.interpolation import even_grid, interpolate, knot_segments
from namewire.operators.prices import cheapest_zone, cost_efficiency, latest_price, price_series
from namewire.operators.runs import cheapest_config, run_cost, run_times, scaling_ratio
from namewire.operators.sizing import lookup_join
from namewire.operators.trends import linear_trend, predict, quadratic_trend
from namewire.sources.prices import price_history

# Published run times in minutes: (type, instances, data size, minutes).
RUNS = [
    *[("c4.8xlarge", n, "year", m) for n, m in zip((1, 2, 3, 4, 5), (22.0, 10.5, 7.3, 5.7, 4.5))],
    *[("c4.8xlarge", n, "all", m) for n, m in zip((2, 3, 4, 5), (62.0, 33.4, 26.1, 20.7))],
    *[("c5.xlarge", n, "year", m) for n, m in zip((9, 18, 27, 36, 45), (18.8, 9.7, 6.5, 5.0, 4.2))],
    *[("c5.xlarge", n, "all", m) for n, m in zip((9, 18, 27, 36, 45), (87.4, 43.3, 29.2, 22.7, 18.4))],
]


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(RUNS, "instance_type string, instances int, data_size string, runtime_min double")


@pytest.fixture(scope="module")
def prices(spark):
    data = [("c4", "us-east-2a", 1, 0.3, "Linux/UNIX"), ("c4", "us-east-2a", 2, 0.5, "Linux/UNIX"),
            ("c4", "us-east-2b", 1, 0.4, "Linux/UNIX"), ("c4", "us-east-1c", 9, 0.4, "Windows"),
            ("r5", "us-east-2a", 1, 0.0, "Linux/UNIX")]
    return spark.createDataFrame(data, "instance_type string, zone string, ts int, price double, product string")


def test_costs(spark, runs):
    hourly = spark.createDataFrame([("c4.8xlarge", 0.296), ("c5.xlarge", 0.0387)], "instance_type string, price double")
    costs = run_cost(runs, hourly)
    best = {r.data_size: (r.instance_type, r.instances, round(r.cost, 3)) for r in cheapest_config(costs).collect()}
    assert best["all"] == ("c4.8xlarge", 3, 0.494)
    ratios = {(r[0], r[1]): r[2] for r in scaling_ratio(runs, "all", "year").select(
        "instance_type", "instances", "ratio").collect()}
    assert ratios["c4.8xlarge", 2] == pytest.approx(5.90, abs=.01) and ratios["c4.8xlarge", 1] is None


def test_run_times(spark):
    stages = spark.createDataFrame([(1, 2.0), (1, 3.5), (2, 1.0)], "run_id int, stage_seconds double")
    assert rows(run_times(stages)) == [(1, 5.5), (2, 1.0)]


def test_prices(spark, prices):
    latest = latest_price(prices)
    assert ("c4", "us-east-2a", 0.5) in rows(latest)
    assert rows(cheapest_zone(latest)) == [("c4", "us-east-1c", 0.4), ("r5", "us-east-2a", 0.0)]
    attrs = spark.createDataFrame([("c4", "8 GiB", "Variable"), ("r5", "1,952 GiB", "3"), ("x1", "1", "1")],
                                  "instance_type string, memory string, ecu string")
    assert rows(cost_efficiency(attrs, cheapest_zone(latest)).select(
        "instance_type", "family", F.col("memory_efficiency").cast("string"), "ecu_efficiency")) == [
            ("c4", "compute optimized", "20.0", None), ("r5", "memory optimized", None, None)]
    kept = price_history(prices, ["c4"], "Linux/UNIX", since=2)
    assert rows(kept.select("zone", "ts")) == [("us-east-2a", 2)]
    merged = price_series(prices.where("zone like '%-1_'"), prices.where("zone like '%-2_'"))
    assert [(r.zone, r.region, r.ts) for r in merged.collect()] == [
        ("us-east-1c", "1", 9), ("us-east-2a", "2", 1), ("us-east-2a", "2", 2), ("us-east-2b", "2", 1),
        ("us-east-2a", "2", 1)]


def test_lookup_join_both_ways(spark, runs):
    hourly = spark.createDataFrame([("c4.8xlarge", 0.296), ("c5.xlarge", 0.0387)], "instance_type string, price double")
    small, large = (lookup_join(runs, hourly, "instance_type", max_bytes=b) for b in (1 << 20, 0))
    assert rows(small) == rows(large) and small.count() == len(RUNS)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_trends(spark):
    files = np.repeat([10, 50, 100, 500, 1000], 3).astype(float)
    seconds = np.array([1.2, 1.3, 1.3, 2.7, 2.7, 4, 5, 5, 5, 16, 16, 16, 35, 35, 35])
    points = spark.createDataFrame(list(zip(files.tolist(), seconds.tolist())), "x double, y double")
    for degree, fit in ((1, linear_trend), (2, quadratic_trend)):
        trend = fit(points)
        expected = np.polyfit(files, seconds, degree)
        assert list(trend.first())[::-1] == pytest.approx(expected.tolist(), rel=1e-9)
        got = {r.x: r.predicted for r in predict(trend, [1, 10000]).collect()}
        assert got == pytest.approx({float(x): np.polyval(expected, x) for x in (1, 10000)}, rel=1e-9)
    far = points.withColumn("x", F.col("x") + 1e6)
    assert quadratic_trend(far).first().c2 == pytest.approx(np.polyfit(files, seconds, 2)[0], rel=1e-4)
    assert quadratic_trend(points.where("x = 10")).first().c2 is None


def test_interpolation(runs):
    for width in (1.0, 4.0, 100.0):
        got = interpolate(runs.where("data_size = 'all'"), 1001, "instances", "runtime_min", ["instance_type"], width)
        for kind in ("c4.8xlarge", "c5.xlarge"):
            knots = [(n, m) for t, n, s, m in RUNS if t == kind and s == "all"]
            grid = np.linspace(knots[0][0], knots[-1][0], 1001)
            mine = got.where(F.col("instance_type") == kind).orderBy("i").collect()
            assert [r.i for r in mine] == list(range(1001))
            assert [r.x for r in mine] == pytest.approx(grid.tolist())
            assert [r.y for r in mine] == pytest.approx(np.interp(grid, *zip(*knots)).tolist())


def test_interpolation_irregular(spark):
    rng = np.random.default_rng(3)
    xs = np.sort(rng.choice(10_000, 300, replace=False)).astype(float)
    ys = rng.normal(size=300)
    knots = spark.createDataFrame(list(zip(xs.tolist(), ys.tolist())), "x double, y double")
    got = interpolate(knots, 777, width=64).orderBy("i").collect()
    grid = np.linspace(xs[0], xs[-1], 777)
    assert [r.y for r in got] == pytest.approx(np.interp(grid, xs, ys).tolist())
    assert knot_segments(knots, width=64).count() == 300
    assert [r.x for r in interpolate(knots.limit(1), 5).collect()] == [xs[0]]


def test_even_grid(spark):
    bounds = spark.createDataFrame([(9.0, 45.0)], "a double, b double")
    got = even_grid(bounds, "a", "b", 1001).orderBy("i").collect()
    assert [r.x for r in got] == pytest.approx(np.linspace(9, 45, 1001).tolist())
