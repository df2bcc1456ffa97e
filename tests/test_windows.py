"""Rolling statistics against brute force, on data that crowds."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from meterflow.operators import correlate, rollup
from meterflow.operators import windows as W

START_US = 1_704_067_200_000_000


def readings(spark, rows):
    """Rows of (event, device, microseconds, volts)."""
    frame = spark.createDataFrame(rows, "event_id bigint, device_id string, us bigint, voltage_v double")
    return frame.withColumn("timestamp", F.timestamp_micros(F.col("us") + START_US))


@pytest.fixture(scope="module")
def crowded():
    pick = random.Random(11)
    rows = []
    for i in range(1500):
        device = "hot" if i % 3 else f"d{pick.randrange(3)}"
        us = 25_000_000 if i % 3 == 1 and i % 5 == 0 else pick.randrange(0, 120_000) * 1000
        rows.append((i, device, us, round(pick.gauss(120, 0.3) if i % 50 else 150.0, 2)))
    # Window ends that fall exactly on readings and on cell borders.
    rows += [(2000 + k, "edge", k * 5_000_000, 120.0 + k) for k in range(8)]
    return rows


def test_rolling_mean(spark, crowded):
    found = {r.event_id: r for r in W.rolling_mean(readings(spark, crowded)).collect()}
    assert len(found) == len(crowded)
    for event, device, us, _ in crowded:
        near = [v for _, d, t, v in crowded if d == device and us - 10_000_000 <= t <= us]
        assert found[event].readings == len(near)
        assert found[event].rolling_voltage == pytest.approx(statistics.fmean(near), abs=1e-9)


@pytest.mark.parametrize("min_n", [2, 5])
def test_spikes(spark, crowded, min_n):
    want = set()
    for event, device, us, v in crowded:
        near = [x for _, d, t, x in crowded if d == device and us - 10_000_000 <= t < us]
        if len(near) >= min_n:
            sd = statistics.stdev(near)
            if sd > 1e-9 and abs(v - statistics.fmean(near)) > 3 * sd:
                want.add(event)
    assert {r.event_id for r in W.spikes(readings(spark, crowded), min_n=min_n).collect()} == want
    assert want


def test_flat_baseline_raises_nothing(spark):
    rows = [(i, "d", i * 100_000, 119.97) for i in range(60)] + [(99, "d", 6_000_000, 150.0)]
    assert W.spikes(readings(spark, rows)).count() == 0


def test_nan_is_neither_baseline_nor_spike(spark):
    rows = [(i, "d", i * 100_000, 120.0 + (i % 2) * 0.1) for i in range(20)]
    rows += [(20, "d", 1_950_000, float("nan")), (21, "d", 2_000_000, 140.0)]
    assert [r.event_id for r in W.spikes(readings(spark, rows)).collect()] == [21]


def test_energy_and_cadence(spark):
    rows = [(1, "d", 0, 120.0), (2, "d", 100_000, 120.0), (3, "d", 100_000, 120.0), (4, "d", 30_100_000, 120.0)]
    frame = readings(spark, rows).withColumn("power_kw", F.col("event_id").cast("double"))
    kwh = rollup.energy_by_gap(frame, "event_id").first().energy_kwh
    # 0.1 s at 1 kW, no time at 2 kW, 30 s at 3 kW, and the last reading lasts no time.
    assert kwh == pytest.approx((0.1 * 1 + 30 * 3) / 3600)
    gaps = [r.gap_sec for r in W.cadence_gaps(frame).collect()]
    assert gaps == [30.0]


def test_latest(spark):
    rows = readings(spark, [(1, "a", 5, 1.0), (2, "a", 9, 2.0), (3, "a", 9, 3.0), (4, "b", 1, 4.0)])
    latest = W.latest_per_key(rows, ["device_id"], ["timestamp", "event_id"])
    assert {r.device_id: r.event_id for r in latest.collect()} == {"a": 3, "b": 4}


def test_correlation_equals_a_theta_join(spark):
    pick = random.Random(5)
    telemetry = [(i, "t", pick.randrange(0, 300) * 1_000_000) for i in range(60)]
    network = [(i, "n", pick.randrange(0, 300) * 1_000_000) for i in range(40)]

    def alerts(rows):
        frame = spark.createDataFrame(rows, "id int, source string, us bigint")
        return frame.withColumn("alert_time", F.timestamp_micros(F.col("us") + START_US))

    found = correlate.preceded_by(alerts(telemetry), alerts(network), 30.0)
    got = {r.id: (r.network_alerts, r.lead_sec) for r in found.collect()}
    want = {}
    for i, _, us in telemetry:
        near = [t for _, _, t in network if us - 30_000_000 <= t <= us]
        if near:
            want[i] = (len(near), (us - max(near)) / 1e6)
    assert got == want


@pytest.mark.parametrize("width, start", [("7 minutes", 60), ("5 minutes", 300), ("5 seconds", 445)])
def test_bucket_origin(spark, width, start):
    """00:07:30; 7 minutes do not divide a day, and their buckets count from 2000-01-03."""
    ts = F.timestamp_micros(F.lit(START_US + 450_000_000 - (0 if width != "5 seconds" else 1)))
    got = spark.range(1).groupBy(rollup.bucket_start(ts, width).alias("b")).count().select(F.unix_micros("b").alias("b"))
    origin = 946857600_000_000
    span = {"7 minutes": 420_000_000, "5 minutes": 300_000_000, "5 seconds": 5_000_000}[width]
    us = START_US + 450_000_000 - (0 if width != "5 seconds" else 1)
    assert got.first().b == origin + (us - origin) // span * span


def test_windows_never_depend_on_the_device_alone(spark):
    """No window of the rolling operators is partitioned by device only, and none slides over a frame."""
    frame = readings(spark, [(1, "a", 5, 1.0)])
    plan = W.rolling_mean(frame)._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if " Window " in line]
    assert lines and all("cell" in line for line in lines)
