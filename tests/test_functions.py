import math

import pytest
from pyspark.sql import functions as F

from meterflow.functions import quality as Q
from meterflow.functions import scalars as X
from meterflow.functions import text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("number, name", [(42, "meter_00042"), (99, "meter_00099"), (0, "meter_00000"), (123456, "meter_123456")])
def test_device_names(spark, number, name):
    assert one(spark, X.device_name(F.lit(number))) == name
    assert one(spark, X.device_number(F.lit(name))) == number


def test_device_number_of_other_names(spark):
    assert one(spark, X.device_number(F.lit("meter_x"))) is None
    assert one(spark, X.device_number(F.lit("meter_99999999999999999999"))) is None


def test_shard(spark):
    assert one(spark, X.device_shard(F.lit(500))) == 5


def test_epoch_conversion_is_exact(spark):
    base = 1_710_000_000_000_000
    frame = spark.range(20_000).select((F.lit(base) + F.col("id") * 1_234_567).alias("us"))
    wrong = frame.where(F.unix_micros(X.epoch_to_timestamp(F.col("us") / F.lit(1e6))) != F.col("us"))
    assert wrong.count() == 0


def test_epoch_before_1970(spark):
    assert one(spark, F.unix_micros(X.epoch_to_timestamp(F.lit(-0.25)))) == -250_000


def test_local_hour(spark):
    ts = F.timestamp_micros(F.lit(1704119400000000))  # 2024-01-01 14:30:00 UTC
    assert one(spark, X.local_hour(ts)) == 14.5
    assert one(spark, X.local_hour(ts, "America/New_York")) == 9.5


@pytest.mark.parametrize("hour, factor", [(0.0, 0.0), (6.0, 0.5), (12.0, 1.0), (24.0, 0.0)])
def test_load_factor(spark, hour, factor):
    assert one(spark, X.load_factor(F.lit(hour))) == pytest.approx(factor, abs=1e-12)


def test_expected_load_at_noon(spark):
    amps = one(spark, X.expected_current(F.lit(12.0), F.lit(1.0)))
    assert amps == pytest.approx(30.0)
    assert one(spark, X.expected_voltage(F.lit(amps))) == pytest.approx(118.5)


@pytest.mark.parametrize("volts, amps, outside", [
    (118.5, 30.0, False), (118.5, 20.0, False), (118.5, 46.0, False), (118.5, 47.0, True), (118.5, 19.0, True),
    (150.0, 30.0, True), (115.0, 30.0, True),
])
def test_baseline_at_noon(spark, volts, amps, outside):
    assert one(spark, X.is_outside_baseline(F.lit(volts), F.lit(amps), F.lit(12.0))) is outside


def test_surge_and_trip(spark):
    rows = [(150.0, 0.2, 0.2, True), (144.9, 0.2, 0.2, False), (150.0, 0.6, 0.2, False), (150.0, 0.2, 0.9, False), (145.0, 0.5, 0.2, True)]
    frame = spark.createDataFrame(rows, "v float, a float, pf float, want boolean")
    assert frame.where(X.is_surge_and_trip(F.col("v"), F.col("a"), F.col("pf")) != F.col("want")).count() == 0


def test_phase_angle(spark):
    assert one(spark, X.phase_angle_deg(F.lit(0.2))) == pytest.approx(78.463, abs=5e-4)


def test_power(spark):
    assert one(spark, X.active_power_kw(F.lit(120.0), F.lit(10.0), F.lit(0.9))) == pytest.approx(1.08)
    assert one(spark, X.power_factor_of(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, X.power_is_consistent(F.lit(3.876), F.lit(117.88), F.lit(36.54), F.lit(0.9)))
    assert not one(spark, X.power_is_consistent(F.lit(5.0), F.lit(117.88), F.lit(36.54), F.lit(0.9)))


@pytest.mark.parametrize("volts, band", [(114.0, "optimal"), (126.0, "optimal"), (113.9, "acceptable"), (127.0, "acceptable"), (105.9, "out_of_range"), (127.1, "out_of_range")])
def test_voltage_band(spark, volts, band):
    assert one(spark, Q.voltage_band(F.lit(volts))) == band


@pytest.mark.parametrize("volts, alert", [(135.0, False), (135.01, True), (math.nan, False), (math.inf, True)])
def test_severe_voltage(spark, volts, alert):
    assert one(spark, Q.is_severe_voltage(F.lit(volts))) is alert


@pytest.mark.parametrize("factor, valid", [(0.0, True), (1.0, True), (1.01, False), (-0.1, False), (math.nan, False)])
def test_power_factor_range(spark, factor, valid):
    assert one(spark, Q.valid_power_factor(F.lit(factor))) is valid


@pytest.mark.parametrize("gap", [0.0, 0.000452, 5e-05, 4.5e-05, 1e-06, 9.9e-05, 0.0001, 12.5, 0.100001, -0.00002, -3.0, 123456.789])
def test_gap_text_is_that_of_the_log(spark, gap):
    assert one(spark, text.seconds_text(F.lit(gap))) == repr(gap)


LINES = [
    ("[meter_00990] Telemetry payload produced successfully.", "payload_produced", {"device_id": "meter_00990"}),
    ("[meter_00123] Cyber-anomaly injected! V=148.50V, A=0.25A", "anomaly_injected", {"device_id": "meter_00123", "voltage_v": 148.5, "current_a": 0.25}),
    ("Dispatcher #0 Throughput Status: Sent 45000 records (~8950.41 msg/sec)", "throughput", {"dispatcher": 0, "records": 45000, "rate": 8950.41}),
    ("[NetFlow Log] Ingested 184B packet | Flags: PA | Latency Delta: 0.000452s", "packet_flow", {"size_bytes": 184, "tcp_flags": "PA", "gap_sec": 0.000452}),
    ("[NETWORK ALERT] Oversized Payload Detected | From fd00::1:19092 | Size: 1600B | Delta: 5e-05s", "network_alert", {"reason": "Oversized Payload Detected", "src_ip": "fd00::1", "src_port": 19092, "size_bytes": 1600, "gap_sec": 5e-05}),
    ("Queue full! Dropping reading for meter 500", "reading_dropped", {"meter": 500}),
    ("Worker 3 processing loop delayed: took 120.50ms (Limit: 100.00ms)", "deadline_missed", {"worker": 3, "took_ms": 120.5}),
    ("Severe voltage anomaly detected on node: meter_00042 (145.20V)", "voltage_alert", {"device_id": "meter_00042", "voltage_v": 145.2}),
    ("Successfully flushed batch of 50 records to storage.", "batch_flushed", {"records": 50}),
    ("Successfully captured and parsed a batch of 100 packets.", "capture_done", {"records": 100}),
    ("Something else", "other", {}),
    # Numbers that are none leave their fact empty and do not fail the query.
    ("Dispatcher #1 Throughput Status: Sent 5 records (~1.2.3 msg/sec)", "throughput", {"dispatcher": 1, "records": 5}),
    ("Queue full! Dropping reading for meter 99999999999999999999", "reading_dropped", {}),
]


def test_log_facts(spark):
    frame = spark.createDataFrame([(m,) for m, _, _ in LINES], "message string")
    kind = text.event_kind(F.col("message"))
    rows = frame.withColumn("kind", kind).select("message", "kind", *[text.fact(F.col("message"), F.col("kind"), n).alias(n) for n in text.FACT_TYPES])
    found = {r.message: (r.kind, {n: r[n] for n in text.FACT_TYPES if r[n] is not None}) for r in rows.collect()}
    assert found == {m: (k, facts) for m, k, facts in LINES}
