"""Literal messages: what alerts, what is accepted, what is rejected and why."""

import json
import math
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from meterflow.operators import decode as D
from meterflow.schemas import TOPIC_RECORD


def message(device="meter_00042", volts=120.0, amps=1.5, kw=0.18, pf=0.95, flag=0, ts=1710000000.0):
    return json.dumps({
        "timestamp": ts, "device_id": device,
        "metrics": {"voltage_v": volts, "current_a": amps, "power_kw": kw, "power_factor": pf}, "security_flag": flag,
    })


SEVERE = {"device": "meter_critical_node_88", "volts": 145.2, "amps": 0.5, "kw": 0.07, "pf": 0.33, "flag": 1}

# name, value, alerts, reason
CASES = [
    ("normal", message(), False, None),
    ("severe", message(**SEVERE), True, None),
    ("sample", message("meter_00007", 117.88, 36.54, 3.884, 0.9, 0, 1789517476.925408), False, None),
    ("at the limit", message(volts=135.0), False, None),
    ("above the limit", message(volts=135.01), True, None),
    ("negative", message(volts=-500.0), False, None),
    ("nan", message(volts=float("nan")), False, None),
    ("infinite", message(volts=float("inf")), True, None),
    ("integers", message(volts=120, amps=1, ts=1710000000), False, None),
    ("no json", "not json", False, "parse"),
    ("tombstone", None, False, "parse"),
    ("empty", "", False, "parse"),
    ("trailing text", message(**SEVERE) + " xyz", False, "parse"),
    ("two objects", message(**SEVERE) + message(), False, "parse"),
    ("two objects with comma", message(**SEVERE) + "," + message(), False, "parse"),
    ("broken tail", message(**SEVERE)[:-1] + " x}", False, "parse"),
    ("brace in a text", message(device="a{b").replace("}, ", "} , "), False, None),
    ("escapes", message(device='q"q').replace("}, ", "} , "), False, None),
    ("no object", '{abc "metrics": {} }', False, "parse"),
    ("array", "[" + message(**SEVERE) + "]", False, "parse"),
    ("single quotes", message(**SEVERE).replace('"', "'"), False, "parse"),
    ("missing metrics", '{"device_id": "y"}', False, "missing_key"),
    ("missing current", message(**SEVERE).replace('"current_a": 0.5, ', ""), True, "missing_key"),
    ("missing timestamp", message(**SEVERE).replace('"timestamp": 1710000000.0, ', ""), True, "missing_key"),
    ("missing device", message(**SEVERE).replace('"device_id": "meter_critical_node_88", ', ""), False, "missing_key"),
    ("text voltage", message(volts="abc"), False, "type"),
    ("quoted infinity", message(volts="Infinity"), False, "type"),
    ("null voltage", message(volts=None), False, "type"),
    ("text timestamp", message(**SEVERE, ts="x"), True, "type"),
    ("nan timestamp", message(ts=float("nan")), False, "timestamp"),
    ("year 10000", message(ts=253402300800.0), False, "timestamp"),
    ("null current", message(amps=None), False, "constraint"),
    ("long device", message(device="d" * 51), False, "constraint"),
    ("device of 50", message(device="d" * 50), False, None),
    ("null device", message(device=None), False, "constraint"),
    ("flag true", message(flag=True), False, "type"),
    ("flag beyond int", message(flag=2**31), False, "constraint"),
    ("real overflow", message(kw=1e39), False, "constraint"),
    ("real underflow", message(kw=1e-60), False, "constraint"),
]


@pytest.fixture(scope="module")
def decoded(spark):
    at = datetime(2024, 3, 9, 16, tzinfo=timezone.utc)
    rows = [(name, value, "t", 0, i, at) for i, (name, value, _, _) in enumerate(CASES)]
    return D.decode(spark.createDataFrame(rows, TOPIC_RECORD)).cache()


def test_reasons(decoded):
    found = {r.key: r.reject_reason for r in decoded.select("key", "reject_reason").collect()}
    assert found == {name: reason for name, _, _, reason in CASES}


def test_alerts_do_not_wait_for_typing(decoded):
    found = {r.key for r in D.severe_voltage(decoded).select("key").collect()}
    assert found == {name for name, _, alerts, _ in CASES if alerts}


def test_every_record_is_accepted_or_rejected(decoded):
    assert D.accepted(decoded).count() + D.rejected(decoded).count() == len(CASES)


def test_storage_types_and_values(decoded):
    rows = {r.key: r for r in D.accepted(decoded, "key").withColumn("us", F.unix_micros("timestamp")).collect()}
    assert rows["sample"].us == 1789517476925408
    assert rows["normal"].us == 1710000000000000
    assert math.isnan(rows["nan"].voltage_v)
    types = dict(D.accepted(decoded).dtypes)
    assert types["voltage_v"] == "float" and types["security_flag"] == "int" and types["timestamp"] == "timestamp"


def test_invalid_utf8_is_a_parse_reject(spark):
    good = message().encode()
    rows = [("a", bytearray(good), "t", 0, 0, datetime(2024, 1, 1)), ("b", bytearray(b"\xff" + good), "t", 0, 1, datetime(2024, 1, 1))]
    frame = spark.createDataFrame(rows, "key string, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    assert {r.key: r.reject_reason for r in D.decode(frame).collect()} == {"a": None, "b": "parse"}


def test_round_trip_through_messages(spark, decoded):
    rows = D.accepted(decoded, "key").where("key in ('normal', 'sample')").drop("key")
    wide = rows.select("timestamp", "device_id", *[F.col(c).cast("double").alias(c) for c in D.METRICS], "security_flag")
    again = D.to_messages(wide, F.lit("7"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
                          F.lit(1).alias("offset"), "timestamp")
    assert sorted(D.accepted(D.decode(again)).collect()) == sorted(rows.collect())


def test_keep_first_drops_copies(spark):
    at = datetime(2024, 1, 1)
    rows = [("1", "first", "t", 0, 5, at), ("1", "first", "t", 0, 5, at), ("1", "x", "t", 1, 5, at)]
    kept = D.keep_first(spark.createDataFrame(rows, TOPIC_RECORD), ["topic", "partition", "offset"], ["timestamp"])
    assert kept.columns == TOPIC_RECORD.fieldNames() and kept.count() == 2


def test_parser_runs_once_per_record(decoded, spark):
    plan = D.accepted(D.decode(spark.createDataFrame([], TOPIC_RECORD)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructField(_corrupt,StringType") == 1


def test_key_is_the_bare_device_number(spark):
    rows = spark.createDataFrame([("42", "meter_00042"), ("41", "meter_00042"), ("1", "other"), (None, "meter_00001")], "k string, d string")
    assert [r[0] for r in rows.select(D.key_matches_device(F.col("k"), F.col("d"))).collect()] == [True, False, False, False]
