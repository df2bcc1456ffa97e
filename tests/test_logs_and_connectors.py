import json

import pytest

from meterflow.operators import correlate, oplog
from meterflow.sinks import jdbc
from meterflow.sinks import topic as sink
from meterflow.sources import tables, topic

LINES = [
    {"timestamp": "2024-01-01T00:00:01.250000+00:00", "level": "INFO", "logger": "a", "module": "m", "function": "f", "line": 3,
     "thread_name": "MainThread", "message": "Queue full! Dropping reading for meter 500"},
    {"timestamp": "2024-01-01T00:00:02+00:00", "level": "WARNING", "logger": "a", "module": "m", "function": "f", "line": 4,
     "thread_name": "MainThread", "message": "Worker 3 processing loop delayed: took 120.50ms (Limit: 100.00ms)", "user_id": 7, "tags": ["x"]},
    {"timestamp": "2024-01-01T00:06:00+00:00", "level": "ERROR", "logger": "b", "module": "m", "function": "f", "line": 5,
     "thread_name": "T", "message": "bad", "exception": "Traceback", "stack_trace": "Stack"},
]


@pytest.fixture(scope="module")
def logs(spark):
    return oplog.parse_log(spark.createDataFrame([(json.dumps(x),) for x in LINES], "value string"))


def test_core_keys_and_extras(logs):
    rows = {r.line: r for r in logs.collect()}
    assert rows[3].extras == {} and rows[4].extras == {"user_id": "7", "tags": '["x"]'}
    assert rows[5].exception == "Traceback" and rows[3].exception is None


def test_format_and_parse_again(logs):
    again = oplog.parse_log(oplog.format_log(logs))
    assert sorted(map(str, again.collect())) == sorted(map(str, logs.collect()))
    text = {json.loads(r.value)["line"]: json.loads(r.value) for r in oplog.format_log(logs).collect()}
    assert "exception" not in text[3] and text[4]["user_id"] == "7"


def test_a_warning_takes_both_routes(logs):
    assert {r.level for r in oplog.quiet_route(logs).collect()} == {"INFO", "WARNING"}
    assert {r.level for r in oplog.loud_route(logs).collect()} == {"WARNING", "ERROR"}


def test_losses(logs):
    rows = oplog.losses(logs).collect()
    assert [(r.dropped_readings, r.missed_deadlines, r.worst_ms) for r in rows] == [(1, 1, 120.5)]


def test_rotated_files_are_read(spark, tmp_path):
    for name in ["app_log.jsonl", "app_log.jsonl.1", "app_log.jsonl.2"]:
        (tmp_path / name).write_text(json.dumps(LINES[0]) + "\n")
    (tmp_path / "other.txt").write_text("x\n")
    assert tables.log_text(spark, str(tmp_path / "app_log.jsonl")).count() == 3


def test_unknown_devices_keep_their_readings(spark):
    readings = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "device_id string, v double")
    sites = spark.createDataFrame([("a", "s")], "device_id string, site string")
    assert {(r.device_id, r.site) for r in correlate.enrich(readings, sites).collect()} == {("a", "s"), ("b", None)}


def test_topic_options():
    options = topic.source_options("h:1", "t", 500, min_per_trigger=50, group="g")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "t"
    assert options["kafka.fetch.min.bytes"] == "65536" and options["kafka.fetch.max.wait.ms"] == "50"
    assert options["minOffsetsPerTrigger"] == "50" and options["maxOffsetsPerTrigger"] == "500" and options["kafka.group.id"] == "g"
    assert topic.sample_options("h:1", "t")["endingOffsets"] == "latest"
    written = sink.sink_options("h:1", "t")
    assert written["kafka.compression.type"] == "zstd" and written["kafka.acks"] == "1"
    assert written["kafka.linger.ms"] == "10" and written["kafka.batch.size"] == "262144"


def test_retry_then_success():
    calls, pauses = [], []

    def action():
        calls.append(1)
        if len(calls) < 2:
            raise ConnectionError("gone")

    jdbc.with_retry(action, sleep=pauses.append)
    assert len(calls) == 2 and pauses == [1.0]


def test_retry_gives_up():
    pauses = []

    def action():
        raise RuntimeError("java.sql.SQLTransientConnectionException: gone")

    with pytest.raises(RuntimeError):
        jdbc.with_retry(action, sleep=pauses.append)
    assert pauses == [1.0, 2.0]


def test_other_errors_are_not_retried():
    pauses = []

    def action():
        raise ValueError("not null constraint")

    with pytest.raises(ValueError):
        jdbc.with_retry(action, sleep=pauses.append)
    assert pauses == []


def test_half_written_batches_do_not_show(spark):
    staging = spark.createDataFrame([(1, 0, 10), (2, 0, 11), (3, 1, 12)], "v int, batch_id int, write_id long")
    ledger = spark.createDataFrame([(0, 11), (1, 12)], "batch_id int, write_id long")
    assert sorted(r.v for r in jdbc.visible(staging, ledger).collect()) == [2, 3]
