"""Lines followed through rotations, typed extras, and errors told by their SQL state."""

import json
import os

import pytest
from pyspark.sql import functions as F

from meterflow.operators import oplog
from meterflow.sinks import jdbc
from meterflow.sources import rotated, tables
from meterflow.streaming.aggregates import start_side_table
from test_streaming import NOW


def line(number):
    return json.dumps({"timestamp": f"2024-01-01T00:00:{number % 60:02d}+00:00", "level": "INFO", "line": number, "message": "é" * (number % 9)})


def append(path, numbers, end="\n"):
    with open(path, "a", encoding="utf-8", newline="") as file:
        file.write("".join(line(n) + "\n" for n in numbers)[: None if end else -1])


def rotate(path, keep=3):
    for number in range(keep, 0, -1):
        older = path if number == 1 else f"{path}.{number - 1}"
        if os.path.exists(older):
            os.replace(older, f"{path}.{number}")


def test_every_line_once_through_rotations(spark, tmp_path, monkeypatch):
    path, rows, check = str(tmp_path / "app_log.jsonl"), str(tmp_path / "rows"), str(tmp_path / "check")
    (tmp_path / "app_log.jsonl.old").write_text("not a sibling\n")
    (tmp_path / "app_log.jsonl2").write_text("neither\n")

    def step():
        stream = tables.stream_log_text(spark, path)
        start_side_table(stream, rows, check, trigger=NOW).awaitTermination()
        return sorted(json.loads(r.value)["line"] for r in spark.read.parquet(rows).collect())

    append(path, range(10))
    assert step() == list(range(10))
    append(path, range(10, 15))  # grows in place
    rotate(path)
    append(path, range(15, 20))
    append(path, [20], end="")  # a line under way
    assert step() == list(range(20))
    rotate(path)  # moves on with half a line, which is completed there
    with open(f"{path}.1", "a") as file:
        file.write("\n")
    append(path, range(21, 24))
    rotate(path)
    append(path, range(24, 30))
    assert step() == list(range(30))
    assert step() == list(range(30))  # nothing new
    for _ in range(4):
        rotate(path)
    append(path, [30])
    assert step() == list(range(31))


def test_parts_of_a_file_meet_at_lines(tmp_path, monkeypatch):
    path = str(tmp_path / "a.jsonl")
    append(path, range(200))
    monkeypatch.setattr(rotated, "PART", 97)
    monkeypatch.setattr(rotated, "BLOCK", 31)
    reader = rotated.Reader(path)
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    found = [row for part in parts for row in rotated.lines(path, part)]
    assert [json.loads(text)["line"] for _, text in found] == list(range(200))
    content = (tmp_path / "a.jsonl").read_bytes()
    assert all(content[at:].startswith(text.encode()) for at, text in found)
    assert reader.partitions(reader.latestOffset(), reader.latestOffset()) == []


def test_a_log_that_is_not_there_yet(tmp_path):
    assert rotated.scan(str(tmp_path / "none" / "a.jsonl")) == {}
    (tmp_path / "a.jsonl").write_text("no line end")
    assert rotated.scan(str(tmp_path / "a.jsonl")) == {}
    (tmp_path / "a.jsonl").write_text("x" * 5000)
    assert list(rotated.scan(str(tmp_path / "a.jsonl")).values()) == [0]


def test_typed_extras_survive_a_round_trip(spark):
    extras = {"user_id": 7, "share": 0.25, "tags": ["x", 1, None], "nested": {"a": {"b": [True]}}, "text": "1", "none": None}
    body = {"timestamp": "2024-01-01T00:00:02+00:00", "level": "WARNING", "line": 4, "message": "m"}
    lines = spark.createDataFrame([(json.dumps(body | extras),), (json.dumps(body),), ("broken",)], "value string")
    parsed = oplog.parse_log(lines, typed=True)
    again = [json.loads(r.value) for r in oplog.format_log(parsed.where("line = 4")).collect()]
    assert sorted(again, key=len) == [body, body | extras]
    once_more = oplog.parse_log(oplog.format_log(parsed), typed=True)
    row = once_more.where(oplog.extra("user_id", "int") == 7).select(
        oplog.extra("share", "double").alias("share"), oplog.extra("tags", "string", "$[0]").alias("tag"),
        oplog.extra("nested", "boolean", "$.a.b[0]").alias("deep"), oplog.extra("text", "string").alias("text"),
        oplog.extra("tags", "int").alias("other_kind"), oplog.extra("missing", "int").alias("missing"),
    ).first()
    assert tuple(row) == (0.25, "x", True, "1", None, None)


def java_error(spark, error):
    """As the gateway hands on an exception of the driver's JVM."""
    from py4j.protocol import Py4JJavaError

    raised = Py4JJavaError.__new__(Py4JJavaError)
    raised.errmsg, raised.java_exception, raised.exception_cmd = "failed", error, ""
    return raised


@pytest.mark.parametrize("state, wanted", [
    ("08006", True), ("08001", True), ("57P01", True), ("57P03", True), ("57014", False), ("23502", False), ("22P02", False),
])
def test_retry_by_sql_state(spark, state, wanted):
    sql = spark._jvm.java.sql
    deep = spark._jvm.java.lang.RuntimeException("job aborted", sql.SQLException("value 57P01 is out of range, 08006", state))
    assert jdbc.is_transient(java_error(spark, deep)) is wanted


def test_retry_by_class(spark):
    java = spark._jvm.java
    assert jdbc.is_transient(java_error(spark, java.lang.RuntimeException("x", java.net.SocketException("Connection reset"))))
    assert jdbc.is_transient(java_error(spark, java.sql.SQLTransientConnectionException("gone")))
    assert not jdbc.is_transient(java_error(spark, java.lang.RuntimeException("java.net.ConnectException is what the row says")))
    assert not jdbc.is_transient(ValueError("57P01"))
    assert jdbc.is_transient(TimeoutError())


def test_a_stream_appends_each_batch_once(spark, tmp_path):
    source, check, written, broken = str(tmp_path / "src"), str(tmp_path / "check"), {}, [2]

    def append_batch(batch, batch_id, options, ledger):
        def attempt():
            if broken and batch_id == 1:
                broken.pop()
                raise ConnectionError("reset")
            written.setdefault(batch_id, []).append((options["dbtable"], ledger, sorted(r.id for r in batch.collect())))

        jdbc.with_retry(attempt, sleep=lambda _: None)

    options = jdbc.writer_options("jdbc:x", "readings", "u", "p")
    for first in (0, 5):
        spark.range(first, first + 5).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id long").parquet(source)
        jdbc.start_database_append(stream, options, "ledger", check, NOW, append_batch).awaitTermination()
    assert written == {0: [("readings", "ledger", list(range(5)))], 1: [("readings", "ledger", list(range(5, 10)))]}
    assert spark.read.parquet(source).agg(F.count("*")).first()[0] == 10
