"""Streams against batch: several micro-batches, restarts, copies and late rows."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from meterflow.operators import decode as D
from meterflow.operators import network as N
from meterflow.operators.rollup import device_rollup
from meterflow.operators.windows import spikes
from meterflow.schemas import PACKET, TELEMETRY, TOPIC_RECORD
from meterflow.sinks import rollup as M
from meterflow.sinks.table import COLUMNS
from meterflow.sinks.topic import publish_files
from meterflow.sources import tables, topic
from meterflow.streaming import aggregates, ingest
from meterflow.streaming import packets as P

NOW = {"availableNow": True}
DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)
START_US = int(DAY.timestamp() * 1e6)


def records(spark, first, count, seed=1):
    """Topic records in time order; every tenth is broken."""
    pick = random.Random(seed)
    out = []
    for i in range(first, first + count):
        us = START_US + i * 250_000
        volts = 150.0 if i % 40 == 39 else round(pick.gauss(120, 0.3), 2)
        value = "broken" if i % 10 == 9 and i % 40 != 39 else json.dumps({
            "timestamp": us / 1e6, "device_id": f"meter_{i % 3:05d}",
            "metrics": {"voltage_v": volts, "current_a": 1.0, "power_kw": 0.1, "power_factor": 0.9}, "security_flag": 0})
        out.append((str(i % 3), value, "t", i % 2, i // 2, datetime.fromtimestamp(us / 1e6, timezone.utc)))
    if first:
        # A reading that was a day under way.
        old = json.dumps({"timestamp": START_US / 1e6 - 86400, "device_id": "meter_00001", "metrics": {
            "voltage_v": 120.0, "current_a": 1.0, "power_kw": 0.1, "power_factor": 0.9}, "security_flag": 0})
        out.append(("1", old, "t", 9, first, datetime.fromtimestamp((START_US + first * 250_000) / 1e6, timezone.utc)))
    return spark.createDataFrame(out, TOPIC_RECORD)


def run(spark, source, paths, **kw):
    stream = topic.stream_topic_files(spark, source, files_per_trigger=1)
    ingest.start_ingest(stream, paths, NOW, **kw).awaitTermination()


def landed(spark, paths):
    return sorted(tuple(r) for r in tables.telemetry(spark, paths.table).select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def ingested(spark, tmp_path_factory):
    """Three runs with a restart between them; the second brings all records of the first again."""
    root = tmp_path_factory.mktemp("ingest")
    source, paths = str(root / "topic"), ingest.Paths(str(root / "out"))
    publish_files(records(spark, 0, 400).coalesce(1), source)
    run(spark, source, paths, spike_options={"k": 3.0, "min_n": 5})
    publish_files(records(spark, 0, 400).coalesce(1), source)
    run(spark, source, paths, spike_options={"k": 3.0, "min_n": 5})
    publish_files(records(spark, 400, 300, seed=2).coalesce(1), source)
    run(spark, source, paths, spike_options={"k": 3.0, "min_n": 5})
    everything = records(spark, 0, 400).unionByName(records(spark, 400, 300, seed=2))
    return paths, D.decode(everything).cache()


def test_no_loss_and_no_copies_over_restarts(spark, ingested):
    paths, decoded = ingested
    assert landed(spark, paths) == sorted(tuple(r) for r in D.accepted(decoded).select(*COLUMNS).collect())


def test_rejects_are_kept(spark, ingested):
    paths, decoded = ingested
    found = {(r.partition, r.offset, r.value) for r in spark.read.parquet(paths.rejects).collect()}
    assert found == {(r.partition, r.offset, r.value) for r in D.rejected(decoded).collect()} and found


def test_flush_counts(spark, ingested):
    paths, decoded = ingested
    total = spark.read.parquet(paths.flushes).agg(F.sum("accepted"), F.sum("rejected")).first()
    assert tuple(total) == (D.accepted(decoded).count(), D.rejected(decoded).count())


def test_alerts_equal_batch(spark, ingested):
    paths, decoded = ingested
    alerts = spark.read.parquet(paths.alerts)
    severe = {r.detail for r in alerts.where("reason = 'Severe voltage anomaly'").collect()}
    assert severe == {r.detail for r in D.voltage_alerts(D.severe_voltage(decoded)).collect()} and severe
    found = {(r.subject, r.alert_time) for r in alerts.where("reason = 'Voltage spike'").collect()}
    want = spikes(D.accepted(decoded), k=3.0, min_n=5)
    assert found == {(r.device_id, r.timestamp) for r in want.collect()} and found


def test_a_replayed_batch_changes_nothing(spark, ingested):
    paths, _ = ingested
    before = landed(spark, paths)
    ingest._write(paths, None)(records(spark, 0, 400), 0)
    assert landed(spark, paths) == before


def test_ingest_without_dedup(spark, tmp_path):
    source, paths = str(tmp_path / "topic"), ingest.Paths(str(tmp_path / "out"))
    publish_files(records(spark, 0, 100), source)
    run(spark, source, paths, dedup=False)
    want = D.accepted(D.decode(records(spark, 0, 100))).select(*COLUMNS)
    assert landed(spark, paths) == sorted(tuple(r) for r in want.collect())


def readings_file(spark, rows, path):
    data = [(us, d, v, 1.0, 2.0, 0.9, 0) for us, d, v in rows]
    frame = spark.createDataFrame(data, "us bigint, device_id string, voltage_v float, current_a float, power_kw float, power_factor float, security_flag int")
    frame.select(F.timestamp_micros(F.col("us") + START_US).alias("timestamp"), *COLUMNS[1:]).coalesce(1).write.mode("append").parquet(path)


def test_rollup_takes_late_rows_within_the_lateness_and_no_others(spark, tmp_path):
    source, changes, check = (str(tmp_path / n) for n in ("src", "changes", "check"))
    minute = 60_000_000

    def step(rows):
        readings_file(spark, rows, source)
        stream = spark.readStream.schema(TELEMETRY).parquet(source)
        aggregates.start_rollup(stream, changes, check, NOW).awaitTermination()

    step([(10 * minute, "a", 120.0), (12 * minute, "b", 121.0), (100 * minute, "a", 119.0)])
    step([(50 * minute, "a", 130.0), (10 * minute, "a", 999.0)])  # 50 min late, and 90 min late
    state = {(r.us // minute, r.device_id): r.max_voltage for r in aggregates.latest_changes(spark, changes)
             .withColumn("us", F.unix_micros("bucket") - START_US).collect()}
    assert state == {(10, "a"): 120.0, (10, "b"): 121.0, (100, "a"): 119.0, (50, "a"): 130.0}

    step([(51 * minute, "a", 110.0)])
    latest = aggregates.latest_changes(spark, changes)
    row = latest.where("device_id = 'a'").where(F.unix_micros("bucket") == START_US + 50 * minute).first()
    assert (row.avg_voltage, row.max_voltage, row.total_power_kw) == (120.0, 130.0, 4.0)
    assert aggregates.closed(latest, DAY + timedelta(minutes=100)).count() == 3

    view = str(tmp_path / "view")
    aggregates.fold(spark, changes, view, DAY + timedelta(minutes=40))
    assert M.view(spark, view).count() == 2


def test_rollup_stream_equals_batch(spark, tmp_path):
    source, changes, check = (str(tmp_path / n) for n in ("src", "changes", "check"))
    pick = random.Random(3)
    rows = [(pick.randrange(0, 1800) * 1_000_000, f"d{pick.randrange(4)}", float(pick.randrange(100))) for _ in range(900)]
    for part in range(3):
        readings_file(spark, rows[part::3], source)
    stream = spark.readStream.schema(TELEMETRY).option("maxFilesPerTrigger", 1).parquet(source)
    aggregates.start_rollup(stream, changes, check, NOW).awaitTermination()
    batch = device_rollup(spark.read.parquet(source))
    both = [sorted((str(r.bucket), r.device_id, round(r.avg_voltage, 6), r.max_voltage, round(r.total_power_kw, 4)) for r in f.collect())
            for f in (aggregates.latest_changes(spark, changes), batch)]
    assert both[0] == both[1] and spark.read.parquet(changes).select("batch").distinct().count() == 3
    # Folding the first two batches of the log keeps the state, and what comes later still wins.
    assert aggregates.compact_changes(spark, changes, 1) == 2
    assert {r.batch for r in spark.read.parquet(changes).select("batch").distinct().collect()} == {-2, 2}
    again = sorted((str(r.bucket), r.device_id, round(r.avg_voltage, 6), r.max_voltage, round(r.total_power_kw, 4))
                   for r in aggregates.latest_changes(spark, changes).collect())
    assert again == both[1]


def test_packet_stream_keeps_the_clock_between_batches(spark, tmp_path):
    source, flows, state, check = (str(tmp_path / n) for n in ("src", "flows", "state", "check"))
    pick = random.Random(8)
    times = sorted(pick.sample(range(0, 3_000_000_000, 40), 900))
    rows = [(1 + (i % 5 == 0), us, i, True, False, i % 7 != 0, "1.1.1.1", "2.2.2.2", None, None, 45322, 19092, 60 + i * 2, "S")
            for i, us in enumerate(times)]
    schema = ", ".join(f"{f.name} {'bigint' if f.name == 'ts' else f.dataType.simpleString()}" for f in PACKET.fields)

    def frame(part):
        return spark.createDataFrame(part, schema).withColumn("ts", F.timestamp_micros(F.col("ts") + START_US))

    for k in range(3):
        frame(rows[k * 300:(k + 1) * 300]).coalesce(1).write.mode("append").parquet(source)
        P.start_packet_analysis(tables.stream_packet_records(spark, source), flows, state, check, trigger=NOW).awaitTermination()
    found = spark.read.parquet(flows).drop("batch")
    want = N.analyze(frame(rows))
    assert found.count() == want.count() and found.exceptAll(want).count() == 0


def test_late_packet_does_not_turn_the_clock_back(spark, tmp_path):
    source, flows, state, check = (str(tmp_path / n) for n in ("src", "flows", "state", "check"))
    schema = ", ".join(f"{f.name} {'bigint' if f.name == 'ts' else f.dataType.simpleString()}" for f in PACKET.fields)
    for seq, us in enumerate([1_000_000, 400_000, 1_000_050]):
        row = (1, us, seq, True, False, True, "1.1.1.1", "2.2.2.2", None, None, 45322, 19092, 60, "S")
        spark.createDataFrame([row], schema).withColumn("ts", F.timestamp_micros(F.col("ts") + START_US)).write.mode("append").parquet(source)
        P.start_packet_analysis(tables.stream_packet_records(spark, source), flows, state, check, trigger=NOW).awaitTermination()
    found = {r.seq: (r.time_delta_seconds, r.alert_reason) for r in spark.read.parquet(flows).collect()}
    assert found == {0: (0.0, ""), 1: (-0.6, ""), 2: (5e-05, N.FLOOD)}


def test_a_batch_of_packets_makes_few_files(spark, tmp_path):
    source, flows, state, check, alerts = (str(tmp_path / n) for n in ("src", "flows", "state", "check", "alerts"))
    schema = ", ".join(f"{f.name} {'bigint' if f.name == 'ts' else f.dataType.simpleString()}" for f in PACKET.fields)
    rows = [(1 + i % 3, i * 50, i, True, False, True, "1.1.1.1", "2.2.2.2", None, None, 45322, 19092, 1000 + i, "S")
            for i in range(900)]
    packets = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_micros(F.col("ts") + START_US))
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for k in range(2):
            packets.where(F.floor(F.col("seq") / 450) == k).coalesce(1).write.mode("append").parquet(source)
            P.start_packet_analysis(
                tables.stream_packet_records(spark, source), flows, state, check, alerts, trigger=NOW
            ).awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    for table, want in ((flows, N.analyze(packets)), (alerts, N.network_alerts(N.analyze(packets)))):
        found = spark.read.parquet(table).drop("batch")
        assert found.count() == want.count() > 0 and found.exceptAll(want).count() == 0
        assert all(len(list((tmp_path / table).glob(f"batch={k}/part-*"))) < 10 for k in range(2))


def test_late_partitions_land_and_the_ledger_adds_up(spark, tmp_path):
    source, paths = str(tmp_path / "topic"), ingest.Paths(str(tmp_path / "out"))
    ahead = records(spark, 0, 60).withColumn("timestamp", F.col("timestamp") + F.expr("interval 5 hours"))
    behind = records(spark, 0, 60, seed=3).withColumn("topic", F.lit("slow"))
    for part in (ahead, behind, ahead):
        publish_files(part.coalesce(1), source)
        run(spark, source, paths)
    rejects = spark.read.parquet(paths.rejects).count()
    ledger = spark.read.parquet(paths.flushes).agg(F.sum("accepted"), F.sum("rejected")).first()
    assert len(landed(spark, paths)) + rejects == 120
    assert tuple(ledger) == (len(landed(spark, paths)), rejects)


def test_packet_batch_without_relevant_rows(spark, tmp_path):
    source = str(tmp_path / "packets")
    other = spark.createDataFrame([], PACKET)
    other.coalesce(1).write.parquet(source)
    folders = [str(tmp_path / n) for n in ("flows", "state", "checkpoint")]
    for _ in range(2):
        P.start_packet_analysis(tables.stream_packet_records(spark, source), *folders, trigger=NOW).awaitTermination()
        other.coalesce(1).write.mode("append").parquet(source)


@pytest.mark.parametrize("device", ['{"x": 1}', '["q"]', "true", "7"])
def test_device_id_is_a_text(spark, device):
    value = json.dumps({"timestamp": START_US / 1e6, "device_id": 0, "metrics": {
        "voltage_v": 120.0, "current_a": 1.0, "power_kw": 0.1, "power_factor": 0.9}, "security_flag": 0})
    value = value.replace('"device_id": 0', f'"device_id": {device}')
    row = spark.createDataFrame([("k", value, "t", 0, 0, DAY)], TOPIC_RECORD)
    assert D.decode(row).first()["reject_reason"] == "type"
