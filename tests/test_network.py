"""Packets: guards, gaps and the order of the rules."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators import network as N
from meterflow.operators.windows import gap_to_previous, positions
from meterflow.schemas import PACKET

BASE_US = 1_704_067_200_000_000


def packet(us, seq, size=64, flags="S", capture=1, v4=True, v6=False, tcp=True, src=45322, dst=19092):
    return (capture, us, seq, v4, v6, tcp, "192.168.1.50" if v4 else None, "192.168.1.100" if v4 else None,
            "fd00::50" if v6 else None, "fd00::100" if v6 else None, src, dst, size, flags)


def frame(spark, rows):
    schema = ", ".join(f"{f.name} {'bigint' if f.name == 'ts' else f.dataType.simpleString()}" for f in PACKET.fields)
    return spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_micros(F.col("ts") + BASE_US))


def flows(spark, rows, **kw):
    return {r.seq: r for r in N.analyze(frame(spark, rows), **kw).collect()}


def test_other_protocols_do_not_show_or_move_the_clock(spark):
    found = flows(spark, [packet(0, 1), packet(500_000, 2, tcp=False), packet(700_000, 3, v4=False), packet(1_000_000, 4)])
    assert set(found) == {1, 4}
    assert found[4].time_delta_seconds == 1.0


def test_first_packet(spark):
    row = flows(spark, [packet(0, 1, 500, "A")])[1]
    assert (row.time_delta_seconds, row.is_anomaly, row.tcp_flags, row.src_ip) == (0.0, False, "A", "192.168.1.50")


def test_rules(spark):
    rows = [
        packet(0, 1, 1600), packet(1_000_000, 2, 1500), packet(2_000_000, 3), packet(2_000_050, 4),
        packet(2_000_050, 5), packet(2_000_150, 6), packet(2_000_200, 7, 1600),
    ]
    found = flows(spark, rows)
    assert {s: r.alert_reason for s, r in found.items()} == {
        1: N.OVERSIZED, 2: "", 3: "", 4: N.FLOOD, 5: "", 6: "", 7: N.OVERSIZED,
    }
    assert found[5].time_delta_seconds == 0.0
    assert found[6].time_delta_seconds == 0.0001


def test_addresses_flags_and_ports(spark):
    found = flows(spark, [packet(0, 1, v4=False, v6=True, flags=""), packet(1, 2, src=1, dst=2), packet(2, 3, src=19092, dst=1, flags=None)])
    assert set(found) == {1, 3}
    assert found[1].src_ip == "fd00::50" and found[1].tcp_flags == "None" and found[3].tcp_flags == "None"


def test_captures_have_their_own_clocks(spark):
    rows = [packet(0, 1), packet(50, 2, capture=2), packet(2_000_000, 3)]
    assert flows(spark, rows)[2].alert_reason == ""
    assert flows(spark, rows, per_capture=False)[2].alert_reason == N.FLOOD


def test_texts(spark):
    rows = N.flow_lines(N.analyze(frame(spark, [packet(0, 1, 1600), packet(1_000_000, 2, 184, "PA"), packet(1_000_452, 3, 184, "PA")]))).collect()
    lines = {r.seq: r.line for r in rows}
    assert lines[1] == "[NETWORK ALERT] Oversized Payload Detected | From 192.168.1.50:45322 | Size: 1600B | Delta: 0.0s"
    assert lines[3] == "[NetFlow Log] Ingested 184B packet | Flags: PA | Latency Delta: 0.000452s"


@pytest.mark.parametrize("keys", [["capture_id"], []])
def test_gaps_equal_a_plain_lag_on_crowded_data(spark, keys):
    """A third of the packets are of one capture, a third share one instant; gaps reach over empty cells."""
    pick = random.Random(7)
    rows = []
    for seq in range(6000):
        us = 40_000_000 if seq % 3 == 0 else pick.randrange(0, 300_000_000)
        if seq % 11 == 0:
            us += 3_600_000_000
        rows.append(packet(us, seq, capture=1 if seq % 3 else pick.randrange(2, 6)))
    data = frame(spark, rows)
    ours = gap_to_previous(data, keys, "ts", "seq").select("seq", F.round("gap_sec", 6).alias("gap"))
    w = Window.partitionBy(*keys).orderBy("ts", "seq")
    us = F.unix_micros("ts")
    plain = data.select("seq", F.round(F.coalesce((us - F.lag(us).over(w)) / 1e6, F.lit(0.0)), 6).alias("gap"))
    assert ours.exceptAll(plain).count() == 0 and ours.count() == plain.count()


def test_positions_number_every_key_densely(spark):
    pick = random.Random(3)
    rows = [(1 if i % 3 else pick.randrange(9), 5 if i % 4 == 0 else pick.randrange(1000), i) for i in range(5000)]
    data = spark.createDataFrame(rows, "k int, t int, i int")
    w = Window.partitionBy("k").orderBy("t", "i")
    want = data.withColumn("position", F.row_number().over(w).cast("long"))
    assert positions(data, ["k"], ["t", "i"]).select("k", "t", "i", "position").exceptAll(want).count() == 0


def test_batches(spark):
    data = frame(spark, [packet(i * 1000, i) for i in range(250)])
    assert N.first_batch(data).count() == 100
    counts = {r.batch: r["count"] for r in N.batch_numbers(data).groupBy("batch").count().collect()}
    assert counts == {0: 100, 1: 100, 2: 50}


def test_port_and_protocol_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "packets")
    frame(spark, [packet(0, 1)]).write.parquet(path)
    scan = N.relevant(spark.read.schema(PACKET).parquet(path)).select("seq")
    plan = scan._sc._jvm.PythonSQLUtils.explainString(scan._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "Or(EqualTo(src_port,19092),EqualTo(dst_port,19092))" in pushed and "EqualTo(has_tcp,true)" in pushed
    read = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "ip4_src" not in read and "tcp_flags" not in read
