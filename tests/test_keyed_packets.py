"""Packet clocks in the state store against the table form: five batches with late packets and restarts."""

import random

import pytest
from pyspark.sql import functions as F

from meterflow.schemas import PACKET
from meterflow.sources import tables
from meterflow.streaming import packets as P
from meterflow.streaming.aggregates import start_side_table
from test_streaming import NOW, START_US



@pytest.fixture(autouse=True)
def end_without_data(spark):
    """Clocks of the machine would keep a run over all available data going for ever, batch after empty batch."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


SCHEMA = ", ".join(f"{f.name} {'bigint' if f.name == 'ts' else f.dataType.simpleString()}" for f in PACKET.fields)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_micros(F.col("ts") + START_US))


def packet(capture, us, seq, tcp=True, v4=True):
    return (capture, us, seq, v4, not v4, tcp, "1.1.1.1" if v4 else None, "2.2.2.2" if v4 else None, None if v4 else "fd00::1",
            None if v4 else "fd00::2", 45322, 19092, 60 + seq * 3, None if seq % 3 else "S")


def test_both_forms_give_the_same_flows(spark, tmp_path):
    source, keyed, check, *folders = (str(tmp_path / n) for n in ("src", "keyed", "check", "flows", "state", "check2"))
    pick, seq = random.Random(6), 0
    for batch in range(5):
        rows = []
        for _ in range(120):
            late = pick.random() < 0.15
            us = pick.randrange(0, batch * 1_000_000 + 1) if late else batch * 1_000_000 + pick.randrange(1_000_000)
            rows.append(packet(pick.randrange(4), us - us % 40, seq, pick.random() < 0.9, pick.random() < 0.8))
            seq += 1
        if batch == 2:
            rows = [r for r in rows if r[0] != 3]  # a capture that pauses
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        start_side_table(P.keyed_flows(tables.stream_packet_records(spark, source)), keyed, check, trigger=NOW).awaitTermination()
        P.start_packet_analysis(tables.stream_packet_records(spark, source), *folders, trigger=NOW).awaitTermination()
    one, other = spark.read.parquet(keyed).drop("batch"), spark.read.parquet(folders[0]).drop("batch")
    other = other.select(*one.columns)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty() and one.count() > 450
