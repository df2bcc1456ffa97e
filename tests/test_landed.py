"""The index of landed offsets: what it finds, what it reads, and ingest on top of it."""

import random

from pyspark.sql import functions as F

from meterflow.schemas import TOPIC_RECORD
from meterflow.sinks.topic import publish_files
from meterflow.sources import topic
from meterflow.streaming import ingest, landed
from test_streaming import DAY, NOW, records
from test_streaming import landed as landed_rows


def offsets(spark, rows):
    return spark.createDataFrame([("k", "v", t, p, o, DAY) for t, p, o in rows], TOPIC_RECORD)


def load(spark, path, rows, batch):
    """One batch of the index: the keys that it finds landed already."""
    keys = landed.keys_of(offsets(spark, rows)).persist()
    slots = landed.slots_of(keys)
    known = landed.landed(spark, path, slots, batch)
    found = set() if known is None else {tuple(r) for r in landed.known_keys(keys, known).collect()}
    landed.write_landed(spark, path, landed.intervals(keys), known, batch)
    landed.drop_old(spark, path, slots, batch)
    keys.unpersist()
    return found


def test_index_equals_a_set_of_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "BLOCK", 8)
    monkeypatch.setattr(landed, "SLOT_BLOCKS", 4)
    path, pick, seen = str(tmp_path / "seen"), random.Random(5), set()
    for batch in range(6):
        rows = [(pick.choice(["a", "b/=c"]), pick.randrange(2), pick.randrange(120)) for _ in range(70)]
        rows += [("a", 0, o) for o in range(batch * 20, batch * 20 + 20)]
        assert load(spark, path, rows, batch) == seen & set(rows)
        seen |= set(rows)


def test_a_batch_reads_the_slots_of_its_own_offsets(spark, tmp_path):
    path, far = str(tmp_path / "seen"), landed.BLOCK * landed.SLOT_BLOCKS
    for batch in range(10):
        load(spark, path, [("t", 0, batch * far + o) for o in range(50)] + [("t", 1, o) for o in range(batch * 50, batch * 50 + 50)], batch)
    # The partition that lags behind has all its offsets in one slot, the other ten in ten.
    assert len(landed.folders(spark, path, ["74_0_3", "74_1_0"], 10)) == 2
    read = landed.landed(spark, path, ["74_1_0"], 10)
    assert len(read.inputFiles()) == 1 and [(r.first, r.last) for r in read.collect()] == [(0, 499)]
    assert landed.landed(spark, path, ["74_5_0"], 10) is None
    # A replay of the last batch starts from the version before it.
    assert [(r.first, r.last) for r in landed.landed(spark, path, ["74_1_0"], 9).collect()] == [(0, 449)]


def test_copies_within_a_batch_and_records_without_a_key(spark, tmp_path):
    source, paths = str(tmp_path / "topic"), ingest.Paths(str(tmp_path / "out"))
    good = records(spark, 0, 8)
    third = good.where("offset = 1").withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("again")
    nameless = good.where("offset = 2 AND partition = 0").withColumn("offset", F.lit(None).cast("long"))
    publish_files(good.unionByName(third).unionByName(nameless).unionByName(nameless).coalesce(1), source)
    for _ in range(2):
        ingest.start_ingest(topic.stream_topic_files(spark, source), paths, NOW).awaitTermination()
    assert len(landed_rows(spark, paths)) == 8 + 2


def test_dedup_can_be_turned_on_later(spark, tmp_path):
    source, paths = str(tmp_path / "topic"), ingest.Paths(str(tmp_path / "out"))
    for number, dedup in enumerate((False, True, True)):
        publish_files(records(spark, 0 if number == 0 else 60, 20).coalesce(1), source)
        ingest.start_ingest(topic.stream_topic_files(spark, source), paths, NOW, dedup=dedup).awaitTermination()
    ledger = spark.read.parquet(paths.flushes).orderBy("batch").collect()
    assert [r.accepted + r.rejected for r in ledger] == [20, 21, 0]
