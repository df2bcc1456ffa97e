"""Files of the topic: what a batch of few files splits into."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from meterflow.files import Files
from meterflow.plans import catalog
from meterflow.sinks.topic import publish_files


def test_a_file_of_the_topic_splits_over_many_tasks(spark, tmp_path):
    path = str(tmp_path / "topic")
    text = F.concat_ws("", *[F.sha2(F.concat("id", F.lit(f":{n}")).cast("binary"), 256) for n in range(4)])
    publish_files(spark.range(100_000).select(text.alias("value")).coalesce(1), path)
    files = Files(spark, path).glob(f"{path}/part-*")
    assert len(files) == 1
    assert pq.ParquetFile(files[0].removeprefix("file:")).num_row_groups >= 4


def test_events_of_a_stream_come_in_files_that_split(spark, tmp_path, monkeypatch):
    tables, ran = tmp_path / "tables", []
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f":{n}")).cast("binary"), 512) for n in range(3)])
    events = spark.range(200_000).select(
        F.col("id").alias("event_id"), F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 1000).alias("ts"),
        text.alias("props"),
    )
    events.coalesce(1).write.parquet(f"{tables}/events.parquet")

    class Ran:
        def awaitTermination(self):
            pass

    def start(stream):
        ran.append(stream)
        return Ran()

    folder = str(tmp_path / "stream")
    monkeypatch.setattr(catalog, "scratch_path", lambda session, name: folder)
    catalog._in_parts(spark, str(tables), start, late=False)
    files = [f.removeprefix("file:") for f in Files(spark, folder).glob(f"{folder}/part-*")]
    assert len(ran) == 4 and sum(pq.ParquetFile(f).metadata.num_rows for f in files) == 200_000
    assert max(pq.ParquetFile(f).num_row_groups for f in files) >= 2
