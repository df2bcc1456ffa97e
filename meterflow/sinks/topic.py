"""Publishing to the topic and its file twin."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sink_options(servers: str, topic: str) -> dict[str, str]:
    # Compression, acknowledgements, linger, batch size and request cap.
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.compression.type": "zstd",
        "kafka.acks": "1",
        "kafka.linger.ms": "10",
        "kafka.batch.size": "262144",
        "kafka.max.request.size": "5242880",
    }


def publish(messages: DataFrame, options: dict[str, str]) -> None:
    """Write keyed messages. Needs the Kafka connector of the Spark distribution on the class path."""
    messages.select("key", "value").write.format("kafka").options(**options).save()


def publish_stream(messages: DataFrame, options: dict[str, str], checkpoint: str):
    return (
        messages.select("key", "value").writeStream.format("kafka").options(**options)
        .option("checkpointLocation", checkpoint).start()
    )


#: Bytes of a row group of the topic's files. A task reads whole row groups, and a batch may be a single file: its records are
#: decoded by as many tasks as it has row groups.
ROW_GROUP_BYTES = 4 << 20


def publish_files(records: DataFrame, path: str) -> None:
    """Topic records as zstd Parquet, readable by ``stream_topic_files``; a file of any size splits over many tasks."""
    (
        records.write.mode("append").option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES)
        .parquet(path)
    )
