"""Telemetry topic: the broker source, its replayable file twin and a bounded sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterflow.schemas import TOPIC_RECORD

TOPIC_COLUMNS = TOPIC_RECORD.fieldNames()


def source_options(
    servers: str,
    topic: str,
    max_per_trigger: int = 1_000_000,
    min_per_trigger: int | None = None,
    max_delay: str = "1s",
    group: str | None = None,
) -> dict[str, str]:
    """Reader options. Offsets live in the checkpoint, so a group is only named where access control asks for it.

    ``min_per_trigger`` with ``max_delay`` waits for a worthwhile batch, as a minimum fetch size would.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(max_per_trigger),
        "kafka.fetch.min.bytes": "65536",
        "kafka.fetch.max.wait.ms": "50",
    }
    if min_per_trigger is not None:
        options |= {"minOffsetsPerTrigger": str(min_per_trigger), "maxTriggerDelay": max_delay}
    if group is not None:
        options["kafka.group.id"] = group
    return options


def sample_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream. Needs the Kafka connector of the Spark distribution on the class path."""
    return spark.readStream.format("kafka").options(**options).load().select(*TOPIC_COLUMNS)


def sample_topic(spark: SparkSession, options: dict[str, str], n: int = 5) -> DataFrame:
    return spark.read.format("kafka").options(**options).load().select(*TOPIC_COLUMNS).limit(n)


def read_topic_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(TOPIC_RECORD).format(fmt).load(path)


def stream_topic_files(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    """The same columns from files, so all that follows is shared with the broker."""
    return (
        spark.readStream.schema(TOPIC_RECORD).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(path)
    )
