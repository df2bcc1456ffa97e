"""The given tables reshaped into readings, packets, topic records and log lines.

``events`` holds no meters: its value drives the voltage, and its 30 days are squeezed into 1,000 seconds so that
ten devices report densely. All adapters are projections of one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.scalars import device_name, flag_to_int
from meterflow.operators.decode import to_messages
from meterflow.schemas import TELEMETRY
from meterflow.session import pin_utc

# 2024-01-01 in epoch microseconds, and 30 days over 1,000 seconds.
START_US = 1_704_067_200_000_000
SQUEEZE = 2592
DEVICES = 10
CORRUPT_EVERY = 97
DUPLICATE_EVERY = 50
BROKEN_KINDS = 10
TOPIC = "telemetry"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def readings_of(source: DataFrame, *keep: Column) -> DataFrame:
    """Events as flat readings with wire types (8-byte numbers); ``keep`` adds columns of the event."""
    value = F.col("value")
    volts = F.lit(110.0) + value / F.lit(10.0)
    # The one number of a flat object: a pattern finds it several times faster than the JSON functions.
    amps = F.regexp_extract("props", r'"k"\s*:\s*(-?[\d.]+)', 1).try_cast("double") / F.lit(10.0)
    factor = F.lit(0.88) + (F.col("event_id") % 8) / F.lit(100.0)
    since = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(START_US)
    return source.select(
        "event_id",
        device_name(F.col("user_id") % DEVICES).alias("device_id"),
        F.timestamp_micros(F.lit(START_US) + F.floor(since / F.lit(SQUEEZE)).cast("long")).alias("timestamp"),
        volts.alias("voltage_v"),
        amps.alias("current_a"),
        factor.alias("power_factor"),
        (volts * amps * factor / F.lit(1000.0)).alias("power_kw"),
        flag_to_int((value > 240) & (F.col("event_type") != "view")).alias("security_flag"),
        "event_type",
        "value",
        "user_id",
        *keep,
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(events(spark, sf_dir))


def stored(flat: DataFrame, *keep: str) -> DataFrame:
    """Readings in the types of the telemetry table."""
    return flat.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TELEMETRY.fields], *keep)


def packets_of(flat: DataFrame) -> DataFrame:
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    v4 = event % 5 != 0
    return flat.select(
        (user % 4).cast("int").alias("capture_id"),
        F.col("timestamp").alias("ts"),
        event.alias("seq"),
        v4.alias("has_ipv4"),
        (~v4).alias("has_ipv6"),
        (F.col("event_type") != "view").alias("has_tcp"),
        F.when(v4, F.concat(F.lit("10.0.0."), user.cast("string"))).alias("ip4_src"),
        F.when(v4, F.lit("10.0.1.1")).alias("ip4_dst"),
        F.when(~v4, F.concat(F.lit("fd00::"), user.cast("string"))).alias("ip6_src"),
        F.when(~v4, F.lit("fd00::1")).alias("ip6_dst"),
        F.when(event % 2 == 0, 19092).otherwise(45322).cast("int").alias("src_port"),
        F.when(event % 7 == 0, 443).when(event % 2 == 0, 45322).otherwise(19092).cast("int").alias("dst_port"),
        (F.floor(value * 5).cast("int") + 40).alias("packet_size_bytes"),
        F.when(F.col("event_type") == "signup", "S").when(F.col("event_type") == "error", "").otherwise("PA")
        .alias("tcp_flags"),
    )


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_of(readings(spark, sf_dir))


def _set(json: Column, name: str, text: str) -> Column:
    return F.regexp_replace(json, rf'"{name}":[^,}}]+', f'"{name}":{text}')


def _broken(value: Column, case: Column) -> Column:
    variants = [
        F.lit("not json"),
        F.lit(None).cast("string"),
        F.concat(value, F.lit(" xyz")),
        F.lit('{"device_id": "y"}'),
        _set(value, "voltage_v", '"abc"'),
        _set(_set(value, "voltage_v", "145.2"), "timestamp", '"x"'),
        _set(value, "current_a", "null"),
        _set(value, "device_id", '"' + "d" * 51 + '"'),
        _set(value, "security_flag", "true"),
        _set(value, "voltage_v", "NaN"),
    ]
    text = value
    for number, variant in enumerate(variants):
        text = F.when(case == number, variant).otherwise(text)
    return text


def messages_of(flat: DataFrame) -> DataFrame:
    """Readings as topic records: every 97th broken in one of ten ways, every 50th delivered twice."""
    event = F.col("event_id")
    whole = to_messages(
        flat.withColumn("_event", event),
        F.col("user_id") % DEVICES,
        F.lit(TOPIC).alias("topic"),
        (F.col("_event") % 4).cast("int").alias("partition"),
        F.floor(F.col("_event") / 4).cast("long").alias("offset"),
        F.timestamp_micros(F.unix_micros("timestamp") + (F.col("_event") % 8) * 1_000_000).alias("timestamp"),
        "_event",
    )
    case = F.floor(F.col("_event") / CORRUPT_EVERY) % BROKEN_KINDS
    # In a lambda, so that the rare cases stay out of the compiled loop.
    broken = F.transform(F.array("value"), lambda value: _broken(value, case))[0]
    text = F.when(F.col("_event") % CORRUPT_EVERY == 0, broken).otherwise(F.col("value"))
    copies = F.when(F.col("_event") % DUPLICATE_EVERY == 0, 2).otherwise(1)
    return whole.withColumn("value", text).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop(
        "_copy", "_event"
    ).select("key", "value", "topic", "partition", "offset", "timestamp")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(readings(spark, sf_dir))


def log_lines_of(flat: DataFrame) -> DataFrame:
    """Readings as JSON log lines of the message kinds the log knows."""
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    kind = event % 9
    message = (
        F.when(kind == 0, F.format_string("[%s] Telemetry payload produced successfully.", F.col("device_id")))
        .when(kind == 1, F.format_string(
            "[%s] Cyber-anomaly injected! V=%.2fV, A=%.2fA", F.col("device_id"), value, F.col("current_a")))
        .when(kind == 2, F.format_string(
            "Dispatcher #%d Throughput Status: Sent %d records (~%.2f msg/sec)", user % 4, event, value))
        .when(kind == 3, F.format_string(
            "Severe voltage anomaly detected on node: %s (%.2fV)", F.col("device_id"), value))
        .when(kind == 4, F.format_string(
            "[NetFlow Log] Ingested %dB packet | Flags: %s | Latency Delta: 0.000452s", event, F.lit("PA")))
        .when(kind == 5, F.format_string("Queue full! Dropping reading for meter %d", user))
        .when(kind == 6, F.format_string(
            "Worker %d processing loop delayed: took %.2fms (Limit: 100.00ms)", user % 100, value + F.lit(100.0)))
        .when(kind == 7, F.format_string("Successfully flushed batch of %d records to storage.", event % 50))
        .otherwise(F.format_string("Successfully captured and parsed a batch of %d packets.", F.lit(100)))
    )
    level = (
        F.when(F.col("event_type") == "view", "DEBUG").when(F.col("event_type") == "click", "INFO")
        .when(F.col("event_type") == "signup", "WARNING").when(F.col("event_type") == "error", "ERROR")
        .otherwise("CRITICAL")
    )
    logger = F.when(event % 2 == 0, "grid.consumer").otherwise("grid.simulation")
    row = F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        level.alias("level"),
        logger.alias("logger"),
        F.lit("main").alias("module"),
        F.lit("run").alias("function"),
        (event % 300).cast("int").alias("line"),
        F.lit("MainThread").alias("thread_name"),
        message.alias("message"),
        F.when(level.isin("ERROR", "CRITICAL"), "Traceback: sample").alias("exception"),
        user.alias("user_id"),
    )
    return flat.select(F.to_json(row).alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_lines_of(readings(spark, sf_dir))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A device dimension: device number to nation and region."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        device_name(F.col("n_nationkey")).alias("device_id"), F.col("n_name").alias("site"),
        F.col("r_name").alias("area"),
    )


