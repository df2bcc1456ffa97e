"""The registered queries: each takes a session and a folder of tables and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterflow.files import Files
from meterflow.functions import quality as Q
from meterflow.functions import scalars as X
from meterflow.operators import correlate, decode, network, oplog, rollup, windows
from meterflow.schemas import LOG_EVENT, METRICS
from meterflow.session import scratch_path
from meterflow.sinks import rollup as materialized
from meterflow.sinks import table as telemetry_sink
from meterflow.sinks.topic import publish_files
from meterflow.sources import adapters, tables, topic
from meterflow.streaming import aggregates, closing, correlation, ingest, partials
from meterflow.streaming import packets as packet_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = datetime(2024, 1, 1, 0, 16, tzinfo=timezone.utc)
AVAILABLE_NOW = {"availableNow": True}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def plain(frame: DataFrame, *means: str, **digits: int) -> DataFrame:
    """Times as text, 4-byte floats as 8-byte ones, and the named columns rounded.

    The mean of 16 readings with 3 decimals lies halfway between two roundings to 6: ``means`` are nudged upwards by
    far less than the last digit, so that the noise of summing does not decide.
    """
    columns = []
    for field in frame.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if isinstance(field.dataType, T.FloatType):
            column = column.cast("double")
        if field.name in means:
            column = F.round(column + F.lit(3.3e-9), 6)
        if field.name in digits:
            column = F.round(column, digits[field.name])
        columns.append(column.alias(field.name))
    return frame.select(*columns)


ROLLUP_DIGITS = {"avg_voltage": 6, "avg_current": 6, "avg_power_factor": 6, "total_power_kw": 6}


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.stored(adapters.readings(spark, sf_dir))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = decode.keep_first(adapters.messages(spark, sf_dir), ingest.RECORD_KEY, ["timestamp"])
    return decode.decode(records)


def _flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.analyze(adapters.packets(spark, sf_dir))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlate.union_alerts(
        decode.voltage_alerts(adapters.readings(spark, sf_dir)), network.network_alerts(_flows(spark, sf_dir))
    )


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oplog.parse_log(adapters.log_lines(spark, sf_dir))


def _table(spark: SparkSession, sf_dir: str, batches: int = 1) -> str:
    """All readings written to a fresh telemetry table."""
    path = scratch_path(spark, "telemetry")
    rows = adapters.stored(adapters.readings(spark, sf_dir), "event_id")
    for number in range(batches):
        telemetry_sink.write_batch(rows.where(F.col("event_id") % batches == number), path, number)
    return path


# --- rollups ---------------------------------------------------------------------------------------------------


@registered
def rollup_5min(spark, sf_dir):
    return plain(rollup.device_rollup(_stored(spark, sf_dir)), **ROLLUP_DIGITS)


@registered
def rollup_7min(spark, sf_dir):
    """A width that does not divide a day."""
    return plain(rollup.device_rollup(_stored(spark, sf_dir), "7 minutes"), **ROLLUP_DIGITS)


@registered
def rollup_refresh(spark, sf_dir):
    return plain(materialized.refreshed(_stored(spark, sf_dir), AS_OF), **ROLLUP_DIGITS)


@registered
def rollup_view(spark, sf_dir):
    """Table, refresh job and the view over what it wrote."""
    path, view = _table(spark, sf_dir), scratch_path(spark, "rollup")
    materialized.refresh(spark, path, view, AS_OF)
    return plain(materialized.view(spark, view), **ROLLUP_DIGITS)


@registered
def rollup_realtime(spark, sf_dir):
    path, view = _table(spark, sf_dir), scratch_path(spark, "rollup")
    materialized.refresh(spark, path, view, AS_OF)
    return plain(materialized.realtime_view(spark, path, view), **ROLLUP_DIGITS)


@registered
def shard_rollup(spark, sf_dir):
    readings = adapters.readings(spark, sf_dir)
    return plain(rollup.shard_rollup(readings, X.device_shard(F.col("user_id"))), "avg_voltage", total_power_kw=6)


@registered
def block_avg_100ms(spark, sf_dir):
    return plain(rollup.block_average(adapters.readings(spark, sf_dir)), "avg_voltage", "avg_current")


@registered
def throughput_5s(spark, sf_dir):
    return plain(rollup.throughput(adapters.messages(spark, sf_dir)))


@registered
def energy_kwh(spark, sf_dir):
    return plain(rollup.energy_by_gap(adapters.readings(spark, sf_dir), "event_id"), energy_kwh=9)


@registered
def energy_fixed(spark, sf_dir):
    return plain(rollup.energy_fixed_cadence(adapters.readings(spark, sf_dir)), energy_kwh=9)


# --- decode, quality, alerts -----------------------------------------------------------------------------------


@registered
def message_fields(spark, sf_dir):
    """Readings nested into keyed JSON messages, read back field by field."""
    messages = decode.to_messages(
        adapters.readings(spark, sf_dir), F.col("user_id") % adapters.DEVICES, "event_id"
    )

    def at(path: str):
        return F.get_json_object("value", path)

    return messages.select(
        "event_id", "key", at("$.timestamp").cast("double").alias("epoch_sec"), at("$.device_id").alias("device_id"),
        *[at(f"$.metrics.{m}").cast("double").alias(m) for m in METRICS],
        at("$.security_flag").cast("int").alias("security_flag"),
    )


@registered
def decode_telemetry(spark, sf_dir):
    rows = decode.accepted(_decoded(spark, sf_dir), "key", "partition", "offset")
    matches = decode.key_matches_device(F.col("key"), F.col("device_id"))
    numbers = plain(rows.withColumn("key_matches", matches))
    return numbers.withColumn("voltage_v", F.nanvl("voltage_v", F.lit(None).cast("double")))


@registered
def quarantine(spark, sf_dir):
    return plain(decode.rejected(_decoded(spark, sf_dir)).select("partition", "offset", "record_time", "reject_reason"))


@registered
def decoded_alerts(spark, sf_dir):
    """Alerts come before typing: some of these records are rejected."""
    return decode.severe_voltage(_decoded(spark, sf_dir)).select(
        "partition", "offset", "device_id", "voltage_v", F.col("reject_reason").isNotNull().alias("is_rejected")
    )


@registered
def quality_states(spark, sf_dir):
    state = Q.quality_state(F.col("reject_reason"), F.col("timestamp"), F.col("record_time"), 5.0)
    return _decoded(spark, sf_dir).select("partition", "offset", state.alias("quality"))


@registered
def dedup(spark, sf_dir):
    records = decode.keep_first(adapters.messages(spark, sf_dir), ingest.RECORD_KEY, ["timestamp"])
    return plain(records.select("topic", "partition", "offset", "key", "timestamp"))


@registered
def topic_sample(spark, sf_dir):
    """A bounded look at the topic."""
    rows = tables.head(adapters.messages(spark, sf_dir), ["partition", "offset"], 5)
    return plain(rows.select("key", "topic", "partition", "offset", "timestamp"))


@registered
def telemetry_head(spark, sf_dir):
    rows = adapters.readings(spark, sf_dir).select("event_id", "timestamp", "device_id", *METRICS, "security_flag")
    return plain(tables.head(rows, ["event_id"], 10))


@registered
def voltage_alerts(spark, sf_dir):
    return plain(decode.voltage_alerts(adapters.readings(spark, sf_dir)))


@registered
def alert_union(spark, sf_dir):
    return plain(_alerts(spark, sf_dir))


@registered
def alert_counts(spark, sf_dir):
    return plain(rollup.alert_counts(_alerts(spark, sf_dir)))


@registered
def alert_subjects(spark, sf_dir):
    return plain(rollup.alert_counts_by_subject(_alerts(spark, sf_dir)))


@registered
def alert_quality(spark, sf_dir):
    return rollup.detector_quality(adapters.readings(spark, sf_dir))


@registered
def voltage_band(spark, sf_dir):
    return adapters.readings(spark, sf_dir).select(
        "event_id", Q.voltage_band(F.col("voltage_v")).alias("band"),
        Q.valid_power_factor(F.col("power_factor")).alias("power_factor_valid"),
    )


# --- scalar functions ------------------------------------------------------------------------------------------


@registered
def device_names(spark, sf_dir):
    name = X.device_name(F.col("user_id") * 1009)
    return adapters.events(spark, sf_dir).select(
        "event_id", name.alias("device_id"), X.device_number(name).alias("device_number"),
        X.device_shard(F.col("user_id") * 7).alias("shard"),
    )


@registered
def power_math(spark, sf_dir):
    v, i, pf, kw = (F.col(c) for c in ["voltage_v", "current_a", "power_factor", "power_kw"])
    kva = X.apparent_power_kva(v, i)
    return plain(
        adapters.readings(spark, sf_dir).select(
            "event_id", X.active_power_kw(v, i, pf).alias("active_kw"), kva.alias("apparent_kva"),
            X.power_factor_of(kw, kva).alias("power_factor"), X.phase_angle_deg(pf).alias("phase_deg"),
            X.power_is_consistent(kw + (F.col("event_id") % 3) * F.lit(0.001), v, i, pf).alias("is_consistent"),
        ),
        power_factor=9, phase_deg=9,
    )


@registered
def presented(spark, sf_dir):
    r = adapters.readings(spark, sf_dir)
    return r.select(
        "event_id", *[X.present(F.col(c), "metric").alias(c) for c in ["voltage_v", "current_a", "power_factor"]],
        X.present(F.col("power_kw"), "kw").alias("power_kw"),
    )


@registered
def baseline_residual(spark, sf_dir):
    """Distance from the expected load of the hour, on the clock of the original events and at unit scale."""
    hour = X.local_hour(F.col("clock"))
    amps = X.expected_current(hour, F.lit(1.0))
    volts = X.expected_voltage(amps)
    flat = adapters.readings_of(adapters.events(spark, sf_dir), F.col("ts").cast("timestamp").alias("clock"))
    return plain(
        flat.select(
            "event_id", hour.alias("hour"), X.load_factor(hour).alias("load_factor"), amps.alias("expected_a"),
            volts.alias("expected_v"), X.voltage_residual(F.col("voltage_v"), volts).alias("voltage_residual"),
            X.current_residual(F.col("current_a"), amps).alias("current_residual"),
        ),
        hour=9, load_factor=9, expected_a=9, expected_v=9, voltage_residual=6, current_residual=6,
    )


@registered
def baseline_outliers(spark, sf_dir):
    """Readings that no meter of the modelled fleet would show at that hour (of the squeezed clock)."""
    outside = X.is_outside_baseline(F.col("voltage_v"), F.col("current_a"), X.local_hour(F.col("timestamp")))
    return plain(adapters.readings(spark, sf_dir).where(outside).select("event_id", "device_id", "voltage_v", "current_a"))


@registered
def surge_signature(spark, sf_dir):
    """Stored (4-byte) readings that look like a surge which tripped the load. Errors have their current cut off and
    their power factor spoilt, so that those at the right voltage are surges."""
    r, tripped = adapters.readings(spark, sf_dir), F.col("event_type") == "error"
    odd = r.withColumn("power_factor", F.when(tripped, 0.2).otherwise(F.col("power_factor"))).withColumn(
        "current_a", F.when(tripped, F.col("current_a") / 20).otherwise(F.col("current_a"))
    ).withColumn("voltage_v", F.when(tripped, F.col("voltage_v") + 25).otherwise(F.col("voltage_v")))
    stored = adapters.stored(odd, "event_id")
    return plain(
        stored.where(X.is_surge_and_trip(F.col("voltage_v"), F.col("current_a"), F.col("power_factor")))
        .select("event_id", "device_id", "voltage_v", "current_a")
    )


# --- time series -----------------------------------------------------------------------------------------------


@registered
def rolling_avg_10s(spark, sf_dir):
    rows = windows.rolling_mean(adapters.readings(spark, sf_dir).select("event_id", "device_id", "timestamp", "voltage_v"))
    return plain(rows.select("event_id", "device_id", "readings", "rolling_voltage"), "rolling_voltage")


@registered
def spike_alerts(spark, sf_dir):
    rows = windows.spikes(adapters.readings(spark, sf_dir).select("event_id", "device_id", "timestamp", "voltage_v"))
    return plain(
        rows.select("event_id", "device_id", "timestamp", "voltage_v", "baseline_n", "baseline_mean", "baseline_sd"),
        "baseline_mean", baseline_sd=6,
    )


@registered
def latest_per_device(spark, sf_dir):
    rows = adapters.readings(spark, sf_dir).select("device_id", "timestamp", "event_id", *METRICS)
    return plain(windows.latest_per_key(rows, ["device_id"], ["timestamp", "event_id"]))


@registered
def cadence_gaps(spark, sf_dir):
    return plain(windows.cadence_gaps(adapters.readings(spark, sf_dir)))


# --- packets ---------------------------------------------------------------------------------------------------


@registered
def packet_flows(spark, sf_dir):
    return plain(network.flow_lines(_flows(spark, sf_dir)))


@registered
def packet_alerts(spark, sf_dir):
    return plain(network.network_alerts(_flows(spark, sf_dir)))


@registered
def packet_delta_global(spark, sf_dir):
    """One clock for all captures."""
    flows = network.analyze(adapters.packets(spark, sf_dir), per_capture=False)
    return flows.select("seq", "time_delta_seconds", "alert_reason")


@registered
def capture_first_batch(spark, sf_dir):
    return network.first_batch(adapters.packets(spark, sf_dir)).select("capture_id", "seq", "position")


@registered
def capture_batches(spark, sf_dir):
    return network.batch_numbers(adapters.packets(spark, sf_dir)).select("capture_id", "seq", "batch")


# --- joins -----------------------------------------------------------------------------------------------------


@registered
def device_enrich(spark, sf_dir):
    r = adapters.readings(spark, sf_dir).withColumn("device_id", X.device_name(F.col("user_id") % 30))
    return correlate.enrich(r.select("event_id", "device_id", "voltage_v"), adapters.sites(spark, sf_dir))


@registered
def alert_correlation(spark, sf_dir):
    telemetry = decode.voltage_alerts(adapters.readings(spark, sf_dir))
    found = correlate.preceded_by(telemetry, network.network_alerts(_flows(spark, sf_dir)))
    return plain(found.select("alert_time", "subject", "value", "network_alerts", "last_network_alert", "lead_sec"))


# --- table maintenance -----------------------------------------------------------------------------------------


@registered
def hour_partitions(spark, sf_dir):
    rows = adapters.events(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("timestamp"))
    counts = telemetry_sink.with_hours(rows).groupBy("event_date", "event_hour").agg(F.count("*").alias("readings"))
    return counts.withColumn("event_date", F.col("event_date").cast("string"))


@registered
def device_lookup(spark, sf_dir):
    start = datetime(2024, 1, 1, 0, 2, tzinfo=timezone.utc)
    end = datetime(2024, 1, 1, 0, 12, tzinfo=timezone.utc)
    rows = tables.telemetry_between(spark, _table(spark, sf_dir), start, end, "meter_00003")
    return plain(rows.select(*telemetry_sink.COLUMNS))


@registered
def compaction(spark, sf_dir):
    """Three batches folded into one sorted folder per hour; the rows stay as they were."""
    path = _table(spark, sf_dir, batches=3)
    telemetry_sink.compact(spark, path, datetime(2024, 1, 1, 4, tzinfo=timezone.utc))
    return plain(tables.telemetry(spark, path).select(*telemetry_sink.COLUMNS, "batch"))


# --- logs ------------------------------------------------------------------------------------------------------


@registered
def log_events(spark, sf_dir):
    """Written by the formatter and parsed again: fixed keys and extras."""
    again = oplog.parse_log(oplog.format_log(_logs(spark, sf_dir)))
    return plain(
        again.select("event_time", "level", "logger", "line", "message", "exception", "stack_trace",
                     F.col("extras")["user_id"].cast("long").alias("user_id"))
    )


@registered
def log_extras(spark, sf_dir):
    """Extras that are numbers, lists and objects, written by the formatter and parsed again as what they were."""
    value = F.struct(F.col("value").alias("of"), F.array("event_type", F.lit("x")).alias("tags"))
    extras = F.struct(F.col("event_id").alias("number"), value.alias("object"), F.array("user_id", "event_id").alias("ids"))
    events = adapters.events(spark, sf_dir).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in LOG_EVENT.fields if f.name not in ("level", "line")],
        F.lit("INFO").alias("level"), F.col("event_id").cast("int").alias("line"),
        F.from_json(F.to_json(extras), "map<string,variant>").alias("extras"),
    )
    again = oplog.parse_log(oplog.format_log(events.select(*[f.name for f in LOG_EVENT.fields], "extras")), typed=True)
    return again.select(
        "line", oplog.extra("number", "bigint").alias("number"), oplog.extra("object", "double", "$.of").alias("value"),
        oplog.extra("object", "string", "$.tags[0]").alias("tag"), oplog.extra("ids", "array<bigint>").alias("ids"),
    ).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@registered
def stream_rotated_log(spark, sf_dir):
    """Log lines followed through three rotations, one of them between two lines of a batch."""
    folder, root = scratch_path(spark, "log"), scratch_path(spark, "stream")
    lines, log = adapters.log_lines(spark, sf_dir), f"{folder}/app_log.jsonl"
    files = Files(spark, folder)
    for number in range(4):
        # A file of the log is what one task writes; the ones before move on by a number.
        lines.where(F.pmod(F.xxhash64("value"), F.lit(4)) == number).coalesce(1).write.text(f"{folder}/new-{number}")
        for older in range(number, 0, -1):
            files.move(f"{log}.{older - 1}" if older > 1 else log, f"{log}.{older}")
        files.move(files.glob(f"{folder}/new-{number}/part-*")[0], log)
        if number != 1:
            stream = oplog.parse_log(tables.stream_log_text(spark, log))
            aggregates.start_side_table(stream, f"{root}/rows", f"{root}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
    return plain(oplog.level_counts(spark.read.parquet(f"{root}/rows")))


@registered
def log_levels(spark, sf_dir):
    return plain(oplog.level_counts(_logs(spark, sf_dir)))


@registered
def log_facts(spark, sf_dir):
    facts = oplog.with_facts(
        _logs(spark, sf_dir), "device_id", "voltage_v", "current_a", "dispatcher", "records", "rate", "size_bytes",
        "tcp_flags", "gap_sec", "meter", "worker", "took_ms",
    )
    return plain(facts.drop("timestamp", "level", "logger", "module", "function", "line", "thread_name", "message",
                            "exception", "stack_trace", "extras"))


@registered
def log_routes(spark, sf_dir):
    logs = _logs(spark, sf_dir)
    routed = oplog.quiet_route(logs).withColumn("route", F.lit("quiet")).unionByName(
        oplog.loud_route(logs).withColumn("route", F.lit("loud"))
    )
    return routed.groupBy("route", "level").agg(F.count("*").alias("events"))


@registered
def log_filters(spark, sf_dir):
    """Warnings, and what is left without the payload notices."""
    logs = _logs(spark, sf_dir)
    warnings = oplog.with_level(logs, "WARNING").withColumn("filter", F.lit("warnings"))
    others = oplog.without_text(logs, "Telemetry payload").withColumn("filter", F.lit("no_payloads"))
    return plain(warnings.unionByName(others).select("filter", "event_time", "level", "message"))


@registered
def log_losses(spark, sf_dir):
    return plain(oplog.losses(_logs(spark, sf_dir)))


# --- streams ---------------------------------------------------------------------------------------------------


def _ingested(spark: SparkSession, sf_dir: str, spike_options: dict | None = None) -> ingest.Paths:
    paths = ingest.Paths(scratch_path(spark, "ingest"))
    records = adapters.messages_of(adapters.readings_of(adapters.events_stream(spark, sf_dir)))
    ingest.start_ingest(records, paths, AVAILABLE_NOW, spike_options).awaitTermination()
    return paths


def _in_parts(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery], late: bool = True) -> None:
    """Runs a stream over the events in files by time, with a restart before each. If ``late``, the first two quarters
    change places and an eighth of every quarter comes one file after its time."""
    folder, events = scratch_path(spark, "events"), adapters.events(spark, sf_dir)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(us, [0.25, 0.5, 0.75])).first()[0]
    part = sum(((us >= cut).cast("int") for cut in cuts), F.lit(0))
    if late:
        part = F.when(part < 2, 1 - part).otherwise(part) + (F.col("event_id") % 8 == 0).cast("int")
    for number in range(5 if late else 4):
        publish_files(events.where(part == number), folder)
        start(spark.readStream.schema(events.schema).parquet(folder)).awaitTermination()


def _totals(spark: SparkSession, sf_dir: str, rows_of: Callable[[DataFrame], DataFrame], spec: partials.Mergeable) -> DataFrame:
    """A mergeable aggregate over a stream with late files and restarts, folded on the way."""
    root = scratch_path(spark, "stream")
    _in_parts(spark, sf_dir, lambda events: partials.start_partials(
        rows_of(events), spec, f"{root}/parts", f"{root}/checkpoint", AVAILABLE_NOW, fold_every=4
    ))
    return partials.totals(spark, spec, f"{root}/parts")


def _packet_analysis(spark: SparkSession, root: str, events: DataFrame) -> StreamingQuery:
    packets = adapters.packets_of(adapters.readings_of(events))
    return packet_stream.start_packet_analysis(
        packets, f"{root}/flows", f"{root}/state", f"{root}/packets", f"{root}/alerts", trigger=AVAILABLE_NOW
    )


@registered
def stream_ingest(spark, sf_dir):
    rows = tables.telemetry(spark, _ingested(spark, sf_dir).table)
    return plain(rows.select(*telemetry_sink.COLUMNS)).withColumn(
        "voltage_v", F.nanvl("voltage_v", F.lit(None).cast("double"))
    )


@registered
def stream_ingest_late(spark, sf_dir):
    """The later half of the records first, then the earlier half, then copies of some, in eight batches; a restart before
    each part."""
    source, paths = scratch_path(spark, "topic"), ingest.Paths(scratch_path(spark, "ingest"))
    messages = adapters.messages(spark, sf_dir)
    middle = messages.agg(F.percentile_approx(F.unix_micros("timestamp"), 0.5)).first()[0]
    late = F.unix_micros("timestamp") < middle
    # The files of a batch, for all cores to decode.
    each = spark.sparkContext.defaultParallelism
    for part, batches in ((~late, 3), (late, 3), (~late & (F.col("offset") % 3 == 0), 2)):
        publish_files(messages.where(part).repartition(batches * each, "offset"), source)
        stream = topic.stream_topic_files(spark, source, files_per_trigger=each)
        ingest.start_ingest(stream, paths, AVAILABLE_NOW).awaitTermination()
    rows = tables.telemetry(spark, paths.table)
    return plain(rows.select(*telemetry_sink.COLUMNS)).withColumn(
        "voltage_v", F.nanvl("voltage_v", F.lit(None).cast("double"))
    )


@registered
def stream_rejects(spark, sf_dir):
    rejects = spark.read.parquet(_ingested(spark, sf_dir).rejects)
    return plain(rejects.select("partition", "offset", "record_time", "reject_reason"))


@registered
def stream_flushes(spark, sf_dir):
    flushes = spark.read.parquet(_ingested(spark, sf_dir).flushes)
    return flushes.agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


@registered
def stream_alerts(spark, sf_dir):
    """Threshold alerts of decoded records and spikes against the landed table."""
    alerts = spark.read.parquet(_ingested(spark, sf_dir, {"k": 3.0, "min_n": 5}).alerts)
    return plain(alerts.select("alert_time", "subject", "reason"))


@registered
def stream_rollup(spark, sf_dir):
    root = scratch_path(spark, "stream")

    def start(events: DataFrame) -> StreamingQuery:
        readings = adapters.stored(adapters.readings_of(events))
        return aggregates.start_rollup(readings, f"{root}/changes", f"{root}/checkpoint", AVAILABLE_NOW)

    _in_parts(spark, sf_dir, start)
    return plain(aggregates.latest_changes(spark, f"{root}/changes"), **ROLLUP_DIGITS)


@registered
def stream_rollup_folded(spark, sf_dir):
    """Only buckets that the closing gate has let through: those that ended five minutes before the newest event."""
    root = scratch_path(spark, "stream")
    folders = [f"{root}/{name}" for name in ("parts", "gate", "rollup", "late", "checkpoint")]
    _in_parts(spark, sf_dir, lambda events: closing.start_closing(
        adapters.stored(adapters.readings_of(events)), *folders, trigger=AVAILABLE_NOW
    ))
    return plain(materialized.view(spark, f"{root}/rollup"), **ROLLUP_DIGITS)


@registered
def stream_packets(spark, sf_dir):
    root = scratch_path(spark, "stream")
    _in_parts(spark, sf_dir, lambda events: _packet_analysis(spark, root, events), late=False)
    return plain(spark.read.parquet(f"{root}/flows").drop("batch"))


@registered
def stream_packet_alerts(spark, sf_dir):
    root = scratch_path(spark, "stream")
    _in_parts(spark, sf_dir, lambda events: _packet_analysis(spark, root, events), late=False)
    return plain(spark.read.parquet(f"{root}/alerts").drop("batch"))


@registered
def stream_sliding_mean(spark, sf_dir):
    means = _totals(spark, sf_dir, adapters.readings_of, partials.sliding_mean())
    return plain(means, "rolling_voltage", rolling_sd=6)


@registered
def stream_throughput(spark, sf_dir):
    def records(events: DataFrame) -> DataFrame:
        return adapters.messages_of(adapters.readings_of(events))

    return plain(_totals(spark, sf_dir, records, partials.throughput()))


@registered
def stream_alert_counts(spark, sf_dir):
    """Voltage alerts of the stream and, as a second source, the alerts that the packet analysis lands."""
    root, spec = scratch_path(spark, "stream"), partials.alert_counts()
    landed = f"{correlation.LANDED.removesuffix(', uid long')}, batch long"

    def start(events: DataFrame) -> StreamingQuery:
        _packet_analysis(spark, root, events).awaitTermination()
        network_alerts = spark.readStream.schema(landed).parquet(f"{root}/alerts")
        alerts = correlate.union_alerts(decode.voltage_alerts(adapters.readings_of(events)), network_alerts)
        return partials.start_partials(alerts, spec, f"{root}/parts", f"{root}/checkpoint", AVAILABLE_NOW, fold_every=3)

    _in_parts(spark, sf_dir, start, late=False)
    return plain(partials.totals(spark, spec, f"{root}/parts"))


@registered
def stream_log_levels(spark, sf_dir):
    def events_of(events: DataFrame) -> DataFrame:
        return oplog.parse_log(adapters.log_lines_of(adapters.readings_of(events)))

    return plain(_totals(spark, sf_dir, events_of, partials.level_counts()))


@registered
def stream_alert_correlation(spark, sf_dir):
    """Alerts land in three batches dealt by hash, so that each brings late ones; a restart before each batch."""
    root = scratch_path(spark, "stream")
    alerts = _alerts(spark, sf_dir)
    for part in range(3):
        dealt = F.pmod(F.xxhash64("alert_time", "source", "subject"), F.lit(3)) == part
        alerts.where(dealt).write.mode("append").parquet(f"{root}/alerts")
        stream = spark.readStream.schema(alerts.schema).parquet(f"{root}/alerts")
        correlation.start_correlation(
            stream, f"{root}/landed", f"{root}/changes", f"{root}/checkpoint", trigger=AVAILABLE_NOW
        ).awaitTermination()
    found = correlation.correlated(spark, f"{root}/changes")
    return plain(found.select("alert_time", "subject", "value", "network_alerts", "last_network_alert", "lead_sec"))


@registered
def stream_enrich(spark, sf_dir):
    """A stream joined with the static device dimension."""
    root = scratch_path(spark, "stream")
    flat = adapters.readings_of(adapters.events_stream(spark, sf_dir))
    flat = flat.withColumn("device_id", X.device_name(F.col("user_id") % 30)).select("event_id", "device_id", "voltage_v")
    enriched = correlate.enrich(flat, adapters.sites(spark, sf_dir))
    aggregates.start_side_table(enriched, f"{root}/rows", f"{root}/checkpoint", trigger=AVAILABLE_NOW).awaitTermination()
    return spark.read.parquet(f"{root}/rows").drop("batch")
