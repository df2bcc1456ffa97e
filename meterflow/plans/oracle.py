"""The same queries as SQL over the given tables, written without the package."""

from __future__ import annotations

# Fixed values of the adapters: see sources/adapters.py.
_TEL = """
tel AS (
  SELECT event_id,
    'meter_' || lpad(cast(user_id % 10 AS varchar), 5, '0') AS device_id,
    make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 2592) AS timestamp,
    110::DOUBLE + value / 10::DOUBLE AS voltage_v,
    cast(json_extract_string(props, '$.k') AS DOUBLE) / 10::DOUBLE AS current_a,
    0.88::DOUBLE + (event_id % 8) / 100::DOUBLE AS power_factor,
    (110::DOUBLE + value / 10::DOUBLE) * (cast(json_extract_string(props, '$.k') AS DOUBLE) / 10::DOUBLE)
      * (0.88::DOUBLE + (event_id % 8) / 100::DOUBLE) / 1000::DOUBLE AS power_kw,
    cast(CASE WHEN value > 240 AND event_type <> 'view' THEN 1 ELSE 0 END AS INTEGER) AS security_flag,
    event_type, value, user_id, ts AS clock
  FROM events)"""

_STORED = """
sto AS (
  SELECT event_id, timestamp, device_id, voltage_v::REAL AS voltage_v, current_a::REAL AS current_a,
    power_kw::REAL AS power_kw, power_factor::REAL AS power_factor, security_flag FROM tel)"""

_PACKETS = """
pk AS (
  SELECT cast(user_id % 4 AS int) AS capture_id, timestamp AS ts, event_id AS seq,
    CASE WHEN event_id % 5 <> 0 THEN '10.0.0.' || user_id ELSE 'fd00::' || user_id END AS src_ip,
    CASE WHEN event_id % 5 <> 0 THEN '10.0.1.1' ELSE 'fd00::1' END AS dst_ip,
    cast(CASE WHEN event_id % 2 = 0 THEN 19092 ELSE 45322 END AS int) AS src_port,
    cast(CASE WHEN event_id % 7 = 0 THEN 443 WHEN event_id % 2 = 0 THEN 45322 ELSE 19092 END AS int) AS dst_port,
    cast(floor(value * 5) AS int) + 40 AS packet_size_bytes,
    CASE WHEN event_type = 'signup' THEN 'S' WHEN event_type = 'error' THEN 'None' ELSE 'PA' END AS tcp_flags
  FROM tel WHERE event_type <> 'view'),
rel AS (SELECT * FROM pk WHERE src_port = 19092 OR dst_port = 19092)"""


def _flow(partition: str, name: str = "flow") -> str:
    return f"""
{name}_gap AS (
  SELECT *, coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER ({partition} ORDER BY ts, seq))) / 1000000::DOUBLE, 0) AS gap
  FROM rel),
{name} AS (
  SELECT capture_id, ts, seq, src_ip, dst_ip, src_port, dst_port, packet_size_bytes, tcp_flags,
    round(gap, 6) AS time_delta_seconds,
    packet_size_bytes > 1500 OR (gap > 0 AND gap < 0.0001) AS is_anomaly,
    CASE WHEN packet_size_bytes > 1500 THEN 'Oversized Payload Detected'
         WHEN gap > 0 AND gap < 0.0001 THEN 'High-Frequency Traffic Flood (Possible DoS)' ELSE '' END AS alert_reason
  FROM {name}_gap)"""


_FLOWS = _PACKETS + "," + _flow("PARTITION BY capture_id")

# Topic records: every 97th reading is broken (c says how), every 50th is delivered twice.
_MESSAGES = """
msg AS (
  SELECT *, cast(user_id % 10 AS varchar) AS key, 'telemetry' AS topic, cast(event_id % 4 AS int) AS partition,
    event_id // 4 AS "offset", make_timestamp(epoch_us(timestamp) + (event_id % 8) * 1000000) AS record_time,
    CASE WHEN event_id % 97 = 0 THEN (event_id // 97) % 10 ELSE -1 END AS c
  FROM tel)"""

_REASON = """CASE WHEN c IN (0, 1, 2) THEN 'parse' WHEN c = 3 THEN 'missing_key' WHEN c IN (4, 5, 8) THEN 'type'
  WHEN c IN (6, 7) THEN 'constraint' END"""


def _time(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def _decimal_round(expr: str, places: int) -> str:
    """Half up on the decimal text of the number."""
    return f"cast(round(cast(cast({expr} AS varchar) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


def _mean(expr: str) -> str:
    """As in the catalog: means that lie halfway between two roundings go up."""
    return f"round({expr} + 3.3e-9::DOUBLE, 6)"


def _volts_text(expr: str) -> str:
    return f"cast(cast(round(cast(cast({expr} AS varchar) AS DECIMAL(38,18)), 2) AS DECIMAL(18,2)) AS varchar)"


_V_ALERT = f"""
va AS (
  SELECT timestamp AS alert_time, 'telemetry' AS source, device_id AS subject, 'Severe voltage anomaly' AS reason,
    voltage_v AS value,
    'Severe voltage anomaly detected on node: ' || device_id || ' (' || {_volts_text('voltage_v')} || 'V)' AS detail
  FROM tel WHERE voltage_v > 135)"""

_N_ALERT = """
na AS (
  SELECT ts AS alert_time, 'network' AS source, src_ip AS subject, alert_reason AS reason,
    packet_size_bytes::DOUBLE AS value,
    '[NETWORK ALERT] ' || alert_reason || ' | From ' || src_ip || ':' || src_port || ' | Size: ' || packet_size_bytes
      || 'B | Delta: ' || time_delta_seconds || 's' AS detail
  FROM flow WHERE is_anomaly)"""

_ALERTS = ",".join([_FLOWS, _V_ALERT, _N_ALERT, "\nal AS (SELECT * FROM va UNION ALL SELECT * FROM na)"])

_LOG = f"""
lg AS (
  SELECT event_id, timestamp AS event_time, user_id, event_id % 9 AS kind, value, device_id, current_a,
    CASE event_type WHEN 'view' THEN 'DEBUG' WHEN 'click' THEN 'INFO' WHEN 'signup' THEN 'WARNING'
      WHEN 'error' THEN 'ERROR' ELSE 'CRITICAL' END AS level,
    CASE WHEN event_id % 2 = 0 THEN 'grid.consumer' ELSE 'grid.simulation' END AS logger,
    cast(event_id % 300 AS int) AS line,
    CASE WHEN event_type IN ('error', 'purchase') THEN 'Traceback: sample' END AS exception,
    CASE event_id % 9
      WHEN 0 THEN '[' || device_id || '] Telemetry payload produced successfully.'
      WHEN 1 THEN '[' || device_id || '] Cyber-anomaly injected! V=' || {_volts_text('value')} || 'V, A='
        || {_volts_text('current_a')} || 'A'
      WHEN 2 THEN 'Dispatcher #' || (user_id % 4) || ' Throughput Status: Sent ' || event_id || ' records (~'
        || {_volts_text('value')} || ' msg/sec)'
      WHEN 3 THEN 'Severe voltage anomaly detected on node: ' || device_id || ' (' || {_volts_text('value')} || 'V)'
      WHEN 4 THEN '[NetFlow Log] Ingested ' || event_id || 'B packet | Flags: PA | Latency Delta: 0.000452s'
      WHEN 5 THEN 'Queue full! Dropping reading for meter ' || user_id
      WHEN 6 THEN 'Worker ' || (user_id % 100) || ' processing loop delayed: took '
        || {_volts_text('(value + 100)')} || 'ms (Limit: 100.00ms)'
      WHEN 7 THEN 'Successfully flushed batch of ' || (event_id % 50) || ' records to storage.'
      ELSE 'Successfully captured and parsed a batch of 100 packets.' END AS message
  FROM tel)"""

_BUCKET = "time_bucket(INTERVAL '5 minutes', {})"


def _rollup(source: str, bucket: str = "time_bucket(INTERVAL '5 minutes', timestamp)", where: str = "true") -> str:
    return f"""SELECT {_time(bucket)} AS bucket, device_id, round(avg(voltage_v::DOUBLE), 6) AS avg_voltage,
  max(voltage_v)::DOUBLE AS max_voltage, round(avg(current_a::DOUBLE), 6) AS avg_current,
  round(avg(power_factor::DOUBLE), 6) AS avg_power_factor, round(sum(power_kw::DOUBLE), 6) AS total_power_kw
FROM {source} WHERE {where} GROUP BY {bucket}, device_id"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_TABLE_COLUMNS = f"""{_time('timestamp')} AS timestamp, device_id, voltage_v::DOUBLE AS voltage_v,
  current_a::DOUBLE AS current_a, power_kw::DOUBLE AS power_kw, power_factor::DOUBLE AS power_factor, security_flag"""

_FLOW_COLUMNS = f"""capture_id, {_time('ts')} AS ts, seq, src_ip, dst_ip, src_port, dst_port, packet_size_bytes,
  tcp_flags, time_delta_seconds, is_anomaly, alert_reason"""

_ACCEPTED = """
acc AS (
  SELECT timestamp, device_id, CASE WHEN c <> 9 THEN voltage_v::REAL END AS voltage_v, current_a::REAL AS current_a,
    power_kw::REAL AS power_kw, power_factor::REAL AS power_factor, security_flag, key, partition, "offset"
  FROM msg WHERE c IN (-1, 9))"""

_SPIKE_FRAME = """(PARTITION BY device_id ORDER BY timestamp
    RANGE BETWEEN INTERVAL 10 SECONDS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"""

# Alerts that need no earlier packet, as the alert streams carry them.


ORACLES: dict[str, str] = {
    "rollup_5min": _with(_TEL, _STORED) + _rollup("sto"),
    "rollup_7min": _with(_TEL, _STORED) + _rollup("sto", "time_bucket(INTERVAL '7 minutes', timestamp)"),
    "rollup_refresh": _with(_TEL, _STORED)
    + _rollup("sto", where="timestamp >= TIMESTAMP '2023-12-31 23:20:00' AND timestamp < TIMESTAMP '2024-01-01 00:10:00'"),
    "rollup_view": _with(_TEL, _STORED)
    + _rollup("sto", where="timestamp >= TIMESTAMP '2023-12-31 23:20:00' AND timestamp < TIMESTAMP '2024-01-01 00:10:00'"),
    "rollup_realtime": _with(_TEL, _STORED) + _rollup("sto"),
    "shard_rollup": _with(_TEL) + f"""SELECT {_time(_BUCKET.format('timestamp'))} AS bucket, user_id // 100 AS shard,
  count(*) AS readings, {_mean("avg(voltage_v)")} AS avg_voltage, round(sum(power_kw), 6) AS total_power_kw
FROM tel GROUP BY 1, 2""",
    "block_avg_100ms": _with(_TEL) + f"""SELECT {_time("time_bucket(INTERVAL '100 milliseconds', timestamp)")} AS bucket,
  device_id, count(*) AS readings, {_mean("avg(voltage_v)")} AS avg_voltage, {_mean("avg(current_a)")} AS avg_current
FROM tel GROUP BY 1, 2""",
    "throughput_5s": _with(_TEL, _MESSAGES) + f"""SELECT
  {_time("time_bucket(INTERVAL '5 seconds', record_time)")} AS bucket, partition,
  sum(CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)::BIGINT AS records,
  sum(CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END) / 5::DOUBLE AS rate
FROM msg GROUP BY 1, 2""",
    "energy_kwh": _with(_TEL) + f""", e AS (SELECT *, coalesce(epoch_us(lead(timestamp) OVER (
    PARTITION BY device_id ORDER BY timestamp, event_id)) - epoch_us(timestamp), 0) AS us FROM tel)
SELECT {_time(_BUCKET.format('timestamp'))} AS bucket, device_id, round(sum(power_kw * us / 3.6e9::DOUBLE), 9) AS energy_kwh
FROM e GROUP BY 1, 2""",
    "energy_fixed": _with(_TEL) + f"""SELECT {_time(_BUCKET.format('timestamp'))} AS bucket, device_id,
  round(sum(power_kw) * 0.1::DOUBLE / 3600::DOUBLE, 9) AS energy_kwh FROM tel GROUP BY 1, 2""",
    "message_fields": _with(_TEL) + """SELECT event_id, cast(user_id % 10 AS varchar) AS key,
  epoch_us(timestamp) / 1000000::DOUBLE AS epoch_sec, device_id, voltage_v, current_a, power_kw, power_factor, security_flag
FROM tel""",
    "decode_telemetry": _with(_TEL, _MESSAGES, _ACCEPTED) + f"""SELECT {_TABLE_COLUMNS}, key, partition, "offset",
  true AS key_matches FROM acc""",
    "quarantine": _with(_TEL, _MESSAGES) + f"""SELECT partition, "offset", {_time('record_time')} AS record_time,
  {_REASON} AS reject_reason FROM msg WHERE c BETWEEN 0 AND 8""",
    "decoded_alerts": _with(_TEL, _MESSAGES) + """SELECT partition, "offset",
  CASE WHEN c = 7 THEN repeat('d', 51) ELSE device_id END AS device_id,
  CASE WHEN c = 5 THEN 145.2 ELSE voltage_v END AS voltage_v, c <> -1 AS is_rejected
FROM msg WHERE c = 5 OR (c IN (-1, 6, 7, 8) AND voltage_v > 135)""",
    "quality_states": _with(_TEL, _MESSAGES) + """SELECT partition, "offset",
  CASE WHEN c BETWEEN 0 AND 8 THEN 'Bad' WHEN event_id % 8 > 5 THEN 'Stale' ELSE 'Good' END AS quality FROM msg""",
    "dedup": _with(_TEL, _MESSAGES) + f""", copies AS (SELECT * FROM msg UNION ALL SELECT * FROM msg WHERE event_id % 50 = 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY topic, partition, "offset" ORDER BY record_time) AS rn FROM copies)
SELECT topic, partition, "offset", key, {_time('record_time')} AS timestamp FROM numbered WHERE rn = 1""",
    "topic_sample": _with(_TEL, _MESSAGES) + f""", copies AS (SELECT * FROM msg UNION ALL SELECT * FROM msg WHERE event_id % 50 = 0)
SELECT key, topic, partition, "offset", {_time('record_time')} AS timestamp FROM copies ORDER BY partition, "offset" LIMIT 5""",
    "telemetry_head": _with(_TEL) + f"""SELECT event_id, {_time('timestamp')} AS timestamp, device_id, voltage_v, current_a,
  power_kw, power_factor, security_flag FROM tel ORDER BY event_id LIMIT 10""",
    "voltage_alerts": _with(_TEL, _V_ALERT) + f"""SELECT {_time('alert_time')} AS alert_time, source, subject, reason, value,
  detail FROM va""",
    "alert_union": _with(_TEL, _ALERTS) + f"""SELECT {_time('alert_time')} AS alert_time, source, subject, reason, value,
  detail FROM al""",
    "alert_counts": _with(_TEL, _ALERTS) + f"""SELECT {_time(_BUCKET.format('alert_time'))} AS bucket, source, reason,
  count(*) AS alerts FROM al GROUP BY 1, 2, 3""",
    "alert_subjects": _with(_TEL, _ALERTS) + f"""SELECT source, subject, reason, count(*) AS alerts,
  {_time('min(alert_time)')} AS first_alert, {_time('max(alert_time)')} AS last_alert FROM al GROUP BY 1, 2, 3""",
    "alert_quality": _with(_TEL) + """, q AS (SELECT
  count(*) FILTER (voltage_v > 135 AND security_flag = 1) AS true_positive,
  count(*) FILTER (voltage_v > 135 AND security_flag = 0) AS false_positive,
  count(*) FILTER (voltage_v <= 135 AND security_flag = 1) AS false_negative,
  count(*) FILTER (voltage_v <= 135 AND security_flag = 0) AS true_negative FROM tel)
SELECT *, true_positive / nullif(true_positive + false_positive, 0)::DOUBLE AS precision,
  true_positive / nullif(true_positive + false_negative, 0)::DOUBLE AS recall FROM q""",
    "voltage_band": _with(_TEL) + """SELECT event_id, CASE WHEN voltage_v BETWEEN 114 AND 126 THEN 'optimal'
  WHEN voltage_v BETWEEN 106 AND 127 THEN 'acceptable' ELSE 'out_of_range' END AS band,
  power_factor BETWEEN 0 AND 1 AS power_factor_valid FROM tel""",
    "device_names": """SELECT event_id, 'meter_' || CASE WHEN user_id * 1009 < 100000
  THEN lpad(cast(user_id * 1009 AS varchar), 5, '0') ELSE cast(user_id * 1009 AS varchar) END AS device_id,
  user_id * 1009 AS device_number, user_id * 7 // 100 AS shard FROM events""",
    "power_math": _with(_TEL) + """SELECT event_id, voltage_v * current_a * power_factor / 1000::DOUBLE AS active_kw,
  voltage_v * current_a / 1000::DOUBLE AS apparent_kva,
  round(power_kw / nullif(voltage_v * current_a / 1000::DOUBLE, 0), 9) AS power_factor,
  round(degrees(acos(power_factor)), 9) AS phase_deg,
  abs(power_kw + (event_id % 3) * 0.001::DOUBLE - voltage_v * current_a * power_factor / 1000::DOUBLE)
    <= 0.005::DOUBLE * (voltage_v * current_a + voltage_v * power_factor + current_a * power_factor) / 1000::DOUBLE
      + 0.0005::DOUBLE AS is_consistent
FROM tel""",
    "presented": _with(_TEL) + f"""SELECT event_id, {_decimal_round('voltage_v', 2)} AS voltage_v,
  {_decimal_round('current_a', 2)} AS current_a, {_decimal_round('power_factor', 2)} AS power_factor,
  {_decimal_round('power_kw', 3)} AS power_kw FROM tel""",
    "baseline_residual": _with(_TEL) + """, h AS (SELECT *, extract('hour' FROM clock) + extract('minute' FROM clock) / 60::DOUBLE
    + extract('second' FROM clock) / 3600::DOUBLE AS h FROM tel),
l AS (SELECT *, 0.5::DOUBLE - 0.5::DOUBLE * cos(pi() * h / 12) AS f FROM h),
x AS (SELECT *, 5 + 25 * f AS ea FROM l), y AS (SELECT *, 120 - ea / 30 * 1.5::DOUBLE AS ev FROM x)
SELECT event_id, round(h, 9) AS hour, round(f, 9) AS load_factor, round(ea, 9) AS expected_a, round(ev, 9) AS expected_v,
  round(abs(voltage_v - ev) / 0.3::DOUBLE, 6) AS voltage_residual, round(abs(current_a - ea) / 0.5::DOUBLE, 6) AS current_residual
FROM y""",
    "surge_signature": _with(_TEL, _STORED) + """SELECT event_id, device_id, voltage_v::DOUBLE AS voltage_v, current_a::DOUBLE AS current_a
FROM (SELECT event_id, device_id, (voltage_v + 25)::REAL AS voltage_v, (current_a / 20)::REAL AS current_a FROM tel
  WHERE event_type = 'error') AS tripped WHERE voltage_v BETWEEN 145 AND 155 AND current_a <= 0.5""",
    "rolling_avg_10s": _with(_TEL) + f"""SELECT event_id, device_id, count(*) OVER w AS readings,
  {_mean("avg(voltage_v) OVER w")} AS rolling_voltage FROM tel
WINDOW w AS (PARTITION BY device_id ORDER BY timestamp RANGE BETWEEN INTERVAL 10 SECONDS PRECEDING AND CURRENT ROW)""",
    "spike_alerts": _with(_TEL) + f""", b AS (SELECT event_id, device_id, timestamp, voltage_v, count(*) OVER w AS n,
  avg(voltage_v) OVER w AS m, stddev_samp(voltage_v) OVER w AS sd FROM tel WINDOW w AS {_SPIKE_FRAME})
SELECT event_id, device_id, {_time('timestamp')} AS timestamp, voltage_v, n AS baseline_n, {_mean("m")} AS baseline_mean,
  round(sd, 6) AS baseline_sd FROM b WHERE n >= 5 AND sd > 0 AND abs(voltage_v - m) > 3 * sd""",
    "latest_per_device": _with(_TEL) + f""", r AS (SELECT *, row_number() OVER (
    PARTITION BY device_id ORDER BY timestamp DESC, event_id DESC) AS rn FROM tel)
SELECT device_id, {_time('timestamp')} AS timestamp, event_id, voltage_v, current_a, power_kw, power_factor
FROM r WHERE rn = 1""",
    "cadence_gaps": _with(_TEL) + f""", g AS (SELECT device_id, timestamp, lag(timestamp) OVER (
    PARTITION BY device_id ORDER BY timestamp, event_id) AS p FROM tel)
SELECT device_id, {_time('p')} AS silent_from, {_time('timestamp')} AS silent_to,
  (epoch_us(timestamp) - epoch_us(p)) / 1000000::DOUBLE AS gap_sec
FROM g WHERE (epoch_us(timestamp) - epoch_us(p)) / 1000000::DOUBLE > 0.1""",
    "packet_flows": _with(_TEL, _FLOWS) + f"""SELECT {_FLOW_COLUMNS},
  CASE WHEN is_anomaly THEN '[NETWORK ALERT] ' || alert_reason || ' | From ' || src_ip || ':' || src_port || ' | Size: '
      || packet_size_bytes || 'B | Delta: ' || time_delta_seconds || 's'
    ELSE '[NetFlow Log] Ingested ' || packet_size_bytes || 'B packet | Flags: ' || tcp_flags || ' | Latency Delta: '
      || time_delta_seconds || 's' END AS line
FROM flow""",
    "packet_alerts": _with(_TEL, _FLOWS, _N_ALERT) + f"""SELECT {_time('alert_time')} AS alert_time, source, subject, reason,
  value, detail FROM na""",
    "packet_delta_global": _with(_TEL, _PACKETS, _flow(""))
    + "SELECT seq, time_delta_seconds, alert_reason FROM flow",
    "capture_first_batch": _with(_TEL, _PACKETS) + """, n AS (SELECT capture_id, seq, cast(row_number() OVER (
    PARTITION BY capture_id ORDER BY ts, seq) AS int) AS position FROM rel)
SELECT * FROM n WHERE position <= 100""",
    "capture_batches": _with(_TEL, _PACKETS) + """SELECT capture_id, seq, (row_number() OVER (
    PARTITION BY capture_id ORDER BY ts, seq) - 1) // 100 AS batch FROM rel""",
    "device_enrich": _with(_TEL) + """SELECT event_id, 'meter_' || lpad(cast(user_id % 30 AS varchar), 5, '0') AS device_id,
  voltage_v, n_name AS site, r_name AS area
FROM tel LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON n_nationkey = user_id % 30""",
    "alert_correlation": _with(_TEL, _ALERTS) + f"""SELECT {_time('va.alert_time')} AS alert_time, va.subject, va.value,
  count(*) AS network_alerts, {_time('max(na.alert_time)')} AS last_network_alert,
  (epoch_us(va.alert_time) - epoch_us(max(na.alert_time))) / 1000000::DOUBLE AS lead_sec
FROM va JOIN na ON na.alert_time BETWEEN va.alert_time - INTERVAL 30 SECONDS AND va.alert_time
GROUP BY va.alert_time, va.subject, va.value""",
    "hour_partitions": """SELECT cast(cast(ts AS DATE) AS varchar) AS event_date, cast(extract('hour' FROM ts) AS int) AS event_hour,
  count(*) AS readings FROM events GROUP BY 1, 2""",
    "device_lookup": _with(_TEL, _STORED) + f"""SELECT {_TABLE_COLUMNS} FROM sto WHERE device_id = 'meter_00003'
  AND timestamp >= TIMESTAMP '2024-01-01 00:02:00' AND timestamp < TIMESTAMP '2024-01-01 00:12:00'""",
    "compaction": _with(_TEL, _STORED) + f"SELECT {_TABLE_COLUMNS}, cast(-3 AS BIGINT) AS batch FROM sto",
    "log_events": _with(_TEL, _LOG) + f"""SELECT {_time('event_time')} AS event_time, level, logger, line, message, exception,
  cast(NULL AS varchar) AS stack_trace, user_id FROM lg""",
    "log_levels": _with(_TEL, _LOG) + f"""SELECT {_time(_BUCKET.format('event_time'))} AS bucket, level, logger,
  count(*) AS events FROM lg GROUP BY 1, 2, 3""",
    "log_facts": _with(_TEL, _LOG) + f"""SELECT {_time('event_time')} AS event_time,
  CASE kind WHEN 0 THEN 'payload_produced' WHEN 1 THEN 'anomaly_injected' WHEN 2 THEN 'throughput' WHEN 3 THEN 'voltage_alert'
    WHEN 4 THEN 'packet_flow' WHEN 5 THEN 'reading_dropped' WHEN 6 THEN 'deadline_missed' WHEN 7 THEN 'batch_flushed'
    ELSE 'capture_done' END AS event_kind,
  nullif(regexp_extract(message, '(meter_\\d+)', 1), '') AS device_id,
  try_cast(coalesce(nullif(regexp_extract(message, 'V=([\\d.]+)V', 1), ''),
    nullif(regexp_extract(message, '\\(([\\d.]+)V\\)', 1), '')) AS DOUBLE) AS voltage_v,
  try_cast(regexp_extract(message, 'A=([\\d.]+)A', 1) AS DOUBLE) AS current_a,
  try_cast(regexp_extract(message, 'Dispatcher #(\\d+)', 1) AS INTEGER) AS dispatcher,
  try_cast(coalesce(nullif(regexp_extract(message, 'Sent (\\d+) records', 1), ''),
    nullif(regexp_extract(message, 'batch of (\\d+) ', 1), '')) AS BIGINT) AS records,
  try_cast(regexp_extract(message, '~([\\d.]+) msg', 1) AS DOUBLE) AS rate,
  try_cast(regexp_extract(message, 'Ingested (\\d+)B', 1) AS INTEGER) AS size_bytes,
  nullif(regexp_extract(message, 'Flags: (\\w+)', 1), '') AS tcp_flags,
  try_cast(regexp_extract(message, 'Delta: ([\\d.]+)s', 1) AS DOUBLE) AS gap_sec,
  try_cast(regexp_extract(message, 'for meter (\\d+)', 1) AS BIGINT) AS meter,
  try_cast(regexp_extract(message, 'Worker (\\d+)', 1) AS INTEGER) AS worker,
  try_cast(regexp_extract(message, 'took ([\\d.]+)ms', 1) AS DOUBLE) AS took_ms
FROM lg""",
    "log_routes": _with(_TEL, _LOG) + """SELECT 'quiet' AS route, level, count(*) AS events FROM lg
WHERE level IN ('DEBUG', 'INFO', 'WARNING') GROUP BY level
UNION ALL SELECT 'loud', level, count(*) FROM lg WHERE level IN ('WARNING', 'ERROR', 'CRITICAL') GROUP BY level""",
    "log_filters": _with(_TEL, _LOG) + f"""SELECT 'warnings' AS filter, {_time('event_time')} AS event_time, level, message FROM lg
WHERE level = 'WARNING'
UNION ALL SELECT 'no_payloads', {_time('event_time')}, level, message FROM lg WHERE message NOT LIKE '%Telemetry payload%'""",
    "log_losses": _with(_TEL, _LOG) + f"""SELECT {_time(_BUCKET.format('event_time'))} AS bucket,
  count(*) FILTER (kind = 5) AS dropped_readings, count(*) FILTER (kind = 6) AS missed_deadlines,
  max(CASE WHEN kind = 6 THEN cast(regexp_extract(message, 'took ([\\d.]+)ms', 1) AS DOUBLE) END) AS worst_ms
FROM lg WHERE kind IN (5, 6) GROUP BY 1""",
    "stream_ingest": _with(_TEL, _MESSAGES, _ACCEPTED) + f"SELECT {_TABLE_COLUMNS} FROM acc",
    "stream_ingest_late": _with(_TEL, _MESSAGES, _ACCEPTED) + f"SELECT {_TABLE_COLUMNS} FROM acc",
    "stream_rejects": _with(_TEL, _MESSAGES) + f"""SELECT partition, "offset", {_time('record_time')} AS record_time,
  {_REASON} AS reject_reason FROM msg WHERE c BETWEEN 0 AND 8""",
    "stream_flushes": _with(_TEL, _MESSAGES) + """SELECT count(*) FILTER (c IN (-1, 9)) AS accepted,
  count(*) FILTER (c BETWEEN 0 AND 8) AS rejected FROM msg""",
    "stream_rollup": _with(_TEL, _STORED) + _rollup("sto"),
    "stream_packets": _with(_TEL, _FLOWS) + f"SELECT {_FLOW_COLUMNS} FROM flow",
    "stream_sliding_mean": _with(_TEL) + f""", s AS (SELECT *, time_bucket(INTERVAL '1 second', timestamp)
    - to_seconds(unnest(range(10))) AS ws FROM tel)
SELECT {_time('ws')} AS window_start, {_time('ws + INTERVAL 10 SECONDS')} AS window_end, device_id, count(*) AS readings,
  {_mean("avg(voltage_v)")} AS rolling_voltage, round(stddev_samp(voltage_v), 6) AS rolling_sd FROM s GROUP BY ws, device_id""",
}

ORACLES["stream_packet_alerts"] = ORACLES["packet_alerts"]
ORACLES["baseline_outliers"] = _with(_TEL) + """, h AS (SELECT *, extract('hour' FROM timestamp)
    + extract('minute' FROM timestamp) / 60::DOUBLE + extract('second' FROM timestamp) / 3600::DOUBLE AS h FROM tel),
l AS (SELECT *, (5 + 25 * (0.5::DOUBLE - 0.5::DOUBLE * cos(pi() * h / 12))) AS ea FROM h)
SELECT event_id, device_id, voltage_v, current_a FROM l
WHERE current_a < ea * 0.7::DOUBLE - 1.5 OR current_a > ea * 1.5::DOUBLE + 1.5
  OR voltage_v < 120 - ea * 1.5::DOUBLE / 30 * 1.5::DOUBLE - 0.9::DOUBLE
  OR voltage_v > 120 - ea * 0.7::DOUBLE / 30 * 1.5::DOUBLE + 0.9::DOUBLE"""
ORACLES["stream_alert_counts"] = ORACLES["alert_counts"]
ORACLES["stream_alert_correlation"] = ORACLES["alert_correlation"]
ORACLES["stream_throughput"] = ORACLES["throughput_5s"]
ORACLES["stream_log_levels"] = ORACLES["log_levels"]
ORACLES["stream_rollup_folded"] = _with(_TEL, _STORED) + f"""SELECT * FROM ({_rollup("sto")}) AS r
WHERE strptime(bucket, '%Y-%m-%d %H:%M:%S.%f') + INTERVAL 10 MINUTES
  <= (SELECT time_bucket(INTERVAL '5 minutes', max(timestamp)) FROM sto)"""
ORACLES["stream_rotated_log"] = ORACLES["log_levels"]
ORACLES["log_extras"] = """SELECT cast(event_id AS INTEGER) AS line, event_id AS number, value, event_type AS tag,
  user_id || ',' || event_id AS ids FROM events"""
ORACLES["stream_enrich"] = ORACLES["device_enrich"]
ORACLES["stream_alerts"] = _with(_TEL, _MESSAGES, _ACCEPTED) + f""", b AS (
  SELECT device_id, timestamp, voltage_v, count(voltage_v) OVER w AS n, avg(voltage_v::DOUBLE) OVER w AS m,
    stddev_samp(voltage_v::DOUBLE) OVER w AS sd FROM acc WINDOW w AS {_SPIKE_FRAME})
SELECT {_time('timestamp')} AS alert_time, device_id AS subject, 'Voltage spike' AS reason
FROM b WHERE n >= 5 AND sd > 0 AND abs(voltage_v - m) > 3 * sd
UNION ALL SELECT {_time('CASE WHEN c = 5 THEN record_time ELSE timestamp END')},
  CASE WHEN c = 7 THEN repeat('d', 51) ELSE device_id END, 'Severe voltage anomaly'
FROM msg WHERE c = 5 OR (c IN (-1, 6, 7, 8) AND voltage_v > 135)"""
