"""Fixed schemas of the messages and tables."""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("device_id", T.StringType()),
        T.StructField(
            "metrics",
            T.StructType(
                [
                    T.StructField("voltage_v", T.DoubleType()),
                    T.StructField("current_a", T.DoubleType()),
                    T.StructField("power_kw", T.DoubleType()),
                    T.StructField("power_factor", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("security_flag", T.LongType()),
    ]
)

TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# The order is the column order of the telemetry table.
METRICS = ["voltage_v", "current_a", "power_kw", "power_factor"]

TELEMETRY = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("device_id", T.StringType(), False),
        *[T.StructField(name, T.FloatType(), False) for name in METRICS],
        T.StructField("security_flag", T.IntegerType(), False),
    ]
)

PACKET = T.StructType(
    [
        T.StructField("capture_id", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("has_ipv4", T.BooleanType()),
        T.StructField("has_ipv6", T.BooleanType()),
        T.StructField("has_tcp", T.BooleanType()),
        T.StructField("ip4_src", T.StringType()),
        T.StructField("ip4_dst", T.StringType()),
        T.StructField("ip6_src", T.StringType()),
        T.StructField("ip6_dst", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("packet_size_bytes", T.IntegerType()),
        T.StructField("tcp_flags", T.StringType()),
    ]
)

LOG_EVENT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("logger", T.StringType()),
        T.StructField("module", T.StringType()),
        T.StructField("function", T.StringType()),
        T.StructField("line", T.IntegerType()),
        T.StructField("thread_name", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("exception", T.StringType()),
        T.StructField("stack_trace", T.StringType()),
    ]
)

# Columns every alert carries, whatever raised it.
ALERT_COLUMNS = ["alert_time", "source", "subject", "reason", "value", "detail"]
