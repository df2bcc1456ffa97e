"""The structured log: parsing, routing and the facts in its messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.text import event_kind, fact
from meterflow.operators.rollup import bucket, bucket_start
from meterflow.schemas import LOG_EVENT

# Severity numbers.
SEVERITY = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}
CORE_KEYS = LOG_EVENT.fieldNames()


def severity(level: Column) -> Column:
    pairs = [F.lit(x) for item in SEVERITY.items() for x in item]
    return F.create_map(*pairs)[level]


def parse_log(lines: DataFrame, line: str = "value", typed: bool = False) -> DataFrame:
    """JSON lines to the fixed columns, ``event_time``, and a map ``extras`` of all other keys: as text or, if ``typed``,
    as variants, which keep numbers, lists and objects what they are.

    The generator keeps filters on parsed fields from being pushed below the parser and parsing again.
    """
    kind = "map<string,variant>" if typed else "map<string,string>"
    extras = F.map_filter(F.from_json(line, kind), lambda k, _: ~k.isin(CORE_KEYS))
    parsed = lines.select(line, F.inline(F.array(F.struct(F.from_json(line, LOG_EVENT).alias("e")))))
    return parsed.select("e.*", extras.alias("extras"), F.try_to_timestamp(F.col("e.timestamp")).alias("event_time"))


def extra(name: str, kind: str, path: str = "$") -> Column:
    """A value among typed extras, or at a path within it; null where it is missing or of another kind."""
    return F.try_variant_get(F.element_at("extras", name), path, kind)


def format_log(events: DataFrame) -> DataFrame:
    """Log events to JSON lines: fixed keys, exception and stack trace when present, then the extras as they are."""
    fixed = F.to_json(F.struct(*CORE_KEYS))
    extra = F.to_json("extras")
    body = F.when(
        F.coalesce(F.size("extras"), F.lit(0)) > 0,
        F.concat(F.expr("substring(" + "_fixed, 1, length(_fixed) - 1)"), F.lit(","), F.expr("substring(_extra, 2)")),
    ).otherwise(F.col("_fixed"))
    return events.withColumn("_fixed", fixed).withColumn("_extra", extra).select(body.alias("value"))


def quiet_route(events: DataFrame) -> DataFrame:
    """WARNING and below."""
    return events.where(severity(F.col("level")) <= SEVERITY["WARNING"])


def loud_route(events: DataFrame) -> DataFrame:
    """WARNING and above; a WARNING takes both routes."""
    return events.where(severity(F.col("level")) >= SEVERITY["WARNING"])


def with_level(events: DataFrame, level: str) -> DataFrame:
    return events.where(F.col("level") == level)


def without_text(events: DataFrame, text: str) -> DataFrame:
    return events.where(~F.col("message").contains(text))


def with_facts(events: DataFrame, *names: str) -> DataFrame:
    """Log events with ``event_kind`` and the named facts."""
    staged = events.withColumn("event_kind", event_kind(F.col("message")))
    return staged.select("*", *[fact(F.col("message"), F.col("event_kind"), n).alias(n) for n in names])


def level_counts(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    counts = events.groupBy(bucket("event_time", width), "level", "logger").agg(F.count("*").alias("events"))
    return counts.select(F.col("window.start").alias("bucket"), "level", "logger", "events")


def losses(events: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Dropped readings and missed deadlines per window."""
    facts = with_facts(events, "took_ms").where(F.col("event_kind").isin("reading_dropped", "deadline_missed"))
    return facts.groupBy(bucket_start(F.col("event_time"), width).alias("bucket")).agg(
        F.count_if(F.col("event_kind") == "reading_dropped").alias("dropped_readings"),
        F.count_if(F.col("event_kind") == "deadline_missed").alias("missed_deadlines"),
        F.max("took_ms").alias("worst_ms"),
    )
