"""Appending batches to an external database, once per batch and with retries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Attempts and first pause; the pause doubles.
ATTEMPTS = 3
FIRST_PAUSE_SEC = 1.0
# The class of SQL states that are connection errors, and those of a server going down or coming up.
CONNECTION_CLASS = "08"
SERVER_STATES = ("57P01", "57P02", "57P03")
# Errors of the network itself, which carry no SQL state.
_NETWORK = ("java.net.ConnectException", "java.net.SocketException", "java.net.SocketTimeoutException", "java.io.EOFException")
_TRANSIENT = ("java.sql.SQLTransientConnectionException", "java.sql.SQLNonTransientConnectionException", "java.sql.SQLRecoverableException")


def writer_options(url: str, table: str, user: str, password: str, batch_rows: int = 10_000, writers: int = 16):
    return {
        "url": url, "dbtable": table, "user": user, "password": password, "batchsize": str(batch_rows),
        "numPartitions": str(writers), "isolationLevel": "READ_COMMITTED",
    }


def _java(error: BaseException):
    """The Java exception behind an error of Spark or of its gateway."""
    return getattr(error, "java_exception", None) or getattr(error, "_origin", None)


def causes(error: BaseException) -> list[tuple[tuple[str, ...], str | None]]:
    """Class names (with those above) and SQL state of an error's Java exception and of all that caused it."""
    found, at, seen = [], _java(error), set()
    while at is not None and at.hashCode() not in seen:
        seen.add(at.hashCode())
        names, kind = [], at.getClass()
        while kind is not None:
            names.append(kind.getName())
            kind = kind.getSuperclass()
        found.append((tuple(names), at.getSQLState() if "java.sql.SQLException" in names else None))
        at = at.getCause()
    return found


def is_transient(error: BaseException) -> bool:
    """Connection errors, by the SQL states and classes of the cause chain. Texts decide only where there is no Java
    exception to ask: there the name of a connection error's class has to stand before the message."""
    if isinstance(error, (ConnectionError, TimeoutError)):
        return True
    chain = causes(error)
    states = [state for _, state in chain if state]
    if states:
        return any(state.startswith(CONNECTION_CLASS) or state in SERVER_STATES for state in states)
    names = {name for own, _ in chain for name in own}
    if chain:
        return not names.isdisjoint((*_TRANSIENT, *_NETWORK))
    return any(f"{name}:" in str(error) for name in (*_TRANSIENT, *_NETWORK))


def with_retry(
    action: Callable[[], None], attempts: int = ATTEMPTS, pause_sec: float = FIRST_PAUSE_SEC, sleep=time.sleep
) -> None:
    """Repeat on connection errors with a doubling pause; any other error is raised at once."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception as error:
            if not is_transient(error) or attempt == attempts:
                raise
            sleep(pause_sec)
            pause_sec *= 2


def append_once(spark_batch: DataFrame, batch_id: int, options: dict[str, str], ledger_table: str) -> None:
    """Append a batch under a fresh ``write_id`` and then enter both ids in the ledger.

    Rows of a write that died half way are in no ledger entry and do not show in ``visible``.
    """
    spark = spark_batch.sparkSession

    def attempt() -> None:
        ledger = spark.read.format("jdbc").options(**{**options, "dbtable": ledger_table}).load()
        if not ledger.where(F.col("batch_id") == batch_id).isEmpty():
            return
        write_id = time.time_ns()
        rows = spark_batch.withColumn("batch_id", F.lit(batch_id)).withColumn("write_id", F.lit(write_id))
        rows.write.format("jdbc").options(**options).mode("append").save()
        entry = spark.range(1).select(F.lit(batch_id).alias("batch_id"), F.lit(write_id).alias("write_id"))
        entry.write.format("jdbc").options(**{**options, "dbtable": ledger_table}).mode("append").save()

    with_retry(attempt)


def start_database_append(
    rows: DataFrame, options: dict[str, str], ledger_table: str, checkpoint: str, trigger: dict | None = None,
    append: Callable[[DataFrame, int, dict[str, str], str], None] = append_once,
) -> StreamingQuery:
    """A stream into an external table, every batch once. ``append`` is what writes a batch."""
    return (
        rows.writeStream.foreachBatch(lambda batch, batch_id: append(batch, batch_id, options, ledger_table))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def visible(staging: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of the writes that the ledger names, once per batch."""
    done = ledger.groupBy("batch_id").agg(F.min("write_id").alias("write_id"))
    return staging.join(done, ["batch_id", "write_id"], "left_semi").drop("batch_id", "write_id")
