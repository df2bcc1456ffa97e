"""What the watermarks of running streams have dropped, batch by batch."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query string, batch long, input_rows long, dropped_rows long, state_rows long, watermark string"


class DroppedRows(StreamingQueryListener):
    """Remembers the last batches of the session's streams; totals go on for ever.

    Spark counts what reaches the stateful operator: rows of one group that one task has already combined are one. So
    ``dropped_rows`` is 0 exactly if no row was dropped, and else a lower bound. Add it with ``spark.streams.addListener``.
    """

    def __init__(self, batches: int = 10_000):
        self.batches: deque[tuple] = deque(maxlen=batches)
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query = progress.name or str(progress.id)
        dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        rows = sum(s.numRowsTotal for s in progress.stateOperators)
        self.dropped[query] = self.dropped.get(query, 0) + dropped
        self.batches.append(
            (query, progress.batchId, progress.numInputRows, dropped, rows, progress.eventTime.get("watermark"))
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.batches), SCHEMA)
