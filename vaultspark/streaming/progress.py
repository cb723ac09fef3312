"""Progress of streaming queries as rows."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.storage import append_log

PROGRESS_SCHEMA = (
    "name string, batch_id bigint, num_input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, trigger_ms bigint, add_batch_ms bigint, state_operators int"
)


class ProgressRecorder(StreamingQueryListener):
    """Progress reports of all queries as rows.

    Add it with ``spark.streams.addListener``. ``frame`` gives the reports that are
    not yet stored; ``flush`` appends them to a log, after which they are held no
    longer. With a ``log`` path, reports are stored by themselves once
    ``flush_every`` have come together. None is dropped.
    """

    def __init__(self, spark: SparkSession | None = None, log: str | None = None, flush_every: int = 1_000):
        self._reports: list[tuple] = []
        self._lock = threading.Lock()
        self._spark, self._log, self._flush_every = spark, log, flush_every

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        took = p.durationMs or {}
        report = (p.name, p.batchId, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond,
                  took.get("triggerExecution"), took.get("addBatch"), len(p.stateOperators))
        with self._lock:
            self._reports.append(report)
            full = self._log is not None and len(self._reports) >= self._flush_every
        if full:
            self.flush(self._spark, self._log)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            reports = list(self._reports)
        # A rate that could not be measured is not a number; it shows as NULL.
        return spark.createDataFrame(reports, PROGRESS_SCHEMA).replace(float("nan"), None)

    def flush(self, spark: SparkSession, path: str) -> None:
        """Append the reports to a log. Each is taken by one flush only, and put back if it cannot be stored."""
        with self._lock:
            reports, self._reports = self._reports, []
        if not reports:
            return
        try:
            append_log(spark.createDataFrame(reports, PROGRESS_SCHEMA).replace(float("nan"), None).coalesce(1), path)
        except BaseException:
            with self._lock:
                self._reports = reports + self._reports
            raise
