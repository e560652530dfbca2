"""State and history of streams (STM3)."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "name string, batch_id bigint, started string, input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, duration_ms bigint"
)
LOG = f"query_id string, run_id string, {PROGRESS}, state_rows bigint, watermark string"


def status_of(query: StreamingQuery) -> dict:
    """Message and activity flags, and the last progress entry or None."""
    last = query.lastProgress
    return {**query.status, "is_running": query.isActive, "last_batch": last["batchId"] if last else None}


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch. Spark keeps a bounded number of them; a `ProgressLog` keeps all."""
    rows = [
        (
            p["name"],
            p["batchId"],
            p["timestamp"],
            p["numInputRows"],
            float(p["inputRowsPerSecond"]),
            float(p["processedRowsPerSecond"]),
            int(p["durationMs"].get("triggerExecution", 0)),
        )
        for p in query.recentProgress
    ]
    return spark.createDataFrame(rows, PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Writes a row for every micro-batch of the session's streams to a folder.

    Spark tells a listener about every batch, however many it keeps itself. Entries are written
    `every` batches and when a stream ends, each time as one small file, so the log outlives the
    session; what a lost driver had not written yet is missing. Use as a context, or call `begin`
    and `end`.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 1):
        self.spark, self.path, self.every = spark, path, every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def begin(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def end(self) -> None:
        self.spark.streams.removeListener(self)
        self._write()

    __enter__ = begin

    def __exit__(self, *_) -> None:
        self.end()

    def _end_of(self, run_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def _write(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (
            str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, p.numInputRows, float(p.inputRowsPerSecond),
            float(p.processedRowsPerSecond), int(p.durationMs.get("triggerExecution", 0)),
            sum(s.numRowsTotal for s in p.stateOperators), p.eventTime.get("watermark"),
        )
        with self._lock:
            self._rows.append(row)
            due = len(self._rows) >= self.every
        if due:
            self._write()

    def onQueryTerminated(self, event) -> None:
        self._write()
        self._end_of(event.runId).set()

    def settled(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all entries of a stream that has ended are written; entries arrive a little behind it."""
        return self._end_of(query.runId).wait(seconds)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The log, a row for each stream and batch: the last entry where a batch was run again."""
    last = Window.partitionBy("query_id", "batch_id").orderBy(F.desc("started"), F.desc("run_id"))
    stored = spark.read.schema(LOG).parquet(path)
    return stored.withColumn("__rank", F.row_number().over(last)).where("__rank = 1").drop("__rank")
