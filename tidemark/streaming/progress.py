"""What a stream did, trigger by trigger, kept as a table."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions.marks import wall_to_micros
from tidemark.spec import PROGRESS_SPEC, Lake


class ProgressLog(StreamingQueryListener):
    """Appends a row per trigger that read rows to the lake's ``stream_progress``: when it
    started, what it read (a row counts each time a batch is read) and how long it took. Spark tells listeners afterwards, so a
    driver lost at once leaves a gap; the audit, not this table, says what is done."""

    def __init__(self, spark: SparkSession, lake: Lake) -> None:
        self._spark, self._path = spark, lake.path(lake.progress_table)
        self._ended: dict[str, threading.Event] = {}

    def _end_of(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        seen = event.progress
        if not seen.numInputRows:
            return
        durations = dict(seen.durationMs)
        row = (str(seen.id), str(seen.runId), seen.batchId, seen.timestamp, seen.numInputRows, durations.get("triggerExecution"))
        started = wall_to_micros(F.to_timestamp_ntz(F.regexp_replace("at", "Z$", "")))
        (
            self._spark.createDataFrame([row], "stream_id string, run_id string, epoch_id long, at string, input_rows long, millis long")
            .select(
                "stream_id", "run_id", "epoch_id", started.alias("trigger_us"), "input_rows", "millis",
                F.substring("at", 1, 10).alias("trigger_date"),
            )
            .coalesce(1)
            .write.mode("append")
            .partitionBy(*PROGRESS_SPEC.partition_fields)
            .parquet(self._path)
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Until everything about a finished query is written."""
        return self._end_of(str(query.runId)).wait(seconds)
