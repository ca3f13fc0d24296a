"""Continuous delivery: bronze files arriving in a directory, batch by batch."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import Future
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.marks import from_micros, to_micros
from tidemark.operators.merge import EVENT_TIME
from tidemark.plans.batch import BatchWindow, append_audit, progress
from tidemark.plans.layers import SLICE, process
from tidemark.spec import Lake

CADENCE = "5 minutes"


def _now(_epoch_id: int) -> datetime:
    return datetime.now(timezone.utc)


def run_stream(
    spark: SparkSession,
    lake: Lake,
    arrivals: str,
    schema: T.StructType,
    checkpoint: str,
    *,
    available_now: bool = False,
    cadence: str = CADENCE,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    max_file_age: str | None = None,
    archive: str | None = None,
    gold_mode: str = SLICE,
    merge_order: str = EVENT_TIME,
    clock: Callable[[int], datetime] = _now,
) -> StreamingQuery:
    """Start a query that runs each new set of files in ``arrivals`` through the
    layers, one batch at a time.

    ``available_now`` takes what is there and stops; otherwise a batch starts
    every ``cadence``. The checkpoint remembers which files were delivered, and an
    epoch already in the audit table is not run again. Nothing is dropped as late:
    batches are cut by arrival, groups by event day. ``arrivals`` must be a
    directory that only gains files, not a table that upserts rewrite.

    What a trigger takes can be limited by files or bytes. With ``archive``, a
    folder outside ``arrivals``, files are moved there once a later epoch begins, so the
    listing stays short. Spark forgets files older than ``max_file_age`` (its default: a
    week) than the newest, and takes none as old as that.
    """

    # The id lives in the checkpoint: a stream started over counts epochs anew.
    stream_id: Future[str] = Future()

    def deliver(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        epoch = (stream_id.result(), epoch_id)
        before = progress(session, lake, epoch[0])
        if before.epoch is not None and before.epoch >= epoch_id:
            return
        started = time.monotonic()
        begin = before.commit_us or 0
        # Always past the last commit, even if the clock stood still or went back.
        window = BatchWindow(begin, max(to_micros(clock(epoch_id)), begin + 1))
        counts = process(
            session,
            lake,
            batch,
            window,
            as_of=from_micros(window.end_us),
            gold_mode=gold_mode,
            merge_order=merge_order,
        )
        # The stream read arrivals, not bronze, whose mark stays where it is.
        seconds = time.monotonic() - started
        append_audit(session, lake, window, counts, seconds, epoch, window.end_us, before.mark_us or 0)

    source = spark.readStream.schema(schema)
    options = {
        "maxFilesPerTrigger": max_files_per_trigger,
        "maxBytesPerTrigger": max_bytes_per_trigger,
        "maxFileAge": max_file_age,
        "cleanSource": archive and "archive",
        "sourceArchiveDir": archive,
    }
    for name, value in options.items():
        if value is not None:
            source = source.option(name, value)
    trigger = {"availableNow": True} if available_now else {"processingTime": cadence}
    query = (
        source.parquet(arrivals)
        .writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    stream_id.set_result(query.id)
    return query
