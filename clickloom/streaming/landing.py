"""Landing a stream of events in numbered batches."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.schema import BATCH_SIZE
from clickloom.sources.landed import BATCHES_PER_SLICE
from clickloom.sources.landed import land as land_step
from clickloom.streaming.progress import stop_when_idle, with_counts


#: The column with the text of a broken message, where a stream has one.
BAD_COLUMN = "bad_message"


def land_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    order_by: Sequence[str] = ("partition", "offset"),
    size: int = BATCH_SIZE,
    batches_per_slice: int = BATCHES_PER_SLICE,
    processing_time: str | None = None,
    bad_path: str | None = None,
    idle_stop: float | None = None,
) -> StreamingQuery:
    """Start a query that lands ``stream`` below ``path`` and return it.

    Batches have exactly ``size`` rows however the source cuts its micro-batches: numbering
    goes on where the table ends, and a batch that a micro-batch leaves unfinished is
    filled by the next. Within a micro-batch rows are taken in ``order_by`` order. A
    restart from ``checkpoint`` repeats at most the last micro-batch, with the same rows
    and numbers, over its own folders. A new checkpoint is a new writer, which goes on
    where the table ends.

    Rows whose ``BAD_COLUMN`` is not null are no events: their text and order columns go to
    ``bad_path``, a folder for each micro-batch, and the landing goes on past them.

    The query takes what the source has and ends; with ``processing_time`` it goes on, until it
    has had no input for ``idle_stop`` seconds if that is given. ``batch_counts`` of the query
    tells how many rows each micro-batch had.
    """
    if BAD_COLUMN in stream.columns and not bad_path:
        raise ValueError(f"a stream with {BAD_COLUMN} needs bad_path")
    started, own = threading.Event(), {"again": True}

    def land(rows: DataFrame, step: int) -> None:
        started.wait()
        writer = f"stream-{own['query'].id}"
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events = rows
            if BAD_COLUMN in rows.columns:
                broken = rows.filter(F.col(BAD_COLUMN).isNotNull()).select(*order_by, BAD_COLUMN)
                if not broken.isEmpty():
                    broken.write.mode("overwrite").parquet(f"{bad_path}/writer={writer}/step={step}")
                events = rows.filter(F.col(BAD_COLUMN).isNull()).drop(BAD_COLUMN)
            if not events.isEmpty():
                land_step(events, path, order_by, size, writer, step, batches_per_slice, again=own["again"])
            own["again"] = False  # only what a run begins with may have been tried before
        finally:
            rows.unpersist()

    trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
    counted = with_counts(stream, BAD_COLUMN if BAD_COLUMN in stream.columns else None)
    own["query"] = (
        counted.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    started.set()
    if idle_stop is not None:
        stop_when_idle(own["query"], stream.sparkSession.streams, idle_stop)
    return own["query"]
