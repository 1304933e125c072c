"""Appends of micro-batches that are exactly once without a log of all files.

Each attempt at a batch writes to directories of its own, named after the query's checkpoint, the batch and
the attempt, below the other partition directories. It counts from the moment its record is created
(``sources.commits``), so a reader sees a batch whole or not at all, also where an attempt died half way; a batch
that is run again finds its record, or makes another attempt. Another checkpoint has another id, so
counting from 0 again replaces nothing. Readers drop the name: ``read_ticks``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sinks import PLACED_BY_TASKS
from ..schema import BATCH_COL
from ..sources.commits import publish_batch


def place_batch(rows: DataFrame, path: str, attempt: str, partition_cols: Sequence[str] = ()) -> None:
    """Write the files of an attempt. Tasks put them in place as they end; the driver moves nothing."""
    (
        rows.withColumn(BATCH_COL, F.lit(attempt))
        .write.mode("append")
        .options(**PLACED_BY_TASKS)
        .partitionBy(*partition_cols, BATCH_COL)
        .parquet(path)
    )


def write_batch(rows: DataFrame, path: str, batch: str, partition_cols: Sequence[str] = ()) -> None:
    """Append and publish the rows of a batch, unless it is published. One stream writes to a root at a time."""
    publish_batch(
        rows.sparkSession, path, batch, lambda attempt: place_batch(rows, path, attempt, partition_cols)
    )


def start_batches(
    stream: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, str, int], None],
    trigger: str | None,
    available_now: bool,
    mode: str = "append",
    query_name: str | None = None,
) -> StreamingQuery:
    """Run ``each(rows, batch name, batch id)`` for every micro-batch."""
    known: list[str] = []

    def run(rows: DataFrame, batch_id: int) -> None:
        if not known:
            # Spark keeps the id of a query in its checkpoint, so it outlives restarts.
            kept = rows.sparkSession.read.text(f"{checkpoint}/metadata").first().value
            known.append(json.loads(kept)["id"])
        each(rows, f"{known[0]}-{batch_id}", batch_id)

    writer = stream.writeStream.outputMode(mode).foreachBatch(run).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
