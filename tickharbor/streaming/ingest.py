"""Exactly-once appends of ticks to the raw root."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.parsing import judge_messages, split_judged, with_time_partitions
from ..operators.sinks import gather_partitions
from ..schema import PARTITION_COLS
from .batches import start_batches, write_batch
from .progress import observe_messages
from .repeats import without_repeats

# Fixed value: the cadence at which new files appear in the raw root.
TRIGGER = "30 seconds"


def _append(rows: DataFrame, path: str, batch: str, partition_cols: Sequence[str], spread: int | None) -> None:
    if spread is not None and partition_cols:
        rows = gather_partitions(rows, partition_cols, spread)
    write_batch(rows, path, batch, partition_cols)


def write_tick_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_cols: Sequence[str] = PARTITION_COLS,
    trigger: str | None = TRIGGER,
    available_now: bool = False,
    query_name: str | None = None,
    spread: int | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet table and return the running query.

    ``trigger=None`` starts the next batch as soon as the last one is done;
    ``available_now`` processes what is there, in bounded batches, and stops. After a restart from
    the same checkpoint nothing is missing and nothing is there twice, and readers see batches whole: see ``batches``.

    Live data needs no shuffle before the write: it is all in the current hour, and the small
    files are what compaction is for. A backfill has many hours in each batch, and every task
    would open a file in all of them: there, ``spread`` first brings the rows of an hour into at
    most that many tasks.
    """
    return start_batches(
        stream,
        checkpoint,
        lambda rows, batch, _: _append(rows, path, batch, partition_cols, spread),
        trigger,
        available_now,
        query_name=query_name,
    )


def ingest_ticks(
    messages: DataFrame,
    raw: str,
    quarantine: str,
    checkpoints: str,
    value_col: str = "value",
    trigger: str | None = TRIGGER,
    available_now: bool = False,
    spread: int | None = None,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Run the whole ingest: good ticks to ``raw`` by hour, bad messages to ``quarantine``.

    ``repeats_within`` drops messages that were delivered before within that time (``repeats``); within
    ``progress.recorded_progress`` the counts of each batch are kept as a table.

    Each batch is read and parsed once and kept, on disk where memory is short, until both sides are
    written; what a lost executor held of it is read again from the source.
    """

    def both(rows: DataFrame, batch: str, _: int) -> None:
        judged = rows.persist()
        try:
            good, bad = split_judged(judged)
            _append(with_time_partitions(good), raw, batch, PARTITION_COLS, spread)
            _append(bad, quarantine, batch, (), None)
        finally:
            judged.unpersist()

    if repeats_within is not None:
        messages = without_repeats(messages, repeats_within, [value_col])
    judged = observe_messages(judge_messages(messages, value_col))
    return start_batches(judged, f"{checkpoints}/ingest", both, trigger, available_now)
