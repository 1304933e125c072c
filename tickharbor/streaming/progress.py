"""What a stream's batches held and how long they took, kept as a table.

``observe_messages`` adds counts to a stream, which Spark gathers while the batch is processed anyway; a
listener writes each batch's report to a small file of its own, created exclusively under the batch's number. A batch
that is run again after a restart has its number again, so it is in the table once.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import DoubleType

from ..functions.times import event_time
from ..sources.paths import create_small

OBSERVED = "ingest"

_PROGRESS_SCHEMA = (
    "query string, batch bigint, started timestamp, seconds double, n_messages bigint, n_bad bigint, "
    "oldest_ts timestamp, newest_ts timestamp"
)


def observe_messages(judged: DataFrame) -> DataFrame:
    """Count what :func:`judge_messages` returned, batch by batch; times are those of good messages."""
    good_time = F.when(F.col("reason").isNull(), event_time(F.col("tick.timestamp"), DoubleType()))
    return judged.observe(
        OBSERVED,
        F.count(F.lit(1)).alias("n_messages"),
        F.count("reason").alias("n_bad"),
        F.unix_micros(F.min(good_time)).alias("oldest"),
        F.unix_micros(F.max(good_time)).alias("newest"),
    )


class _Recorder(StreamingQueryListener):
    """Writes reports of observed batches; others are left alone."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder
        self._running: set[str] = set()
        self._changed = threading.Condition()
        self.error: Exception | None = None

    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(OBSERVED)
        if seen is None or not progress.numInputRows:
            return
        try:
            report = {
                "query": str(progress.id), "batch": progress.batchId, "started": progress.timestamp,
                "seconds": progress.durationMs.get("triggerExecution", 0) / 1000,
                "n_messages": seen.n_messages, "n_bad": seen.n_bad,
                "oldest_ts": _instant(seen.oldest), "newest_ts": _instant(seen.newest),
            }
            name = f"{progress.id}-{progress.batchId:012d}.json"
            create_small(self._spark, f"{self._folder}/{name}", json.dumps(report))
        except Exception as error:  # a listener's errors are only logged, so the caller is told at the end
            self.error = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._running.discard(str(event.runId))
            self._changed.notify_all()

    def wait(self, seconds: float) -> bool:
        """Whether the reports of all queries that have been started here are written."""
        with self._changed:
            return self._changed.wait_for(lambda: not self._running, seconds)


def _instant(micros: int | None) -> str | None:
    if micros is None:
        return None
    return (dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)).isoformat()


@contextmanager
def recorded_progress(spark: SparkSession, folder: str, timeout: float = 60.0) -> Iterator[None]:
    """Record the batches of the streams that start, and stop, within the block. Spark reports them a little later than
    it ends them, so leaving the block waits for that, ``timeout`` seconds at most."""
    recorder = _Recorder(spark, folder)
    spark.streams.addListener(recorder)
    try:
        yield
        if not recorder.wait(timeout):
            raise TimeoutError(f"streams still run, or their last reports did not come within {timeout} seconds")
        if recorder.error is not None:
            raise recorder.error
    finally:
        spark.streams.removeListener(recorder)


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """A row per batch; ``lag_seconds`` is from its newest good tick to the end of the batch."""
    ended = F.unix_micros("started") / 1e6 + F.col("seconds")
    kept = spark.read.schema(_PROGRESS_SCHEMA).json(folder)
    return kept.withColumn("lag_seconds", ended - F.unix_micros("newest_ts") / 1e6)
