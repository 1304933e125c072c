"""Streaming sources of wire messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    bootstrap: str,
    topic: str = "stock-ticks",
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    Losing offsets fails the query unless the caller accepts it. ``max_offsets_per_trigger``
    bounds the batches of a backfill; ``min_partitions`` splits large topic partitions, so one
    busy partition is read by several tasks.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def tick_source(
    spark: SparkSession,
    kind: str = "kafka",
    *,
    path: str | None = None,
    max_files_per_trigger: int | None = None,
    **kafka: object,
) -> DataFrame:
    """An unbounded DataFrame with the message in its ``value`` column.

    ``kind="kafka"`` takes the arguments of :func:`kafka_options`; ``kind="files"`` reads text
    files (one message per line) that appear below ``path``.
    """
    if kind == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(**kafka)).load()
    if kind == "files":
        if path is None:
            raise ValueError("a file source needs a path")
        reader = spark.readStream
        if max_files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.text(path)
    raise ValueError(f"kind must be 'kafka' or 'files', not {kind!r}")
