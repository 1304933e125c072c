"""WARC archives of pages, and an index of their captures merged from sorted runs.

Archives are text output with CRLF CRLF as the separator, so that Spark's writer commits them on any
file system. Reading gives one locally sorted run of index rows for each archive; the runs are dealt
out by ranges of (URL key, timestamp), and each range merges its pieces of the runs with a loser
tree, which leaves globally ordered capture histories.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_path, stage
from .text_blocks import column_of

ARCHIVE_BYTES = 16 << 20
REVISIT_BYTES = 100
_INDEX = (
    "url_key string, captured_at string, page_id bigint, record_id string, url string, payload_bytes bigint, "
    "payload_digest string, archive string, record_no bigint"
)
_TYPED = _INDEX + ", record_type string, refers_to bigint"
_ORDER = ["url_key", "captured_at", "page_id", "archive", "record_no"]


def _header(value: Column) -> Column:
    """A header value: line breaks and other control characters become spaces."""
    return F.regexp_replace(value, r"[\x00-\x1F\x7F]", " ")


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a response record for each row of ``pages`` (``page_id, url, html``) below ``path``.

    The payload is the html in UTF-8, NULL as the empty one. Pages have no capture time: second
    ``page_id`` of 2024 stands for it. Rows are dealt evenly over gzipped files of about
    ``archive_bytes``; a page is never split. Equal rows give equal records, columns besides the three
    are ignored, and no rows give an archive without records.
    """
    html = F.coalesce("html", F.lit(""))
    size = pages.agg(F.sum(F.octet_length(html) + 400)).first()[0] or 0
    second = F.timestamp_seconds(F.lit(1704067200) + F.coalesce(F.col("page_id"), F.lit(0)) % (366 * 86400))
    eol = F.lit("\r\n")
    record = F.concat_ws(
        "",
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Date: "),
        F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), second.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        eol,
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), _header(F.col("url")), eol)),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
        html,
    )
    dealt = pages.repartition(int(size // archive_bytes) + 1).select(record.alias("record"))
    dealt.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of each record, by content length: payloads may hold anything."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        payload = stream.read(length)
        if len(payload) < length:
            raise ValueError("the archive ends inside a record")
        yield headers, payload


def url_key(url: str | None) -> str:
    """Host labels from the right, then path and query: ``com,example)/a?b``; NULL sorts first."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
    except ValueError:
        return url
    labels = host.removeprefix("www.").split(".")[::-1]
    return ",".join(labels) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def read_index_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index rows of all archives below ``path``, each archive's sorted: the runs to be merged."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(column_of(batch, "path"), column_of(batch, "content")):
                archive = name.as_py().rsplit("/", 1)[-1]
                rows = []
                with gzip.open(io.BytesIO(content.as_buffer())) as stream:
                    for number, (headers, payload) in enumerate(records(stream)):
                        page = headers["warc-record-id"].rpartition(":")[2].rstrip(">")
                        url = headers.get("warc-target-uri")
                        rows.append(
                            (url_key(url), headers["warc-date"], int(page) if page != "none" else None,
                             headers["warc-record-id"], url, len(payload),
                             hashlib.sha256(payload).hexdigest(), archive, number)
                        )
                rows.sort(key=_capture)
                yield _index_batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(parse, _INDEX)


def _capture(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[7], row[8]


def _index_batch(rows: list[tuple], schema: str = _INDEX) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = [pa.int64() if field.endswith("bigint") else pa.string() for field in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the root's winner is next."""

    def __init__(self, runs: Iterable[Iterable[tuple]]):
        self._runs = [iter(run) for run in runs]
        self._heads = [next(run, None) for run in self._runs]
        n = len(self._runs)
        self._losers = [-1] * n
        for leaf in range(n):
            self._replay(leaf, first=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        return y is None or (x is not None and (_capture(x), a) <= (_capture(y), b))

    def _replay(self, winner: int, first: bool = False) -> None:
        node = (winner + len(self._runs)) // 2
        while node:
            other = self._losers[node]
            if other < 0 and first:  # the first to arrive waits for its opponent
                self._losers[node] = winner
                return
            if not self._beats(winner, other):
                self._losers[node], winner = winner, other
            node //= 2
        self._losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self._runs and (head := self._heads[winner := self._losers[0]]) is not None:
            yield head
            self._heads[winner] = next(self._runs[winner], None)
            self._replay(winner)


def merge_runs(index: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows of all runs in one global order of URL key, timestamp and page.

    ``index`` has the columns of :func:`read_index_runs`, and those of :func:`typed_runs` or not. Ranges
    are cut on the whole order, not on the URL, so that a host or page with many captures spreads over
    several of them. Each range holds its piece of every run; a run that a join has dealt anew is sorted again.
    """
    schema = _TYPED if "record_type" in index.columns else _INDEX
    index = index.select(*[field.split()[0] for field in schema.split(", ")])
    spark = index.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                runs.setdefault(row[7], []).append(row)
        for run in runs.values():
            run.sort(key=_capture)  # no work on a run that came in order
        out = []
        for row in LoserTree(runs.values()):
            out.append(row)
            if len(out) == 10_000:
                yield _index_batch(out, schema)
                out = []
        yield _index_batch(out, schema)

    return index.repartitionByRange(count, *_ORDER).mapInArrow(merge, schema)


def typed_runs(runs: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``runs``, a table that can be read twice, with ``record_type`` and ``refers_to``, in any order."""
    firsts = (
        runs.where(F.col("payload_bytes") >= revisit_bytes)
        .groupBy(F.col("payload_digest").alias("first_digest"))
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    revisit = F.col("page_id") > F.col("first_page")
    return (
        runs.join(firsts, F.col("payload_digest") == F.col("first_digest"), "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first_page")))
        .drop("first_digest", "first_page")
    )


def capture_histories(spark: SparkSession, path: str, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """The index of the archives below ``path`` with ``record_type`` and ``refers_to``, in one global order.

    Of records with equal payloads of at least ``revisit_bytes`` the one with the smallest ``page_id`` is
    the response and the others revisit it; shorter ones, and rows without a ``page_id``, are responses.
    A ``page_id`` that occurs twice with equal payload is a response each time. The merge comes last, so
    rows and what is written of them are ordered whatever join finds the types.
    """
    runs = stage(read_index_runs(spark, path), "warc-runs")
    return merge_runs(typed_runs(runs, revisit_bytes))


def archive_and_index(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, read them back, and return their histories."""
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return capture_histories(spark, path)
