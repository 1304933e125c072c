"""Removal of long byte strings that occur more than once in a collection.

Column-wise construction, one symbol of every member a round, as for the Burrows-Wheeler transform of a
collection with its common prefixes. A round over all documents would be a job for each column, so
members are the places around shared anchors: every string of the given length holds an anchor (the
smallest of its 64-byte hashes), at the same place in each copy. The places of one anchor form a
group; each round inserts the next symbol to the right, or to the left, of every member, which
refines their order and tells how far their common context goes. A window around an anchor is
repeated if another member shares both its left and its right part.

Places whose whole surroundings are equal are settled by counting, so that copies cost a row each, and
an anchor with very many different surroundings has its windows counted instead of grouped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stage
from .text_blocks import Block, SpanHash, blocks, column_of, covered, mix

LENGTH, ANCHOR = 400, 64
#: An anchor with more different surroundings than this has its windows counted one by one.
GROUP_MEMBERS = 16_384
#: Members whose columns are inserted together.
ROUND_MEMBERS = 6_000
_DOC = ["doc", "text_key"]


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a key: rows of equal id and text share it, as they share their result."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1).cast("bigint"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).withColumns(
        {"doc": own, "text_key": F.xxhash64("text")}
    )


def anchors_of(block: Block, hashes: SpanHash, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of each anchor of a block, and its hash: the last smallest one of each string of ``length`` bytes."""
    size = len(block.data)
    begin = np.arange(max(size - ANCHOR + 1, 0))
    grams = hashes(begin, begin + ANCHOR)
    width = length - ANCHOR + 1
    if len(grams) < width:
        return begin[:0], grams[:0]
    order = (grams >> np.uint64(32) << np.uint64(32)) | np.uint64(0xFFFFFFFF) - begin.astype(np.uint64)
    padded = np.full(-(-len(order) // width) * width, np.uint64(2**64 - 1))
    padded[: len(order)] = order
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[: len(order) - width + 1], before[width - 1 : len(order)])
    owner = np.searchsorted(block.offsets, begin[: len(least)], "right") - 1
    whole = begin[: len(least)] + length <= block.offsets[owner + 1]
    at = np.unique((np.uint64(0xFFFFFFFF) - (least[whole] & np.uint64(0xFFFFFFFF))).astype(np.int64))
    return at, grams[at]


def find_anchors(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``anchor, around, doc, text_key, at, size``: anchors, a hash of all windows around each, and where they are."""
    reach = length - ANCHOR

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [column_of(batch, c).to_numpy() for c in _DOC]
            for block in blocks(column_of(batch, "text"), 2_000_000):
                hashes = SpanHash(block.data)
                at, grams = anchors_of(block, hashes, length)
                text = np.searchsorted(block.offsets, at, "right") - 1
                first, last = block.offsets[text], block.offsets[text + 1]
                low, high = np.maximum(at - reach, first), np.minimum(at + length, last)
                around = mix(hashes(low, high) + (at - low).astype(np.uint64))
                columns = [grams.view(np.int64), around.view(np.int64), *(c[block.first + text] for c in own)]
                columns += [(at - first).astype(np.int32), (last - first).astype(np.int32)]
                names = ["anchor", "around", *_DOC, "at", "size"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    schema = "anchor bigint, around bigint, doc bigint, text_key bigint, at int, size int"
    return docs.select(*_DOC, "text").mapInArrow(find, schema)


def _columns(symbols: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Classes of members after each round, [round, member]: equal if group and all symbols so far are.

    Round by round the next symbol of every member (-1 past its end) is inserted into the order of the
    members so far. A member that differs from all others leaves: its class is -1 from then on.
    """
    rounds, members = symbols.shape
    out = np.full((rounds + 1, members), -1, dtype=np.int32)
    active = np.arange(members)
    order = np.unique(group, return_inverse=True)[1]
    for depth in range(rounds + 1):
        if depth:
            symbol = symbols[depth - 1, active]
            active, order = active[symbol >= 0], order[symbol >= 0]
            key = order * 256 + symbol[symbol >= 0]
        else:
            key = order
        order, counts = np.unique(key, return_inverse=True, return_counts=True)[1:]
        shared = counts[order] > 1
        active, order = active[shared], order[shared]
        if not len(active):
            break
        out[depth, active] = order
    return out


def repeated_windows(group: np.ndarray, texts: list[bytes], left: np.ndarray, length: int) -> np.ndarray:
    """Which windows of ``length`` bytes recur in their group, [bytes of the window left of the anchor, member].

    ``texts``: what surrounds each member's anchor; ``left`` of its bytes stand before it.
    """
    reach, members = length - ANCHOR, len(texts)
    before = np.full((reach, members), -1, dtype=np.int16)
    after = np.full((length, members), -1, dtype=np.int16)
    for i, (text, cut) in enumerate(zip(texts, left.tolist())):
        own = np.frombuffer(text, dtype=np.uint8)
        before[:cut, i] = own[:cut][::-1]
        after[: len(own) - cut, i] = own[cut:]
    to_left, to_right = _columns(before, group), _columns(after, group)
    out = np.zeros((reach + 1, members), dtype=bool)
    for cut in range(reach + 1):
        a, b = to_left[cut], to_right[length - cut]
        both = np.flatnonzero((a >= 0) & (b >= 0))
        if len(both):
            which, counts = np.unique(a[both].astype(np.int64) << 32 | b[both], return_inverse=True, return_counts=True)[1:]
            out[cut, both] = counts[which] > 1
    return out


def _surroundings(needed: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes around each of ``needed`` (``anchor, doc, text_key, at``), from whole texts."""
    reach = length - ANCHOR
    listed = needed.groupBy(*_DOC).agg(F.collect_list(F.struct("anchor", "at")).alias("places"))
    joined = docs.select(*_DOC, "text").join(listed, _DOC)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, key, text, places in zip(*(column_of(batch, c) for c in (*_DOC, "text", "places"))):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for place in places.as_py():
                    at = place["at"]
                    low = max(at - reach, 0)
                    rows.append((place["anchor"], doc.as_py(), key.as_py(), at, at - low, data[low : at + length]))
                if len(rows) >= 10_000:
                    yield _places(rows)
                    rows = []
            yield _places(rows)

    return joined.mapInArrow(cut, "anchor bigint, doc bigint, text_key bigint, at bigint, cut bigint, around binary")


def _places(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 6
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, ["anchor", *_DOC, "at", "cut", "around"])


def _grouped_spans(places: DataFrame, length: int) -> DataFrame:
    """``doc, text_key, low, high`` of repeated windows among the places of each anchor."""

    def rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                rest.append(whole.slice(at, 1_000))
                if sum(b.num_rows for b in rest) >= ROUND_MEMBERS:
                    table = pa.Table.from_batches(rest)
                    anchor = table["anchor"].to_numpy()
                    last = int(np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))[-1])
                    if last:
                        yield _spans_of(table.slice(0, last), length)
                        rest = table.slice(last).to_batches()
        if rest:
            yield _spans_of(pa.Table.from_batches(rest), length)

    dealt = places.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(rounds, "doc bigint, text_key bigint, low bigint, high bigint")


def _spans_of(table: pa.Table, length: int) -> pa.RecordBatch:
    cut = table["cut"].to_numpy()
    found = repeated_windows(table["anchor"].to_numpy(), table["around"].to_pylist(), cut, length)
    at = table["at"].to_numpy()
    # Runs of windows that begin one byte after the other make one span.
    closed = np.zeros((1, found.shape[1]), dtype=bool)
    steps = np.diff(np.concatenate([closed, found, closed]).astype(np.int8), axis=0)
    begin, first = np.nonzero((steps == 1).T)
    end, last = np.nonzero((steps == -1).T)
    # Sorted by member, then by bytes to the left: the k-th opening and closing belong together.
    member, most, least = begin, last - 1, first
    low, high = at[member] - most, at[member] - least + length
    columns = [table[c].to_numpy()[member] for c in _DOC] + [low, high]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*_DOC, "low", "high"])


def _counted_spans(places: DataFrame, length: int) -> DataFrame:
    """As :func:`_grouped_spans`, by counting every window of every place: no group, only sums."""
    reach = length - ANCHOR

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                rows: list[list[np.ndarray]] = []
                columns = [column_of(batch, c).to_numpy() for c in ("anchor", *_DOC, "at", "cut")]
                for anchor, doc, key, at, cut, around in zip(*columns, column_of(batch, "around")):
                    data = np.frombuffer(around.as_buffer(), dtype=np.uint8)
                    begin = np.arange(max(cut - reach, 0), min(cut, len(data) - length) + 1)
                    n = len(begin)
                    own = [np.full(n, anchor, np.int64), np.full(n, doc, np.int64), np.full(n, key, np.int64)]
                    # With the anchor's place: a window that holds the anchor twice is still one window.
                    own_hash = mix(SpanHash(data)(begin, begin + length) + (cut - begin).astype(np.uint64))
                    rows.append([*own, at - cut + begin, own_hash.view(np.int64)])
                flat = [np.concatenate(c) for c in zip(*rows)] if rows else []
                if not flat:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in flat], ["anchor", *_DOC, "low", "window"])

    schema = "anchor bigint, doc bigint, text_key bigint, low bigint, window bigint"
    table = stage(places.mapInArrow(windows, schema), "windows")
    several = table.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = table.join(several, ["anchor", "window"], "left_semi")
    return found.select(*_DOC, "low", (F.col("low") + length).alias("high"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, group_members: int = GROUP_MEMBERS) -> DataFrame:
    """``doc, text_key, low, high``: byte spans that repeated strings of ``length`` bytes cover, in parts that overlap."""
    reach = length - ANCHOR
    every = stage(find_anchors(docs, length), "anchors")
    # Sides that a join has in groups are written first: of two shuffled scans, Spark can split a hot anchor.
    twice = stage(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "twice")
    places = stage(every.join(twice, "anchor", "left_semi"), "shared-anchors")
    same = places.groupBy("anchor", "around").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*_DOC, "at")).alias("first")
    )
    surroundings = stage(same, "surroundings")

    settled = places.join(surroundings.where("n > 1").select("anchor", "around"), ["anchor", "around"], "left_semi")
    low = F.greatest(F.col("at") - reach, F.lit(0))
    spans = settled.select(*_DOC, low.alias("low"), F.least(F.col("at") + length, F.col("size")).alias("high"))

    several = surroundings.groupBy("anchor").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    several = stage(several, "several")
    needed = stage(surroundings.join(several, "anchor").select("anchor", "first.*", "members"), "places")
    few = needed.where(F.col("members") <= group_members)
    spans = spans.unionByName(_grouped_spans(_surroundings(few, docs, length), length))
    many = needed.where(F.col("members") > group_members)
    if not many.isEmpty():
        spans = spans.unionByName(_counted_spans(_surroundings(many, docs, length), length))
    return stage(spans, "repeated")


def without_repeats(docs: DataFrame, length: int = LENGTH, group_members: int = GROUP_MEMBERS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left) of each row of ``docs`` (``doc_id, text``).

    Removed is each byte that a string of ``length`` bytes covers which also starts anywhere else in the
    collection, in the same text too; every occurrence goes, and strings are judged on the input. NULL
    counts as empty; no match reaches from one text into another. Equal rows, also with NULL ids, are
    separate documents, and so repeat each other. Other columns are ignored.
    """
    rows = keyed(docs)
    spans = repeated_spans(rows, length, group_members)
    listed = spans.groupBy(*_DOC).agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    joined = rows.join(listed, _DOC, "left").select("doc_id", "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                out: list[list] = [[], [], [], []]
                for text, own in zip(column_of(batch, "text"), column_of(batch, "spans")):
                    data = text.as_py().encode("utf-8", "surrogatepass")
                    n, removed, runs = len(data), 0, 0
                    if own.is_valid:
                        low, high = (own.values.field(i).to_numpy() for i in (0, 1))
                        gone = covered(low, high, n)
                        removed, runs = int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                        data = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                    for column, value in zip(out, (n, removed, runs, data)):
                        column.append(value)
                columns = [column_of(batch, "doc_id")] + [pa.array(c, pa.int64()) for c in out[:3]]
                columns.append(pa.array(out[3], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(remove, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")

