"""Benchmark decontamination with a positional inverted index over the training texts.

The index holds, for each segment (consecutive documents of one task), the word positions of every
term. Benchmark windows are looked up by intersecting the lists of their terms, shifted by the
term's place in the window, from the rarest term on; what is left are exact phrase matches. Proximity
matches start from the places of the rarest terms too, and count the others around them. A
document is never split over segments, so every segment answers for itself and no text is shuffled;
the windows are a table that is joined to the lists, and never in the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stage
from .text_blocks import LETTERS, Block, SpanHash, blocks, column_of, member, spans

WINDOW = 10
SEGMENT_WORDS = 1_500_000
#: A proximity match lies within so many words, and may lack one in so many of the distinct words of a window.
REACH, MISSING_ONE_IN = 15, 5
#: So many windows at most meet a segment at once.
WINDOWS_TOGETHER = 50_000
_INDEX = "segment bigint, term bigint, n bigint, postings binary"
_NOWHERE = np.zeros(0, dtype=np.int64)
_KINDS = {"item_ids": "exact", "near_item_ids": "NOT exact"}


def term_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block, and the first word of each text (one more at the end)."""
    block = block.lowered()
    starts, ends, firsts = spans(block, LETTERS)
    return SpanHash(block.data)(starts, ends).view(np.int64), firsts


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers in seven-bit bytes, the last of each below 128; where each one begins."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), dtype=np.int64)
    for k in range(1, 6):
        sizes += values >= np.uint64(1 << (7 * k))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(begins[-1], dtype=np.uint8)
    for k in range(6):
        has = np.flatnonzero(sizes > k)
        if not len(has):
            break
        more = (sizes[has] > k + 1).astype(np.uint8) << 7
        out[begins[has] + k] = ((values[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
    return out, begins


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw < 128)
    begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    place = np.arange(len(raw)) - np.repeat(begins, ends - begins + 1)
    parts = (raw & 127).astype(np.int64) << (7 * place)
    return np.add.reduceat(parts, begins) if len(begins) else parts


def _segment_rows(number: int, ids: list, terms: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A segment's lists, one row a term; the row without a term lists its documents."""
    order = np.argsort(terms, kind="stable")
    ordered = terms[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(terms) else np.zeros(0, int)
    gaps = np.diff(order, prepend=0)
    gaps[heads] = order[heads]
    data, begins = pack(gaps)
    documents = pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(counts, pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as writer:
        writer.write_table(documents)
    own = sink.getvalue().to_pybytes()
    bounds = np.concatenate([[0], begins[np.append(heads[1:], len(gaps))] if len(heads) else [], [len(data) + len(own)]])
    lists = pa.Array.from_buffers(
        pa.binary(), len(heads) + 1,
        [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes() + own)],
    )
    sizes = np.append(np.diff(np.append(heads, len(gaps))), len(ids)).astype(np.int64)
    names = pa.array(np.append(ordered[heads], 0), mask=np.append(np.zeros(len(heads), bool), True))
    segment = pa.array(np.full(len(heads) + 1, number, dtype=np.int64))
    return pa.RecordBatch.from_arrays([segment, names, pa.array(sizes), lists], ["segment", "term", "n", "postings"])


def build_index(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The positional index of ``docs`` (``doc_id, text``): ``segment, term, n, postings``.

    Terms are 64-bit hashes of lower-cased words; postings are word positions in the segment as gaps in
    seven-bit bytes. A segment ends with the document that takes it over ``segment_words`` words. NULL
    and empty texts have no words but are listed; a long text is one document of one segment.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        terms: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        words = 0
        for batch in batches:
            own = column_of(batch, "doc_id")
            for block in blocks(column_of(batch, "text")):
                hashes, firsts = term_hashes(block)
                ids += own.slice(block.first, block.size).to_pylist()
                terms.append(hashes)
                counts.append(np.diff(firsts))
                words += len(hashes)
                if words >= segment_words:
                    yield _segment_rows(number, ids, np.concatenate(terms), np.concatenate(counts))
                    number, words, ids, terms, counts = number + 1, 0, [], [], []
        if ids:
            yield _segment_rows(number, ids, np.concatenate(terms), np.concatenate(counts))

    chosen = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return stage(chosen.mapInArrow(build, _INDEX), "postings")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, item_id, terms`` of every window of ``window`` words of ``benchmark`` (``item_id, text``).

    ``item`` numbers the rows. A shorter item is one window; one without words, or NULL, has none.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            own = column_of(batch, "item_id")
            for block in blocks(column_of(batch, "text"), 1 << 18):
                hashes, firsts = term_hashes(block)
                rows = [
                    (number + i, own[block.first + i].as_py(), terms[at : at + window])
                    for i, terms in enumerate(np.split(hashes, firsts[1:-1]))
                    if len(terms)
                    for at in range(max(len(terms) - window, 0) + 1)
                ]
                number += block.size
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
                arrays = [pa.array(c, kind) for c, kind in zip(list(zip(*rows)) or [()] * 3, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["item", "item_id", "terms"])

    chosen = benchmark.selectExpr("CAST(item_id AS BIGINT) AS item_id", "text")
    return stage(chosen.mapInArrow(cut, "item bigint, item_id bigint, terms array<bigint>"), "item-windows")


def ranked_windows(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``item, item_id, window, ranked``: the terms of each window with their places in it, from the rarest on.

    Rare is what the whole index holds least often, so what a segment answers does not depend on the others
    in it; a term that the index does not hold at all comes first.
    """
    numbered = windows.withColumn("window", F.monotonically_increasing_id())
    placed = numbered.select("item", "item_id", "window", F.posexplode("terms").alias("place", "term"))
    used = stage(placed.select("term").distinct(), "item-terms")
    counts = index.join(used, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("total"))
    entry = F.struct(F.coalesce("total", F.lit(0)).alias("total"), "term", "place")
    ranked = placed.join(counts, "term", "left").groupBy("item", "item_id", "window").agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["term"], e["place"])).alias("ranked")
    )
    return stage(ranked, "ranked-windows")


def may_miss(distinct: int) -> int:
    """How many of the distinct terms of a window a proximity match may lack."""
    return distinct // MISSING_ONE_IN


class Segment:
    """Decoded lists of one segment."""

    def __init__(self, rows: pa.Table):
        self.number = rows["segment"][0].as_py()
        documents = next(p for t, p in zip(rows["term"].to_pylist(), rows["postings"]) if t is None)
        listed = pa.ipc.open_stream(documents.as_buffer()).read_all()
        self.firsts = np.concatenate([[0], np.cumsum(listed["n_words"].to_numpy())])
        self.lists = {
            t: np.cumsum(unpack(p.as_py())) for t, p in zip(rows["term"].to_pylist(), rows["postings"]) if t is not None
        }

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, at, "right") - 1

    def phrase(self, terms: list[int], places: list[int]) -> np.ndarray:
        """Where terms stand one after the other in one document; they come with their places, from the rarest on."""
        lists = self.lists
        if any(t not in lists for t in terms):
            return np.zeros(0, np.int64)
        at = lists[terms[0]] - places[0]
        for term, place in zip(terms[1:], places[1:]):
            if not len(at):
                return at
            at = at[member(at + place, lists[term])]
        at = at[at >= 0]
        return at[at + len(terms) <= self.firsts[self.owner(at) + 1]] if len(at) else at

    def near(self, terms: list[int], reach: int, done: set[int]) -> Iterator[tuple[int, int, int]]:
        """Document, first and last word of a match in each document that is not in ``done``, which grows by it.

        A match is a run of at most ``reach`` words of a document that holds all but :func:`may_miss` of the
        distinct ``terms``, which come from the rarest on. It holds one of the rarest but so many, so only
        what stands around these is looked at; a place is given up once too many terms are missing there.
        """
        distinct = list(dict.fromkeys(terms))
        lacking = may_miss(len(distinct))
        lists = [self.lists.get(t, _NOWHERE) for t in distinct]
        at = np.sort(np.concatenate(lists[: lacking + 1]))
        owner = self.owner(at)
        low, high = np.maximum(at - reach + 1, self.firsts[owner]), np.minimum(at + reach, self.firsts[owner + 1])
        missing = np.zeros(len(at), dtype=np.int64)
        for own in lists:
            if not len(at):
                return
            missing += np.searchsorted(own, high) <= np.searchsorted(own, low)
            left = missing <= lacking
            at, owner, low, high, missing = (x[left] for x in (at, owner, low, high, missing))
        for document, begin, end in zip(owner.tolist(), low.tolist(), high.tolist()):
            if document in done:
                continue
            run = densest(lists, begin, end, reach, len(distinct) - lacking)
            if run:
                done.add(document)
                yield document, *run


def densest(lists: list[np.ndarray], begin: int, end: int, reach: int, needed: int) -> tuple[int, int] | None:
    """The first run of at most ``reach`` of the words ``begin`` to ``end`` with ``needed`` different lists, if any."""
    parts = [own[np.searchsorted(own, begin) : np.searchsorted(own, end)] for own in lists]
    held = sorted((at, i) for i, part in enumerate(parts) for at in part.tolist())
    for first, (low, _) in enumerate(held):
        seen: set[int] = set()
        for at, i in held[first:]:
            if at >= low + reach:
                break
            seen.add(i)
            if len(seen) == needed:
                return low, at + 1
    return None


def window_matches(index: DataFrame, windows: DataFrame, reach: int = REACH, together: int = WINDOWS_TOGETHER) -> DataFrame:
    """``segment, place, item_id, exact, low, high``: places of documents in segments, word spans in them.

    ``exact`` rows are all occurrences of whole windows (spans merged by item), the others one
    proximity match (:meth:`Segment.near`) for each document and item. ``windows`` as of :func:`item_windows`.
    A segment meets the windows of which it holds one of the rarest terms, and the lists of their terms;
    with more than ``together`` windows in all they are dealt into shares by item.
    """
    ranked = ranked_windows(index, windows)
    shares = -(-max(ranked.count(), 1) // together)
    dealt = ranked.withColumn("share", F.pmod(F.xxhash64("item"), F.lit(shares)))
    distinct = F.array_distinct(F.transform("ranked", lambda e: e["term"]))
    wanted = dealt.withColumn("term", F.explode(F.slice(distinct, 1, F.floor(F.size(distinct) / MISSING_ONE_IN).cast("int") + 1)))
    probes = wanted.select("term", "share", "window")
    held = index.where("term IS NOT NULL").select("segment", "term")
    meeting = held.join(probes, "term").select("segment", "share", "window").distinct()
    names = ["segment", "share", "item", "item_id", "window", "ranked"]
    candidates = meeting.join(dealt, ["share", "window"]).select(*names).toDF(*names)

    terms = dealt.select(F.explode(distinct).alias("term"), "share").distinct()
    lists = index.join(stage(terms, "shares"), "term").select("segment", "share", "term", "postings")
    listed = index.where("term IS NULL").withColumn("share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shares - 1).cast("bigint"))))
    lists = lists.unionByName(listed.select("segment", "share", "term", "postings"))

    def look(candidates: pa.Table, rows: pa.Table) -> pa.Table:
        runs: dict[tuple, list[tuple[int, int]]] = {}
        near: list[tuple] = []
        if candidates.num_rows:
            segment = Segment(rows)
            done: dict[int, set[int]] = {}
            for row in candidates.sort_by([("item", "ascending"), ("window", "ascending")]).to_pylist():
                terms, places = ([e[name] for e in row["ranked"]] for name in ("term", "place"))
                at = segment.phrase(terms, places)
                owner = segment.owner(at)
                for place, low in zip(owner.tolist(), (at - segment.firsts[owner]).tolist()):
                    own = runs.setdefault((place, row["item"], row["item_id"]), [])
                    if own and own[-1][0] <= low <= own[-1][1]:
                        own[-1] = (own[-1][0], max(own[-1][1], low + len(terms)))
                    else:
                        own.append((low, low + len(terms)))
                for place, low, high in segment.near(terms, reach, done.setdefault(row["item"], set())):
                    first = int(segment.firsts[place])
                    near.append((segment.number, place, row["item_id"], False, low - first, high - first))
        flat = [(segment.number, place, item_id, True, *run) for (place, _, item_id), own in runs.items() for run in own]
        columns = list(zip(*flat, *near)) or [()] * 6
        kinds = [pa.int64()] * 3 + [pa.bool_()] + [pa.int64()] * 2
        names = ["segment", "place", "item_id", "exact", "low", "high"]
        return pa.Table.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

    keys = ["segment", "share"]
    schema = "segment bigint, place bigint, item_id bigint, exact boolean, low bigint, high bigint"
    return candidates.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInArrow(look, schema)


def indexed_documents(index: DataFrame) -> DataFrame:
    """``segment, place, doc_id, n_words`` of every document of the index."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, own in zip(column_of(batch, "segment").to_pylist(), column_of(batch, "postings")):
                listed = pa.ipc.open_stream(own.as_buffer()).read_all().combine_chunks()
                n = listed.num_rows
                columns = [pa.array(np.full(n, number)), pa.array(np.arange(n))]
                columns += [listed[c].combine_chunks() for c in ("doc_id", "n_words")]
                yield pa.RecordBatch.from_arrays(columns, ["segment", "place", "doc_id", "n_words"])

    schema = "segment bigint, place bigint, doc_id bigint, n_words bigint"
    return index.where("term IS NULL").mapInArrow(read, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, reach: int = REACH) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, item_ids, n_near_items, near_item_ids, contaminated``.

    A word is hit inside any occurrence of a benchmark window; ``item_ids`` have such windows. ``near_item_ids``
    have proximity matches: all but one in five of the distinct words of a window, in any order, within
    ``reach`` words; they do not make a document contaminated. NULL texts have no words; equal rows are
    judged one by one; an item without an id hits words but is not listed; an empty benchmark hits nothing.
    """
    index = build_index(docs)
    found = window_matches(index, item_windows(benchmark, window), reach)
    places = F.explode_outer(F.when(F.col("exact"), F.sequence(F.col("low"), F.col("high") - 1)))
    ids = {name: F.when(F.expr(kind), F.col("item_id").cast("string")) for name, kind in _KINDS.items()}
    words = found.select("segment", "place", *(c.alias(name) for name, c in ids.items()), places.alias("word"))
    sets = [F.sort_array(F.collect_set(name)).alias(name) for name in _KINDS]
    hits = words.groupBy("segment", "place").agg(F.count_distinct("word").alias("n_hit"), *sets)
    none = F.array().cast("array<string>")
    listed = {name: F.coalesce(name, none) for name in _KINDS}
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return (
        indexed_documents(index)
        .join(hits, ["segment", "place"], "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(listed["item_ids"]).cast("bigint").alias("n_items"),
            listed["item_ids"].alias("item_ids"),
            F.size(listed["near_item_ids"]).cast("bigint").alias("n_near_items"),
            listed["near_item_ids"].alias("near_item_ids"),
            (n_hit > 0).alias("contaminated"),
        )
    )
