"""Personal data: fixed patterns, and terms that give a protected entity away.

Each distinct e-mail address, phone number, card or address found is a protected entity. Over the
corpus, how much of the information that an entity's presence carries does a term tell? With
``p(e)`` the share of documents that hold the entity and ``p(e|t)`` that among documents with the term,
it is ``1 - log p(e|t) / log p(e)``: 0 for an unrelated term, 1 for one that occurs only with the entity.
Terms are counted over whole texts, and one that tells too much is generalised wherever it stands, in
documents without the entity too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stage
from .text_blocks import LETTERS, Block, SpanHash, blocks, column_of, spans

KINDS = ("email", "ip", "card", "phone")
#: A term is disclosing if it tells at least this share, in at least so many documents.
DISCLOSURE, MIN_DOCUMENTS = 0.9, 3

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
#: Bits of the filter that lets words through to the join with the disclosing terms; the join decides.
_FILTER_BITS = 22
_HELD = "row bigint, entities array<bigint>, terms array<bigint>"
_FOUND = (
    "row bigint, doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, "
    "words array<struct<term:bigint,low:bigint,high:bigint>>"
)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, from the signs outwards: time in proportion to the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and text[low - 1] in _LOCAL:
            low -= 1
        domain = _DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            yield low, domain.end()
            done = domain.end()
        else:
            done = at + 1  # what precedes a sign cannot be part of a later address
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of each finding, by kind as listed and then by start."""
    out = [("email", *span) for span in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return out


def _hashes(words: list[str]) -> np.ndarray:
    """Hashes of whole strings, as those of terms."""
    column = pa.array(words, pa.string())
    parts = [SpanHash(b.data)(b.offsets[:-1], b.offsets[1:]) for b in (b.lowered() for b in blocks(column))]
    return np.concatenate([np.zeros(0, np.int64), *(p.view(np.int64) for p in parts)])


def _terms(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of a block, and the first word of each text."""
    block = block.lowered()
    starts, ends, firsts = spans(block, LETTERS)
    return starts, ends, SpanHash(block.data)(starts, ends).view(np.int64), firsts


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))


def held_terms(docs: DataFrame) -> DataFrame:
    """``row, entities, terms`` of each row of ``docs`` with a finding: its distinct entities and words."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for block in blocks(column_of(batch, "text")):
                texts = column_of(batch, "text").slice(block.first, block.size).to_pylist()
                found = [{f"{k}:{t[a:b].lower()}" for k, a, b in base_spans(t)} if t else set() for t in texts]
                holders = [i for i, own in enumerate(found) if own]
                if not holders:
                    continue
                _, _, hashes, firsts = _terms(block)
                entities = _hashes([e for i in holders for e in found[i]])
                cuts = np.cumsum([len(found[i]) for i in holders])[:-1]
                terms = [np.unique(hashes[firsts[i] : firsts[i + 1]]) for i in holders]
                rows = pa.array(np.arange(row, row + len(holders)))
                row += len(holders)
                columns = [rows, _lists([np.unique(own) for own in np.split(entities, cuts)]), _lists(terms)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "entities", "terms"])

    return docs.select("text").mapInArrow(find, _HELD)


def marked_words(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Base findings of each row of ``docs``, and each word outside them that may be one of ``terms``.

    A filter of fixed size over the hashes of ``terms`` lets words through: all that are among them, and
    more others the more terms there are, which the join with ``terms`` has to take out.
    """
    buckets = terms.select(F.shiftrightunsigned("term", 64 - _FILTER_BITS).alias("b")).distinct().toArrow()
    wanted = np.zeros(1 << _FILTER_BITS, dtype=bool)
    wanted[buckets["b"].to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))  # half a megabyte, whatever the input

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        passes = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            for block in blocks(column_of(batch, "text")):
                texts = column_of(batch, "text").slice(block.first, block.size).to_pylist()
                found = [base_spans(t) if t else [] for t in texts]
                starts, ends, hashes, firsts = _terms(block)
                at = np.flatnonzero(passes[(hashes.view(np.uint64) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
                owner = np.searchsorted(firsts, at, "right") - 1
                chars = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
                base = chars[block.offsets[owner]]
                low, high = chars[starts[at]] - base, chars[ends[at]] - base
                outside = np.ones(len(at), dtype=bool)
                bounds = np.searchsorted(owner, np.arange(block.size + 1))
                for i, own in enumerate(found):
                    part = slice(bounds[i], bounds[i + 1])
                    for _, a, b in own if bounds[i] < bounds[i + 1] else ():
                        outside[part] &= (low[part] >= b) | (high[part] <= a)
                at, owner, low, high = at[outside], owner[outside], low[outside], high[outside]
                offsets = np.searchsorted(owner, np.arange(block.size + 1)).astype(np.int32)
                word = pa.StructArray.from_arrays([pa.array(hashes[at]), pa.array(low), pa.array(high)], ["term", "low", "high"])
                columns = [pa.array(np.arange(row, row + block.size)), column_of(batch, "doc_id").slice(block.first, block.size)]
                columns += [pa.array([sum(f[0] == kind for f in own) for own in found], pa.int64()) for kind in KINDS]
                columns.append(pa.array([",".join(f"{k}:{a}:{b}" for k, a, b in own) for own in found], pa.string()))
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), word))
                row += block.size
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", *(f"n_{k}" for k in KINDS), "base", "words"])

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(find, _FOUND)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``term, documents``: in how many rows of ``docs`` each word occurs, over whole texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for block in blocks(column_of(batch, "text")):
                block = block.lowered()
                starts, ends, firsts = spans(block, LETTERS)
                hashes = SpanHash(block.data)(starts, ends).view(np.int64)
                own = [np.unique(part) for part in np.split(hashes, firsts[1:-1])]
                terms, back = np.unique(np.concatenate([terms, *own]), return_inverse=True)
                seen = np.concatenate([sums, np.ones(sum(map(len, own)), np.int64)])
                sums = np.bincount(back, seen, len(terms)).astype(np.int64)
                if len(terms) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(sums)], ["term", "documents"])
                    terms, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(sums)], ["term", "documents"])

    parts = docs.select("text").mapInArrow(count, "term bigint, documents bigint")
    return parts.groupBy("term").agg(F.sum("documents").alias("documents"))


def disclosing_terms(
    docs: DataFrame, disclosure: float = DISCLOSURE, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``entity, term, disclosed`` for the terms that tell at least the share ``disclosure`` of an entity.

    All words of the whole texts that hold an entity are counted. An entity in fewer than
    ``min_documents`` documents can share no term in so many, and is left out before its words are.
    """
    total = docs.count()
    held = stage(held_terms(docs), "pii-held")
    entities = held.select("row", F.explode("entities").alias("entity"))
    holders = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("holders"))
    holders = stage(holders.where((F.col("holders") >= min_documents) & (F.col("holders") < total)), "pii-holders")
    # By row, not by entity: one that many documents hold is spread over the tasks.
    own = entities.join(holders, "entity", "left_semi").groupBy("row").agg(F.collect_list("entity").alias("own"))
    pairs = held.select("row", "terms").join(own, "row").select(F.explode("own").alias("entity"), "terms")
    pairs = pairs.select("entity", F.explode("terms").alias("term"))
    both = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")).where(F.col("both") >= min_documents)
    candidates = stage(both, "pii-pairs")
    share = 1 - F.log(F.least(F.lit(1.0), F.col("both") / F.col("documents"))) / F.log(F.col("holders") / F.lit(max(total, 2)))
    return (
        candidates.join(holders, "entity")
        .join(document_frequencies(docs), "term")
        .withColumn("disclosed", share)
        .where(F.col("disclosed") >= disclosure)
        .select("entity", "term", "disclosed")
    )


def protected_spans(docs: DataFrame, disclosure: float = DISCLOSURE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): counts by kind, ``base`` and all ``spans``.

    Spans are ``kind:start:end`` in code points, comma-joined, by kind as listed and then start;
    every occurrence of a disclosing term outside these follows as ``term:start:end``, whether or not the
    document holds the entity. NULL and empty texts have none. Each row is judged alone but for the
    corpus statistics, in which every row counts as a document; other columns are ignored.
    """
    terms = disclosing_terms(docs, disclosure, min_documents).groupBy("term").agg(F.max("disclosed").alias("disclosed"))
    terms = stage(terms, "pii-terms")
    found = stage(marked_words(docs, terms), "pii")
    words = found.where("size(words) > 0").select("row", F.explode("words").alias("w")).select("row", "w.*")
    places = words.join(terms, "term", "left_semi").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("places")
    )
    written = F.array_join(F.transform("places", lambda p: F.concat_ws(":", F.lit("term"), p.low, p.high)), ",")
    spans_text = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), written)
    return found.join(places, "row", "left").select("doc_id", *(f"n_{k}" for k in KINDS), "base", spans_text.alias("spans"))


def sanitised(docs: DataFrame, disclosure: float = DISCLOSURE, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` with every span of :func:`protected_spans` replaced by its kind in brackets, row by row.

    Rows are numbered first, so that NULL and repeated ids make no difference. NULL texts stay NULL; other columns
    stay, whatever their names.
    """
    number = "row_number"
    while number in (name.lower() for name in docs.columns):
        number += "_"
    rows = stage(docs.withColumn(number, F.monotonically_increasing_id()), "pii-rows")
    spans_of = protected_spans(rows.select(F.col(number).alias("doc_id"), "text"), disclosure, min_documents)
    listed = f"{number}_spans"
    joined = rows.join(spans_of.select(F.col("doc_id").alias(number), F.col("spans").alias(listed)), number)
    schema = docs.schema

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, own in zip(column_of(batch, "text").to_pylist(), column_of(batch, listed).to_pylist()):
                texts.append(text if not own else generalised(text, own))
            at = batch.schema.get_field_index("text")
            out = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield out.select([f.name for f in schema.fields])

    return joined.mapInArrow(replace, schema)


def generalised(text: str, listed: str) -> str:
    """``text`` with the listed spans replaced; of spans that overlap, the one that begins first."""
    out, done = [], 0
    for low, high, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in listed.split(","))):
        if low >= done:
            out += [text[done:low], f"[{kind.upper()}]"]
            done = high
    return "".join([*out, text[done:]])
