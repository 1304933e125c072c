"""Collocations of two to four words, counted by an FM-index over word ids in each shard.

A shard is a block of texts. Two steps read the texts, both without any group that grows with a word:

1. The *screen*. Every shard sends hashes of its words and word pairs with their counts; hashes whose sum
   reaches the support set three bits each of a bitmap of fixed size. So do, in one more pass, triples of which
   both pairs pass. The parts of a phrase of support have support too, so a phrase with a bit missing cannot be a
   candidate: the bitmap has no false negatives, and what it lets through by chance is dropped later by exact
   counts. Its size is therefore a matter of speed alone.
2. The *index*. A shard cuts its word sequence wherever a pair fails the screen and builds a bidirectional
   FM-index of what is left: word ids ordered by the next :data:`DEPTH` words, and by the previous ones, each with
   the Burrows-Wheeler symbols (the word before, the word after). Intervals of both orders are extended together,
   to the right, to the left and to the right again, which enumerates every phrase with its count. Sums
   across shards go by language and phrase text.

What follows (cuts, containment, ranks) are joins and windows over the phrases of support.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stage
from .text_blocks import Block, SpanHash, blocks, byte_class, column_of, mix, owners, spans, window_hashes

SUPPORT, DEPTH = 30, 4
#: Drop a phrase if a longer candidate around it has this share of its occurrences, in percent.
CONTAINED = 80
#: Rows kept of each language.
TOP = 2_000
NO_LANGUAGE = "und"

#: Bits of the screen (8 MB), and where in a hash its three bit numbers begin.
SCREEN_BITS = 26
_PROBES = (0, 19, 38)

# What ends a piece, and what else ends a word.
_ENDS_PIECE = byte_class([*b".,;:!?", *range(0x0A, 0x0E)])
_WORD = ~(_ENDS_PIECE | byte_class([0x20, 0x09]))

#: Bytes of text in a shard, unless one text has more.
SHARD_BYTES = 2_000_000
_SLICE = 100_000


@dataclass
class Words:
    """The words of a block: bounds, 64-bit key of (language, word), language, and whether the next is in the same piece."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    keys: np.ndarray
    language: np.ndarray
    joined: np.ndarray

    def linked(self, screen: np.ndarray) -> np.ndarray:
        """Which words make a pair of the screen with the next one."""
        return self.joined & passes(screen, window_hashes(self.keys, 2))

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8", "replace")


def words_of(block: Block, languages: np.ndarray, language_keys: np.ndarray) -> Words:
    """``languages``: the language number of each text of the block; ``language_keys``: a key for each number."""
    low = block.lowered()
    starts, ends, firsts = spans(low, _WORD)
    owner = owners(firsts)
    piece = np.cumsum(_ENDS_PIECE[low.data], dtype=np.int32)[starts] if len(starts) else starts
    joined = (owner[1:] == owner[:-1]) & (piece[1:] == piece[:-1])
    language = languages[owner]
    keys = mix(SpanHash(low.data)(starts, ends) + language_keys[language])
    return Words(low.data, starts, ends, keys, language, joined)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], Words]]:
    """The shards of a task's rows (``lang``, ``text``), each with the names of its languages."""
    for whole in batches:
        # Texts are copied on the way: a part of a batch at a time.
        rows = max(whole.num_rows * SHARD_BYTES // max(whole.nbytes, 1), 1)
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            coded = column_of(batch, "lang").fill_null(NO_LANGUAGE).dictionary_encode()
            names = coded.dictionary.to_pylist()
            codes = np.asarray(coded.indices)
            digests = [hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=8).digest() for name in names]
            keys = np.frombuffer(b"".join(digests), dtype=np.uint64)
            for block in blocks(column_of(batch, "text"), SHARD_BYTES):
                yield names, words_of(block, codes[block.first : block.first + block.size], keys)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, _SLICE):
        yield batch.slice(at, _SLICE)


def _hashed_counts(docs: DataFrame, screen: Broadcast | None) -> DataFrame:
    """``key, n``: hashes of the words and pairs of every shard; with a screen, of triples whose pairs pass it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _shards(batches):
            if screen is None:
                keys = np.concatenate([words.keys, window_hashes(words.keys, 2)[words.joined]])
            else:
                linked = words.linked(screen.value)
                keys = window_hashes(words.keys, 3)[linked[:-1] & linked[1:]]
            keys, n = np.unique(keys, return_counts=True)
            yield from _slices(pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"]))

    return docs.select("lang", "text").mapInArrow(count, "key bigint, n bigint")


def _bitmap(counts: DataFrame, support: int, bits: int) -> np.ndarray:
    """The bits of the hashes with support, as 64-bit words: ``2 ** bits`` bits come to the driver at most."""
    frequent = counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= support)
    place = F.explode(F.array(*[F.shiftrightunsigned("key", p).bitwiseAND((1 << bits) - 1) for p in _PROBES]))
    words = frequent.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(place & 63 AS INT)))").alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def screen_of(docs: DataFrame, support: int, bits: int = SCREEN_BITS) -> Broadcast:
    """Words, pairs and triples that may have the support: a broadcast of fixed size, whatever the input."""
    context = docs.sparkSession.sparkContext
    first = _bitmap(_hashed_counts(docs, None), support, bits)
    pairs = context.broadcast(first)
    triples = _bitmap(_hashed_counts(docs, pairs), support, bits)
    pairs.destroy()
    return context.broadcast(first | triples)


def passes(screen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have all their bits set."""
    mask = np.uint64(len(screen) * 64 - 1)
    out = np.ones(len(keys), dtype=bool)
    for probe in _PROBES:
        place = (keys >> np.uint64(probe)) & mask
        out &= (screen[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places ordered by the ``depth`` symbols from each on, which end with the first 0; by prefix doubling."""
    rank, inside, width = symbols.astype(np.int64), symbols > 0, 1
    while width < depth:
        following = np.zeros_like(rank)
        following[:-width] = rank[width:]
        following[~inside] = 0
        rank = np.unique(rank * (int(rank.max()) + 1) + following, return_inverse=True)[1]
        inside[:-width] &= inside[width:]
        inside[-width:] = False
        width *= 2
    return np.argsort(rank, kind="stable")


@dataclass
class Intervals:
    """Phrases of one length: where each begins in the forward and in the backward order, and its count."""

    forward: np.ndarray
    backward: np.ndarray
    count: np.ndarray

    def taken(self, which: np.ndarray) -> Intervals:
        return Intervals(self.forward[which], self.backward[which], self.count[which])


class WordIndex:
    """Bidirectional FM-index of runs of word ids (from 1; a 0 before, between and after the runs).

    Both orders look at ``depth`` symbols only: enough for intervals of phrases of up to that length, and
    the rank queries of an extension need no more than that the symbols of the phrase are in order.
    """

    def __init__(self, symbols: np.ndarray, depth: int = DEPTH):
        n = len(symbols)
        self._n, self._symbols = n, symbols.astype(np.int64)
        self.places = _order(self._symbols, depth)
        behind = n - 1 - _order(self._symbols[::-1], depth)
        self._before = self._symbols[(self.places - 1) % n]
        self._after = self._symbols[(behind + 1) % n]
        self._first = np.concatenate([[0], np.cumsum(np.bincount(self._symbols))])
        self._lists = {"left": self._occurrences(self._before), "right": self._occurrences(self._after)}

    def _occurrences(self, column: np.ndarray) -> np.ndarray:
        """Sorted ``symbol * n + row``: how often a symbol stands above a row is a binary search."""
        return np.sort(column * self._n + np.arange(self._n))

    def words(self) -> Intervals:
        first, count = self._first[1:-1], np.diff(self._first)[1:]
        return Intervals(first, first, count)

    def extended(self, phrases: Intervals, side: str) -> Intervals:
        """Every phrase of one word more on that side."""
        column = self._after if side == "right" else self._before
        own, other = (phrases.backward, phrases.forward) if side == "right" else (phrases.forward, phrases.backward)
        total = int(phrases.count.sum())
        opens = np.cumsum(phrases.count) - phrases.count
        which = np.repeat(np.arange(len(own)), phrases.count)
        symbol = column[np.repeat(own - opens, phrases.count) + np.arange(total)]
        width = len(self._first)
        keys, count = np.unique(which * width + symbol, return_counts=True)
        which, symbol = keys // width, keys % width
        smaller = np.cumsum(count) - count - opens[which]
        real = symbol > 0
        which, symbol, count = which[real], symbol[real], count[real]
        moved = np.searchsorted(self._lists[side], symbol * self._n + own[which])
        beside = other[which] + smaller[real]
        return Intervals(beside, moved, count) if side == "right" else Intervals(moved, beside, count)

    def symbols(self, phrases: Intervals, length: int) -> np.ndarray:
        """The word ids of each phrase, [phrase, word]."""
        return self._symbols[self.places[phrases.forward][:, None] + np.arange(length)]


def _joint(keys: np.ndarray) -> np.ndarray:
    """The key of each row's words, as of a window of them."""
    return window_hashes(keys.ravel(), keys.shape[1])[:: keys.shape[1]]


def _runs(words: Words, screen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the words that stand in a pair of the screen, in runs; one word of each id, and the count of all such words."""
    linked = words.linked(screen)
    ids, first, inverse, count = np.unique(words.keys, return_index=True, return_inverse=True, return_counts=True)
    opens, inside = np.concatenate([[True], ~linked]), np.zeros(len(words.keys), dtype=bool)
    inside[:-1] |= linked
    inside[1:] |= linked
    opened = opens[inside]
    symbols = np.zeros(int(inside.sum()) + int(opened.sum()) + 1, dtype=np.int64)
    symbols[np.arange(len(opened)) + np.cumsum(opened)] = inverse[inside] + 1
    return symbols, first, count


def shard_phrases(words: Words, screen: np.ndarray, depth: int = DEPTH) -> Iterator[tuple[list[int], list[str], int, np.ndarray]]:
    """Languages, texts, length and counts of the words and phrases of a shard that pass the screen."""
    symbols, first, count = _runs(words, screen)
    texts: dict[int, str] = {}

    def text(word: int) -> str:
        if word not in texts:
            texts[word] = words.text(first[word])
        return texts[word]

    frequent = np.flatnonzero(passes(screen, words.keys[first]))
    yield words.language[first[frequent]].tolist(), [text(w) for w in frequent.tolist()], 1, count[frequent]
    if len(symbols) < 3:
        return
    # Only ids in use, in order, so that an interval begins for each.
    used, dense = np.unique(symbols, return_inverse=True)
    index = WordIndex(dense, depth)
    phrases = index.words()
    for length in range(2, depth + 1):
        phrases = index.extended(phrases, "right" if length % 2 == 0 else "left")
        ids = used[index.symbols(phrases, length)] - 1
        if length > 2:
            keys = words.keys[first[ids]]
            kept = np.flatnonzero(passes(screen, _joint(keys[:, :3])) & passes(screen, _joint(keys[:, -3:])))
            phrases, ids = phrases.taken(kept), ids[kept]
        languages = words.language[first[ids[:, 0]]].tolist()
        yield languages, [" ".join([text(w) for w in row]) for row in ids.tolist()], length, phrases.count


_PHRASES = "lang string, phrase string, words int, n bigint"


def phrase_counts(docs: DataFrame, support: int = SUPPORT, depth: int = DEPTH, bits: int = SCREEN_BITS) -> DataFrame:
    """``lang, phrase, words, n``: every phrase of up to ``depth`` words that occurs ``support`` times in its language.

    Besides, a row of 0 words for each language: the number of all its words.
    """
    screen = screen_of(docs, support, bits)

    def enumerate_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, words in _shards(batches):
            if not len(words.keys):
                continue
            total = np.bincount(words.language, minlength=len(names))
            found = [(np.flatnonzero(total).tolist(), [""] * int((total > 0).sum()), 0, total[total > 0])]
            found.extend(shard_phrases(words, screen.value, depth))
            for languages, texts, length, count in found:
                columns = [pa.array([names[code] for code in languages], pa.string()), pa.array(texts, pa.string())]
                columns += [pa.array(np.full(len(texts), length, np.int32)), pa.array(count.astype(np.int64))]
                yield from _slices(pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "n"]))

    parts = docs.select("lang", "text").mapInArrow(enumerate_phrases, _PHRASES)
    summed = parts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return stage(summed.where((F.col("n") >= support) | (F.col("words") == 0)), "phrases")


def _exact(name: str) -> Column:
    """A count as a decimal: products of it keep all digits."""
    return F.col(name).cast("decimal(20,0)")


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, length), " ")


def _scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` by the lowest-scoring cut of each phrase of two words or more."""
    known = phrases.where("words >= 1").select("lang", F.col("phrase").alias("part"), "n")
    whole = phrases.where("words >= 2").withColumnRenamed("n", "a")
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns(
        {"head": _part(F.lit(1), F.col("k")), "tail": _part(F.col("k") + 1, F.col("words") - F.col("k"))}
    )
    for side, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(known.withColumnsRenamed({"part": side, "n": name}), ["lang", side])
    cuts = cuts.withColumn("both", _exact("l") + _exact("r")).withColumn("millions", _exact("a") * 2_000_000)
    cut = F.struct(F.expr("millions div both").alias("score"), "k", "l", "r")
    least = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(cut).alias("cut"))
    return least.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def _extensions(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, longest``: the most frequent candidate of one word more around each phrase.

    No longer one needs a look: what lies between it and the phrase is at least as frequent.
    """
    shorter = F.explode(F.array(_part(F.lit(1), F.col("words") - 1), _part(F.lit(2), F.col("words") - 1)))
    inner = phrases.where("words >= 3").select("lang", shorter.alias("phrase"), "n")
    return inner.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))


def _first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each language with their ``rank``.

    In rounds of 1,024, 32 and 1 parts of a language, so that no task sorts more than it must: the last
    one gets ``32 * top`` rows at most.
    """
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    for parts in (1_024, 32, 1):
        split = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        own = Window.partitionBy("lang", "_split").orderBy(*order)
        rows = rows.withColumn("_split", split).withColumn("rank", F.row_number().over(own).cast("bigint"))
        rows = rows.where(F.col("rank") <= top).drop("_split")
    return rows


def collocations(
    docs: DataFrame, support: int = SUPPORT, contained: int = CONTAINED, top: int = TOP, bits: int = SCREEN_BITS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top`` collocations in ``docs`` (``lang, text``).

    A-Z count as a-z. Pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. Candidates are phrases of
    two to four words with ``support`` occurrences (``a``) within pieces of their language; NULL languages are
    ``und``. Cut in two, with ``l`` and ``r`` occurrences of the parts, one scores ``floor(2000000 a / (l + r))``; the
    lowest-scoring cut counts, of equal ones the first. A candidate inside a longer one with ``contained`` percent
    of its occurrences is dropped. ``n``: all words of the language. Order: score, then ``a``, both falling,
    then phrase by bytes, so that there are no ties. NULL and empty texts have no words, repeated rows count as often
    as they stand, texts of any length are whole, no rows give none, and other columns are ignored.
    """
    phrases = phrase_counts(docs, support, bits=bits)
    totals = phrases.where("words = 0").select("lang", F.col("n").alias("total"))
    rows = _scored(phrases).join(_extensions(phrases), ["lang", "phrase"], "left")
    inside = _exact("longest") * 100 >= _exact("a") * contained
    kept = rows.where(~F.coalesce(inside, F.lit(False))).select("lang", "phrase", "a", "l", "r", "score")
    ranked = _first_of_each(kept, top).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
