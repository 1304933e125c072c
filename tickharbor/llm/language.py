"""Language identification by rank-order profiles of letter n-grams.

A profile lists the most frequent 1-, 2- and 3-grams of a language, most frequent first. A text gets
the language whose profile is nearest by out-of-place distance: how far each of the text's own most
frequent n-grams stands from its place in the profile, and the longest distance if it is not in it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text_blocks import column_of

PROFILE, TEXT_NGRAMS = 400, 300
UNDETERMINED = "und"
_BLOCK_CHARS = 1 << 20
_LETTER_BITS = 14
_LETTER_CODES = 16381  # the largest prime that leaves codes 0 (none) and 1 (edge of a word) free
_GRAM_BITS = 3 * _LETTER_BITS
_GRAM = np.uint64((1 << _GRAM_BITS) - 1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The code of each character: 0 if it is no letter."""
    codes = np.arange(0x110000)
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return np.where(letter, codes % _LETTER_CODES + 2, 0).astype(np.uint16)


def ngrams(texts: list[str]) -> np.ndarray:
    """Each 1-, 2- and 3-gram within the words of each text, as text number and gram in one integer.

    Texts are lower-cased; anything but letters separates words; 2- and 3-grams may take in one edge of
    a word at either end.
    """
    joined = "\0" + "\0".join(t.lower() for t in texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _letters()[points]
    # Which NUL ends a text, and which one a text holds itself, is told by the lengths.
    lengths = np.fromiter((len(t.lower()) for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths + 1)
    codes, inner = codes[: len(owner)], codes[: len(owner)] > 0
    keep = inner.copy()
    keep[:-1] |= inner[1:]  # the edge before a word
    keep[1:] |= inner[:-1]  # and the one after it
    codes = codes[keep].astype(np.uint64)
    codes[codes == 0] = 1
    owner = owner[keep] << np.uint64(_GRAM_BITS)
    bits = np.uint64(_LETTER_BITS)
    parts = [(owner + codes)[codes > 1]]
    two = (codes[:-1] << bits) + codes[1:]
    parts.append((owner[:-1] + two)[(codes[:-1] > 1) | (codes[1:] > 1)])
    three = (two[:-1] << bits) + codes[2:]
    parts.append((owner[:-2] + three)[codes[1:-1] > 1])
    return np.concatenate(parts)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(keys)
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else np.zeros(0, int)
    return ordered[heads], np.diff(np.append(heads, len(ordered)))


def text_groups(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups of about a million characters, or one text; NULL as the empty one."""
    first, group, size = 0, [], 0
    for i, text in enumerate(column):
        text = text.as_py() or ""
        if group and size + len(text) > _BLOCK_CHARS:
            yield first, group
            first, group, size = i, [], 0
        group.append(text)
        size += len(text)
    if group:
        yield first, group


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows of ``docs`` (``text, lang``) with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        total, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            langs = [names.setdefault(x, len(names)) for x in column_of(batch, "lang").to_pylist()]
            for first, texts in text_groups(column_of(batch, "text")):
                keys, n = counted(ngrams(texts))
                own = np.array(langs[first : first + len(texts)], dtype=np.uint64)
                keys = (own[(keys >> np.uint64(_GRAM_BITS)).astype(np.int64)] << np.uint64(_GRAM_BITS)) + (keys & _GRAM)
                total, back = np.unique(np.concatenate([total, keys]), return_inverse=True)
                sums = np.bincount(back, np.concatenate([sums, n]), len(total)).astype(np.int64)
        known = np.array(list(names), dtype=object)
        lang = known[(total >> np.uint64(_GRAM_BITS)).astype(np.int64)] if len(total) else []
        grams = pa.array((total & _GRAM).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), grams, pa.array(sums)], ["lang", "gram", "n"])

    parts = docs.where("lang IS NOT NULL").select("lang", "text").mapInArrow(count, "lang string, gram bigint, n bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """The ``size`` most frequent n-grams of each language of ``docs``, most frequent first (ties: smaller gram).

    Counts cover all rows; the driver gets ``size`` numbers a language.
    """
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = gram_counts(docs).withColumn("place", place).where(F.col("place") <= size).collect()
    profiles: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r.lang, r.place)):
        profiles.setdefault(row.lang, []).append(row.gram)
    return {lang: np.array(grams, dtype=np.uint64) for lang, grams in profiles.items()}


def distances(texts: list[str], profiles: dict[str, np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each text to each profile, and the number of n-grams compared."""
    keys, n = counted(ngrams(texts))
    owner = (keys >> np.uint64(_GRAM_BITS)).astype(np.int64)
    order = np.argsort((owner << 40) - n, kind="stable")  # equal counts stay in the order of grams
    owner, grams = owner[order], (keys & _GRAM)[order]
    firsts = np.searchsorted(owner, np.arange(len(texts)))
    rank = np.arange(len(owner)) - firsts[owner]
    top = rank < size
    owner, grams, rank = owner[top], grams[top], rank[top]
    out = np.zeros((len(profiles), len(texts)))
    for i, profile in enumerate(profiles.values()):
        places = np.argsort(profile)
        at = np.minimum(np.searchsorted(profile[places], grams), len(profile) - 1)
        found = profile[places][at] == grams
        off = np.where(found, np.abs(places[at] - rank), PROFILE)
        out[i] = np.bincount(owner, off, len(texts))
    return out, np.bincount(owner, minlength=len(texts))


def predict_language(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = TEXT_NGRAMS) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row of ``docs`` (``doc_id, text``).

    A text that is NULL, empty or has no letter is ``und`` with score 0, as all are if no language was
    learned. The score is the nearest profile's share of the nearness of all. Equal distances go to the
    language that sorts first. Each row is judged alone, by its whole text; other columns are ignored.
    """
    names = np.array([*sorted(profiles), UNDETERMINED], dtype=object)
    profiles = {lang: profiles[lang] for lang in sorted(profiles)}

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column_of(batch, "doc_id")
            for first, texts in text_groups(column_of(batch, "text")):
                best, score = np.full(len(texts), len(profiles)), np.zeros(len(texts))
                if profiles:
                    far, compared = distances(texts, profiles, size)
                    near = 1 - far / np.maximum(compared * PROFILE, 1) + 1e-9
                    some = compared > 0
                    best = np.where(some, far.argmin(axis=0), len(profiles))
                    score = np.where(some, near.max(axis=0) / near.sum(axis=0), 0.0)
                columns = [ids.slice(first, len(texts)), pa.array(names[best], pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    chosen = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return chosen.mapInArrow(predict, "doc_id bigint, lang_pred string, score double")


def fold(doc_id: Column, of: int) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.crc32(doc_id.cast("string")) % of


def held_out_languages(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Predictions for all rows from profiles of the rows outside fold ``held``; a row without id is not learned from."""
    learned = learn_profiles(docs.where(fold(F.col("doc_id"), folds) != held))
    out = predict_language(docs, learned)
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out")
    return out.select("doc_id", held_out, "lang_pred", "score")
