"""Quality rules by repetition coverage: how much of a text lies in repeated word runs and lines.

For each n-gram length the rolling hashes of all word windows of a text are computed in numpy; a
window whose hash occurs twice or more in the text covers its words, and the share of characters
so covered is held against a limit for that length. Lines are treated alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text_blocks import (
    NOT_BLANK,
    Block,
    SpanHash,
    blocks,
    byte_class,
    column_of,
    covered,
    mix,
    owners,
    per_text,
    repeated,
    spans,
    whole_windows,
    window_hashes,
)

#: Share of word characters that may lie in repeated windows of so many words.
NGRAM_LIMITS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.25, 9: 0.24, 10: 0.22}
#: Share of word characters that may lie in lines that occur twice or more.
LINE_LIMIT = 0.35

_SYMBOLS = byte_class(b"#*$%&|<>")
_NOT_NEWLINE = ~byte_class(b"\n")
_SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, line_chars bigint, {grams}base_failed boolean, kept boolean"
)


def repetition(block: Block, lengths: tuple[int, ...], base: int = 8) -> dict[str, np.ndarray]:
    """The measures of each text of a block; ``gram_chars_n`` are characters in repeated n-grams."""
    starts, ends, firsts = spans(block, NOT_BLANK)
    hashes = SpanHash(block.data)
    lead = (block.data & 0xC0) != 0x80
    chars_to = np.concatenate([[0], np.cumsum(lead)])
    chars = chars_to[ends] - chars_to[starts]
    out = {"n_words": np.diff(firsts), "word_chars": per_text(chars, firsts)}
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[block.data])])
    out["n_symbols"] = symbols[block.offsets[1:]] - symbols[block.offsets[:-1]]

    words, owner = hashes(starts, ends), owners(firsts)
    for n in sorted({*lengths, base}):
        whole = np.flatnonzero(whole_windows(firsts, n))
        keys = mix(window_hashes(words, n)[whole] + mix(owner[whole].astype(np.uint64)))
        at = whole[repeated(keys)]
        inside = covered(at, at + n, len(words))
        if n == base:
            out["n_repeat_words"] = per_text(inside, firsts)
        if n in lengths:
            out[f"gram_chars_{n}"] = per_text(np.where(inside, chars, 0), firsts)

    low, high, line_firsts = spans(block, _NOT_NEWLINE)
    first_word, end_word = np.searchsorted(starts, low), np.searchsorted(starts, high)
    wordy = end_word > first_word
    low, high, first_word, end_word = low[wordy], high[wordy], first_word[wordy], end_word[wordy]
    line_owner = owners(line_firsts)[wordy]
    keys = mix(hashes(low, high) + mix(line_owner.astype(np.uint64)))
    same = repeated(keys)
    _, first = np.unique(keys[same], return_index=True)
    later = same.copy()
    later[np.flatnonzero(same)[first]] = False
    out["n_dup_lines"] = np.bincount(line_owner[later], minlength=block.size)
    inside = covered(first_word[same], end_word[same], len(words))
    out["line_chars"] = per_text(np.where(inside, chars, 0), firsts)
    return out


def quality_report(
    docs: DataFrame,
    ngram_limits: Mapping[int, float] = NGRAM_LIMITS,
    line_limit: float = LINE_LIMIT,
) -> DataFrame:
    """Measures and verdict of each row of ``docs`` (``doc_id``, ``text``).

    ``base_failed``: under 20 words, or over 30 % of the words in repeated 8-word windows. ``kept`` is
    false if that fails, if the characters in repeated n-grams exceed the limit of any length, or if those
    in repeated lines exceed ``line_limit``. Symbols are counted, but decide nothing: they are no repetition.
    NULL and empty texts have no words, and so are not kept. Each row is judged alone: equal rows, and
    rows without a ``doc_id``, are all returned; other columns are ignored. Windows of a text never
    reach into another one, and a long text is judged whole.
    """
    lengths = tuple(sorted(ngram_limits))
    grams = "".join(f"gram_chars_{n} bigint, " for n in lengths)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column_of(batch, "doc_id")
            for block in blocks(column_of(batch, "text")):
                m = repetition(block, lengths)
                words, chars = m["n_words"], m["word_chars"]
                failed = (words < 20) | (100 * m["n_repeat_words"] > 30 * words)
                bad = failed | (m["line_chars"] > line_limit * chars)
                for n in lengths:
                    bad |= m[f"gram_chars_{n}"] > ngram_limits[n] * chars
                names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars"]
                names += [f"gram_chars_{n}" for n in lengths]
                columns = [ids.slice(block.first, block.size)]
                columns += [pa.array(m[name].astype(np.int64)) for name in names]
                columns += [pa.array(failed), pa.array(~bad)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, "base_failed", "kept"])

    chosen = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return chosen.mapInArrow(judge, _SCHEMA.format(grams=grams))
