"""Fill-in-middle rearrangement: one repeated capture finds every unit of a text.

``(unit)*`` is matched against the whole text once, by the ``regex`` library, which keeps all repetitions of a
group: the ends of the group are the number of units and every place where the text may be cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .text_blocks import column_of

SEED = 7
#: A line with its end, or what follows the last end of line.
LINE = r"[^\n]*\n|[^\n]+"
#: Percent of the texts that are rearranged, and of those that put the suffix first.
RATE, SUFFIX_FIRST = 100, 50
# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_SCHEMA = (
    "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored string"
)
_ROWS = 500


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers that depend on the seed and the id only; a NULL id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearranged(
    text: str, numbers: list[int], units: regex.Pattern, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, length of prefix and middle, and the output."""
    match = units.fullmatch(text)
    ends = match.ends(1) if match else []
    n = len(ends)
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not n or marked or numbers[2] % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((numbers[0] % (n + 1), numbers[1] % (n + 1)))
    first, last = (ends[cut - 1] if cut else 0 for cut in (low, high))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    if numbers[3] % 100 < suffix_first:
        return n, "spm", first, last - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, last - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output was made from. No mark stands in such a text, and none can arise at a seam."""
    if form == "plain":
        return output
    rest, _, middle = output.partition(MIDDLE)
    lead, between = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, _, two = rest.removeprefix(lead).partition(between)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, unit: str = LINE, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output, restored`` of each row of ``docs`` (``doc_id, text``).

    ``unit`` is a pattern whose repetitions make up the text; ``n`` counts them. Both cuts are drawn from the seed
    and the id. ``plain``, the text as it is: empty texts (NULL too), texts that hold a mark or that the units do
    not make up, and ``100 - rate`` percent of the rest; lengths are then NULL. ``restored`` is rebuilt from output
    and form. Equal rows give equal results, rows without an id draw alike, texts of any length are whole, no
    rows give none, and other columns are ignored.
    """
    pattern = f"({unit})*"

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                ids, rows = column_of(batch, "doc_id"), []
                for doc_id, text in zip(ids.to_pylist(), column_of(batch, "text").to_pylist()):
                    own = rearranged(text or "", draws(doc_id, seed), units, rate, suffix_first)
                    rows.append((*own, restore(own[-1], own[1])))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
                yield pa.RecordBatch.from_arrays([ids, *columns], names)

    rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return rows.mapInArrow(transform, _SCHEMA)
