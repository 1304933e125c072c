"""BPE encoding and decoding with the vocabulary file of a public tokenizer.

A word is a doubly linked list of symbols; a priority queue holds the merges between neighbours by
rank and place, and an entry is stale if one of its symbols has been merged since. Words repeat, so
each task keeps the encodings of those it has seen.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text_blocks import column_of

#: The white space of Unicode, and the word pattern of the vocabulary file.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = "'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+"
#: Letters, numbers and lower-case pairs of Unicode 16 and 17 that Python's own tables may lack.
_NEW = {
    "L": "1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b 1138e "
    "11390-113b5 113b7 113d1 113d3 11bc0-11be0 13460-143fa 16100-1611d 16d40-16d6c 18cff 1e5d0-1e5ed 1e5f0",
    "N": "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa",
}
_NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5}
_NEW_LOWER |= {0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_NEW_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
_KEPT_WORDS = 400_000
_BATCH = 512


def byte_symbols() -> list[str]:
    """The printable symbol of each byte: Latin-1 where that is visible, else the next from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return [chr(b) if b in set(visible) else chr(0x100 + hidden.index(b)) for b in range(256)]


def category_ranges(kind: str) -> str:
    """The characters of a general category as the inside of a pattern's brackets."""
    new = [[int(x, 16) for x in part.split("-")] for part in _NEW[kind].split()]
    added = {c for part in new for c in range(part[0], part[-1] + 1)}
    ranges: list[list[int]] = []
    for code in range(sys.maxunicode + 1):
        if code in added or unicodedata.category(chr(code))[0] == kind:
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in ranges)


class BpeModel:
    """A vocabulary with merge ranks, read from a tokenizer file with byte symbols and word ends."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = self.vocab
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in ids.items()} | {i: s for s, i in self.special.items()}
        longest = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("|".join(map(regex.escape, longest)) or r"(?!)")
        # Up to U+0530 the library's tables and the ones here agree, and the short classes are faster.
        self._rare = regex.compile(r"[^\x00-\u0530]")
        self._word = regex.compile(_WORD.format(letter=r"\p{L}", number=r"\p{N}", space=_SPACE))
        self._rare_word: regex.Pattern | None = None
        self._symbols = byte_symbols()
        self._seen: dict[str, tuple[int, str, str]] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours, lowest rank first and leftmost of equal ones, until no merge is left."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        merges, queue = self.merges, []

        def offer(left: int, right: int) -> None:
            found = merges.get((symbols[left], symbols[right]))
            if found is not None:
                heapq.heappush(queue, (found[0], left, right, symbols[left], symbols[right], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, left, right, a, b, merged = heapq.heappop(queue)
            if symbols[left] != a or after[left] != right or symbols[right] != b:
                continue  # stale
            symbols[left], symbols[right] = merged, -1
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
                offer(left, after[right])
            if before[left] >= 0:
                offer(before[left], left)
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> list[int]:
        symbols = [self._symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.end
        return self.merge([self.vocab[s] for s in symbols if s in self.vocab])

    def _known(self, word: str) -> tuple[int, str, str]:
        ids = self.word(word)
        if len(self._seen) >= _KEPT_WORDS:
            self._seen.clear()
        strings = " ".join(self.strings[i] for i in ids)
        self._seen[word] = found = (len(ids), " ".join(map(str, ids)), strings)
        return found

    def _words(self, text: str) -> list[str]:
        text = self.normalized(text)
        if not self._rare.search(text):
            return self._word.findall(text)
        if self._rare_word is None:
            letter, number = category_ranges("L"), category_ranges("N")
            self._rare_word = regex.compile(_WORD.format(letter=letter, number=number, space=_SPACE))
        return self._rare_word.findall(text.translate(_NEW_LOWER))

    @staticmethod
    def normalized(text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # letter by letter, so that a final sigma is not told apart
            return "".join(c.lower() for c in text)
        return text.lower()

    def _pieces(self, text: str) -> Iterator[tuple[int, str, str]]:
        seen, known = self._seen, self._known
        at = 0
        marks = [m.span() for m in self._special.finditer(text)] if "<|" in text else []
        for low, high in [*marks, (len(text), len(text))]:
            for word in self._words(text[at:low]):
                yield seen.get(word) or known(word)
            if high > low:
                yield 1, str(self.special[text[low:high]]), text[low:high]
            at = high

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self._pieces(text) for i in ids.split(" ") if i]

    def encoded(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids, and the vocabulary strings that they stand for, spaced."""
        pieces = [p for p in self._pieces(text) if p[0]]
        return sum(p[0] for p in pieces), " ".join(p[1] for p in pieces), " ".join(p[2] for p in pieces)

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings one after the other, spaced, as the file names no decoder."""
        return " ".join(self.strings[i] for i in ids if i in self.strings)


@lru_cache(maxsize=2)
def load_model(path: str) -> BpeModel:
    with open(path, encoding="utf-8") as file:
        return BpeModel(file.read())


def bpe_encode(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each text encoded and decoded again: ``doc_id``, the columns ``keep``, ``n_tokens, ids, decoded``.

    ``vocabulary``: path of the file on every machine. NULL and empty texts have no ids. Rows are
    encoded one by one, whole, whatever their length; equal rows give equal ids, other columns are ignored.
    """
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *keep, "text")
    own = [f for f in chosen.schema.fields if f.name != "text"]
    out = T.StructType([*own]).add("n_tokens", T.LongType())
    out = out.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, _BATCH):
                batch = whole.slice(at, _BATCH)
                found = [model.encoded(text.as_py() or "") for text in column_of(batch, "text")]
                ends = np.cumsum([0, *(n for n, _, _ in found)], dtype=np.int64)
                flat = np.fromstring(" ".join(ids for n, ids, _ in found if n), dtype=np.int32, sep=" ")
                columns = [column_of(batch, f.name) for f in own]
                columns += [pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]
                columns.append(pa.array([decoded for _, _, decoded in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in own), "n_tokens", "ids", "decoded"])

    return chosen.mapInArrow(run, out)


def bpe_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of :func:`bpe_encode`, without keeping the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(vocabulary)
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for text in column_of(batch, "text"):
                n, ids, decoded = model.encoded(text.as_py() or "")
                out[0].append(n)
                out[1].append(hashlib.sha256(ids.encode()).hexdigest())
                out[2].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            columns = [column_of(batch, "doc_id"), pa.array(out[0], pa.int64())]
            columns += [pa.array(x, pa.string()) for x in out[1:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    chosen = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return chosen.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
