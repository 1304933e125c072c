"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

A text is cut into overlapping windows of words. A word's inputs are what its own hash, and those of
its character n-grams, say about the labels (log-odds from all labelled rows), and fixed random
features of them; two GRUs read the window from either end, attention pools their states, and the text's
score is that of its worst window. Counting and scoring run in tasks; the network, of fixed size, is
trained in numpy on a bounded sample of the labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stage
from .language import fold
from .text_blocks import LETTERS, Block, SpanHash, blocks, column_of, owners, spans

WINDOW, STRIDE, HIDDEN = 32, 16, 8
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
NGRAMS = (3, 4, 5)
#: At most so many labelled rows of each label train the network.
SAMPLE = 1_000
EPOCHS, RATE, BATCH = 10, 0.02, 64
THRESHOLD = 0.7
_RANDOM = 6
_WINDOWS_AT_ONCE = 2048


@dataclass
class Words:
    """The words of a block: distinct ones, which of them stands where, and their n-grams."""

    firsts: np.ndarray
    which: np.ndarray
    hashes: np.ndarray
    grams: np.ndarray
    gram_firsts: np.ndarray


def read_words(block: Block) -> Words:
    block = block.lowered()
    starts, ends, firsts = spans(block, LETTERS)
    hashes, first, which = np.unique(SpanHash(block.data)(starts, ends), return_index=True, return_inverse=True)
    # Distinct words again, each between edge marks, for their n-grams.
    low, size = starts[first], (ends - starts)[first]
    bounds = np.concatenate([[0], np.cumsum(size + 2)])
    text = np.full(bounds[-1], 0x20, dtype=np.uint8)
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size + 2)
    inner = (at > 0) & (at <= np.repeat(size, size + 2))
    text[inner] = block.data[(np.repeat(low, size + 2) + at - 1)[inner]]
    sums = SpanHash(text, seed=2)
    owner = np.repeat(np.arange(len(low)), size + 2)
    parts, whose = [], []
    for n in NGRAMS:
        begin = np.arange(max(len(text) - n + 1, 0))
        begin = begin[owner[begin] == owner[begin + n - 1]]
        parts.append(sums(begin, begin + n))
        whose.append(owner[begin])
    grams, whose = np.concatenate(parts), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    counts = np.bincount(whose, minlength=len(low))
    return Words(firsts, which.ravel(), hashes, grams[order], np.concatenate([[0], np.cumsum(counts)]))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def label_counts(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each label with each bucket, [word or n-gram, label, bucket], and documents of each label.

    Over all rows of ``labelled`` (``text, label``); one row of fixed size comes back from each task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros((2, 2, BUCKETS), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            labels = column_of(batch, "label").to_numpy(zero_copy_only=False)
            for block in blocks(column_of(batch, "text"), 1 << 20):
                words = read_words(block)
                buckets, gram_buckets = _bucket(words.hashes), _bucket(words.grams)
                for i in range(block.size):
                    label = labels[block.first + i]
                    rows[label] += 1
                    own = np.unique(words.which[words.firsts[i] : words.firsts[i + 1]])
                    seen[0, label, np.unique(buckets[own])] += 1
                    grams = [gram_buckets[words.gram_firsts[w] : words.gram_firsts[w + 1]] for w in own.tolist()]
                    if grams:
                        seen[1, label, np.unique(np.concatenate(grams))] += 1
        used = np.flatnonzero(seen.ravel())
        keys = np.concatenate([used, seen.size + np.arange(2)])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([seen.ravel()[used], rows]))], ["key", "n"])

    parts = labelled.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(4 * BUCKETS + 2)
    flat[parts["key"].to_numpy()] = parts["n"].to_numpy()
    return flat[:-2].reshape(2, 2, BUCKETS), flat[-2:]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Input tables, and the weights of the two GRUs, the attention and the output."""

    odds: np.ndarray
    base_rate: float
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def untrained(cls, counts: np.ndarray, rows: np.ndarray, strength: float = 8.0) -> Network:
        rate = float((rows[1] + 1) / (rows.sum() + 4))
        share = (counts[:, 1] + strength * rate) / (counts.sum(axis=1) + strength)
        odds = np.log(share / (1 - share)) - np.log(rate / (1 - rate))
        rng = np.random.default_rng(7)
        inputs, h = 4 + _RANDOM, HIDDEN
        shapes = {"w": (2, inputs, 3 * h), "u": (2, h, 3 * h), "b": (2, 3 * h), "a": (2 * h,), "o": (2 * h,), "c": ()}
        weights = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in shapes.items() if k not in "bc"}
        weights |= {k: np.zeros(shapes[k], np.float32) for k in "bc"}
        return cls((odds / 3).clip(-3, 3).astype(np.float32), rate, weights)

    def inputs(self, words: Words) -> np.ndarray:
        """Input row of each distinct word, and a last one of zeros for places past a window's end."""
        own = self.odds[0][_bucket(words.hashes)]
        odds = self.odds[1][_bucket(words.grams)]
        n = len(own)
        out = np.zeros((n + 1, 4 + _RANDOM), dtype=np.float32)
        if n:
            at = words.gram_firsts[:-1]
            out[:n, 0] = own
            out[:n, 1] = np.maximum.reduceat(odds, at)
            out[:n, 2] = np.minimum.reduceat(odds, at)
            out[:n, 3] = np.add.reduceat(odds, at) / np.diff(words.gram_firsts)
            for k in range(_RANDOM // 2):
                out[:n, 4 + k] = ((words.hashes >> np.uint64(8 * k)) & np.uint64(255)) / 512 - 0.25
                bits = ((words.grams >> np.uint64(8 * k)) & np.uint64(255)).astype(np.float32) / 512 - 0.25
                out[:n, 4 + _RANDOM // 2 + k] = np.add.reduceat(bits, at) / np.diff(words.gram_firsts)
        return out

    def read(self, projected: list[np.ndarray], places: np.ndarray, mask: np.ndarray, keep: bool = False):
        """States of both GRUs at each place, [window, place, 2 * hidden]; with ``keep``, what backpropagation needs."""
        n, length, h = len(places), places.shape[1], HIDDEN
        states = np.zeros((n, length, 2 * h), dtype=np.float32)
        kept: list[list] = [[], []]
        for side in range(2):
            u, state = self.weights["u"][side], np.zeros((n, h), dtype=np.float32)
            for t in range(length) if side == 0 else range(length - 1, -1, -1):
                x = projected[side][places[:, t]]
                g = state @ u
                gates = _sigmoid(x[:, : 2 * h] + g[:, : 2 * h])
                z, r = gates[:, :h], gates[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * g[:, 2 * h :])
                m = mask[:, t, None]
                after = state + m * (1 - z) * (new - state)
                if keep:
                    kept[side].append((t, state, z, r, new, g[:, 2 * h :]))
                state = after
                states[:, t, side * h : (side + 1) * h] = state
        return (states, kept) if keep else states

    def pooled(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Attention weights, pooled states and logits of windows."""
        energy = np.where(mask > 0, states @ self.weights["a"] * 4, -1e9)
        energy = np.exp(energy - energy.max(axis=1, keepdims=True))
        attention = energy / energy.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", attention, states)
        return attention, pooled, pooled @ self.weights["o"] * 4 + self.weights["c"]

    def window_logits(self, inputs: np.ndarray, windows: np.ndarray) -> np.ndarray:
        projected = [inputs @ self.weights["w"][s] + self.weights["b"][s] for s in range(2)]
        pad = len(inputs) - 1
        out = np.zeros(len(windows), dtype=np.float32)
        for at in range(0, len(windows), _WINDOWS_AT_ONCE):
            places = windows[at : at + _WINDOWS_AT_ONCE]
            mask = (places != pad).astype(np.float32)
            out[at : at + _WINDOWS_AT_ONCE] = self.pooled(self.read(projected, places, mask), mask)[2]
        return out

    def gradients(self, inputs: np.ndarray, places: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss over windows."""
        w, h = self.weights, HIDDEN
        mask = (places != len(inputs) - 1).astype(np.float32)
        projected = [inputs @ w["w"][s] + w["b"][s] for s in range(2)]
        states, kept = self.read(projected, places, mask, keep=True)
        attention, pooled, logits = self.pooled(states, mask)
        d_logit = (_sigmoid(logits) - targets).astype(np.float32) / len(targets)
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        grads["o"], grads["c"] = 4 * d_logit @ pooled, np.float32(d_logit.sum())
        d_pooled = 4 * d_logit[:, None] * w["o"]
        share = np.einsum("nth,nh->nt", states, d_pooled)
        d_energy = attention * (share - (attention * share).sum(axis=1, keepdims=True)) * 4
        grads["a"] = np.einsum("nt,nth->h", d_energy, states)
        d_states = attention[:, :, None] * d_pooled[:, None, :] + d_energy[:, :, None] * w["a"]
        for side in range(2):
            u, carried = w["u"][side], np.zeros((len(places), h), dtype=np.float32)
            for t, state, z, r, new, gn in reversed(kept[side]):
                d = carried + d_states[:, t, side * h : (side + 1) * h]
                m = mask[:, t, None]
                d_new = d * m * (1 - z) * (1 - new * new)
                d_z = -d * m * (new - state) * z * (1 - z)
                d_r = d_new * gn * r * (1 - r)
                d_gates = np.concatenate([d_z, d_r, d_new], axis=1)
                d_g = np.concatenate([d_z, d_r, d_new * r], axis=1)
                x = inputs[places[:, t]]
                grads["w"][side] += x.T @ d_gates
                grads["b"][side] += d_gates.sum(axis=0)
                grads["u"][side] += state.T @ d_g
                carried = d * (1 - m * (1 - z)) + d_g @ u.T
        return grads


def windows_of(words: Words, length: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of each window, [window, place], and the text that it belongs to.

    Windows start every ``stride`` words, the last where it takes in the text's end; a text without words has none.
    """
    sizes = np.diff(words.firsts)
    counts = np.where(sizes > 0, np.maximum(-(-(sizes - length) // stride), 0) + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = words.firsts[:-1][owner, None] + number[:, None] * stride + np.arange(length)
    which = np.append(words.which, len(words.hashes))
    return np.where(at < words.firsts[1:][owner, None], which[np.minimum(at, len(words.which))], len(words.hashes)), owner


def worst(logits: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The highest logit of each text's windows; minus infinity without windows."""
    out = np.full(texts, -np.inf)
    np.maximum.at(out, owner, logits)
    return out


def train(network: Network, texts: list[str], labels: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Fit the weights on whole texts: in each epoch on the window of each text that scores highest so far."""
    rng = np.random.default_rng(11)
    parts = []
    for block in blocks(pa.array(texts, pa.string()), 1 << 19):
        words = read_words(block)  # not kept: the n-grams take far more room than the inputs made of them
        windows, owner = windows_of(words)
        parts.append((block.first, network.inputs(words), windows.astype(np.int32), owner.astype(np.int32)))
    weights = network.weights
    mean, square = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        rows, targets = [], []
        for first, inputs, windows, owner in parts:
            logits = network.window_logits(inputs, windows)
            if epoch == 0:  # before any training: the window with the most telling word
                logits = inputs[windows][:, :, :2].sum(axis=2).max(axis=1)
            order = np.lexsort((-logits, owner))
            heads = order[np.unique(owner[order], return_index=True)[1]]
            rows.append(inputs[windows[heads]])
            targets.append(labels[first + owner[heads]])
        if not rows or not sum(map(len, rows)):
            return network
        x, y = np.concatenate(rows), np.concatenate(targets).astype(np.float32)
        flat = np.concatenate([x.reshape(-1, x.shape[2]), np.zeros((1, x.shape[2]), np.float32)])
        places = np.arange(len(x) * x.shape[1]).reshape(len(x), -1)
        places = np.where(np.abs(x).sum(axis=2) > 0, places, len(flat) - 1)
        for batch in np.array_split(rng.permutation(len(x)), max(len(x) // BATCH, 1)):
            step += 1
            used, back = np.unique(places[batch], return_inverse=True)
            own = np.concatenate([flat[used[used < len(flat) - 1]], flat[-1:]])
            grads = network.gradients(own, back.reshape(len(batch), -1), y[batch])
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                rate = RATE * (1 - epoch / epochs) + 1e-3
                weights[k] = weights[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
    return network


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Network:
    """Network from ``labelled`` (``doc_id, text, label`` 0 or 1).

    Word statistics come from all rows, the weights from at most ``sample`` rows of each label (those
    whose ids hash lowest). Without rows of both labels the network gives the base rate.
    """
    rows = labelled.select("doc_id", "text", F.col("label").cast("int").alias("label")).where("label IN (0, 1)")
    rows = stage(rows, "labelled")
    counts, totals = label_counts(rows.select("text", "label"))
    network = Network.untrained(counts, totals)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = rows.select("doc_id", "label")
    chosen = [r.doc_id for k in (0, 1) for r in ids.where(F.col("label") == k).orderBy(*order).limit(sample).collect()]
    # At most 2 * sample ids; their texts alone come to the driver.
    wanted = rows.sparkSession.createDataFrame([(i,) for i in set(chosen)], "doc_id bigint")
    taken = rows.join(wanted, "doc_id", "left_semi").orderBy("doc_id").collect()
    if not totals.all():
        network.weights = {k: np.zeros_like(v) for k, v in network.weights.items()}
        return network
    return train(network, [r.text or "" for r in taken], np.array([r.label for r in taken]))


def score_texts(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of each row of ``docs`` (``doc_id, text``).

    The score is that of the worst of all overlapping windows of the whole text; NULL texts and those
    without words get the base rate of the labels. Equal texts score alike; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # some four megabytes, whatever the input

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            ids = column_of(batch, "doc_id")
            for block in blocks(column_of(batch, "text"), 2 << 20):
                words = read_words(block)
                windows, owner = windows_of(words)
                logits = worst(model.window_logits(model.inputs(words), windows), owner, block.size)
                scores = np.where(np.isneginf(logits), min(model.base_rate, 0.5), _sigmoid(logits))
                columns = [ids.slice(block.first, block.size), pa.array(scores)]
                columns.append(pa.array((scores >= threshold).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    chosen = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return chosen.mapInArrow(score, "doc_id bigint, score double, predicted int")


def labelled_rows(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """``doc_id, text, label`` of the rows to learn from: labelled by ``toxic``, outside fold ``held``.

    Of several labels of one id the largest counts: a text that one label calls toxic is toxic.
    """
    own = labels.groupBy(F.col("doc_id").alias("labelled")).agg(F.max("toxic").alias("label"))
    chosen = docs.select("doc_id", "text").where(fold(F.col("doc_id"), folds) != held)
    # A merge join whatever the sizes, as the labels grow with the texts.
    return chosen.join(own.hint("merge"), chosen.doc_id == own.labelled).select("doc_id", "text", "label")


def held_out_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Scores of all rows from labels outside fold ``held``; a row without id is not learned from."""
    out = score_texts(docs, learn(labelled_rows(docs, labels, folds, held)))
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out")
    return out.select("doc_id", held_out, "score", "predicted")
