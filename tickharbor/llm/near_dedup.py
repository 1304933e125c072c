"""Near-duplicate documents by HyperMinHash sketches of word shingles.

The shingle hashes of a document are dealt over buckets; a bucket keeps its smallest hash as leading
zeros and a few mantissa bits, one byte in all. Bands of these bytes propose candidates, the
collision-corrected Jaccard estimate sorts out most false ones, and full shingle sets confirm the rest.

Documents with equal sets are one class from the start. In each band bucket the classes are first held
against the smallest one only; then, in blocks, against those that are not yet in the same component.
So large groups of copies cost a row each, and no pair is left out for the size of its bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import stage
from .components import components
from .text_blocks import NOT_BLANK, SpanHash, blocks, column_of, mix, spans, window_hashes

SHINGLE = 5
#: Buckets of a sketch, and how many of them make a band: two documents at a similarity of 0.85 miss all
#: 60 bands once in 10**8 pairs.
BUCKETS, BAND = 480, 8
PERCENT = 85
MANTISSA_BITS = 4
#: Chance that two different smallest hashes leave the same byte: equal leading zeros and mantissa.
COLLISION = 1 / (3 * 2**MANTISSA_BITS)
#: No pair is a candidate below this estimate: five standard errors from 0.85. Registers that repeat others,
#: in small sets, are as good as a sample with replacement, so the bound holds for every size.
LEAST_ESTIMATE = 0.765
#: A word of 48 register parities and a size comes with each class, to sort out most chance meetings before
#: registers are fetched: documents at 0.85 differ in 3.6 parities on average, and in more than 15
#: twice in 10**7 pairs by the binomial sum.
PARITIES, MOST_DIFFERENT, PARITY_SET = 48, 15, 60
SIZE_STEPS = 1000
BLOCK_ROWS = 512
_SKETCH = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, tag bigint, registers binary"


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, list[np.ndarray]]]:
    """For each block the number of its first text and the sorted shingle hashes of each text.

    A text with fewer words than ``size`` has its whole word sequence as one shingle, one without words has none.
    """
    for block in blocks(texts):
        block = block.lowered()
        starts, ends, firsts = spans(block, NOT_BLANK)
        words = SpanHash(block.data)(starts, ends)
        windows = window_hashes(words, size)
        bounds, out = firsts.tolist(), []
        for low, high in zip(bounds[:-1], bounds[1:]):
            if high - low >= size:
                out.append(np.unique(windows[low : high - size + 1]))
            else:
                out.append(window_hashes(words[low:high], high - low)[:1] if high > low else words[:0])
        yield block.first, out


def _donors(buckets: int) -> np.ndarray:
    """For each bucket the order in which the others are asked for a value if it is empty."""
    rng = np.random.default_rng(5)
    return np.stack([rng.permutation(buckets) for _ in range(buckets)], axis=1)


def registers(sets: list[np.ndarray], buckets: int = BUCKETS) -> np.ndarray:
    """One byte for each bucket of each set; empty buckets repeat another's, the same way for every set."""
    out = np.zeros((len(sets), buckets), dtype=np.uint8)
    full = np.zeros((len(sets), buckets), dtype=bool)
    k, low = np.uint64(buckets), np.uint64(0xFFFFFFFF)
    for i, own in enumerate(sets):
        if len(own):
            scaled = (own >> np.uint64(32)) * k
            bucket = (scaled >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            rest = (scaled[first] & low) | np.uint64(1)
            zeros = 31 - np.log2(rest.astype(np.float64)).astype(np.int64)
            mantissa = (rest << (zeros + 1).astype(np.uint64) & low) >> np.uint64(32 - MANTISSA_BITS)
            out[i, bucket[first]] = np.minimum(zeros, 15) << MANTISSA_BITS | mantissa.astype(np.int64)
            full[i, bucket[first]] = True
    rows = np.flatnonzero(full.any(axis=1) & ~full.all(axis=1))
    values, has, known = out[rows], full[rows], full[rows].copy()
    for donor in _donors(buckets):
        take = ~known & has[:, donor]
        values[take] = out[rows][:, donor][take]
        known |= take
        open_rows = ~known.all(axis=1)
        if not open_rows.any():
            break
        if open_rows.mean() < 0.5:  # go on with those that still have empty buckets
            out[rows[~open_rows]] = values[~open_rows]
            rows, values, has, known = rows[open_rows], values[open_rows], has[open_rows], known[open_rows]
    out[rows] = values
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers, corrected for bytes that are equal by chance."""
    return (((a == b).mean(axis=-1) - COLLISION) / (1 - COLLISION)).clip(0, 1)


def tags(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Parities of every tenth register, and above them the logarithm of the set's size in thousandths."""
    parities = np.bitwise_count(values[:, :: BUCKETS // PARITIES]) & 1
    word = (parities.astype(np.int64) << np.arange(PARITIES)).sum(axis=1)
    return word | np.round(np.log(np.maximum(sizes, 1)) * SIZE_STEPS).astype(np.int64) << PARITIES


def _tags_allow(a: Column, b: Column) -> Column:
    """Whether two tags leave room for a link: near enough in size, and in parities unless a set is small."""
    size_a, size_b = F.shiftright(a, PARITIES), F.shiftright(b, PARITIES)
    sizes = F.abs(size_a - size_b) <= int(np.log(100 / PERCENT) * SIZE_STEPS) + 2
    different = F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit((1 << PARITIES) - 1)))
    small = F.least(size_a, size_b) < int(np.log(PARITY_SET) * SIZE_STEPS)
    return sizes & (small | (different <= MOST_DIFFERENT))


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, registers`` of each row; two sums over the set stand for it."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column_of(batch, "doc_id")
            for first, sets in shingle_sets(column_of(batch, "text")):
                sums = [(int(s.sum()), int(mix(s).sum())) for s in sets]
                values = registers(sets)
                kept = [bytes(r) for r in values]
                columns = [ids.slice(first, len(sets)), pa.array([len(s) for s in sets], pa.int64())]
                columns += [pa.array(np.array([s[i] for s in sums], dtype=np.uint64).view(np.int64)) for i in (0, 1)]
                columns += [pa.array(tags(values, np.array([len(s) for s in sets]))), pa.array(kept, pa.binary())]
                names = ["doc_id", "n_shingles", "set_a", "set_b", "tag", "registers"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(sketch, _SKETCH)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), BUCKETS)


def _near_enough(n_a, n_b, registers_a, registers_b) -> np.ndarray:
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return (100 * small >= PERCENT * large) & (estimate(registers_a, registers_b) >= LEAST_ESTIMATE)


def likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of ``pairs`` (``a, b``) whose sizes and estimated similarity allow a link."""

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [column_of(batch, c).to_numpy() for c in ("n_a", "n_b")]
            ok = _near_enough(*n, *(_matrix(column_of(batch, c)) for c in ("registers_a", "registers_b")))
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return _with_both(pairs, classes, ["n", "registers"]).mapInArrow(screen, "a bigint, b bigint")


def _with_both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    for side in ("a", "b"):
        own = table.select(F.col("rep").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", *[f"{c}_{s}" for c in columns for s in ("a", "b")])


def shingle_table(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``rep, shingles``: the full sets of the documents ``wanted`` (``rep``), from whole texts."""
    # A merge join whatever the sizes: the texts are far larger than the ids, and those grow with them.
    texts = docs.selectExpr("CAST(doc_id AS BIGINT) AS rep", "text").join(wanted.hint("merge"), "rep", "left_semi")

    def collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column_of(batch, "rep")
            for first, sets in shingle_sets(column_of(batch, "text")):
                shingles = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(sets)), shingles], ["rep", "shingles"])

    return stage(texts.mapInArrow(collect_sets, "rep bigint, shingles binary"), "shingles")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` that are linked by their full shingle sets."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for left, right in zip(column_of(batch, "shingles_a"), column_of(batch, "shingles_b")):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (left, right))
                both = np.concatenate([a, b])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                ok.append(common > 0 and 100 * common >= PERCENT * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return stage(_with_both(pairs, sets, ["shingles"]).mapInArrow(confirm, "a bigint, b bigint"), "links")


def _across(members: DataFrame) -> DataFrame:
    """Likely pairs of ``members`` (``key, band, rep, label, n, registers``) of one key and different labels.

    The members of a key are dealt over blocks of some ``BLOCK_ROWS`` rows, and each two blocks of a
    key meet in one group, so that no group grows with the key. Only likely pairs come out, each for the
    first band that it has in common.
    """
    counts = members.groupBy("key").agg(F.countDistinct("label").alias("labels"), F.count(F.lit(1)).alias("rows"))
    counts = counts.where("labels > 1").select("key", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = members.join(counts, "key").withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "band", "rep", "label", "n", "registers",
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            heads = _group_heads(table)
            yield _pairs_of(table.slice(0, heads[-1]), heads[:-1])
            rest = table.slice(heads[-1])
        if rest is not None:
            yield _pairs_of(rest, _group_heads(rest))

    at = ["key", "low", "high"]
    return dealt.repartition(*at).sortWithinPartitions(*at).mapInArrow(meet, "a bigint, b bigint").distinct()


def _group_heads(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for name in ("key", "low", "high"):
        values = table[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _pairs_of(table: pa.Table, heads: np.ndarray) -> pa.RecordBatch:
    found: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
    if len(heads):
        names = ("band", "rep", "label", "n", "own", "low", "high")
        band, rep, label, n, own, low, high = (table[c].to_numpy() for c in names)
        values = _matrix(table["registers"].combine_chunks())
        for begin, end in zip(heads, np.append(heads[1:], table.num_rows)):
            for i in range(begin, end):
                j = np.arange(i + 1, end)
                j = j[(label[j] != label[i]) & ((own[j] != own[i]) | (low[i] == high[i]))]
                j = j[_near_enough(n[i], n[j], values[i], values[j])]
                same = (values[j] == values[i]).reshape(len(j), BUCKETS // BAND, BAND).all(axis=2)
                j = j[same.argmax(axis=1) == band[i]]
                found.append(np.stack([np.maximum(rep[i], rep[j]), np.minimum(rep[i], rep[j])], axis=1))
    pairs = np.concatenate(found)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs`` (``doc_id, text``).

    Two documents are linked if their sets of 5-word shingles have a Jaccard similarity of 0.85 or more;
    a component's id is its smallest ``doc_id``, and that document is kept. NULL texts and those
    without words are linked with nothing. Rows that share a ``doc_id`` are one document; rows without
    one are kept, with component NULL. Other columns are ignored.
    """
    rows = stage(sketches(docs), "sketches")
    sets = ["n_shingles", "set_a", "set_b"]
    classes = stage(
        rows.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy(*sets)
        .agg(F.min("doc_id").alias("rep"), F.min("tag").alias("tag"), F.first("registers").alias("registers"))
        .withColumnRenamed("n_shingles", "n"),
        "classes",
    )
    # One class for each set: a document with several of them (its rows differ) joins their classes.
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS // BAND - 1)),
        lambda band: F.xxhash64(band, F.substring("registers", band * BAND + 1, F.lit(BAND))),
    )
    members = classes.select("rep", "tag", F.posexplode(bands).alias("band", "key"))
    hubs = members.groupBy("key").agg(
        F.min("rep").alias("hub"), F.min_by("tag", "rep").alias("hub_tag"), F.max("rep").alias("last")
    )
    hubs = hubs.where("hub < last").drop("last")
    shared = stage(members.join(hubs, "key").where("rep <> hub"), "members")

    near_hub = shared.where(_tags_allow(F.col("tag"), F.col("hub_tag")))
    stars = near_hub.select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    ends = shared.select("rep").union(shared.select("hub")).distinct()
    full_sets = shingle_table(ends, docs)
    links = confirmed(stage(likely(stars, classes), "likely"), full_sets)
    labels = stage(components(links), "labels").select(F.col("node").alias("rep"), "label")

    rest = shared.join(labels, "rep", "left").select("key", "band", "rep", F.coalesce("label", "rep").alias("label"))
    several = rest.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
    open_rows = stage(rest.join(several, "key", "left_semi"), "open").join(classes.select("rep", "n", "registers"), "rep")
    more = stage(_across(open_rows), "across")
    if not more.isEmpty():
        links = links.unionByName(confirmed(more, full_sets))
        labels = stage(components(links), "labels").select(F.col("node").alias("rep"), "label")

    of_set = classes.drop("registers", "tag").withColumnRenamed("n", "n_shingles").join(labels, "rep", "left")
    of_set = of_set.select(*sets, F.coalesce("label", "rep").alias("component"))
    out = rows.drop("registers", "tag").join(of_set, sets, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    return out.select("doc_id", "n_shingles", component).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
