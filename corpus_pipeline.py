"""Raw documents to token ids: each stage works on what the one before it kept, read back from Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickharbor.llm.bpe import bpe_encode
from tickharbor.llm.decontaminate import contamination
from tickharbor.llm.line_dedup import without_shared_lines
from tickharbor.llm.near_dedup import near_duplicates
from tickharbor.llm.queries import read, vocabulary_path
from tickharbor.llm.toxicity import held_out_scores
from tickharbor.scratch import scratch_path


def _with_verdict(docs: DataFrame, verdicts: DataFrame, kept) -> DataFrame:
    """Rows of ``docs`` but those whose ``doc_id`` has a verdict that is not ``kept``; rows without an id stay."""
    gone = verdicts.where(~kept).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity network rejects; it learns from labels outside the held-out fold."""
    scores = held_out_scores(docs, read(spark, sf_dir, "labels"))
    return _with_verdict(docs, scores, F.col("predicted") == 0)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that many sites share; a document that consisted of them goes, but for the first."""
    out = without_shared_lines(docs)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"\S")
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; rows that share the id of a kept one are that document."""
    return _with_verdict(docs, near_duplicates(docs), F.col("kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item."""
    found = contamination(docs, read(spark, sf_dir, "benchmark"))
    return _with_verdict(docs, found, ~F.col("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_chars, n_tokens, ids`` and the digest of the decoded text."""
    out = bpe_encode(docs, vocabulary_path(), keep=("lang", "source", "n_chars"))
    return out.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: The first stage is a trained network: no SQL for the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.lower().replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
