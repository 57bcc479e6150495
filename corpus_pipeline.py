"""The corpus pipeline: stages over documents, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, common, decontaminate, lines, minhash, quality

#: The columns that stages hand on.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents; n_chars is that of the text as it is now (null for null)."""
    return docs.select(*[F.length("text").cast("bigint").alias(n) if n == "n_chars" else F.col(n) for n in COLUMNS])


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the best grade is at least a half; the model is fitted on a bounded sample of the rated ones."""
    model = quality.train(docs.select("doc_id", "text"), common.table(spark, sf_dir, "labels"))
    return quality.classify(docs, model).where("keep").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that an earlier one has; documents of which nothing is left stay, empty."""
    return _documents(lines.dedup_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the least id."""
    return minhash.keep_first(docs).select(*COLUMNS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly made of them go."""
    return _documents(decontaminate.remove(docs, common.table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of them and of what they decode to."""
    return bpe.encode(docs.select("doc_id", "text"), with_ids=True).select("doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("bpe_encoding", encode),
]

#: Fitting a model and BPE cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, common.stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if hasattr(before, "_stashed_at"):
            common.discard(before)
    return docs
