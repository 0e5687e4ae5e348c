"""The corpus pipeline: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellcast.llm import edit_walk, packing, set_join, suffixes, toxicity
from cellcast.llm.queries import word_bpe
from cellcast.llm.rows import fold
from cellcast.session import scratch_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier scores 0.5 or more; it learns from four fifths of the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold("doc_id", 5) != 0)
    model = toxicity.fit_toxicity(docs, labels)
    return toxicity.score_toxicity(docs, model).where("toxicity_score < 0.5").drop("toxicity_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; of equal ids the smallest row by content."""
    return set_join.keep_representatives(docs, set_join.Similarity(words=5, share=80))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of 50 or more words are cut out; `n_chars` is counted anew."""
    out = suffixes.drop_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return edit_walk.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of all that is left, packed into sequences."""
    return packing.pack_documents(docs, word_bpe(), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("benchmark_leaks", drop_leaks),
    ("packing", pack),
]
#: SQL cannot express the stages; tests/llm holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
