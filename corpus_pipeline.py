"""The corpus pipeline: stages from raw documents to encoded text, each over all that the one before it kept.

A stage takes `(spark, docs, sf_dir)` and returns a DataFrame that is written as Parquet and read again as the next
stage's documents; all but the last keep the columns of `documents`. Stages work on rows with null or empty texts as
the operators they call do: such texts are neither toxic nor copies nor contaminated, and encode to no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisift.llm import byte_bpe, decontamination, line_dedup, near_dedup, toxicity
from lumisift.llm.stored import stored

#: No single statement expresses a fitted classifier or a tokenizer; tests compare each stage with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold of their language."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), lang_col="lang")
    scored = docs.withColumn("__score", toxicity.score_column(model, spark, F.col("text")))
    return scored.where(F.col("__score") < toxicity.threshold_of(model, F.col("lang"))).drop("__score")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of repeated runs of lines; `n_chars` counts what is left."""
    return line_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates, over shingles of two words and a similarity of 0.8."""
    copies = near_dedup.near_duplicates(docs, width=2).where("not kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the digest of what they decode to."""
    return byte_bpe.coded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
