"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes what a stage returns as Parquet in the
shared folder and reads it again for the next. All but the last return the columns of documents. The stages that run
Python bound the batches of texts that its workers get.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import byte_bpe, line_dedup, mixing, near_copies as near, quality
from orrery.llm.common import documents, materialise, small_batches


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content."""
    small_batches(spark)
    return quality.filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without globally repeated chunks of lines; n_chars follows the text."""
    found = line_dedup.dedup_lines(docs)
    return found.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash tiles over five-word shingles, a Jaccard similarity of 0.8 or more."""
    small_batches(spark)
    return near.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or twice."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens and digests of its ids and of the bytes they decode to."""
    small_batches(spark)
    return byte_bpe.digests(byte_bpe.encode(docs))


STAGES = [("quality rules", quality_rules), ("line dedup", line_chunks), ("near copies", near_copies), ("source mix", source_mix), ("tokens", tokens)]

#: A trained model and sampling have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
