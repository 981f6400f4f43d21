"""A corpus pipeline over ``documents``; each stage's rows are written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starfeed.llm.jaccard_join import one_of_each
from starfeed.llm.packing import pack
from starfeed.llm.perplexity import judged
from starfeed.llm.secrets import redacted
from starfeed.workspace import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or lie outside their language's perplexity band go."""
    return judged(docs).where("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the least doc_id."""
    return one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; ``n_chars`` follows them."""
    return redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept texts as pieces of windows of 2,048 token ids."""
    return pack(docs).drop("ids")


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("secret scan", secret_scan), ("packing", packing)]

#: SQL cannot express MinHash banding, the models or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
