"""A corpus pipeline of five stages: quality rules, toxicity, near duplicates, source mix, BPE.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows its predecessor kept; all but the last return the
columns of the documents, whatever these are. A stage's result is written as Parquet in the shared folder and read again.

Nulls and odd input: a text that is null or empty fails the quality rules; repeated rows pass these and the toxicity stage
alike, and one of them passes the near-duplicate stage; the mix gives a document as often as its source's rate says. Further
columns may have any name. Near duplicates are linked as the operator links them: five words, 85 of 100 shingles in common.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, minhash, mixing, quality, toxicity
from millrace.session import scratch_path, tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return quality.keep_good(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return minhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return mixing.mix(docs)


def word_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return bpe.digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("word BPE", word_bpe),
]

# Tokenisers, nearest examples and sketches are beyond SQL. tests/llm/test_pipeline.py holds the base rules, near duplicates,
# the mix and the tokens against brute force, and the verdicts of the token bands and of toxicity against the operators' scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
