"""A corpus pipeline: quality rules, near-dedup, decontamination, mixing, and token records.

Each stage takes (spark, docs, sf_dir), judges everything that its predecessor kept, and returns a DataFrame; all but
the last one return the columns of documents. Between stages the rows are written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomrank.llm import decontaminate, mixing, quality_rules, simhash_dedup, token_records
from loomrank.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: fingerprints of five-word shingles, similarity 0.8 or more."""
    return simhash_dedup.drop_near_duplicates(docs.select(*COLUMNS), width=5, least=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its Poisson draw says, in the order of the mix."""
    return mixing.mix(docs.select(*COLUMNS), mixing.source_rates(docs)).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Record files with their index, and what reading them back shows."""
    return token_records.token_records(docs.select("doc_id", "text"), token_records.vocabulary())


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mix_sources),
    ("token records", tokens),
]

#: Fingerprints, alignment and tokenizing can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
