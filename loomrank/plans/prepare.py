"""Preparation jobs: raw files to corpus, queries and qrels; and the whole labelling job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomrank import schemas
from loomrank.operators import bm25, passages
from loomrank.plans import cascade
from loomrank.plans.config import Config
from loomrank.sources import readers, sinks
from loomrank.streaming import incremental


def wiki(spark: SparkSession, root: str, queries: str, out: str) -> bool:
    """Pages and generated queries to JSON lines, unless both are there."""
    return sinks.export_if_absent({f"{out}/corpus.jsonl": readers.page_texts(spark, root), f"{out}/queries.jsonl": readers.raw_queries(spark, queries)})


def with_splits(corpus: DataFrame, train: tuple[DataFrame, DataFrame], dev: tuple[DataFrame, DataFrame], out: str) -> bool:
    """Corpus of the training part, queries and qrels (query_id, doc_id, relevance) of both parts, unless all are there."""
    queries = readers.with_split(train[0], dev[0]).select("query_id", "text", "split")
    qrels = readers.with_split(train[1], dev[1]).select("query_id", F.lit(0).alias("iter"), "doc_id", F.col("relevance").cast("int").alias("relevance"), "split")
    spark = corpus.sparkSession
    paths = [f"{out}/{n}" for n in ("corpus.jsonl", "queries.jsonl", "qrels.tsv")]
    if all(readers.exists(spark, p) for p in paths):
        return False
    sinks.write_jsonl(corpus.select("doc_id", "text"), paths[0], "overwrite")
    sinks.write_jsonl(queries, paths[1], "overwrite")
    sinks.write_qrels_with_split(qrels, paths[2], "overwrite")
    return True


def build_tables(spark: SparkSession, folder: str, out: str) -> dict[str, int]:
    """Parquet copies of prepared files; empty qrels are left out."""
    counts = {}
    frames = {"corpus": readers.jsonl_strict(spark, f"{folder}/corpus.jsonl", schemas.CORPUS), "queries": readers.jsonl_strict(spark, f"{folder}/queries.jsonl", schemas.QUERIES_WITH_SPLIT)}
    if readers.exists(spark, f"{folder}/qrels.tsv"):
        frames["qrels"] = readers.qrels_with_split(spark, f"{folder}/qrels.tsv")
    for name, frame in frames.items():
        if name != "qrels" or not frame.isEmpty():
            frame.write.mode("overwrite").parquet(f"{out}/{name}")
            counts[name] = spark.read.parquet(f"{out}/{name}").count()
    return counts


def limited(queries: DataFrame, most: int | None) -> DataFrame:
    """The first queries by id, after normalising; all if most is None."""
    return queries if most is None else queries.orderBy("query_id").limit(most)


def label(spark: SparkSession, config: Config, corpus: DataFrame, raw_queries: DataFrame, path: str, batches: int = 1, **more) -> incremental.Run:
    """Passages, index and labels for a corpus (doc_pos, doc_id, text) and queries; resumes what is under path."""
    plan = cascade.Cascade.from_config(config, **more)
    made = passages.passages_of(corpus, plan.chunking)
    index = bm25.Index.open(made, f"{path}/index", plan.bm25)
    run = incremental.Run(spark, f"{path}/run", index, plan)
    run.run(limited(readers.normalized_queries(raw_queries), config.get("agent.max_queries")), batches)
    sinks.write_qrels(run.qrels(), f"{path}/qrels.tsv", "overwrite")
    sinks.write_triples(run.triples(), f"{path}/triples.jsonl", "overwrite")
    return run
