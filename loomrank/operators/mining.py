"""From judged candidates to labels: positives, hard negatives, qrels and training triples.

Judged rows carry their ranks (bm25_rank, dense_rank, null where a list lacks them) and cand_pos, the order in which
candidates were judged, which orders the arrays and cuts the negatives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP = 20
NEGATIVES = 10


def is_positive() -> Column:
    return F.coalesce("answerable", F.lit(False)) & (F.coalesce("relevance_score", F.lit(0)) >= 2)


def in_top(rank: str, top: int = TOP) -> Column:
    return F.coalesce(F.col(rank) <= top, F.lit(False))


def is_hard() -> Column:
    """In exactly one of the two lists' tops, or scored 1."""
    return (in_top("bm25_rank") != in_top("dense_rank")) | (F.coalesce("relevance_score", F.lit(0)) == 1)


def positives(judged: DataFrame) -> DataFrame:
    return judged.where(is_positive())


def hard_negatives(judged: DataFrame, n: int = NEGATIVES) -> DataFrame:
    """The first n hard non-positives of each query, with neg_pos."""
    order = Window.partitionBy("query_id").orderBy("cand_pos")
    return judged.where(~is_positive() & is_hard()).withColumn("neg_pos", F.row_number().over(order)).where(F.col("neg_pos") <= n)


def qrels(judged: DataFrame) -> DataFrame:
    """(query_id, iter, doc_id, relevance_score): positives alone; a missing score is 3."""
    return positives(judged).select("query_id", F.lit(0).alias("iter"), "doc_id", F.coalesce("relevance_score", F.lit(3)).cast("int").alias("relevance_score"))


def triples(judged: DataFrame, n: int = NEGATIVES) -> DataFrame:
    """One row for each query with a positive, arrays in judged order. One grouped pass: a query has few candidates."""
    marked = judged.withColumn("_pos", is_positive()).withColumn("_hard", ~is_positive() & is_hard())
    entry = F.struct("cand_pos", "doc_id", F.coalesce("relevance_score", F.lit(3)).cast("int").alias("score"))
    grouped = marked.groupBy("query_id").agg(
        F.min("query").alias("query"),
        F.array_sort(F.collect_list(F.when(F.col("_pos"), entry))).alias("p"),
        F.array_sort(F.collect_list(F.when(F.col("_hard"), entry))).alias("n"),
    )
    return grouped.where(F.size("p") > 0).select(
        "query_id", "query", F.col("p.doc_id").alias("positive_doc_ids"), F.col("p.score").alias("positive_scores"), F.slice(F.col("n.doc_id"), 1, n).alias("hard_negative_doc_ids")
    )


def run_stats(judged: DataFrame, queries: DataFrame) -> DataFrame:
    """One row of counters over a run; queries without a hit count as processed."""
    counts = judged.agg(
        F.count("*").alias("passages_judged"),
        F.coalesce(F.sum(is_positive().cast("long")), F.lit(0)).alias("positives_found"),
        F.coalesce(F.sum((F.col("source") == "judge").cast("long")), F.lit(0)).alias("llm_calls"),
        F.coalesce(F.sum((F.col("source") == "cache").cast("long")), F.lit(0)).alias("cache_hits"),
        F.coalesce(F.sum((F.col("source") == "prefilter").cast("long")), F.lit(0)).alias("prefiltered"),
    )
    negatives = hard_negatives(judged).agg(F.count("*").alias("hard_negatives_found"))
    return queries.agg(F.countDistinct("query_id").alias("queries_processed")).crossJoin(counts).crossJoin(negatives)  # three single rows
