"""The cascade: BM25 top 200, similarity top 100, pair score top 40, banded sample, judge, mine.

One set-based plan over all queries given; `streaming.incremental` feeds it micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomrank.operators import bm25, judging, mining, passages, ranking
from loomrank.plans.config import Config


@dataclass(frozen=True)
class Cascade:
    chunking: passages.Chunking = passages.DEFAULT
    bm25: bm25.Bm25 = bm25.DEFAULT
    bm25_k: int = 200
    dense_k: int = 100
    pair_k: int = 40
    negatives: int = 10
    seed: str = "sample"
    use_prefilter: bool = True
    judge: judging.Judge = field(default_factory=judging.CoverageJudge)
    embedder: ranking.Embedder | None = None
    scorer: ranking.PairScorer | None = None

    @staticmethod
    def from_config(config: Config, **more) -> Cascade:
        get = config.get
        return Cascade(
            chunking=passages.Chunking(size=get("corpus.passage_tokens", 160), stride=get("corpus.passage_stride", 80)),
            bm25=bm25.Bm25(k1=get("bm25.k1", 0.9), b=get("bm25.b", 0.4)),
            bm25_k=get("agent.global_top_k_bm25", 200),
            dense_k=get("agent.dense_top_k_from_bm25", 100),
            negatives=get("agent.hard_negatives_per_query", 10),
            **more,
        )


def with_passages(hits: DataFrame, index: bm25.Index, *columns: str) -> DataFrame:
    """hits with columns of their passages. The hits are the small side: `Index.few` gives the hint where it bounds them."""
    return hits.join(index.tokens.select(*ranking.PASSAGE, *columns), ranking.PASSAGE)


def lexical(index: bm25.Index, queries: DataFrame, k: int) -> DataFrame:
    """BM25 hits with their texts."""
    return with_passages(index.few(queries, k)(index.top(queries, k)), index, "doc_id", "text")


def dense(index: bm25.Index, queries: DataFrame, plan: Cascade) -> DataFrame:
    few = index.few(queries, plan.bm25_k)
    hits = with_passages(few(index.top(queries, plan.bm25_k)), index, "doc_id", "chars", "terms")
    hits = hits.withColumn("norm2", bm25.norm2(F.col("terms"))).drop("terms")
    if plan.embedder is None:
        return ranking.term_cosine_top(hits, index, queries, plan.dense_k)
    asked = with_passages(few(hits.select(*ranking.PASSAGE).distinct()), index, "text")
    texts = ranking.embedded(asked, plan.embedder).select(*ranking.PASSAGE, "embedding")
    rows = hits.join(texts, ranking.PASSAGE).withColumn("length", F.col("chars"))
    return ranking.vector_top(ranking.embedded_queries(queries, plan.embedder), rows, plan.dense_k)


def paired(index: bm25.Index, queries: DataFrame, plan: Cascade) -> DataFrame:
    rows = dense(index, queries, plan)
    if plan.scorer is None:
        return ranking.coverage_top(rows, index, queries, plan.pair_k)
    pairs = with_passages(index.few(queries, plan.dense_k)(rows), index, "text").join(queries.select("query_id", F.col("text").alias("query")), "query_id")
    return ranking.ranked(ranking.pair_scored(pairs, plan.scorer).drop("query", "text"), "ce_rank", F.desc("ce_score"), "dense_rank", k=plan.pair_k)


def candidates(index: bm25.Index, queries: DataFrame, plan: Cascade) -> DataFrame:
    """(query_id, query, doc_id, text, bm25_rank, dense_rank, ce_rank, ce_score, cand_pos): what is judged."""
    sample = ranking.banded_sample(paired(index, queries, plan), seed=plan.seed)
    chosen = with_passages(index.few(queries, plan.pair_k)(sample), index, "text")
    named = chosen.join(bm25.small(queries.select("query_id", F.col("text").alias("query"))), "query_id")
    return named.select("query_id", "query", "doc_id", "text", "bm25_rank", "dense_rank", "ce_rank", "ce_score", "cand_pos")


def judged(index: bm25.Index, queries: DataFrame, plan: Cascade, cache: DataFrame | None = None, write: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    return judging.judged(candidates(index, queries, plan), cache, plan.judge, plan.use_prefilter, write)


def labels(rows: DataFrame, plan: Cascade) -> tuple[DataFrame, DataFrame]:
    """(qrels, triples) of judged rows."""
    return mining.qrels(rows), mining.triples(rows, plan.negatives)
