"""Reranking and sampling: similarity top-k, pair scores, rank bands, and Arrow interfaces for models.

The relational stand-ins score with term statistics alone, so every step can be checked; they show the flow of data, not
the quality of labels. Real models plug in through `Embedder` and `PairScorer`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loomrank.functions import vector
from loomrank.operators import best, bm25
from loomrank.session import share_code, spread

PASSAGE = bm25.PASSAGE


class Embedder(Protocol):
    """Loaded once in each Python worker; gives a unit vector for each text."""

    def load(self) -> Callable[[list[str]], list[list[float]]]: ...


class PairScorer(Protocol):
    """Loaded once in each Python worker; gives a score for each (query, text)."""

    def load(self) -> Callable[[list[str], list[str]], list[float]]: ...


def embedded(texts: DataFrame, embedder: Embedder, column: str = "text") -> DataFrame:
    """texts with an `embedding` column. Rows are sorted by length inside partitions, so a batch holds texts of like size."""
    share_code(texts.sparkSession)

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = embedder.load()
        for batch in batches:
            yield pd.Series(run(batch.fillna("").tolist()), index=batch.index)

    return texts.sortWithinPartitions(F.length(column)).withColumn("embedding", encode.asNondeterministic()(F.col(column)))


def embedding_stats(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """One row: number of vectors and their bytes as floats."""
    return rows.agg(F.count(column).alias("n_vectors"), F.coalesce(F.sum(F.size(column).cast("long") * 4), F.lit(0)).alias("bytes"))


def default_device() -> str:
    """cuda, mps or cpu: the best that a worker's torch offers, cpu without torch."""
    try:
        import torch
    except ImportError:
        return "cpu"
    if torch.cuda.is_available():
        return "cuda"
    return "mps" if torch.backends.mps.is_available() else "cpu"


def embedded_queries(queries: DataFrame, embedder: Embedder) -> DataFrame:
    """Each distinct query text is encoded once."""
    distinct = embedded(queries.select("text").distinct(), embedder)
    return queries.join(distinct, "text")


def pair_scored(pairs: DataFrame, scorer: PairScorer) -> DataFrame:
    """pairs(query, text, ...) with a `ce_score` column rounded to six decimals."""
    share_code(pairs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        run = scorer.load()
        for query, text in batches:
            yield pd.Series(run(query.fillna("").tolist(), text.fillna("").tolist()), index=query.index, dtype=float)

    return pairs.withColumn("ce_score", F.round(score.asNondeterministic()(F.col("query"), F.col("text")), 6))


def ranked(rows: DataFrame, name: str, *order: Column | str, k: int) -> DataFrame:
    """rows with their rank in each query, k at most. The limit also works before the shuffle."""
    window = Window.partitionBy("query_id").orderBy(*order)
    return rows.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)


def vector_top(queries: DataFrame, candidates: DataFrame, k: int = 100) -> DataFrame:
    """(query_id, doc_id, sim, dense_rank, ...) from queries(query_id, embedding) and candidates(query_id, doc_id, embedding,
    length, bm25_rank); ties go to the shorter text, then to the better rank."""
    q = bm25.small(queries.select("query_id", F.col("embedding").alias("q_embedding")))
    sims = candidates.join(q, "query_id").withColumn("sim", F.round(vector.dot(F.col("embedding"), F.col("q_embedding")), 6)).drop("embedding", "q_embedding")
    return ranked(sims, "dense_rank", F.desc("sim"), "length", "bm25_rank", k=k)


def matrix(vectors: pa.Array, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, matrix) of the vectors of that width that hold no null."""
    here = np.nonzero(pc.fill_null(pc.list_value_length(vectors), -1).to_numpy() == wide)[0]
    flat = vectors.take(pa.array(here)).flatten()
    if flat.null_count:
        whole = ~flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, wide).any(axis=1)
        here, flat = here[whole], vectors.take(pa.array(here[whole])).flatten()
    return here, flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(here), wide)


def vector_search(queries: DataFrame, rows: DataFrame, k: int = 100) -> DataFrame:
    """(query_id, sim, dense_rank, ...) from queries(query_id, embedding, skip) and rows(doc_id, embedding, length, bm25_rank,
    ...): the k rows most like each query, of all rows but those whose doc_id is `skip`; order as in `vector_top`, vectors
    that can't be compared last. All pairs are compared, as products of matrices inside the scan of the rows, and the best
    kept there; if the queries are no small table, by a join."""
    asked, few = bm25.checked(queries)
    if few is not F.broadcast:
        given = rows.join(queries.select("query_id", "skip"), ~F.col("doc_id").eqNullSafe(F.col("skip"))).drop("skip")
        return vector_top(queries, given, k)
    share_code(rows.sparkSession)
    table = asked.toArrow().combine_chunks()
    names = [c for c in rows.columns if c != "embedding"]
    schema = StructType([queries.schema["query_id"], *(rows.schema[c] for c in names), StructField("sim", DoubleType())])
    wide = spread(rows)
    parts = (wide.mapInArrow(_searching(table.slice(at, best.QUERY_BLOCK), names, k), schema) for at in range(0, max(1, table.num_rows), best.QUERY_BLOCK))
    return ranked(reduce(DataFrame.unionAll, parts), "dense_rank", F.desc("sim"), "length", "bm25_rank", k=k)


def _searching(table: pa.Table, names: list[str], k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    n = table.num_rows
    ids, skip, vectors = (pa.concat_arrays(table[c].chunks) if n else pa.array([], table.schema.field(c).type) for c in ("query_id", "skip", "embedding"))
    widths = [int(w) for w in pc.unique(pc.drop_null(pc.list_value_length(vectors)))]
    asked = [(w, *matrix(vectors, w)) for w in widths]
    barred = pc.drop_null(pc.unique(skip))
    number = pc.fill_null(pc.index_in(skip, value_set=barred), -1).to_numpy()
    by_number = np.argsort(number, kind="stable")
    ends = np.searchsorted(number[by_number], np.arange(len(barred) + 1))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = best.Best(k, n, "length", "bm25_rank")
        for piece in best.pieces(batches, n) if n else ():
            sims, known, found = np.full((piece.num_rows, n), -np.inf), np.zeros((piece.num_rows, n), bool), np.ones((piece.num_rows, n), bool)
            for w, which, of_queries in asked:
                here, of_rows = matrix(piece.column("embedding"), w)
                whole = len(here) == piece.num_rows and len(which) == n
                cells = slice(None) if whole else np.ix_(here, which)
                sims[cells], known[cells] = of_rows @ of_queries.T, True
            if np.isnan(sims).any():  # NaN comes first
                odd = np.isnan(sims)
                order = np.where(odd, np.inf, sims)
            else:
                odd, order = None, sims
            same = pc.fill_null(pc.index_in(piece.column("doc_id"), value_set=barred), -1).to_numpy()
            for row in np.nonzero(same >= 0)[0]:
                found[row, by_number[ends[same[row]] : ends[same[row] + 1]]] = False
            at, query = kept.hopeful(order, found, slack=1e-6)
            sim = best.rounded(sims[at, query])
            score = sim if odd is None else np.where(odd[at, query], np.inf, sim)
            row = piece.select(names).take(pa.array(at))
            kept.add(pa.table({"_query": query, **{c: row.column(c) for c in names}, "_score": score, "sim": pa.array(sim, mask=~known[at, query])}))
        rows = kept.cut()
        if rows is not None:
            yield from rows.set_column(0, "query_id", ids.take(rows["_query"])).drop_columns(["_score"]).to_batches(10_000)

    return search


# ------------------------------------------------------------------ stand-ins


def term_cosine_top(hits: DataFrame, index: bm25.Index, queries: DataFrame, k: int = 100) -> DataFrame:
    """The bi-encoder's stand-in: cosine of term counts. hits: rows of Index.top with the passages' norm2 and chars."""
    counts = bm25.query_terms(queries, index.rule)
    q_norm = counts.groupBy("query_id").agg(F.sqrt(F.sum(F.col("qtf") * F.col("qtf")).cast("double")).alias("q_norm"))
    sim = F.round(F.col("matched") / (F.col("q_norm") * F.sqrt(F.col("norm2").cast("double"))), 6)
    rows = hits.join(bm25.small(q_norm), "query_id").withColumn("sim", sim).drop("q_norm", "norm2")
    return ranked(rows, "dense_rank", F.desc("sim"), "chars", "bm25_rank", k=k)


def query_weight(index: bm25.Index, queries: DataFrame) -> DataFrame:
    """(query_id, weight): sum of idf over the distinct terms of each query, known to the corpus or not."""
    known = index.asked(queries)
    if known is not None:
        weight = np.bincount(known.query, index.idfs(known.terms)[known.term], len(known.ids))
        return F.broadcast(queries.sparkSession.createDataFrame(pa.table({"query_id": known.ids, "weight": weight})))
    asked = bm25.query_terms(queries, index.rule)
    terms = asked.join(index.df_of(asked.select("term").distinct()), "term", "left").crossJoin(F.broadcast(index.stats))  # one row
    return terms.groupBy("query_id").agg(F.sum(bm25.idf(F.col("n_docs"), F.coalesce("df", F.lit(0)))).alias("weight"))


def coverage_top(dense: DataFrame, index: bm25.Index, queries: DataFrame, k: int = 40) -> DataFrame:
    """The cross-encoder's stand-in: the idf-weighted share of the query's distinct terms that the passage has."""
    rows = dense.join(query_weight(index, queries), "query_id").withColumn("ce_score", F.round(F.col("shared") / F.col("weight"), 6)).drop("weight")
    return ranked(rows, "ce_rank", F.desc("ce_score"), "dense_rank", k=k)


# ------------------------------------------------------------------ sampling


@dataclass(frozen=True)
class Band:
    first: int
    last: int
    quota: int


#: All of the best ten ranks, ten of the next twenty, five of the twenty after.
BANDS = (Band(1, 10, 10), Band(11, 30, 10), Band(31, 50, 5))


def banded_sample(rows: DataFrame, rank: str = "ce_rank", bands: tuple[Band, ...] = BANDS, seed: str = "sample") -> DataFrame:
    """rows with cand_pos, 1 onwards in each query: every band in turn, a seeded choice of its quota where it has more.
    The first band keeps its order."""
    band = F.lit(None).cast("int")
    quota = F.lit(None).cast("int")
    for i, b in reversed(list(enumerate(bands))):
        here = F.col(rank).between(b.first, b.last)
        band = F.when(here, F.lit(i)).otherwise(band)
        quota = F.when(here, F.lit(b.quota)).otherwise(quota)
    draw = F.md5(F.concat_ws("|", F.lit(seed), "query_id", "doc_id"))
    key = F.when(F.col("band") == 0, F.format_string("%010d", F.col(rank))).otherwise(draw)
    chosen = rows.withColumn("band", band).withColumn("_quota", quota).where("band IS NOT NULL").withColumn("_key", key)
    inside = Window.partitionBy("query_id", "band").orderBy("_key")
    chosen = chosen.withColumn("_in", F.row_number().over(inside)).where("_in <= _quota")
    order = Window.partitionBy("query_id").orderBy("band", "_in")
    return chosen.withColumn("cand_pos", F.row_number().over(order)).drop("_quota", "_key", "_in")
