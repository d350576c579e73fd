"""BM25 (the variant without the k1 + 1 factor): inverted index, equi-join on terms, grouped sum, top-k.

`Index.scored` is that plan, for all hits. Hits are nearly as many as passages times queries, so `Index.top` does the same
join and sum for a few passages at a time inside the scan, and keeps the k best of each query there (`best`); where the
queries are no small table, it ranks what `scored` gives.

idf = ln(1 + (N - df + 0.5) / (df + 0.5)); weight = idf tf / (tf + k1 (1 - b + b dl / avgdl)); a repeated query term counts
as often as it stands. Only passages with a common term are hits. Ranks go by the score rounded to six decimals, then by
corpus order, so that they do not depend on the order of summation.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from loomrank.functions import text as tx
from loomrank.operators import best
from loomrank.session import share_code

#: Query-side tables are broadcast up to this many rows and bytes; beyond, Spark chooses.
MOST_BROADCAST_ROWS = 500_000
MOST_BROADCAST_BYTES = 64 << 20


class Stemmer(Protocol):
    """Loaded once in each Python worker; maps a term to its stem. name: part of an index's manifest."""

    name: str

    def load(self) -> Callable[[str], str]: ...


@dataclass(frozen=True)
class Bm25:
    k1: float = 0.9
    b: float = 0.4
    stop_words: tuple[str, ...] = tx.STOP_WORDS
    stemmer: Stemmer | None = None

    def terms(self, text: Column) -> Column:
        found = tx.terms(text, self.stop_words)
        return found if self.stemmer is None else stemmed(found, self.stemmer)

    def key(self) -> dict:
        return {"k1": self.k1, "b": self.b, "stop_words": self.stop_words, "stemmer": self.stemmer and self.stemmer.name}


def stemmed(terms: Column, stemmer: Stemmer) -> Column:
    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        stem = stemmer.load()
        for batch in batches:
            yield batch.map(lambda words: None if words is None else [stem(w) for w in words])

    return run(terms)


DEFAULT = Bm25()


PASSAGE = ["doc_pos", "chunk_idx"]


def norm2(terms: Column) -> Column:
    """The sum of squared term counts."""
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).cast("long").alias("sum"))

    def step(acc: Column, term: Column) -> Column:
        run = F.when(acc.last == term, acc.run + 1).otherwise(F.lit(1))
        return F.struct(term.alias("last"), run.alias("run"), (acc["sum"] + (2 * run - 1)).alias("sum"))

    return F.aggregate(F.array_sort(terms), start, step, lambda acc: acc["sum"])


def tokenized(passages: DataFrame, rule: Bm25 = DEFAULT) -> DataFrame:
    """Passages with their terms, length in terms and in chars, and norm2, the sum of squared term counts."""
    return with_terms(passages, rule).withColumn("norm2", norm2(F.col("terms")))


def with_terms(passages: DataFrame, rule: Bm25 = DEFAULT) -> DataFrame:
    """`tokenized` without norm2, which is dear and asked of hits alone."""
    return passages.withColumn("terms", rule.terms(F.col("text"))).withColumn("dl", F.size("terms")).withColumn("chars", F.length("text"))


def corpus_stats(tokens: DataFrame) -> DataFrame:
    """One row: number of passages and their mean length."""
    return tokens.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))


def postings(tokens: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(term, doc_pos, chunk_idx, dl, tf); only(term): a small set of terms to keep, met before anything moves. What is left is
    dealt by passage, so that counting terms here and summing over a passage later need no other exchange."""
    each = tokens.select(*PASSAGE, "dl", F.explode("terms").alias("term"))
    if only is not None:
        each = each.join(only, "term", "left_semi").repartition(*PASSAGE)
    return each.groupBy("term", *PASSAGE, "dl").agg(F.count("*").alias("tf"))


def term_df(tokens: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(term, df), summed in each task before anything moves."""
    each = tokens.select(F.explode(F.array_distinct("terms")).alias("term"))
    if only is not None:
        each = each.join(only, "term", "left_semi")
    return each.groupBy("term").agg(F.count("*").alias("df"))


def query_terms(queries: DataFrame, rule: Bm25 = DEFAULT) -> DataFrame:
    """(query_id, term, qtf)."""
    each = queries.select("query_id", F.explode(rule.terms(F.col("text"))).alias("term"))
    return each.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row of df in memory."""

    def size(column: Column, kind) -> Column:
        if isinstance(kind, StringType | BinaryType):
            return F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(16)
        if isinstance(kind, ArrayType):
            wide = kind.elementType
            if isinstance(wide, StringType | BinaryType | ArrayType | StructType):
                return F.coalesce(F.aggregate(column, F.lit(16), lambda sum_, x: sum_ + size(x, wide).cast("int")), F.lit(16))
            return F.greatest(F.size(column), F.lit(0)) * 8 + F.lit(16)
        if isinstance(kind, StructType):
            return sum((size(column[f.name], f.dataType) for f in kind.fields), F.lit(8))
        return F.lit(8)

    return sum((size(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8)).cast("long")


def checked(df: DataFrame, most: int = MOST_BROADCAST_ROWS, most_bytes: int = MOST_BROADCAST_BYTES) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df, and a hint to broadcast tables of at most as many rows as df; it does nothing if df is not small, in rows and in
    bytes."""
    rows, size = df.limit(most + 1).agg(F.count("*"), F.sum(row_bytes(df))).first()
    return df, F.broadcast if rows <= most and (size or 0) <= most_bytes else lambda other: other


def small(df: DataFrame, most: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if a look at its first rows shows that it is small."""
    return checked(df, most)[1](df)


def cells(terms: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number of the term, tf) of the terms of `known` that lists of terms hold, by row and term."""
    number = pc.index_in(terms.flatten(), value_set=known)
    there = number.is_valid()
    row = pc.filter(pc.list_parent_indices(terms), there).to_numpy(zero_copy_only=False).astype(np.int64)
    pair, tf = np.unique(row * len(known) + pc.drop_null(number).to_numpy(zero_copy_only=False), return_counts=True)
    return pair // max(1, len(known)), pair % max(1, len(known)), tf


def counted(tokens: DataFrame, known: pa.Array) -> DataFrame:
    """(number, df) of the terms of `known` that occur, a small array: one row for each term and task leaves the scan."""
    share_code(tokens.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            total += np.bincount(cells(batch.column(0), known)[1], minlength=len(known))
        found = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["number", "df"])

    return tokens.select("terms").mapInArrow(count, "number long, df long").groupBy("number").agg(F.sum("df").alias("df"))


@dataclass(frozen=True)
class Asked:
    """The terms of a small set of queries, on the driver: query, term and qtf of each pair, by term."""

    ids: pa.Array
    terms: pa.Array
    query: np.ndarray
    term: np.ndarray
    qtf: np.ndarray

    @staticmethod
    def of(pairs: pa.Table) -> Asked:
        ids, terms = pairs["query_id"].combine_chunks(), pairs["term"].combine_chunks()
        each, known = pc.unique(ids), pc.unique(terms)
        number = lambda values, among: pc.index_in(values, value_set=among).to_numpy(zero_copy_only=False).astype(np.int64)
        query, term, qtf = number(ids, each), number(terms, known), pairs["qtf"].to_numpy().astype(np.int64)
        order = np.lexsort((query, term))
        return Asked(each, known, query[order], term[order], qtf[order])

    def block(self, first: int, n: int) -> Asked:
        """Queries first to first + n - 1, numbered from 0; the terms keep their numbers."""
        here = (self.query >= first) & (self.query < first + n)
        return Asked(self.ids.slice(first, n), self.terms, self.query[here] - first, self.term[here], self.qtf[here])


def best_of(tokens: DataFrame, asked: Asked, idfs: np.ndarray, avgdl: float, rule: Bm25, k: int, query_id: StructField) -> DataFrame:
    """The rows of `scored` that are among the k best of their query in their task."""
    share_code(tokens.sparkSession)
    n, ids, known, query, qtf = len(asked.ids), asked.ids, asked.terms, asked.query, asked.qtf
    fan = np.bincount(asked.term, minlength=len(known))
    start = np.cumsum(fan) - fan
    idf_of = idfs[asked.term]
    k1, b = float(rule.k1), float(rule.b)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = best.Best(k, n, *PASSAGE)
        for piece in best.pieces(batches, n):
            row, term, tf = cells(piece.column("terms"), known)
            dl = piece.column("dl").to_numpy(zero_copy_only=False)[row]
            weight = tf / (tf + k1 * (1.0 - b + b * dl / avgdl))
            times = fan[term]
            each = np.repeat(np.arange(len(term)), times)  # the join: postings with the queries of their term
            at = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(start[term], times)
            cell, size = row[each] * n + query[at], piece.num_rows * n
            total = lambda x: np.bincount(cell, x, size)  # noqa: B023, E731
            scores, matched, shared = best.rounded(total(qtf[at] * idf_of[at] * weight[each])), total(qtf[at] * tf[each]), total(idf_of[at])
            rows, queries = kept.hopeful(scores.reshape(-1, n), matched.reshape(-1, n) > 0)
            found = rows * n + queries
            passage = piece.select(PASSAGE).take(pa.array(rows))
            kept.add(pa.table({"_query": queries, **{c: passage.column(c) for c in PASSAGE}, "_score": scores[found], "matched": matched[found].astype(np.int64), "shared": shared[found]}))
        rows = kept.cut()
        if rows is not None:
            yield from rows.set_column(0, "query_id", ids.take(rows["_query"])).rename_columns(["query_id", *PASSAGE, "bm25_score", "matched", "shared"]).to_batches(10_000)

    schema = StructType([query_id, *(tokens.schema[c] for c in PASSAGE), StructField("bm25_score", DoubleType()), StructField("matched", LongType()), StructField("shared", DoubleType())])
    return tokens.select(*PASSAGE, "dl", "terms").mapInArrow(search, schema)


class Index:
    """An inverted index: passages with their terms, corpus statistics, and postings.

    A `stored` index has postings and document frequencies in tables sorted by term; one made `over` passages draws the
    postings of the terms asked for from the passages' terms, in one pass for each set of queries.
    """

    def __init__(self, tokens: DataFrame, rule: Bm25, stats: DataFrame | None = None, post: DataFrame | None = None, dfs: DataFrame | None = None):
        self.tokens, self.rule, self._post, self._dfs = tokens, rule, post, dfs
        self.stats = corpus_stats(tokens) if stats is None else stats
        self._asked: tuple[DataFrame, Asked | None] | None = None
        self._counted: tuple[pa.Array, np.ndarray] | None = None

    @property
    def passages(self) -> DataFrame:
        return self.tokens

    @property
    def postings(self) -> DataFrame:
        return postings(self.tokens) if self._post is None else self._post

    @property
    def term_df(self) -> DataFrame:
        return term_df(self.tokens) if self._dfs is None else self._dfs

    def postings_of(self, terms: DataFrame) -> DataFrame:
        """Postings of terms(term), a small table."""
        return postings(self.tokens, terms) if self._post is None else self._post.join(terms, "term", "left_semi")

    def df_of(self, terms: DataFrame) -> DataFrame:
        """(term, df) of terms(term)."""
        return term_df(self.tokens, terms) if self._dfs is None else self._dfs.join(terms, "term", "left_semi")

    @staticmethod
    def over(passages: DataFrame, rule: Bm25 = DEFAULT, write: Callable[[DataFrame], DataFrame] | None = None) -> Index:
        """write: puts the passages with their terms down and reads them back, so that no query works them out again."""
        tokens = with_terms(passages, rule)
        return Index(write(tokens) if write is not None else tokens, rule)

    @staticmethod
    def build(passages: DataFrame, path: str, rule: Bm25 = DEFAULT) -> Index:
        """Write the tables under path and read them again. A manifest holds the parameters and a fingerprint of the
        passages; `open` refuses tables that were made for others."""
        spark = passages.sparkSession
        with_terms(passages, rule).write.mode("overwrite").parquet(f"{path}/tokens")
        tokens = spark.read.parquet(f"{path}/tokens")
        by_term = postings(tokens).repartitionByRange("term", *PASSAGE).sortWithinPartitions("term", *PASSAGE)  # a frequent term is cut
        by_term.write.mode("overwrite").parquet(f"{path}/postings")
        term_df(tokens).write.mode("overwrite").parquet(f"{path}/term_df")
        corpus_stats(tokens).write.mode("overwrite").parquet(f"{path}/stats")
        manifest = json.dumps({"rule": rule.key(), "passages": fingerprint(tokens)}, sort_keys=True)
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
        return Index._read(spark, path, rule)

    @staticmethod
    def _read(spark: SparkSession, path: str, rule: Bm25) -> Index:
        read = spark.read.parquet
        return Index(read(f"{path}/tokens"), rule, read(f"{path}/stats"), read(f"{path}/postings"), read(f"{path}/term_df"))

    @staticmethod
    def open(passages: DataFrame, path: str, rule: Bm25 = DEFAULT) -> Index:
        """The index under path if it was built for these passages and parameters, else a new one."""
        spark = passages.sparkSession
        try:
            found = spark.read.text(f"{path}/manifest").first()
        except AnalysisException:  # no such path
            found = None
        wanted = json.dumps({"rule": rule.key(), "passages": fingerprint(passages)}, sort_keys=True)
        return Index._read(spark, path, rule) if found is not None and found[0] == wanted else Index.build(passages, path, rule)

    def scored(self, queries: DataFrame) -> DataFrame:
        """(query_id, doc_pos, chunk_idx, bm25_score, matched, shared): all hits. matched: sum of query counts times passage
        counts of common terms; shared: sum of idf of the distinct common terms. Only terms of the queries are exchanged."""
        asked, few = checked(query_terms(queries, self.rule))
        only = few(asked.select("term").distinct())
        weights = few(asked).join(self.df_of(only), "term").crossJoin(F.broadcast(self.stats))  # stats is one row
        weights = few(weights.select("query_id", "term", "qtf", idf(F.col("n_docs"), F.col("df")).alias("idf"), "avgdl"))
        tf, dl = F.col("tf"), F.col("dl")
        k1, b = F.lit(float(self.rule.k1)), F.lit(float(self.rule.b))
        weight = F.col("qtf") * F.col("idf") * tf / (tf + k1 * (F.lit(1.0) - b + b * dl / F.col("avgdl")))
        joined = self.postings_of(only).join(weights, "term")
        sums = joined.groupBy("query_id", "doc_pos", "chunk_idx").agg(F.sum(weight).alias("bm25_score"), F.sum(F.col("qtf") * tf).alias("matched"), F.sum("idf").alias("shared"))
        return sums.withColumn("bm25_score", F.round("bm25_score", 6))

    def asked(self, queries: DataFrame) -> Asked | None:
        """The queries' terms on the driver, null if they are no small table. Those asked for last are kept."""
        if self._asked is None or self._asked[0] is not queries:
            pairs, few = checked(query_terms(queries, self.rule))
            self._asked = queries, Asked.of(pairs.toArrow()) if few is F.broadcast else None
        return self._asked[1]

    def idfs(self, terms: pa.Array) -> np.ndarray:
        """The idf of each of `terms`, a small array; a term that no passage has counts as df 0."""
        if self._counted is None or not self._counted[0].equals(terms):
            dfs = np.zeros(len(terms), np.int64)
            if self._dfs is None:
                found = counted(self.tokens, terms).toArrow()
                at = found["number"].to_numpy()
            else:
                found = self.df_of(F.broadcast(self.tokens.sparkSession.createDataFrame(pa.table({"term": terms})))).toArrow()
                at = pc.index_in(found["term"], value_set=terms).to_numpy()
            dfs[at] = found["df"].to_numpy()
            n_docs = self._stats_row()[0]
            self._counted = terms, np.log(1.0 + (n_docs - dfs + 0.5) / (dfs + 0.5))
        return self._counted[1]

    def _stats_row(self) -> tuple[int, float]:
        row = self.stats.select("n_docs", "avgdl").first()
        return row[0], row[1] or 0.0

    def few(self, queries: DataFrame, k: int) -> Callable[[DataFrame], DataFrame]:
        """A hint to broadcast hits of queries, k of each at most; it does nothing if they may be many."""
        asked = self.asked(queries)
        most = None if asked is None else len(asked.ids) * k
        return F.broadcast if most is not None and most <= MOST_BROADCAST_ROWS and most * 128 <= MOST_BROADCAST_BYTES else lambda hits: hits

    def top(self, queries: DataFrame, k: int = 200) -> DataFrame:
        """(query_id, doc_pos, chunk_idx, bm25_score, bm25_rank, matched, shared): the k best passages of each query."""
        order = Window.partitionBy("query_id").orderBy(F.desc("bm25_score"), "doc_pos", "chunk_idx")
        asked = self.asked(queries)
        if asked is None:
            rows = self.scored(queries)
        else:
            idfs, avgdl = self.idfs(asked.terms), self._stats_row()[1]
            blocks = [asked.block(i, best.QUERY_BLOCK) for i in range(0, max(1, len(asked.ids)), best.QUERY_BLOCK)]
            rows = reduce(DataFrame.unionAll, (best_of(self.tokens, b, idfs, avgdl, self.rule, k, queries.schema["query_id"]) for b in blocks))
        return rows.withColumn("bm25_rank", F.row_number().over(order)).where(F.col("bm25_rank") <= k)

    def search(self, queries: DataFrame, k: int = 200) -> DataFrame:
        """(query_id, bm25_rank, doc_id): ids alone, for any number of queries."""
        hits = self.few(queries, k)(self.top(queries, k))
        return hits.join(self.passages.select("doc_pos", "chunk_idx", "doc_id"), ["doc_pos", "chunk_idx"]).select("query_id", "bm25_rank", "doc_id")


def fingerprint(passages: DataFrame) -> str:
    """Count and order-free checksum of the passages."""
    row = passages.agg(F.count("*"), F.sum(F.xxhash64("doc_id", "text").cast("decimal(38,0)"))).first()
    return f"{row[0]}:{row[1]}"
