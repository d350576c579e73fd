"""From documents to passages: length filter, sliding word windows, quality filter, first-copy dedup.

Documents are rows (doc_pos, doc_id, text); doc_pos is the corpus order, which decides what copy stays.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomrank.functions import text as tx
from loomrank.session import spread


@dataclass(frozen=True)
class Chunking:
    size: int = 160
    stride: int = 80
    least_words: int = 20
    least_chars: int = 50
    least_alpha: float = 0.5
    key_chars: int = 200


DEFAULT = Chunking()
#: Windows are made of up to so many blocks, of up to so many words (an expression repeats its group by recursion).
MOST_BLOCKS = 16
MOST_WORDS = 512


def long_enough(docs: DataFrame, rule: Chunking = DEFAULT) -> DataFrame:
    return docs.where(tx.stripped_at_least(F.col("text"), rule.least_chars))


def n_chunks(n_words: Column, rule: Chunking = DEFAULT) -> Column:
    """Windows of a document that keep at least `least_words` words; the rest of a text is shorter than the one before."""
    return F.when(n_words >= rule.least_words, F.floor((n_words - rule.least_words) / rule.stride).cast("int") + 1).otherwise(F.lit(0))


def chunked(docs: DataFrame, rule: Chunking = DEFAULT) -> DataFrame:
    """(doc_pos, chunk_idx, doc_id, text, source_doc_id): windows of `size` words, each `stride` words on."""
    split = spread(docs.select("doc_pos", "doc_id", "text")).select("doc_pos", F.col("doc_id").alias("source_doc_id"), tx.words(F.col("text")).alias("w")).where(F.size("w") >= rule.least_words)
    starts = F.sequence(F.lit(0), n_chunks(F.size("w"), rule) - 1)
    block = math.gcd(rule.size, rule.stride)
    if rule.size // block <= MOST_BLOCKS and block <= MOST_WORDS:
        # slice() goes through all words for each window; blocks of words are found in one pass and make up the windows
        blocks = F.regexp_extract_all(F.array_join("w", " "), F.lit(f"[^ ]+(?: [^ ]+){{0,{block - 1}}}"), F.lit(0))
        split = split.select("doc_pos", "source_doc_id", starts.alias("starts"), blocks.alias("b"))
        texts = F.transform("starts", lambda k: F.concat_ws(" ", *(F.get("b", k * (rule.stride // block) + i) for i in range(rule.size // block))))
    else:
        texts = F.transform(starts, lambda k: F.array_join(F.slice("w", k * rule.stride + 1, rule.size), " "))
    each = split.select("doc_pos", "source_doc_id", F.posexplode(texts).alias("chunk_idx", "text"))  # not the words, once for each window
    return each.select("doc_pos", "chunk_idx", tx.chunk_id(F.col("source_doc_id"), F.col("chunk_idx")).alias("doc_id"), "text", "source_doc_id")


def with_default_ids(docs: DataFrame, rule: Chunking = DEFAULT) -> DataFrame:
    """(doc_pos, doc_id, text) from (doc_pos, doc_id, id, text): doc_id, else id, else the number of passages produced by
    the documents before. The running number is built from partial sums by ranges of positions, so no single task sees
    all documents."""
    text = F.col("text")
    made = F.when(F.length(tx.strip(text)) >= rule.least_chars, n_chunks(tx.word_count(text), rule)).otherwise(F.lit(0))
    counted = docs.withColumn("_n", F.coalesce(made, F.lit(0)).cast("long")).withColumn("_range", F.floor(F.col("doc_pos") / 65536))
    inside = Window.partitionBy("_range").orderBy("doc_pos").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counted.groupBy("_range").agg(F.sum("_n").alias("_sum"))
    ahead = ranges.select(F.col("_range"), F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    numbered = counted.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(ahead, "_range")
    doc_id = F.coalesce(F.col("doc_id"), F.col("id").cast("string"), (F.col("_ahead") + F.col("_inside")).cast("string"))
    return numbered.select("doc_pos", doc_id.alias("doc_id"), "text")


def reject_reason(text: Column, rule: Chunking = DEFAULT) -> Column:
    """Why a passage goes, the first rule that holds; null if it stays."""
    return (
        F.when(tx.word_count(text) < rule.least_words, "short")
        .when(tx.alpha_ratio(text) < F.lit(rule.least_alpha), "alpha")
        .when(tx.has_boilerplate(text), "boilerplate")
    )


def good(passages: DataFrame, rule: Chunking = DEFAULT, counted: bool = False) -> DataFrame:
    """counted: the passages come from `chunked` with this rule, which makes none of fewer words."""
    text = F.col("text")
    clean = (tx.alpha_ratio(text) >= F.lit(rule.least_alpha)) & ~tx.has_boilerplate(text)
    return passages.where(clean if counted else (tx.word_count(text) >= rule.least_words) & clean)


def first_copies(passages: DataFrame, rule: Chunking = DEFAULT) -> DataFrame:
    """Of passages with equal keys the first in corpus order. The rank limit is applied before the shuffle as well, so a
    key that holds a large share of all passages sends one row from each task."""
    order = Window.partitionBy("_key").orderBy("doc_pos", "chunk_idx")
    keyed = passages.withColumn("_key", F.unhex(tx.dedup_key(F.col("text"), rule.key_chars)))
    return keyed.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_key", "_rn")


def passages_of(docs: DataFrame, rule: Chunking = DEFAULT) -> DataFrame:
    """The whole chain; the quality filter comes before dedup."""
    made = chunked(long_enough(docs, rule), rule)
    kept = first_copies(good(made.drop("doc_id"), rule, counted=True), rule)  # the ids need not move, they are made again
    return kept.withColumn("doc_id", tx.chunk_id(F.col("source_doc_id"), F.col("chunk_idx"))).select(*made.columns)


def removal_counts(docs: DataFrame, rule: Chunking = DEFAULT) -> DataFrame:
    """(reason, n): passages dropped by each quality rule."""
    return chunked(long_enough(docs, rule), rule).select(reject_reason(F.col("text"), rule).alias("reason")).where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))
