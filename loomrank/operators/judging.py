"""Judging candidates: cheap prefilter, cached judgments, a pluggable YES / NO judge.

Candidates are rows (query_id, query, doc_id, text, cand_pos, ...). A judge is asked only for what neither the cache nor
the prefilter settles; its answers come through `mapInPandas` and are written before anything else is derived from them,
so no pair is ever asked twice by a re-evaluated plan.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomrank.functions import text as tx
from loomrank.session import share_code

LEAST_TOKENS = 30
POSITIVE_SCORE = 3
#: The wording of the question (fixed values).
PROMPT = ("Query: ", "\nPassage: ", "\n\nCan the passage answer the query?\nReply ONLY: YES or NO")
PAYLOAD = {"temperature": 0.0, "max_tokens": 3, "stop": ["\n", "."]}


# ------------------------------------------------------------------ prefilter


def too_short(text: Column, least: int = LEAST_TOKENS) -> Column:
    return tx.word_count(text) < least


def no_overlap(query: Column, text: Column) -> Column:
    """No word of the query among the first hundred of the passage; holds for an empty query."""
    return ~F.arrays_overlap(tx.query_term_set(query), tx.passage_term_set(text))


def with_reject(rows: DataFrame) -> DataFrame:
    """rows with `reject`: whether the prefilter settles them as negative."""
    query, text = F.col("query"), F.col("text")
    return rows.withColumn("reject", too_short(text) | no_overlap(query, text))


# ------------------------------------------------------------------ prompts and verdicts


def prompt(query: Column, text: Column) -> Column:
    return F.concat(F.lit(PROMPT[0]), tx.line_feeds(query), F.lit(PROMPT[1]), tx.sanitized(text), F.lit(PROMPT[2]))


def payload(content: Column) -> Column:
    """The body of a chat request, as JSON."""
    message = F.struct(F.lit("user").alias("role"), content.alias("content"))
    stop = F.array(*(F.lit(x) for x in PAYLOAD["stop"]))
    return F.to_json(F.struct(F.array(message).alias("messages"), F.lit(PAYLOAD["temperature"]).alias("temperature"), F.lit(PAYLOAD["max_tokens"]).alias("max_tokens"), stop.alias("stop")))


def response_text(body: Column) -> Column:
    """choices[0].message.content of a response; null where it is missing or no JSON."""
    return F.get_json_object(body, "$.choices[0].message.content")


def is_yes(answer: Column) -> Column:
    return F.coalesce(F.contains(F.upper(answer), F.lit("YES")), F.lit(False))


def verdict(yes: Column) -> list[Column]:
    """relevance_score, answerable and confidence."""
    return [
        F.when(yes, POSITIVE_SCORE).otherwise(0).cast("int").alias("relevance_score"),
        yes.alias("answerable"),
        F.when(yes, 1.0).otherwise(0.0).cast("double").alias("confidence"),
    ]


# ------------------------------------------------------------------ judges


class Judge(Protocol):
    """judge_id names model and prompt, so that a cache never mixes them."""

    judge_id: str

    def answers(self, pairs: DataFrame) -> DataFrame:
        """pairs with `answer` (text, null after an error) and `error` (null if none)."""
        ...


@dataclass(frozen=True)
class CoverageJudge:
    """Deterministic stand-in: YES where the pair's `ce_score` reaches the threshold."""

    threshold: float = 0.5
    judge_id: str = "coverage"

    def answers(self, pairs: DataFrame) -> DataFrame:
        yes = F.col("ce_score") >= F.lit(float(self.threshold))
        return pairs.withColumn("answer", F.when(yes, "YES").otherwise("NO")).withColumn("error", F.lit(None).cast("string"))


@dataclass(frozen=True)
class ChatJudge:
    """Asks a chat server over HTTP, `concurrency` requests at a time in each task: requests in flight are tasks times
    that number. Any error makes the pair negative and is kept in `error`; there are no retries."""

    url: str
    judge_id: str
    timeout: float = 30.0
    concurrency: int = 20

    def answers(self, pairs: DataFrame) -> DataFrame:
        share_code(pairs.sparkSession)
        url, timeout, concurrency = self.url, self.timeout, self.concurrency

        def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import requests

            def one(body: str) -> tuple[str | None, str | None]:
                try:
                    reply = requests.post(url, data=body.encode(), headers={"Content-Type": "application/json"}, timeout=timeout)
                    reply.raise_for_status()
                    return json.loads(reply.text)["choices"][0]["message"]["content"], None
                except Exception as error:  # noqa: BLE001  one pair must not end the run
                    return None, f"{type(error).__name__}: {error}"[:300]

            with ThreadPoolExecutor(concurrency) as pool:
                for frame in frames:
                    found = list(pool.map(one, frame.pop("_body")))
                    yield frame.assign(answer=[a for a, _ in found], error=[e for _, e in found])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields) + ", answer string, error string"
        bodies = pairs.withColumn("_body", payload(prompt(F.col("query"), F.col("text"))))
        return bodies.mapInPandas(ask, schema)


def judged_by(pairs: DataFrame, judge: Judge, use_prefilter: bool = True, write: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """pairs with relevance_score, answerable, confidence, error and source ('prefilter' or 'judge'). write: puts the judge's
    answers down and reads them back."""
    flagged = with_reject(pairs) if use_prefilter else pairs.withColumn("reject", F.lit(False))
    asked = judge.answers(flagged.where("NOT reject").drop("reject"))
    if write is not None:
        asked = write(asked)
    names = pairs.columns
    fresh = asked.select(*names, *verdict(is_yes(F.col("answer"))), "error", F.lit("judge").alias("source"))
    settled = flagged.where("reject").select(*names, F.lit(0).alias("relevance_score"), F.lit(False).alias("answerable"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("error"), F.lit("prefilter").alias("source"))
    return fresh.unionByName(settled)


# ------------------------------------------------------------------ cache


def latest(cache: DataFrame) -> DataFrame:
    """The newest judgment for each (judge_id, query_hash, doc_id): the cache is an append-only table of batches."""
    order = Window.partitionBy("judge_id", "query_hash", "doc_id").orderBy(F.desc("batch_id"), F.desc("relevance_score"))
    return cache.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def split_by_cache(pairs: DataFrame, cache: DataFrame, judge_id: str) -> tuple[DataFrame, DataFrame]:
    """(pairs with the cached verdict, pairs without one), by one left join."""
    held = latest(cache.where(F.col("judge_id") == judge_id)).select("query_hash", "doc_id", "relevance_score", "answerable", "confidence", F.lit(True).alias("hit"))
    joined = pairs.withColumn("query_hash", tx.query_hash(F.col("query"))).join(held, ["query_hash", "doc_id"], "left")
    return joined.where("hit").drop("hit", "query_hash"), joined.where("hit IS NULL").select(*pairs.columns)


def cache_rows(judged: DataFrame, judge_id: str, batch_id: int, cache_errors: bool = False) -> DataFrame:
    """What a batch adds to the cache: verdicts of the judge and of the prefilter, errors only if asked for."""
    rows = judged.where("source <> 'cache'")
    if not cache_errors:
        rows = rows.where("error IS NULL")
    return rows.select(tx.query_hash(F.col("query")).alias("query_hash"), "doc_id", "relevance_score", "answerable", "confidence", F.lit(judge_id).alias("judge_id"), F.lit(batch_id).cast("long").alias("batch_id")).distinct()


def cache_stats(cache: DataFrame) -> DataFrame:
    return cache.agg(F.count("*").alias("n_judgments"), F.countDistinct("query_hash").alias("n_queries"))


def judged(pairs: DataFrame, cache: DataFrame | None, judge: Judge, use_prefilter: bool = True, write: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Cached verdicts first, then the prefilter, then the judge; source says which."""
    if cache is None:
        return judged_by(pairs, judge, use_prefilter, write)
    hits, misses = split_by_cache(pairs, cache, judge.judge_id)
    return judged_by(misses, judge, use_prefilter, write).unionByName(hits.withColumn("error", F.lit(None).cast("string")).withColumn("source", F.lit("cache")))
