"""LM scoring by stupid backoff (Brants et al., 2007), counted over the whole corpus.

Every document's n-grams are exploded inside its block, the block's counts are added up and sent to the n-gram's hash
bucket, the count tables of a bucket are summed over all blocks and joined back to the blocks that hold the n-gram, and
the scores of a document's positions are summed. What is gathered grows with the corpus; no vocabulary is fixed and no
n-gram that can reach a count of two is left out: one of three words or more is asked for in a later round, and only
where both its first and its last n - 1 words were counted twice or more, without which it can't be either.

S(w | context) = c(context w) / c(context) where c(context w) >= least_count, else `backoff` times S with a shorter
context; S(w) = c(w) / N. The score is the mean log10 S over the words of a document.

Defined results: null, empty and white texts have 0 words and a null score; the first words of a text have as much
context as there is; repeated rows count as often as they come; rows with a null doc_id are counted and scored like
others; an empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

from functools import reduce as fold

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomrank.llm.blocks import BLOCK_BYTES, Blocks, gathered, mixed, runs
from loomrank.llm.common import MULT

TOTAL = np.uint64(0)  # the key under which all words are counted
BACKOFF = 0.4
ORDER = 3
LEAST_COUNT = 2


class Grams:
    """The n-grams of a block's texts, asked for in rounds: of one and two words first, then of one word more each.

    `places[n]` are the positions (of last words) whose n-gram has been asked for, `counts[n]` the count in the corpus at
    every position, 0 where it isn't known.
    """

    def __init__(self, texts: list[bytes | None], order: int, enough: int):
        lists = [t.split() if t else [] for t in texts]
        self.n_docs, self.sizes = len(texts), np.fromiter(map(len, lists), np.int64, len(lists))
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w) for ws in lists for w in ws), np.uint64, int(self.sizes.sum()))
        self.owner = np.repeat(np.arange(self.n_docs, dtype=np.int32), self.sizes)
        self.order, self.enough = order, enough
        self.grams, self.n = self.hashes, 0
        self.places: dict[int, np.ndarray] = {}
        self.counts: dict[int, np.ndarray] = {}
        self.total = 0

    def inside(self, n: int) -> np.ndarray:
        """Positions that have n words of their document up to them."""
        out = np.zeros(len(self.owner), dtype=bool)
        out[n - 1 :] = self.owner[n - 1 :] == self.owner[: max(0, len(self.owner) - n + 1)]
        return out

    def _add(self) -> np.ndarray:
        """The keys of the n-grams of one word more that can matter."""
        n = self.n = self.n + 1
        if n > 1:
            self.grams = np.concatenate([self.grams[:1] * MULT, self.grams[:-1] * MULT + self.hashes[1:]])
        wanted = self.inside(n)
        if n > 2:
            often = self.counts[n - 1] >= self.enough
            wanted[1:] &= often[1:] & often[:-1]
        self.places[n] = np.flatnonzero(wanted)
        return np.maximum(mixed(self.grams[self.places[n]] + np.uint64(n)), TOTAL + np.uint64(1))

    def ask(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """The sorted distinct keys of the next round, and how often the block has each."""
        first = self.n == 0
        keys = np.concatenate([self._add() for _ in range(min(2, self.order) if first else 1)])
        order = np.argsort(keys)
        keys = keys[order]
        at = runs(keys)
        counts = np.diff(np.append(at, len(keys)))
        self.row = np.empty(len(keys), dtype=np.int64)
        self.row[order] = np.repeat(np.arange(len(at)), counts)
        keys, counts = keys[at], counts.astype(np.int64)
        if first:
            self.row += 1
            keys, counts = np.concatenate([[TOTAL], keys]), np.concatenate([[len(self.hashes)], counts])
        self.asked = (1, 2)[: self.order] if first else (self.n,)
        return keys, [counts]

    def learn(self, answer: np.ndarray) -> None:
        """The counts in the corpus of the keys of the last round."""
        if self.asked[0] == 1:
            self.total = int(answer[0])
        found = answer[self.row].astype(np.float64)
        for n in self.asked:
            own, found = found[: len(self.places[n])], found[len(self.places[n]) :]
            self.counts[n] = np.zeros(len(self.hashes))
            self.counts[n][self.places[n]] = np.maximum(own, 1.0) if n == 1 else own  # a word without an answer is counted once

    def score(self, least_count: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
        """log10 S at each position, and whether it was not scored by the longest context there is."""
        score = np.log10(self.counts[1]) - np.log10(max(1.0, float(self.total)))
        missed = np.zeros(len(score), dtype=bool)
        for n in range(2, self.order + 1):
            inside, c = self.inside(n), self.counts[n]
            known = inside & (c >= max(least_count, 1))
            at = np.flatnonzero(known)
            score[inside & ~known] += np.log10(backoff)
            score[at] = np.log10(c[at]) - np.log10(self.counts[n - 1][at - 1])
            missed[inside] = ~known[inside]
        return score, missed


def score_corpus(docs: DataFrame, order: int = ORDER, least_count: int = LEAST_COUNT, backoff: float = BACKOFF, block_bytes: int = 2 * BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_backoff (positions not scored by the longest context they have), score."""
    blocks = Blocks(docs, block_bytes)
    enough = min(max(least_count, 1), 2)
    rounds = max(1, order - 1)

    def after(texts: list[bytes | None], got: pa.Table | None, n_rounds: int) -> Grams:
        """The n-grams of a block with the answers of so many rounds."""
        grams = Grams(texts, order, enough)
        for turn in range(n_rounds):
            grams.ask()
            (answer,) = gathered(got, turn)[1] or [np.zeros(0, dtype=np.int64)]
            grams.learn(answer)
        return grams

    def summed(keys, values):
        """The count table of a bucket: n-grams with their counts in the corpus, and which of them matter."""
        place = np.argsort(keys)
        keys, counts = keys[place], values[0][place]
        at = runs(keys)
        total = np.add.reduceat(counts, at)
        return keys[at], (total >= enough) | (keys[at] == TOTAL), [total]  # words and contexts have no least count

    def conclude(ids, texts, got):
        grams = after(texts, got, rounds)
        score, missed = grams.score(least_count, backoff)
        sums = np.bincount(grams.owner, weights=score, minlength=grams.n_docs)
        return {
            "doc_id": ids, "n_words": grams.sizes, "n_backoff": np.bincount(grams.owner, weights=missed, minlength=grams.n_docs).astype(np.int64),
            "score": [s / n if n else None for s, n in zip(sums.tolist(), grams.sizes.tolist(), strict=True)],
        }

    answers = [blocks.exchange(blocks.ask_first(lambda ids, texts: Grams(texts, order, enough).ask()), summed, aligned=True)]
    for turn in range(1, rounds):
        asked = blocks.ask(lambda ids, texts, got, turn=turn: after(texts, got, turn).ask(), fold(DataFrame.union, answers))
        answers.append(blocks.exchange(asked, summed, aligned=True, turn=turn))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_backoff", pa.int64()), ("score", pa.float64())])
    return blocks.finish(conclude, fold(DataFrame.union, answers), schema, "doc_id long, n_words long, n_backoff long, score double")


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_corpus(docs).select("doc_id", "n_words", "n_backoff", F.round("score", 6).alias("score"))


#: The same by DuckDB: n-grams as lists of words, one join for each order.
SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS ws FROM documents),
t AS (SELECT doc_id, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS p, CASE WHEN i > 2 THEN ws[i - 2] END AS q
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
u AS (SELECT w, count(*) AS c FROM t GROUP BY w),
b AS (SELECT p, w, count(*) AS c FROM t WHERE p IS NOT NULL GROUP BY p, w),
g AS (SELECT q, p, w, count(*) AS c FROM t WHERE q IS NOT NULL GROUP BY q, p, w),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM t),
s AS (SELECT t.doc_id,
             CASE WHEN t.q IS NOT NULL THEN coalesce(g.c, 0) < 2 ELSE t.p IS NOT NULL AND coalesce(b.c, 0) < 2 END AS missed,
             CASE WHEN g.c >= 2 THEN log10(g.c) - log10(a.c)
                  ELSE CASE WHEN t.q IS NOT NULL THEN log10(0.4e0) ELSE 0e0 END
                       + CASE WHEN b.c >= 2 THEN log10(b.c) - log10(v.c)
                              ELSE CASE WHEN t.p IS NOT NULL THEN log10(0.4e0) ELSE 0e0 END + log10(u.c) - log10(n.n) END END AS x
      FROM t JOIN u ON t.w = u.w LEFT JOIN u v ON t.p = v.w LEFT JOIN b ON t.p = b.p AND t.w = b.w LEFT JOIN b a ON t.q = a.p AND t.p = a.w
           LEFT JOIN g ON t.q = g.q AND t.p = g.p AND t.w = g.w, n)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(count(*) FILTER (WHERE s.missed) AS BIGINT) AS n_backoff,
       round(avg(s.x), 6) AS score
FROM d LEFT JOIN s ON d.doc_id = s.doc_id GROUP BY d.doc_id, d.ws
"""
