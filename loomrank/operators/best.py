"""The k best rows of each query, kept inside a task: no task holds more than a bounded number of scored pairs, whatever the
number of rows, and only k rows a query and task leave it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Queries of one pass, and scores held at once.
QUERY_BLOCK = 4096
CELLS = 1 << 20


def rounded(x: np.ndarray) -> np.ndarray:
    """Six decimals, halves away from zero."""
    with np.errstate(invalid="ignore", over="ignore"):
        return np.where(np.abs(x) < 4e9, np.trunc(x * 1e6 + np.copysign(0.5, x)) / 1e6, x)


def pieces(batches: Iterator[pa.RecordBatch], n_queries: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that rows times queries stay within CELLS."""
    rows = max(1, CELLS // max(1, n_queries))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Best:
    """Rows with the columns `_query` (number of a query) and `_score`; the highest scores are the best, then the lowest of
    the columns `ties` in turn."""

    def __init__(self, k: int, n_queries: int, *ties: str):
        self.k, self.ties = k, ties
        self.worst = np.full(n_queries, -np.inf)  # what a row must reach
        self.held: list[pa.Table] = []
        self.size = 0

    def hopeful(self, scores: np.ndarray, found: np.ndarray, slack: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(rows, queries) of the cells found that may be among the best. scores, found: rows by queries; no score is NaN.
        slack: by how much a score may still be rounded up."""
        n = scores.shape[0]
        least = self.worst
        if n > self.k and np.isneginf(least).any():
            at = n - self.k
            least = np.maximum(least, np.partition(np.where(found, scores, -np.inf), at, axis=0)[at])
        return np.nonzero(found & (scores >= least - slack))

    def add(self, rows: pa.Table) -> None:
        self.held.append(rows)
        self.size += rows.num_rows
        if self.size > 2 * self.k * len(self.worst) + CELLS:
            self.cut()

    def cut(self) -> pa.Table | None:
        """All that is held, without what is not among the best."""
        if not self.held:
            return None
        rows = pa.concat_tables(self.held).combine_chunks()
        query, score = rows["_query"].to_numpy(), rows["_score"].to_numpy()
        low = np.iinfo(np.int64).min
        order = np.lexsort((*(pc.fill_null(rows[t].cast(pa.int64()), low).to_numpy() for t in reversed(self.ties)), -score, query))
        query, score = query[order], score[order]
        first = np.searchsorted(query, query, "left")
        rank = np.arange(len(query)) - first
        last = rank == self.k - 1
        self.worst[query[last]] = score[last]
        rows = rows.take(pa.array(order[rank < self.k]))
        self.held, self.size = [rows], rows.num_rows
        return rows
