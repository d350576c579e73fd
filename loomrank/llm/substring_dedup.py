"""Substring dedup by recompression.

The words of a text are named by hashes; rounds then shorten the sequence of names. A round of runs names each maximal run
of one name; a round of pairs splits the names by a hash bit into left and right ones and names every left one followed by
a right one as a pair. A name is a hash of what it stands for, so it is the same in every document and no dictionary is
needed to name globally. What a symbol looks like depends on the words it covers and on few words around them (its
context, carried along), so equal substrings get equal symbols wherever the context lies inside.

Every window of `window` words chooses an anchor: a symbol of the highest round whose context lies inside the window,
the one of the smallest hash. Equal windows choose equal anchors. The distinct anchors of each block of documents are
exchanged with their smallest and largest documents; windows whose anchor is shared by two documents are then verified
by 128 bits, two rolling hashes of all their words over two 64-bit hashes of each word, exchanged in the same way with
the smallest document that holds each. A window that also starts in a document with a smaller doc_id is removed, i.e. its
words are.

Runs are named in rounds 0 and 2 alone: naming runs makes the context grow by a symbol on either side, and later rounds
would leave no symbol whose context fits into a window.

Defined results: null and empty texts have no words; texts shorter than a window lose none; words inside one document or
in repeated rows of one doc_id do not remove each other; rows with a null doc_id keep all words and remove none; an empty
table gives no rows. The kept words are joined by one space. Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomrank.llm.blocks import BLOCK_BYTES, Blocks, gathered, least_and_most, look_up, mixed
from loomrank.llm.common import MULT, MULT2

WINDOW = 50
RUN_ROUNDS = (0, 2)
MOST_ROUNDS = 12


class Level:
    """Symbols of one round: names, and the words [low, high) on which each depends. wall: ends of documents."""

    def __init__(self, names, low, high, wall):
        self.names, self.low, self.high, self.wall = names, low, high, wall


def first_level(hashes: np.ndarray, owner: np.ndarray, n_docs: int) -> tuple[Level, np.ndarray]:
    """The words with a wall before each document and after the last, and the place of each word."""
    place = np.arange(len(hashes)) + owner + 1
    names = np.zeros(len(hashes) + n_docs + 1, dtype=np.uint64)
    wall = np.ones(len(names), dtype=bool)
    names[place], wall[place] = hashes, False
    at = np.arange(len(names), dtype=np.int32)
    return Level(names, at, at + 1, wall), place


def name_runs(level: Level) -> Level:
    names, wall = level.names, level.wall
    new = np.concatenate([[True], (names[1:] != names[:-1]) | wall[1:] | wall[:-1]])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(names)))
    last = first + length - 1
    out = names[first]
    many = length > 1
    out[many] = mixed(out[many] * MULT2 + length[many].astype(np.uint64))
    low = np.where(wall[first], level.low[first], level.low[np.maximum(first - 1, 0)])
    high = np.where(wall[first], level.high[last], level.high[np.minimum(last + 1, len(names) - 1)])
    return Level(out, low, high, wall[first])


def name_pairs(level: Level, turn: int) -> Level:
    names, wall, n = level.names, level.wall, len(level.names)
    right = (mixed(names + np.uint64(turn + 1)) >> np.uint64(63)).astype(bool)
    left = ~right & ~wall
    joined = np.zeros(n, dtype=bool)
    joined[:-1] = left[:-1] & right[1:] & ~wall[1:]
    second = np.concatenate([[False], joined[:-1]])
    after, before = np.minimum(np.arange(n) + 1, n - 1), np.maximum(np.arange(n) - 1, 0)
    out = np.where(joined, mixed(names * MULT + mixed(names[after] + MULT2)), names)
    low = np.where(left | wall, level.low, level.low[before])
    high = np.where(left, level.high[after], level.high)
    keep = ~second
    return Level(out[keep], low[keep], high[keep], wall[keep])


def anchors(hashes: np.ndarray, owner: np.ndarray, n_docs: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows, and the anchor's key of each."""
    starts = np.flatnonzero(owner[: len(owner) - window + 1] == owner[window - 1 :]) if len(owner) >= window else np.zeros(0, dtype=np.int64)
    keys = np.zeros(len(starts), dtype=np.uint64)
    if not len(starts):
        return starts, keys
    level, place = first_level(hashes, owner, n_docs)
    levels = [level]
    for turn in range(MOST_ROUNDS):
        if turn in RUN_ROUNDS:
            level = name_runs(level)
        level = name_pairs(level, turn)
        levels.append(level)
        if not ((level.high - level.low <= window) & ~level.wall).any():
            break
    left, at = np.arange(len(starts)), place[starts]
    for turn in range(len(levels) - 1, -1, -1):
        level = levels[turn]
        a = np.searchsorted(level.low, at, side="left")
        b = np.searchsorted(level.high, at + window, side="right")
        some = b > a
        if some.any():
            names = mixed(level.names + np.uint64(turn))
            first, stop = a[some], b[some]
            best = first.copy()
            for step in range(1, int((stop - first).max())):
                other = np.minimum(first + step, len(names) - 1)
                better = (first + step < stop) & (names[other] < names[best])
                best[better] = other[better]
            keys[left[some]] = names[best]
            left, at = left[~some], at[~some]
        if not len(left):
            break
    return starts, keys


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the words of all texts, and the text of each word."""
    lists = [t.split() if t else [] for t in texts]
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w) for ws in lists for w in ws), dtype="<u8").reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1]), np.repeat(np.arange(len(texts), dtype=np.int32), [len(ws) for ws in lists])


def window_hashes(hashes: np.ndarray, starts: np.ndarray, window: int, base: int) -> np.ndarray:
    """A rolling hash of the words of each window."""
    inverse = pow(base, -1, 1 << 64)

    def powers(of: int, n: int) -> np.ndarray:
        out = np.full(n, of, dtype=np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out, dtype=np.uint64)

    n = len(hashes)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * powers(base, n), dtype=np.uint64)])
    return mixed((sums[starts + window] - sums[starts]) * powers(inverse, n)[starts])


class Words:
    """The words of a block's documents, with the document and the rolling hashes of each window."""

    def __init__(self, ids: list, texts: list[bytes | None], window: int):
        self.hashes, self.others, self.owner = word_hashes(texts)
        self.ids, self.n_docs, self.window = ids, len(texts), window

    def named(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The doc_id of each window, and whether it has one."""
        number = np.array([0 if i is None else i for i in self.ids], dtype=np.int64)
        return number[self.owner[starts]], np.array([i is not None for i in self.ids], dtype=bool)[self.owner[starts]]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        return anchors(self.hashes, self.owner, self.n_docs, self.window)

    def windows(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key and check of each window."""
        return (
            window_hashes(self.hashes, starts, self.window, int(MULT) * int(MULT2) % (1 << 64) | 1),
            window_hashes(self.others, starts, self.window, int(MULT) ^ int(MULT2) | 1).view(np.int64),
        )


def dedup_substrings(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text."""
    blocks = Blocks(docs, block_bytes)

    def give_anchors(ids, texts):
        words = Words(ids, texts, window)
        starts, keys = words.anchors()
        number, has = words.named(starts)
        change = np.concatenate([[True], (keys[1:] != keys[:-1]) | (number[1:] != number[:-1])]) & has if len(keys) else has
        key, least, most, _ = least_and_most(keys[change], number[change], number[change])
        return key, [least, most - least]

    def shared_anchors(keys, values):
        key, least, most, _ = least_and_most(keys, values[0], values[0] + values[1])
        return key, least < most, [least]

    def give_windows(ids, texts, got):
        shared, _ = gathered(got)
        if not len(shared):  # nothing to verify here
            return shared, [shared.view(np.int64)] * 3
        words = Words(ids, texts, window)
        starts, keys = words.anchors()
        number, has = words.named(starts)
        wanted = (look_up(shared, keys) >= 0) & has
        key, check = words.windows(starts[wanted])
        key, least, most, check = least_and_most(key, number[wanted], number[wanted], check)
        return key, [check, least, most - least]

    def shared_windows(keys, values):
        key, least, most, check = least_and_most(keys, values[1], values[1] + values[2], values[0])
        return key, least < most, [check, least]

    def conclude(ids, texts, got):
        keys, values = gathered(got)
        lists = [t.split() if t else [] for t in texts]
        size = np.array([len(ws) for ws in lists], dtype=np.int64)
        removed = np.zeros(len(texts), dtype=np.int64)
        gone = np.zeros(0, dtype=bool)
        if len(keys):
            words = Words(ids, texts, window)
            owner, n = words.owner, len(words.owner)
            starts = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
            number, has = words.named(starts)
            key, check = words.windows(starts)
            row = look_up(keys, key, values[0], check)
            later = starts[(row >= 0) & has & (values[1][row] < number)]
            edge = np.bincount(later, minlength=n + 1) - np.bincount(later + window, minlength=n + 1)
            gone = np.cumsum(edge[:-1]) > 0
            removed = np.bincount(owner, weights=gone, minlength=len(texts)).astype(np.int64)
        begin, kept = 0, []
        for ws, n_gone in zip(lists, removed.tolist(), strict=True):
            if n_gone:
                keep = (~gone[begin : begin + len(ws)]).tolist()
                kept.append(b" ".join(w for w, k in zip(ws, keep, strict=True) if k).decode("utf-8", "replace"))
            else:
                kept.append(b" ".join(ws).decode("utf-8", "replace"))
            begin += len(ws)
        return {"doc_id": ids, "n_words": size, "n_removed": removed, "kept_text": kept}

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
    shared = blocks.exchange(blocks.ask_first(give_anchors), shared_anchors)
    windows = blocks.exchange(blocks.ask(give_windows, shared), shared_windows, checked=True)
    return blocks.finish(conclude, windows, schema, "doc_id long, n_words long, n_removed long, kept_text string")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: The same by DuckDB, over windows as text.
SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM g),
c AS (SELECT DISTINCT doc_id, i + o AS i FROM m, range(0, 50) AS t(o) WHERE first < doc_id),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM d),
k AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS kept, count(*) AS n FROM w LEFT JOIN c ON w.doc_id = c.doc_id AND w.i = c.i WHERE c.i IS NULL GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
