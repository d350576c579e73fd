"""Quality rules: how much of a text lies inside repeated n-grams and lines.

Each text is judged alone in numpy, inside one Arrow map without a shuffle: word hashes are rolled into hashes of
several n-gram lengths for a whole chunk of documents at a time, equal hashes of one document mark the words they cover,
and the covered characters are set against all characters of the words.

Defined results: a null or empty text has no words, fails the base rule and is not kept. Rows repeat as they come; a null
doc_id stays null. Extra columns of the input are kept by `with_quality` and dropped by `quality_report`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomrank.llm.common import MULT, MULT2, as_bytes, bound_batches, chunks, give_back, spread, word_lists

#: Largest share of characters in duplicated n-grams, by n (fixed values published for the MassiveText rules).
DUP_NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of lines, and of characters in lines, that equal an earlier line (fixed values, same source).
DUP_LINE_LIMIT = 0.30
DUP_LINE_CHAR_LIMIT = 0.20
BASE_LEAST_WORDS = 50
BASE_MOST_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

LENGTHS = tuple(DUP_NGRAM_LIMITS)
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_chars long, n_lines long, " + ", ".join(f"dup_{n}gram_chars long" for n in LENGTHS) + ", base_failed boolean, kept boolean"
)


def covered_words(grams: np.ndarray, owner: np.ndarray, length: int, n_words: int) -> np.ndarray:
    """Mask of the words inside windows of this length that occur twice or more in their document.

    grams: hash of the window at each word of the chunk; owner: the document of each word.
    """
    inside = owner[: len(grams)] == owner[length - 1 :]
    at = np.flatnonzero(inside)
    if len(at) < 2:
        return np.zeros(n_words, dtype=bool)
    key = (grams[at] ^ (owner[at].astype(np.uint64) * MULT2)) * MULT
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    hit = np.zeros(len(at), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    starts = at[hit]
    edge = np.bincount(starts, minlength=n_words + 1) - np.bincount(starts + length, minlength=n_words + 1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """All counts for a chunk of texts."""
    n_docs = len(texts)
    lists = word_lists(texts)
    n_words = np.fromiter(map(len, lists), np.int64, n_docs)
    words = [w for ws in lists for w in ws]
    total = len(words)
    owner = np.repeat(np.arange(n_docs), n_words)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, total)
    joined = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, total)
    stops = np.cumsum(lengths + 1) - 1
    begins = stops - lengths
    heads = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])
    chars = heads[stops] - heads[begins] if total else np.zeros(0, dtype=np.int64)
    is_symbol = np.zeros(256, dtype=bool)
    is_symbol[list(SYMBOLS)] = True
    marks = np.concatenate([[0], np.cumsum(is_symbol[joined])])
    symbols = marks[stops] - marks[begins] if total else chars

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=n_docs).astype(np.int64) if total else np.zeros(n_docs, dtype=np.int64)

    out = {"n_words": n_words, "word_chars": per_doc(chars), "n_symbols": per_doc(symbols)}
    dup_lines, dup_line_chars, n_lines = (np.zeros(n_docs, dtype=np.int64) for _ in range(3))
    for i, text in enumerate(texts):
        if text:
            lines = [x for x in text.split(b"\n") if x.strip()]
            n_lines[i] = len(lines)
            if len(set(lines)) < len(lines):
                seen: set[bytes] = set()
                for x in lines:
                    if x in seen:
                        dup_lines[i] += 1
                        dup_line_chars[i] += sum(len(w.decode("utf-8", "replace")) for w in x.split())
                    seen.add(x)
    out |= {"n_dup_lines": dup_lines, "dup_line_chars": dup_line_chars, "n_lines": n_lines}
    grams = hashes
    for length in range(2, max(LENGTHS) + 1):
        if len(grams) < 2:
            grams = grams[:0]
        else:
            grams = grams[:-1] * MULT + hashes[length - 1 :]
        if length == 3 or length in LENGTHS:
            mask = covered_words(grams, owner, length, total) if len(grams) else np.zeros(total, dtype=bool)
            if length == 3:
                out["n_repeat_words"] = per_doc(mask)
            if length in LENGTHS:
                out[f"dup_{length}gram_chars"] = per_doc(chars * mask)
    out["base_failed"] = (n_words < BASE_LEAST_WORDS) | (100 * out["n_repeat_words"] > BASE_MOST_REPEAT_PERCENT * n_words)
    bad = out["base_failed"].copy()
    bad |= dup_lines > DUP_LINE_LIMIT * n_lines
    bad |= dup_line_chars > DUP_LINE_CHAR_LIMIT * out["word_chars"]
    for n, limit in DUP_NGRAM_LIMITS.items():
        bad |= out[f"dup_{n}gram_chars"] > limit * out["word_chars"]
    out["kept"] = ~bad
    return out


def quality_report(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the verdict of each document."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            found = measure(as_bytes(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(found[k]) for k in names)], names=["doc_id", *names])
        give_back()

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is `kept`, with their own columns and order of columns, in one map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            found = measure(as_bytes(part.column(part.schema.get_field_index("text"))))
            yield part.filter(pa.array(found["kept"]))
        give_back()

    bound_batches(docs.sparkSession)
    return spread(docs).mapInArrow(run, docs.schema)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_report(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id"), F.col("text")))


def _sql() -> str:
    sizes = ", ".join(f"({n})" for n in (3, *LENGTHS))
    chars = ", ".join(f"CAST(coalesce(sum(chars) FILTER (WHERE n = {n}), 0) AS BIGINT) AS dup_{n}gram_chars" for n in LENGTHS)
    within = " AND ".join(f"coalesce(dup_{n}gram_chars, 0) <= {limit}e0 * word_chars" for n, limit in DUP_NGRAM_LIMITS.items())
    named = ", ".join(f"coalesce(dup_{n}gram_chars, 0) AS dup_{n}gram_chars" for n in LENGTHS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w FROM d),
g AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (VALUES {sizes}) AS t(n) WHERE len(ws) >= n)),
r AS (SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, g) AS c FROM g),
c AS (SELECT DISTINCT doc_id, n, i + o AS i FROM r, range(0, 10) AS t(o) WHERE c > 1 AND o < n),
v AS (SELECT c.doc_id, c.n, count(*) AS words, sum(length(w.w)) AS chars FROM c JOIN w ON c.doc_id = w.doc_id AND c.i = w.i GROUP BY ALL),
s AS (SELECT doc_id, CAST(coalesce(sum(words) FILTER (WHERE n = 3), 0) AS BIGINT) AS n_repeat_words, {chars} FROM v GROUP BY doc_id),
l AS (SELECT doc_id, line, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^ \\t-\\r]') GROUP BY ALL),
k AS (SELECT doc_id, sum(c) AS n_lines, sum(c - 1) AS n_dup, sum((c - 1) * length(regexp_replace(line, '[ \\t-\\r]', '', 'g'))) AS dup_chars FROM l GROUP BY doc_id),
a AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[ \\t-\\r]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(dup_chars, 0) AS BIGINT) AS dup_line_chars, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, {named}
      FROM d LEFT JOIN s ON d.doc_id = s.doc_id LEFT JOIN k ON d.doc_id = k.doc_id)
SELECT *, n_words < {BASE_LEAST_WORDS} OR 100 * n_repeat_words > {BASE_MOST_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {BASE_LEAST_WORDS} OR 100 * n_repeat_words > {BASE_MOST_REPEAT_PERCENT} * n_words) AND n_dup_lines <= {DUP_LINE_LIMIT}e0 * n_lines
       AND dup_line_chars <= {DUP_LINE_CHAR_LIMIT}e0 * word_chars AND {within} AS kept
FROM a
"""


#: The same by DuckDB, over windows as text.
SQL = _sql()
