"""Line dedup over overlapping windows of three lines.

A document's lines are cut at \\n; each run of three consecutive lines is hashed (two seeded 64-bit hashes, 128 bits).
Over the whole corpus the first occurrence of a window, by (doc_id, position), stays; every later one covers its three
lines, overlapping covers are merged, and the covered lines are removed. Windows are judged on the input, and a window
without a visible character is none.

Windows are aggregated map-side to (hash, first place, number), so a window in a third of all documents is one row from
each task; the windows that occur more than once join back under adaptive skew handling, and what reaches a document is
the list of its own covered positions.

Defined results: null and empty texts, and texts of fewer than three lines, keep all their lines; kept_text of a null
text is null. Repeated rows: equal (doc_id, text) rows count as one occurrence each in an undefined but fixed order of
equal places, so none of them covers the other; rows with a null doc_id keep their lines and cover nothing. Extra columns
are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomrank.llm.common import written

WIDTH = 3
#: The covered positions are broadcast up to this size, so that texts need not move; above it both sides are shuffled.
MOST_BROADCAST_BYTES = 64 << 20


def windows_of(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, pos, h1, h2): the windows of each document that show a visible character."""
    lines = docs.where("doc_id IS NOT NULL").select("doc_id", F.split("text", "\n", -1).alias("_lines")).where(F.size("_lines") >= width)
    starts = F.sequence(F.lit(0), F.size("_lines") - width)
    joined = F.transform(starts, lambda i: F.array_join(F.slice("_lines", i + 1, width), "\n"))
    each = lines.select("doc_id", F.posexplode(joined).alias("pos", "w")).where(F.col("w").rlike("[^ \\t-\\r]"))
    return each.select("doc_id", "pos", F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(width), "w").alias("h2"))


def covered_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, spans): starts of the windows to remove, one row for each document that has any."""
    windows = windows_of(docs, width)
    place = F.struct("doc_id", "pos")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first")
    later = windows.join(repeated, ["h1", "h2"]).where(place != F.col("first"))
    return later.groupBy("doc_id").agg(F.collect_set("pos").alias("spans"))


def _merged(spans: Column, width: int) -> Column:
    """Covered positions: the union of [s, s + width) over all starts."""
    return F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s, s + (width - 1)))))


def dedup_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_text."""
    spans = written(covered_lines(docs, width), "line-spans").withColumnRenamed("doc_id", "_id")
    held = spans.agg(F.count("*"), F.sum(F.size("spans"))).first()
    if held[0] * 40 + (held[1] or 0) * 4 <= MOST_BROADCAST_BYTES:
        spans = F.broadcast(spans)
    lines = F.split("text", "\n", -1)
    joined = docs.select("doc_id", "text").join(spans, F.col("doc_id") == F.col("_id"), "left")
    marked = joined.select("doc_id", "text", lines.alias("lines"), F.map_from_arrays(_merged(F.col("spans"), width), F.transform(_merged(F.col("spans"), width), lambda x: F.lit(True))).alias("cover"))
    kept = F.filter("lines", lambda line, i: F.col("cover")[i].isNull())
    out = marked.select("doc_id", F.coalesce(F.size("lines"), F.lit(0)).alias("n"), F.coalesce(F.size("cover"), F.lit(0)).alias("gone"), F.when(F.col("cover").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"))
    return out.select("doc_id", F.greatest("n", F.lit(0)).cast("long").alias("n_lines"), F.greatest("gone", F.lit(0)).cast("long").alias("n_removed"), "kept_text")


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


SQL = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, i - 1 AS pos, array_to_string(lines[i:i + 2], chr(10)) AS w
      FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM l WHERE len(lines) >= 3)),
v AS (SELECT * FROM w WHERE regexp_matches(w, '[^ \\t-\\r]')),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS n FROM v),
c AS (SELECT DISTINCT doc_id, pos + d AS pos FROM r, range(0, 3) AS g(d) WHERE n > 1),
p AS (SELECT doc_id, unnest(range(0, len(lines))) AS pos, unnest(lines) AS line FROM l),
k AS (SELECT p.doc_id, string_agg(p.line, chr(10) ORDER BY p.pos) AS kept, count(*) AS n
      FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.pos = c.pos WHERE c.doc_id IS NULL GROUP BY p.doc_id)
SELECT l.doc_id, CAST(coalesce(len(l.lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(l.lines), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM l LEFT JOIN k ON l.doc_id = k.doc_id
"""
