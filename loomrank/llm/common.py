"""What the corpus operators share: Arrow and byte-word helpers, components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomrank.session import scratch_path, share_code, spread, written

__all__ = ["MULT", "MULT2", "as_bytes", "bound_batches", "chunks", "connected_components", "give_back", "scratch_path", "spread", "word_lists", "written"]

#: Odd multipliers for polynomial hashes over 64-bit word hashes.
MULT = np.uint64(0x9E3779B97F4A7C15)
MULT2 = np.uint64(0xC2B2AE3D27D4EB4F)


# ---------------------------------------------------------------- arrow


def bound_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Lower the session's Arrow batches to so many rows (a batch of whole texts is held twice, in Spark and in Python), and
    let Python workers find this package. The setting is read when a plan runs, which is after the operator has returned, so
    it stays; a session that has set its own bound, as `session.build` does, keeps it."""
    share_code(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Hand freed memory of this Python worker back to the system: idle workers are kept for later tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def chunks(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about most_bytes of the column (a longer text stays alone)."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        size = np.cumsum(np.array([0 if x is None else x for x in pc.binary_length(text).to_pylist()], dtype=np.int64))
        start, n = 0, batch.num_rows
        while start < n:
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def word_lists(texts: list[bytes | None]) -> list[list[bytes]]:
    """Words [^\\x20\\x09-\\x0D]+ of each text: bytes.split() cuts at exactly these six characters."""
    return [t.split() if t else [] for t in texts]


# ---------------------------------------------------------------- components


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of edges(a, b); component is the smallest node reachable.

    Alternates large-star and small-star rounds (Kiveris et al., 2014), each one a grouped minimum and an equi-join, so
    that no node's neighbours ever meet in one place; each round is written to the shared folder. Rows with a null end
    and self loops carry no link and are left out.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        sign = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if sign == before or not sign[0]:
            break
        before = sign
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi")
        small = small.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(root.select("hi", F.col("m").alias("lo"))).distinct()
        now = written(small, "stars")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(now.select("lo", "lo").distinct())
