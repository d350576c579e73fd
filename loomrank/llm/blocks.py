"""Exchange of hashed keys between blocks of documents, for statistics over a whole corpus.

A block is a run of neighbouring rows of the input, of bounded bytes, so rows are spread evenly whatever they hold: equal
rows, a hot source and null ids are no heavier than any others. Each block gives out its distinct keys, summarised (counts
added up, smallest and largest document taken), so a key reaches the exchange at most once from each block however often it
occurs: a frequent word or a copied passage is no heavier than any other key. Keys are cut into ranges of the 64-bit hash
space (buckets); a bucket brings the summaries together and answers every block that asked, with the keys that matter
alone. The answers meet the documents of their block again in a co-group over one shuffle of packed blocks.

Keys and values travel packed: sorted keys as differences, byte planes apart, compressed. A row holds the keys of one block
in one bucket, so rows are never more than keys; the number of buckets follows the size of the input and the number of
shuffle partitions, not the number of blocks.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomrank.llm.common import MULT, MULT2, as_bytes, bound_batches, give_back
from loomrank.session import settled

BLOCK_BYTES = 4 << 20
#: Text whose keys share a bucket; with few blocks there are as many buckets as shuffle partitions.
BUCKET_BYTES = 32 << 20
#: Blocks that share a shuffle partition at most; each is worked off alone.
BLOCKS_IN_PARTITION = 64
HEAD = struct.Struct("<II")
IPC = pa.ipc.IpcWriteOptions(compression="zstd")
Columns = list[np.ndarray]
Summary = tuple[np.ndarray, Columns]


# ---------------------------------------------------------------- keys


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(31))) * MULT
    x = (x ^ (x >> np.uint64(29))) * MULT2
    return x ^ (x >> np.uint64(32))


def pack(keys: np.ndarray, values: Columns) -> bytes:
    """Sorted keys with columns of 64-bit values."""
    columns = [np.diff(keys, prepend=np.uint64(0)), *values]
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return HEAD.pack(len(keys), len(columns)) + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes) -> Summary:
    n, width = HEAD.unpack_from(data)
    raw = zstandard.ZstdDecompressor().decompress(data[HEAD.size :], max_output_size=max(1, 8 * n * width))
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(width, 8, n)
    columns = [np.ascontiguousarray(p.T).view(np.uint64).reshape(-1) for p in planes]
    return np.cumsum(columns[0], dtype=np.uint64), [c.view(np.int64) for c in columns[1:]]


def block_rows(block: int, keys: np.ndarray, values: Columns, buckets: int) -> pa.Table:
    """The packed keys of a block, a row for each bucket that has any."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    first = runs(bucket)
    ends = zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=False)
    data = [pack(keys[a:b], [v[a:b] for v in values]) for a, b in ends]
    return pa.table({"bucket": pa.array(bucket[first].astype(np.int32)), "block": pa.array([block] * len(first), pa.int64()), "data": pa.array(data, pa.binary())})


def gathered(table: pa.Table | None, turn: int = 0) -> Summary:
    """All answers to a block in one round of questions, in the order of buckets, which is that of keys."""
    if table is not None:
        table = table.filter(pc.equal(table.column("turn"), turn))
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("data").to_pylist(), strict=True)) if table is not None else []
    parts = [unpack(data) for _, data in rows]
    if not parts:
        return np.zeros(0, dtype=np.uint64), []
    return np.concatenate([p[0] for p in parts]), [np.concatenate(c) for c in zip(*(p[1] for p in parts), strict=True)]


def places(keys: np.ndarray, wanted: np.ndarray, checks: np.ndarray | None = None, wanted_checks: np.ndarray | None = None) -> np.ndarray:
    """Row of each wanted key among sorted keys that hold them all, by key and check."""
    at = np.searchsorted(keys, wanted)
    if checks is not None:
        late = np.flatnonzero(checks[at] != wanted_checks)
        while len(late):  # keys that differ in their checks alone stand side by side
            at[late] += 1
            late = late[checks[at[late]] != wanted_checks[late]]
    return at


def look_up(keys: np.ndarray, wanted: np.ndarray, checks: np.ndarray | None = None, wanted_checks: np.ndarray | None = None) -> np.ndarray:
    """Row of each wanted key (and check) among sorted keys, or -1. A bit table passes over most of what is absent."""
    out = np.full(len(wanted), -1, dtype=np.int64)
    if not len(keys) or not len(wanted):
        return out
    bits = max(10, int(len(keys) * 8).bit_length())
    table = np.zeros(1 << bits, dtype=bool)
    shift = np.uint64(64 - bits)
    table[(keys * MULT) >> shift] = True
    maybe = np.flatnonzero(table[(wanted * MULT) >> shift])
    at = np.searchsorted(keys, wanted[maybe])
    while len(maybe):
        inside = at < len(keys)
        at[~inside] = 0
        same = inside & (keys[at] == wanted[maybe])
        hit = same if checks is None else same & (checks[at] == wanted_checks[maybe])
        out[maybe[hit]] = at[hit]
        maybe, at = maybe[same & ~hit], at[same & ~hit] + 1
    return out


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """First places of the distinct values of a sorted array."""
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, dtype=np.int64)


def least_and_most(keys: np.ndarray, least: np.ndarray, most: np.ndarray, checks: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct keys (by key and check) with the smallest and largest value of each, and their checks."""
    order = np.argsort(keys)
    new = np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]]) if len(keys) else np.zeros(0, dtype=bool)
    if checks is not None and len(keys):
        other = checks[order[1:]] != checks[order[:-1]]
        if (other & ~new[1:]).any():
            order = np.lexsort((checks, keys))
            other = checks[order[1:]] != checks[order[:-1]]
            new[1:] = keys[order[1:]] != keys[order[:-1]]
        new[1:] |= other
    at = np.flatnonzero(new)
    if not len(at):
        return keys[:0], least[:0], most[:0], keys[:0]
    own = keys[order][at]
    return own, np.minimum.reduceat(least[order], at), np.maximum.reduceat(most[order], at), own if checks is None else checks[order][at]


# ---------------------------------------------------------------- documents


def pack_docs(part: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=IPC) as out:
        out.write_table(part.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpack_docs(data: bytes) -> tuple[list, list[bytes | None]]:
    """The ids and texts of a block."""
    table = pa.ipc.open_stream(data).read_all()
    texts: list[bytes | None] = []
    for piece in table.column("text").chunks:
        texts.extend(as_bytes(piece))
    return table.column("doc_id").to_pylist(), texts


def cut(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[int, pa.Table]]:
    """Blocks of a partition of (row, doc_id, text): the number of the first row, and the rows. A block ends with the row
    that fills it, wherever batches end."""
    held: list[pa.RecordBatch] = []
    size = 0

    def block() -> tuple[int, pa.Table]:
        table = pa.Table.from_batches(held)
        return table.column("row")[0].as_py(), table.select(["doc_id", "text"])

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
        start = 0
        while start < batch.num_rows:
            full = size + np.cumsum(sizes[start:], dtype=np.int64) >= block_bytes
            stop = start + int(full.argmax()) + 1 if full.any() else batch.num_rows
            held.append(batch.slice(start, stop - start))
            size += int(sizes[start:stop].sum())
            if full.any():
                yield block()
                held, size = [], 0
            start = stop
    if held:
        yield block()


class Blocks:
    """docs(doc_id, text) cut into blocks, and the exchange of keys between them."""

    def __init__(self, docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES):
        bound_batches(docs.sparkSession)
        docs = settled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        session = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n_blocks = max(1, -(-total // block_bytes))
        self.block_bytes = block_bytes
        self.buckets = max(min(session, n_blocks), -(-total // bucket_bytes))
        self.parts = max(min(session, n_blocks), -(-n_blocks // BLOCKS_IN_PARTITION))
        self.numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, part in cut(batches, block_bytes):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([pack_docs(part)], pa.binary())], names=["block", "docs"])
            give_back()

        self.rows = self.numbered.mapInArrow(packed, "block long, docs binary").repartition(self.parts, "block")

    def _met(self, answers: DataFrame):
        return self.rows.groupBy("block").cogroup(answers.repartition(self.parts, "block").groupBy("block"))

    def ask_first(self, summarise: Callable[[list, list], Summary]) -> DataFrame:
        """Rows (bucket, block, data) of the keys that each block gives out, where the documents are."""
        buckets, block_bytes = self.buckets, self.block_bytes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, part in cut(batches, block_bytes):
                texts = [t for piece in part.column("text").chunks for t in as_bytes(piece)]
                yield from block_rows(block, *summarise(part.column("doc_id").to_pylist(), texts), buckets).to_batches()
            give_back()

        return self.numbered.mapInArrow(run, "bucket int, block long, data binary")

    def ask(self, summarise: Callable[[list, list, pa.Table], Summary], answers: DataFrame) -> DataFrame:
        """Rows (bucket, block, data) of the keys that each block gives out, with the answers it has got before."""
        buckets = self.buckets

        def run(docs: pa.Table, got: pa.Table) -> pa.Table:
            keys, values = summarise(*unpack_docs(docs.column("docs")[0].as_py()), got)
            return block_rows(docs.column("block")[0].as_py(), keys, values, buckets)

        return self._met(answers).applyInArrow(run, "bucket int, block long, data binary")

    def exchange(self, asked: DataFrame, reduce: Callable[[np.ndarray, Columns], tuple[np.ndarray, np.ndarray, Columns]], aligned: bool = False, checked: bool = False, turn: int = 0) -> DataFrame:
        """Answers (block, bucket, turn, data) to rows (bucket, block, data). reduce(keys, values), over all rows of a bucket,
        gives the sorted distinct keys, which of them to answer, and their values. An answer holds the keys it is about; an
        `aligned` one holds values alone, in the order of the keys asked for, 0 for those not answered, and is for a
        block that works its keys out again. `checked`: the first value of a key is a part of it. turn: number of the
        round of questions."""

        def run(table: pa.Table) -> pa.Table:
            blocks, bucket = table.column("block").to_pylist(), table.column("bucket")[0].as_py()
            parts = [unpack(x) for x in table.column("data").to_pylist()]
            keys = np.concatenate([p[0] for p in parts])
            distinct, wanted, values = reduce(keys, [np.concatenate(c) for c in zip(*(p[1] for p in parts), strict=True)])
            to, data = [], []
            for block, (own, with_it) in zip(blocks, parts, strict=True):
                at = places(distinct, own, values[0], with_it[0]) if checked else places(distinct, own)
                if aligned:
                    to.append(block)
                    data.append(pack(np.zeros(len(own), dtype=np.uint64), [np.where(wanted[at], v[at], 0) for v in values]))
                else:
                    at = at[wanted[at]]
                    if len(at):
                        to.append(block)
                        data.append(pack(distinct[at], [v[at] for v in values]))
            n = len(to)
            return pa.table({"block": pa.array(to, pa.int64()), "bucket": pa.array([bucket] * n, pa.int32()), "turn": pa.array([turn] * n, pa.int32()), "data": pa.array(data, pa.binary())})

        dealt = asked.repartition(self.parts, "bucket")
        return dealt.groupBy("bucket").applyInArrow(run, "block long, bucket int, turn int, data binary")

    def finish(self, conclude: Callable[[list, list, pa.Table], dict[str, list]], answers: DataFrame, schema: pa.Schema, spark_schema: str) -> DataFrame:
        """A row for each document, from its block's documents and answers."""

        def run(docs: pa.Table, got: pa.Table) -> pa.Table:
            found = conclude(*unpack_docs(docs.column("docs")[0].as_py()), got)
            return pa.table([pa.array(found[f.name], f.type) for f in schema], schema=schema)

        return self._met(answers).applyInArrow(run, spark_schema)
