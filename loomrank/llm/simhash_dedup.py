"""SimHash near-dedup with Golay-code fuzzy hashing.

A fingerprint bit is set where over half of the shingles' hashes have it. Distinct fingerprints (exact copies of a
fingerprint meet in a grouped minimum, so a group of any size is one row) are cut into segments of at most 23 bits, which
are decoded to nearby Golay codewords; the codeword indices are fuzzy keys.

`complete` keys, for 64 bits and up to 3 differing ones. The errors e1 + e2 + e3 <= 3 of the segments of 22, 21 and 21
bits either leave some segment whole, and then another one has at most one error, or they are one each. So the keys are
(a whole segment, a codeword of another one) for the six ordered pairs, and (codewords of all three). Two words one bit
apart have different parity, and the codeword nearest to one is within 4 bits of the other: it is enough that in each
segment one side gives its nearest codeword and the other all codewords within 4 bits, parity choosing the side. No link
is lost, with some 36 keys of 36 bits for a fingerprint.

`wide` keys, for 128 bits and larger radii: pairs of codewords of the segments of each half, and of like segments of both,
all codewords within 4 bits on both sides, some 255 keys. A pair within the radius is met with a probability: by
measurement 0.998 at a Jaccard similarity of 0.9 or more of five-word shingles, 0.97 from 0.82 on, 0.94 at 0.8. There the
radius is set wide (28 bits, a similarity of about 0.68) and every link found is verified: the shingle sets of both texts are compared, and links below `least` go. The forest
of a component that falls apart by that says nothing of its other pairs, so those are all compared (`missed_links`).

Keys are shuffled with the fingerprint, sorted, and streamed; within a bucket the distances are taken in numpy and only a
spanning forest of the links is given out, the closest links first, so a bucket never yields all its pairs. A bucket of over `bucket` distinct
fingerprints is dealt anew as pairs of blocks of bounded size, many tasks for one bucket. Components of the forests are
found by star rounds.

Defined results: a text without words has fingerprint zero and is linked like any other; fewer words than a shingle has
are one shingle. Rows of one doc_id are one node. Rows with a null doc_id get a fingerprint, belong to the component of
the documents with that same fingerprint (and, where links are verified, the same words; null if there are none), and
never name one; an empty table gives no rows. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomrank.llm import golay
from loomrank.llm.common import as_bytes, bound_batches, chunks, connected_components, give_back, spread, written

SEGMENTS = (22, 21, 21)
SEED = 42
BUCKET = 8192
#: Documents and bytes of shingle sets in a block of a component that is compared anew.
BLOCK = 256
BLOCK_BYTES = 4 << 20


# ---------------------------------------------------------------- fingerprints


def shingles_of(text: bytes | None, width: int) -> list[bytes]:
    """The shingles of a text, repeats included; the words of a shorter text are one shingle; none without words."""
    words = text.lower().split() if text else []
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *stops[:-width].tolist()]
    return [joined[a:b] for a, b in zip(starts, (stops[width - 1 :] - 1).tolist(), strict=True)]


def shingle_hashes(shingles: list[bytes], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], dtype=np.uint64)


def fingerprint(text: bytes | None, width: int, bits: int) -> list[int]:
    """The fingerprint as signed 64-bit numbers, the hash seeds being SEED, SEED + 1, ..."""
    shingles = shingles_of(text, width)
    out = []
    for i in range(bits // 64):
        hashes = shingle_hashes(shingles, SEED + i)
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 1 << 14):
            part = hashes[at : at + (1 << 14)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
        out.append(int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0]))
    return out


def words_hash(text: bytes | None) -> int:
    """A hash of the words, as a signed number; texts of equal words have all their shingles in common."""
    return np.uint64(xxhash.xxh64_intdigest(b" ".join(text.lower().split()) if text else b"", SEED)).view(np.int64)


def fingerprints(docs: DataFrame, width: int, bits: int, hashed: bool = False) -> DataFrame:
    """(doc_id, f0[, f1]) for each row of docs(doc_id, text). hashed: with h, a hash of the words."""
    names = [f"f{i}" for i in range(bits // 64)] + ["h"] * hashed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            rows = [fingerprint(t, width, bits) + ([words_hash(t)] if hashed else []) for t in as_bytes(part.column(1))]
            found = np.array(rows, dtype=np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(found[:, i]) for i in range(len(names)))], names=["doc_id", *names])
        give_back()

    bound_batches(docs.sparkSession)
    return spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(run, ", ".join(["doc_id long", *(f"{n} long" for n in names)]))


# ---------------------------------------------------------------- keys


def segments_of(prints: np.ndarray) -> list[np.ndarray]:
    """The segments of fingerprints given as a matrix of unsigned 64-bit columns."""
    out = []
    for column in prints.T:
        at = 0
        for n in SEGMENTS:
            out.append((column >> np.uint64(at)) & np.uint64((1 << n) - 1))
            at += n
    return out


def complete_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) such that any two fingerprints of 64 bits at most 3 bits apart share a key."""
    parts = segments_of(prints)
    keys = [golay.near(p) for p in parts]
    odd = [np.bitwise_count(p) % 2 == 1 for p in parts]
    rows, out = [], []

    def side(j: int, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return keys[j][0], np.where(wide, keys[j][1], 1)

    tag = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                r, (k,) = golay.products([side(j, odd[j])])
                rows.append(r)
                out.append((np.int64(tag) << 60 - 3) | (parts[i][r].astype(np.int64) << 12) | k)
                tag += 1
    n_odd = odd[0].astype(int) + odd[1] + odd[2]
    all_or_none = (n_odd == 3) | (n_odd == 0)
    wide = [np.where(all_or_none, (n_odd == 3) == (j < 2), odd[j]) for j in range(3)]
    r, (a, b, c) = golay.products([side(j, wide[j]) for j in range(3)])
    rows.append(r)
    out.append((np.int64(tag) << 60 - 3) | (a << 24) | (b << 12) | c)
    return np.concatenate(rows), np.concatenate(out)


def wide_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for the pairs of codewords of two segments of one 64-bit half, and of like segments of both halves."""
    keys = [golay.near(p) for p in segments_of(prints)]
    n = len(SEGMENTS)
    pairs = [(h + i, h + j) for h in range(0, len(keys), n) for i in range(n) for j in range(i + 1, n)]
    pairs += [(i, n + i) for i in range(n) if len(keys) > n]
    rows, out = [], []
    for tag, (i, j) in enumerate(pairs):
        r, (a, b) = golay.products([keys[i], keys[j]])
        rows.append(r)
        out.append((np.int64(tag) << 24) | (a << 12) | b)
    return np.concatenate(rows), np.concatenate(out)


# ---------------------------------------------------------------- links


def forest(prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges, by row, of a smallest spanning forest of the links between fingerprints at most `most` bits apart."""
    left = np.arange(1, len(prints))
    near = np.zeros(len(left), dtype=np.int64)  # the row of the forest that is closest to each row left
    gap = np.bitwise_count(prints[left] ^ prints[0]).sum(axis=1)
    a, b = [], []
    while len(left):
        k = int(gap.argmin())
        row = int(left[k])
        if gap[k] <= most:
            a.append(int(near[k]))
            b.append(row)
            keep = gap > 0  # equal rows of nearby ones join at no distance, all at once
            keep[k] = False
            zero = ~keep
            zero[k] = False
            a.extend(near[zero].tolist())
            b.extend(left[zero].tolist())
        else:  # nothing left is linked to what there is: begin another tree
            keep = np.ones(len(left), dtype=bool)
            keep[k] = False
        left, near, gap = left[keep], near[keep], gap[keep]
        if len(left):
            new = np.bitwise_count(prints[left] ^ prints[row]).sum(axis=1)
            closer = new < gap
            near[closer], gap = row, np.minimum(gap, new)
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def bucket_links(key: np.ndarray, ids: np.ndarray, prints: np.ndarray, most: int, bucket: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of whole sorted buckets: ends of forest edges, and a mask of the rows in buckets that are too large."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    two = starts[sizes == 2]
    ok = np.bitwise_count(prints[two] ^ prints[two + 1]).sum(axis=1) <= most
    a, b = [ids[two[ok]]], [ids[two[ok] + 1]]
    for s, n in zip(starts[(sizes > 2) & (sizes <= bucket)].tolist(), sizes[(sizes > 2) & (sizes <= bucket)].tolist(), strict=True):
        u, v = forest(prints[s : s + n], most)
        a.append(ids[s + u])
        b.append(ids[s + v])
    return np.concatenate(a), np.concatenate(b), np.repeat(sizes > bucket, sizes)


def stream_links(width: int, most: int, bucket: int):
    """A map over rows (key, id, f0, ...) sorted by key: (a, b) links, and rows (key, id, prints) left to another pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 2 + width), dtype=np.int64)
        overfull = None

        def give(links: tuple[np.ndarray, np.ndarray], rest: np.ndarray) -> pa.RecordBatch:
            n = len(links[0])
            columns = [np.concatenate([links[0], rest[:, 1]]), np.concatenate([links[1], rest[:, 0]])]
            columns += [np.concatenate([np.zeros(n, dtype=np.int64), rest[:, 2 + i]]) for i in range(width)]
            late = np.concatenate([np.zeros(n, dtype=bool), np.ones(len(rest), dtype=bool)])
            return pa.RecordBatch.from_arrays([pa.array(late), *map(pa.array, columns)], names=["late", "a", "b", *(f"f{i}" for i in range(width))])

        def settle(rows: np.ndarray) -> pa.RecordBatch:
            u, v, late = bucket_links(rows[:, 0], rows[:, 1], rows[:, 2:].view(np.uint64), most, bucket)
            return give((u, v), rows[late])

        empty = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.int64)])
            if overfull is not None:
                same = rows[:, 0] == overfull
                if same.any():
                    yield give(empty, rows[same])
                    rows = rows[~same]
                if not same.all():
                    overfull = None
            if not len(rows):
                held = rows
                continue
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            done, held = np.ascontiguousarray(rows[:cut]), rows[cut:]
            if len(done):
                yield settle(done)
            if len(held) > 4 * bucket:
                overfull = held[-1, 0]
                yield give(empty, held)
                held = held[:0]
        if len(held):
            yield settle(np.ascontiguousarray(held))

    return run


def near_links(nodes: DataFrame, bits: int, most: int, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between rows of nodes(id, f0, ...), distinct fingerprints, whose components are those of all links."""
    spark = nodes.sparkSession
    width = bits // 64
    names = [f"f{i}" for i in range(width)]
    make = complete_keys if bits == 64 and most <= 3 else wide_keys
    schema = ", ".join(["key long", "id long", *(f"{n} long" for n in names)])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                data = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.slice(at, 2000).columns], axis=1).astype(np.int64)
                rows, keys = make(np.ascontiguousarray(data[:, 1:]).view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(data[rows, i]) for i in range(1 + width))], names=["key", "id", *names])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = nodes.select("id", *names).mapInArrow(spread, schema).repartition(parts, "key").sortWithinPartitions("key", "id")
    found_schema = ", ".join(["late boolean", "a long", "b long", *(f"{n} long" for n in names)])
    found = written(keyed.mapInArrow(stream_links(width, most, bucket), found_schema), "links")
    links = found.where("not late").select("a", "b")
    late = found.where("late").select(F.col("b").alias("key"), F.col("a").alias("id"), *names)
    sizes = late.groupBy("key").agg(F.ceil(F.count("*") / F.lit(bucket // 2)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64(F.lit(1), *names), F.col("blocks")).cast("int")
    dealt = late.join(sizes, "key").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = dealt.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "id", *names)
    again = pair.repartition(parts, "key").sortWithinPartitions("key", "id").mapInArrow(stream_links(width, most, 1 << 30), found_schema)
    return links.union(again.select("a", "b"))


#: Ids broadcast at most, 8 bytes each; above it the join is shuffled.
MOST_BROADCAST_IDS = 2_000_000


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is in ids(doc_id), a small written table: broadcast if its count allows it."""
    return docs.join(small_ids(ids), "doc_id", "left_anti").select(*docs.columns)


def small_ids(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if its count allows it."""
    return F.broadcast(ids) if ids.count() <= MOST_BROADCAST_IDS else ids


def shingle_sets(links: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingles) of the documents at the ends of links(a, b): sorted distinct hashes. Only those texts move."""
    ends = written(links.select(F.col("a").alias("doc_id")).union(links.select("b")).distinct(), "link-ends")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_ids(ends), "doc_id", "left_semi")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            sets = [np.unique(shingle_hashes(shingles_of(t, width), SEED)).tobytes() for t in as_bytes(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])
        give_back()

    sets = texts.mapInArrow(gather, "doc_id long, shingles binary").groupBy("doc_id").agg(F.max("shingles").alias("shingles"))
    return written(sets, "shingles")


def verified(links: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The links (a, b) between documents whose sets of shingles have a Jaccard similarity of `least` or more."""
    left, right = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(common >= least * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
        give_back()

    return links.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def set_links(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, least: float) -> tuple[list[int], list[int]]:
    """Edges, by row, that join all rows of different labels whose sets have a similarity of `least` or more: rows joined
    already are not compared again. Where there are two sides, only rows of different ones are compared."""
    size = np.array([len(x) for x in sets], dtype=np.int64)
    words, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(size)
    mark = np.zeros(len(words), dtype=bool)
    label, cross = label.copy(), side.min() != side.max()
    a, b = [], []
    for i in range(len(sets) - 1):
        ask = label[i + 1 :] != label[i]
        if cross:
            ask &= side[i + 1 :] != side[i]
        n = size[i + 1 :]
        ask &= np.minimum(n, size[i]) >= least * np.maximum(n, size[i])
        rows = i + 1 + np.flatnonzero(ask)
        if not len(rows):
            continue
        mine = codes[ends[i] - size[i] : ends[i]]
        mark[mine] = True
        lengths = size[rows]
        stops = np.cumsum(lengths)
        met = np.cumsum(mark[codes[np.repeat(ends[rows] - stops, lengths) + np.arange(stops[-1])]])
        mark[mine] = False
        upto = np.concatenate([[0], met])[np.concatenate([[0], stops])]
        common = np.diff(upto)
        for j in rows[common >= least * (size[i] + lengths - common)].tolist():
            if label[j] != label[i]:
                a.append(i)
                b.append(j)
                label[label == label[j]] = label[i]
    return a, b


def missed_links(links: DataFrame, parts: DataFrame, sets: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """(a, b): the verified links, between components, that a forest of unverified ones stands for. links: the forest,
    parts(node, component): what its verified edges join. Components with rejected edges between them are compared anew,
    all pairs, as pairs of blocks of bounded size, many tasks for one group; a pair of blocks gives a spanning forest."""
    for end in ("a", "b"):
        known = parts.select(F.col("node").alias(end), F.col("component").alias("of"))
        links = links.join(known, end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
    whole = connected_components(links.where("a <> b")).select(F.col("node").alias("label"), F.col("component").alias("whole"))
    nodes = sets.select(F.col("doc_id").alias("node")).join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("label"))
    nodes = nodes.join(whole, "label").select("node", "whole", "label")
    sized = nodes.join(sets.select("doc_id", F.length("shingles").alias("bytes")), nodes["node"] == F.col("doc_id"))
    count = F.greatest(F.ceil(F.count("*") / F.lit(block)), F.ceil(F.sum("bytes") / F.lit(BLOCK_BYTES)))
    # two documents are one link, which was verified
    torn = sized.groupBy("whole").agg(count.cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 2")
    mine = F.pmod(F.xxhash64(F.lit(2), "node"), F.col("blocks")).cast("int")
    dealt = nodes.join(torn.select("whole", "blocks"), "whole").withColumn("mine", mine)
    dealt = written(dealt.join(sets, dealt["node"] == sets["doc_id"]).select("whole", "label", "blocks", "mine", "shingles"), "torn")
    pair = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = pair.select(F.struct("whole", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")).alias("key"), "label", "mine", "shingles")

    def compare(group: pa.Table) -> pa.Table:
        label, side = group.column("label").to_numpy(), group.column("mine").to_numpy()
        held = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in group.column("shingles")]
        a, b = set_links(held, label, side, least)
        return pa.table({"a": pa.array(label[np.array(a, dtype=np.int64)], pa.int64()), "b": pa.array(label[np.array(b, dtype=np.int64)], pa.int64())})

    return pair.groupBy("key").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, bits: int = 128, most: int = 28, least: float | None = 0.8, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, f0[, f1], component_id) for each row of docs(doc_id, text). least: the similarity to verify links by, those of
    equal fingerprints and different words as well; None to go by fingerprints alone."""
    names = [f"f{i}" for i in range(bits // 64)]
    key = names if least is None else [*names, "h"]
    prints = written(fingerprints(docs, width, bits, least is not None), "fingerprints")
    nodes = written(prints.groupBy(*key).agg(F.min("doc_id").alias("id")), "nodes")
    heads = nodes.where("id IS NOT NULL")
    if least is not None:
        heads = written(heads.groupBy(*names).agg(F.min("id").alias("id")), "heads")
    links = near_links(heads, bits, most, bucket)
    if least is not None:
        alike = nodes.join(heads.select(*names, F.col("id").alias("head")), names).select(F.col("head").alias("a"), F.col("id").alias("b"))
        links = links.select("a", "b").union(alike)
        pair = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pair = written(pair, "found-links")
        sets = shingle_sets(pair, docs, width)
        links = written(verified(pair, sets, least), "sound-links")
    parts = connected_components(links)
    if least is not None and links.count() < pair.count():
        parts = written(parts, "parts")
        more = connected_components(missed_links(pair, parts, sets, least)).select(F.col("node").alias("label"), F.col("component").alias("joined"))
        every = sets.select(F.col("doc_id").alias("node")).join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("label"))
        parts = every.join(more, "label", "left").select("node", F.coalesce("joined", "label").alias("component"))
    named = nodes.join(parts, nodes["id"] == parts["node"], "left").select(*key, F.coalesce("component", "id").alias("component_id"))
    return prints.join(named, key).select("doc_id", *names, "component_id")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of each group, the one of the smallest doc_id; repeated rows of it become one, rows with a
    null doc_id stay."""
    found = written(near_duplicates(docs.select("doc_id", "text"), **options), "groups")
    gone = written(found.where("doc_id IS NOT NULL AND component_id <> doc_id").select("doc_id").distinct(), "dropped")
    kept = without_ids(docs, gone)
    twice = written(found.where("component_id = doc_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if twice.isEmpty():
        return kept
    repeated = kept.join(twice, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return without_ids(kept, twice).unionByName(repeated)


def op1_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs, width=3, bits=64, most=3, least=None)
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")
