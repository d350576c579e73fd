"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and benchmark items are brought to one form (letters A-Z lowered, runs of white space one space) and compared as
bytes. A region of a document at edit distance k or less from an item of m bytes shares at least m - q + 1 - k q q-grams
with it, all of them on diagonals (document position minus item position) that lie within k of each other. So

1. every position's q-gram is looked up in a table of the items' q-grams (one shift and one gather in numpy);
2. the hits of an item fall into bands of 2 k + 1 diagonals, each overlapping the next by half, so that any 2 k or fewer
   neighbouring diagonals lie in one band; bands with too few distinct item positions are dropped;
3. what is left is verified by an alignment of the whole item against the region, in a band of diagonals; an item that
   stands in the region as it is has distance 0.

The budget is `errors` (a share) of the item's length. An item too short for the lemma at that share gets the largest
budget it allows, and one of under `least` bytes is searched as it is, between word bounds. Documents never move: the items
go to them, in blocks of at most `block_bytes`, one pass for each block of a large benchmark. Whole texts are read; items
are never sampled or cut.

Matches are held `MOST_PAIRS` at a time. Documents that have more together are taken apart, then the items of one document,
and then the document for a single item, in pieces that overlap by the longest region an item can have, so that every
region lies whole in one of them. A piece that still has more, of a text and an item that both repeat a few q-grams all
along, is aligned without the filter.

Defined results: null and empty texts have no hit; items that are null or empty after normalising are passed over; items
without an item_id are searched by `drop_leaks`, and left out of `leaks`, which could not name them; repeated rows each get
the same hits, repeated items are one item (the smallest item_id); an empty benchmark leaves everything clean. Rows with a
null doc_id are judged like others (the query brings them together in one row). Extra columns stay in `drop_leaks`.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomrank.llm.common import MULT, as_bytes, bound_batches, chunks, give_back, spread

Q = 8
ERRORS = 0.1
LEAST = 32
BLOCK_BYTES = 4 << 20
MOST_PAIRS = 1 << 20
BASE = 1 << 40  # makes diagonals positive
SEPARATOR = b"\n"  # no normalised text holds one


def normalised(text: bytes | None) -> bytes:
    return b" ".join(text.lower().split()) if text else b""


def budget(length: int, errors: float = ERRORS, q: int = Q) -> int:
    """Edits allowed for an item: the share asked for, as far as the lemma still demands one common q-gram."""
    return max(0, min(int(errors * length), (length - q) // q))


@dataclass
class Brief:
    """Short items of one length, sorted by their first bytes."""

    length: int
    items: np.ndarray
    heads: np.ndarray  # the first 8 bytes, or fewer, of each
    rest: np.ndarray  # the codes at `offsets`, by item
    offsets: list[int]
    left: np.ndarray  # whether the first byte belongs to a word
    right: np.ndarray  # and the last one
    table: np.ndarray  # of hashed heads


@dataclass
class Items:
    """A block of benchmark items, ready for look-up."""

    ids: list[int]
    texts: list[bytes]
    table: np.ndarray  # of hashed q-grams: whether any item has one
    grams: np.ndarray  # sorted q-grams of all items
    owner: np.ndarray  # item of each
    spot: np.ndarray  # position of each
    least: np.ndarray  # common q-grams demanded, by item
    allowed: np.ndarray  # edits allowed, by item
    brief: list[Brief]  # short items, by length


def codes(data: bytes) -> np.ndarray:
    """The 8 bytes from each position as one number."""
    if len(data) < Q:
        return np.zeros(0, dtype=np.uint64)
    return np.ndarray((len(data) - Q + 1,), dtype="<u8", buffer=data, strides=(1,))


def slot(grams: np.ndarray, table: int) -> np.ndarray:
    """Places in a table of so many entries, a power of two."""
    return (grams * MULT) >> np.uint64(65 - table.bit_length())


def table_of(grams: np.ndarray) -> np.ndarray:
    """A table of hashed q-grams, so large that it lets at most an eighth of others pass."""
    table = np.zeros(1 << max(16, (8 * len(grams)).bit_length()), dtype=bool)
    table[slot(grams, len(table))] = True
    return table


#: Bytes that belong to words: letters, digits, and all of multi-byte characters.
WORDY = np.array([chr(c).isalnum() if c < 128 else True for c in range(256)])


def heads_of(data: bytes, length: int) -> np.ndarray:
    """The first bytes, 8 at most, of the `length` bytes from each position as one number."""
    found = codes(data + SEPARATOR * 8)[: max(0, len(data) - length + 1)]
    return found if length >= Q else found & np.uint64((1 << 8 * length) - 1)


def prepare_brief(texts: list[bytes], at: list[int]) -> list[Brief]:
    """The short items, those of the numbers `at`."""
    by_length: dict[int, list[int]] = {}
    for i in at:
        by_length.setdefault(len(texts[i]), []).append(i)
    out = []
    for n, items in sorted(by_length.items()):
        heads = np.array([heads_of(texts[i], n)[0] for i in items], dtype=np.uint64)
        order = np.argsort(heads, kind="stable")
        offsets = [*range(Q, n - Q, Q), n - Q] if n > Q else []
        rest = np.array([codes(texts[i])[offsets] if offsets else [] for i in items], dtype=np.uint64).reshape(len(items), -1)
        left, right = (np.array([WORDY[texts[i][k]] for i in items]) for k in (0, -1))
        out.append(Brief(n, np.array(items)[order], heads[order], rest[order], offsets, left[order], right[order], table_of(heads)))
    return out


def brief_hits(data: bytes, begins: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, 0, position) of short items, the first place of each in a document; data holds documents joined by
    separators."""
    if not items.brief:
        return
    wordy = np.concatenate([[False], WORDY[np.frombuffer(data, dtype=np.uint8)], [False]])  # of the byte before each position
    grams = codes(data)
    for b in items.brief:
        heads = heads_of(data, b.length)
        at = np.flatnonzero(b.table[slot(heads, len(b.table))])
        first = np.searchsorted(b.heads, heads[at], side="left")
        n = np.searchsorted(b.heads, heads[at], side="right") - first
        where = np.repeat(at, n)
        which = np.arange(len(where)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        ok = ~(wordy[where] & b.left[which]) & ~(wordy[where + b.length + 1] & b.right[which])
        for k, offset in enumerate(b.offsets):
            where, which = where[ok], which[ok]
            ok = grams[where + offset] == b.rest[which, k]
        where, item = where[ok], b.items[which[ok]]
        doc = np.searchsorted(begins, where, side="right") - 1
        order = np.lexsort((where, item, doc))
        doc, item, where = doc[order], item[order], where[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])[: len(doc)])
        yield from zip(doc[new].tolist(), item[new].tolist(), [0] * len(new), where[new].tolist(), strict=True)


def prepare(ids: list[int], texts: list[bytes], errors: float, brief_below: int = LEAST) -> Items:
    brief = prepare_brief(texts, [i for i, t in enumerate(texts) if len(t) < max(brief_below, Q)])
    parts = [codes(t) if len(t) >= max(brief_below, Q) else codes(b"") for t in texts]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(p) for p in parts])
    spot = np.concatenate([np.arange(len(p), dtype=np.int32) for p in parts]) if parts else np.zeros(0, dtype=np.int32)
    grams = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    order = np.argsort(grams, kind="stable")
    allowed = np.array([budget(len(t), errors) for t in texts], dtype=np.int64)
    least = np.array([len(t) - Q + 1 for t in texts], dtype=np.int64) - allowed * Q
    return Items(ids, texts, table_of(grams), grams[order], owner[order], spot[order], least, allowed, brief)


def banded_distance(item: bytes, region: bytes, low: int, high: int, most: int) -> int | None:
    """Smallest edit distance of item to any part of region along diagonals low..high (region minus item position), or
    None above `most`. One row for each byte of the item; leftward steps are a running minimum."""
    a, b = np.frombuffer(item, dtype=np.uint8), np.frombuffer(region, dtype=np.uint8)
    width = high - low + 1
    far = 1 << 20
    offsets = np.arange(width)
    start = low + offsets  # region bytes used before the item's first
    row = np.where((start >= 0) & (start <= len(b)), 0, far)
    padded = np.concatenate([b.astype(np.int16), [-1]])
    for i in range(len(a)):
        j = start + i  # region byte beside item byte i on each diagonal
        same = padded[np.where((j >= 0) & (j < len(b)), j, len(b))] == a[i]
        step = row + np.where(same, 0, 1)  # along the diagonal
        step[(j < 0) | (j >= len(b))] = far
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)  # item byte left out: from the next diagonal
        step[(j + 1 < 0) | (j + 1 > len(b))] = far
        row = np.minimum.accumulate(step - offsets) + offsets  # region byte left out: from the diagonal before
        row[(j + 1 < 0) | (j + 1 > len(b))] = far
        if row.min() > most:
            return None
    best = int(row.min())
    return best if best <= most else None


def candidates(where: np.ndarray, first: np.ndarray, n: np.ndarray, begins: np.ndarray, items: Items, entries: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(document, item, band) of the bands with enough common q-grams, in ascending order. where: positions; first, n: the run
    of matching entries (owner, spot) of each."""
    owner, spots = entries
    entry = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    where, item, spot = np.repeat(where, n), owner[entry], spots[entry]
    half = items.allowed[item] + 1  # bands of 2 * half diagonals, each half of them on
    band = (where - spot + BASE) // half
    band = np.concatenate([band, band - 1])
    item, spot, where = np.tile(item, 2), np.tile(spot, 2), np.tile(where, 2)
    doc = np.searchsorted(begins, where, side="right") - 1
    order = np.lexsort((spot, band, item, doc))
    item, spot, band, doc = item[order], spot[order], band[order], doc[order]
    new = np.concatenate([[True], (item[1:] != item[:-1]) | (band[1:] != band[:-1]) | (doc[1:] != doc[:-1])])
    other = new | np.concatenate([[True], spot[1:] != spot[:-1]])
    heads = np.flatnonzero(new)
    count = np.add.reduceat(other.astype(np.int64), heads)
    good = heads[count >= items.least[item[heads]]]
    yield from zip(doc[good].tolist(), item[good].tolist(), band[good].tolist(), strict=True)


def few_at_once(where: np.ndarray, first: np.ndarray, n: np.ndarray, begins: np.ndarray, items: Items, most: int) -> Iterator[tuple[int, int, int]]:
    """candidates() of any number of matches, `most` of them held at a time. A band of None stands for a document's part that
    is to be aligned whole; the item of such a row comes with its place, as (item, left, right)."""
    if not len(where):
        return
    whole = (items.owner, items.spot)
    doc = np.searchsorted(begins, where, side="right") - 1
    cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]]))
    ends = np.concatenate([[0], np.cumsum(n)])[cuts]
    i = 0
    while i < len(cuts) - 1:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, side="right")) - 1)
        own = slice(cuts[i], cuts[j])
        if ends[j] - ends[i] <= most:
            yield from candidates(where[own], first[own], n[own], begins, items, whole)
        else:
            yield from of_one_document(where[own], first[own], n[own], begins, items, most)
        i = j


def of_one_document(where: np.ndarray, first: np.ndarray, n: np.ndarray, begins: np.ndarray, items: Items, most: int) -> Iterator[tuple]:
    """few_at_once() of a single document: items in groups of few matches, or alone."""
    heads, back, times = np.unique(first, return_inverse=True, return_counts=True)
    length = np.zeros(len(heads), dtype=np.int64)
    length[back] = n
    entry = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(heads, length)
    matches = np.bincount(items.owner[entry], weights=np.repeat(times, length), minlength=len(items.texts)).astype(np.int64)
    met = np.flatnonzero(matches)
    sums = np.cumsum(matches[met])
    start = 0
    while start < len(met):
        base = sums[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sums, base + most, side="right")))
        low, high = met[start], met[stop - 1]
        mine = entry[(items.owner[entry] >= low) & (items.owner[entry] <= high)]  # in the order of q-grams
        entries = (items.owner[mine], items.spot[mine])
        near = np.searchsorted(mine, first)
        count = np.searchsorted(mine, first + n) - near
        some = np.flatnonzero(count)
        if sums[stop - 1] - base <= most:
            yield from candidates(where[some], near[some], count[some], begins, items, entries)
        else:
            yield from of_one_item(int(low), where[some], near[some], count[some], begins, items, entries, most)
        start = stop


def of_one_item(item: int, where: np.ndarray, first: np.ndarray, n: np.ndarray, begins: np.ndarray, items: Items, entries: tuple, most: int) -> Iterator[tuple]:
    """few_at_once() of a single document and item: pieces of the document that overlap by a region's length."""
    reach = len(items.texts[item]) + 2 * int(items.allowed[item])
    ends = np.concatenate([[0], np.cumsum(n)])
    doc = int(np.searchsorted(begins, where[0], side="right")) - 1
    start = 0
    while start < len(where):
        stop = int(np.searchsorted(ends, ends[start] + most, side="right")) - 1  # as many as may be held
        stop = max(stop, int(np.searchsorted(where, where[start] + 2 * reach, side="left")))  # at the least two regions
        if ends[stop] - ends[start] <= most:
            yield from candidates(where[start:stop], first[start:stop], n[start:stop], begins, items, entries)
        else:
            yield doc, (item, int(where[start]) - reach, int(where[stop - 1]) + reach), None
        if stop >= len(where):
            return
        start = max(start + 1, int(np.searchsorted(where, where[stop - 1] - reach, side="left")))


def hits(data: bytes, begins: np.ndarray, items: Items, most: int = MOST_PAIRS) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, distance, position) of verified regions; data holds documents joined by separators, begins their
    first bytes. At most one, the best, for each document, item and band; none behind one that stands as it is."""
    grams = codes(data)
    at = np.flatnonzero(items.table[slot(grams, len(items.table))])
    found = grams[at]
    first = np.searchsorted(items.grams, found, side="left")
    n = np.searchsorted(items.grams, found, side="right") - first
    some = np.flatnonzero(n)
    exact_in: set[tuple[int, int]] = set()
    for d, i, band in few_at_once(at[some], first[some], n[some], begins, items, most):
        start, stop = int(begins[d]), (int(begins[d + 1]) - 1 if d + 1 < len(begins) else len(data))
        if band is None:
            i, left, right = i
            left, right = max(start, left), min(stop, right)
            low, high = -int(items.allowed[i]), right - left
        else:
            half = int(items.allowed[i]) + 1
            low, high = band * half - BASE - half, band * half - BASE + 3 * half
            left, right = max(start, low), min(stop, high + len(items.texts[i]) + half)
            low, high = low - left, high - left
        if (d, i) in exact_in:
            continue
        text, region = items.texts[i], data[left:right]
        exact = region.find(text)
        if exact >= 0:
            exact_in.add((d, i))
            yield d, i, 0, left + exact - start
            continue
        distance = banded_distance(text, region, low, high, int(items.allowed[i]))
        if distance is not None:
            yield d, i, distance, left - start


def judge(texts: list[bytes | None], items: Items, most: int = MOST_PAIRS) -> list[dict[int, tuple[int, int]]]:
    """For each text, item -> (distance, position)."""
    forms = [normalised(t) for t in texts]
    begins = np.concatenate([[0], np.cumsum([len(f) + 1 for f in forms])])[:-1]
    out: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
    data = SEPARATOR.join(forms)
    for doc, item, distance, place in chain(hits(data, begins, items, most), brief_hits(data, begins, items)):
        best = out[doc].get(item)
        if best is None or (distance, place) < best:
            out[doc][item] = (distance, place)
    return out


class Benchmark:
    """A block of items as it is sent to the tasks; each worker prepares it once."""

    held: tuple[str, Items] | None = None

    def __init__(self, ids: list[int], texts: list[bytes], errors: float, least: int):
        self.ids, self.texts, self.errors, self.least = ids, texts, errors, least
        self.name = uuid.uuid4().hex

    def items(self) -> Items:
        if Benchmark.held is None or Benchmark.held[0] != self.name:
            Benchmark.held = None
            Benchmark.held = (self.name, prepare(self.ids, self.texts, self.errors, self.least))
        return Benchmark.held[1]


def blocks_of(benchmark: DataFrame, errors: float, least: int, block_bytes: int, nameless: bool = False) -> Iterator[Benchmark]:
    """The distinct normalised items in blocks of bounded size, streamed to the driver one partition at a time. nameless:
    with those that have no item_id."""
    forms: dict[bytes, int] = {}
    held = 0
    rows = benchmark.where("text IS NOT NULL" if nameless else "item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), F.col("text").cast("binary"))
    for item_id, text in rows.orderBy("item_id").toLocalIterator():
        form = normalised(bytes(text))
        if form and form not in forms:
            forms[form] = item_id
            held += len(form)
        if held >= block_bytes:
            yield Benchmark(list(forms.values()), list(forms), errors, least)
            forms, held = {}, 0
    if forms:
        yield Benchmark(list(forms.values()), list(forms), errors, least)


def leaks(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, least: int = LEAST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, position): items found in each row of docs(doc_id, text)."""
    bound_batches(docs.sparkSession)
    schema = "doc_id long, item_id long, distance int, position long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks_of(benchmark, errors, least, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], block: Benchmark = block) -> Iterator[pa.RecordBatch]:
            items = block.items()
            for part in chunks(batches, "text", 2 << 20):
                ids = part.column(0).to_pylist()
                rows = [(ids[d], items.ids[i], *found) for d, got in enumerate(judge(as_bytes(part.column(1)), items)) for i, found in sorted(got.items())]
                if rows:
                    a, b, c, d = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int32()), pa.array(d, pa.int64())], names=["doc_id", "item_id", "distance", "position"])
            give_back()

        out = out.union(spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, errors: float = ERRORS, least: int = LEAST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the rows that hold an item, one map for each block of items."""
    bound_batches(docs.sparkSession)
    for block in blocks_of(benchmark, errors, least, block_bytes, nameless=True):

        def run(batches: Iterator[pa.RecordBatch], block: Benchmark = block) -> Iterator[pa.RecordBatch]:
            items = block.items()
            for part in chunks(batches, "text", 2 << 20):
                found = judge(as_bytes(part.column(part.schema.get_field_index("text"))), items)
                yield part.filter(pa.array([not x for x in found]))
            give_back()

        docs = spread(docs).mapInArrow(run, docs.schema)
    return docs


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """One row for each document that holds an item: the items in order, and the smallest distance."""
    found = leaks(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("item_id")), ",").alias("item_ids"), F.countDistinct("item_id").alias("n_items"), F.min("distance").alias("least_distance"))
