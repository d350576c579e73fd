"""Sharding by sampled splitters: shards of near equal bytes, each one a range of keys.

The key of a record is (hash of the text, doc_id, row number), so copies of a text stand side by side and any group can be
cut, equal rows included. A size-weighted sample of keys gives quantile boundaries for many fine ranges; the exact bytes
of the ranges are then counted, ranges holding more than twice their share are subdivided by a second sample of their own
keys, and a running sum inside each range gives every record its exact place in the bytes of the whole. Shard i takes the
records whose first byte lies in the i-th equal part.

There are `fine` ranges for each shard, and more once a range would hold over `range_rows` records, so that no task sorts
more than a few times as many. Only (key, size, checksum) rows move; the sample (`per_range` keys for each range, in
expectation), the range totals and the shard starts are all that reaches the driver: for 100 million records 640 ranges
and some 10,000 keys, for 30 billion 30,000 ranges and half a million keys of 24 bytes.

Defined results: a null text has 0 bytes (size 16) and checksum 0; a null doc_id sorts first among equal texts; repeated
rows each get a slot, in the order of the input; an empty table gives no rows. Extra columns are left out, and kept by
`write_shards`, whose own columns are `shard` and `slot` (such columns of the input are replaced).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomrank.llm.common import written
from loomrank.session import settled

ROW_BYTES = 16
RANGE_ROWS = 1_000_000
KEY = ["h", "tie", "row"]
#: Boundaries of one slot that are looked through together.
TOGETHER = 64
Key = tuple[int, int, int]


def _up_to(cut):
    """Whether a boundary (a struct of the key's columns) is not above the record's key."""
    return cut <= F.col("key")


def _with_range(keyed: DataFrame, cuts: list[Key]) -> DataFrame:
    """Adds `part`, the range of each key, by a broadcast of the bounded list of boundaries. Records meet only those that share
    the top bits of their hash; where one text has many, these lie in groups, of which one is looked through."""
    spark = keyed.sparkSession
    slots = max(1, 2 * len(cuts))
    width = (1 << 64) // slots + 1
    lists: dict[int, list[Key]] = {}
    for cut in cuts:
        lists.setdefault((cut[0] + (1 << 63)) // width, []).append(cut)
    rows, below = [], 0
    for s in range(slots):
        own = lists.get(s, [])
        groups = [(own[i], i, own[i : i + TOGETHER]) for i in range(0, len(own), TOGETHER)]
        rows.append((s, below, groups))
        below += len(own)
    key = "struct<h:bigint,tie:bigint,row:bigint>"
    table = spark.createDataFrame(rows, f"slot int, below int, groups array<struct<head:{key},before:int,cuts:array<{key}>>>")
    slot = F.expr(f"cast(floor((cast(h AS decimal(20,0)) + {1 << 63}BD) / {width}BD) AS int)")
    at = keyed.withColumn("key", F.struct(*KEY)).withColumn("slot", slot).join(F.broadcast(table), "slot")
    at = at.withColumn("group", F.try_element_at("groups", F.greatest(F.lit(1), F.size(F.filter("groups", lambda g: _up_to(g["head"]))))))
    passed = F.when(F.col("group").isNull(), F.lit(0)).otherwise(F.col("group.before") + F.size(F.filter("group.cuts", _up_to)))
    return at.withColumn("part", F.col("below") + passed).drop("slot", "below", "groups", "group", "key")


def _cuts(keyed: DataFrame, total: int, pieces: int, sample: int, seed: int) -> list[Key]:
    """Up to pieces - 1 boundaries at equal weights of a sample in which a record is drawn in proportion to its size."""
    if pieces < 2 or not total:
        return []
    u = F.pmod(F.xxhash64(F.lit(seed), *KEY), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = keyed.where(u < F.col("size") * F.lit(sample / total)).select(*KEY).collect()
    keys = sorted(tuple(r) for r in drawn)
    return sorted({keys[len(keys) * i // pieces] for i in range(1, pieces)}) if keys else []


def _totals(ranged: DataFrame) -> dict[int, int]:
    return {r.part: r.size for r in ranged.groupBy("part").agg(F.sum("size").alias("size")).collect()}


def ranges(keyed: DataFrame, shards: int, fine: int = 16, per_range: int = 16, range_rows: int = RANGE_ROWS, seed: int = 7) -> tuple[DataFrame, dict[int, int]]:
    """keyed(h, tie, row, size) with `part`, its range, and the bytes of each range."""
    count, total = keyed.agg(F.count("*"), F.sum("size")).first()
    total = total or 0
    pieces = max(shards * fine, -(-count // range_rows))
    cuts = _cuts(keyed, total, pieces, pieces * per_range, seed)
    ranged = _with_range(keyed, cuts)
    sizes = _totals(ranged)
    over = sorted(p for p, s in sizes.items() if s > 2 * total / pieces)
    if over:  # a second sample, of the overfull ranges alone
        weight = sum(sizes[p] for p in over)
        more = _cuts(ranged.where(F.array_contains(F.lit(over), F.col("part"))), weight, max(2, round(2 * pieces * weight / total)), pieces * per_range, seed + 1)
        ranged = _with_range(keyed, sorted({*cuts, *more}))
        sizes = _totals(ranged)
    return ranged, sizes


def keys_of(numbered: DataFrame) -> DataFrame:
    """(doc_id, row, size, text_crc32, h, tie) of numbered(doc_id, text, row)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(ROW_BYTES)
    checksum = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
    tie = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return numbered.select("doc_id", "row", size.alias("size"), checksum.alias("text_crc32"), F.xxhash64("text").alias("h"), tie.alias("tie"))


def _numbered(docs: DataFrame) -> DataFrame:
    return settled(docs).withColumn("row", F.monotonically_increasing_id())


def places(numbered: DataFrame, shards: int = 40, **options) -> DataFrame:
    """doc_id, row, size, text_crc32, shard, slot for each row of numbered(doc_id, text, row)."""
    keyed = written(keys_of(numbered), "shard-keys")
    ranged, sizes = ranges(keyed, shards, **options)
    total = max(1, sum(sizes.values()))
    before, starts = 0, []
    for p in sorted(sizes):
        starts.append((p, before))
        before += sizes[p]
    starts = numbered.sparkSession.createDataFrame(starts, "part int, part_start long")
    order = Window.partitionBy("part").orderBy(*KEY)
    first_byte = F.col("part_start") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = ranged.join(F.broadcast(starts), "part").withColumn("first_byte", first_byte).withColumn("rank", F.row_number().over(order).cast("long"))
    shard = F.least(F.floor(F.col("first_byte").cast("decimal(30,0)") * shards / F.lit(total)), F.lit(shards - 1)).cast("int")
    placed = written(placed.withColumn("shard", shard).select("doc_id", "row", "size", "text_crc32", "part", "rank", "shard"), "shard-places")
    # The rank inside a range minus the first rank of the shard there, after the shard's rows of earlier ranges.
    pieces = placed.groupBy("shard", "part").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("shard", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    return placed.join(F.broadcast(offsets), ["shard", "part"]).select("doc_id", "row", "size", "text_crc32", "shard", (F.col("rank") - F.col("first") + F.col("ahead")).alias("slot"))


def shard_records(docs: DataFrame, shards: int = 40, **options) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for each row of docs(doc_id, text)."""
    return places(_numbered(docs.select("doc_id", "text")), shards, **options).drop("row")


def write_shards(docs: DataFrame, path: str, shards: int = 40, **options) -> None:
    """Write docs as one folder of Parquet for each shard, rows in slot order."""
    numbered = _numbered(docs.drop("shard", "slot").select(F.struct(*[c for c in docs.columns if c not in ("shard", "slot")]).alias("doc"), "doc_id", "text"))
    found = places(numbered, shards, **options).select("row", "shard", "slot")
    joined = numbered.select("row", "doc").join(found, "row").select("doc.*", "shard", "slot")
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard_records(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
