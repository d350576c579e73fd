"""Token-ID output as length-delimited binary records, with a separate offset index.

Documents are range-partitioned by doc_id and sorted; one Arrow map tokenizes whole texts and frames each sequence. The
frames are written by Spark's own committed text writer as raw bytes (a binary column cast to string is not re-encoded),
so files land in any store that Spark can write to, and a lost task is simply redone. One frame:

    u64 length of the payload | u32 masked CRC-32 of those 8 bytes | payload | u32 masked CRC-32 of the payload | \\n

all little-endian; the closing line feed is the writer's separator and part of the frame. The mask rotates the checksum
right by 15 bits and adds 0xA282EAD8 (fixed value of the common record format; the checksum here is zlib's CRC-32, as no
CRC-32C is installed). A payload is: u8 null flag of doc_id, i64 doc_id, u32 number of ids, u8 width of an id (2 or 4),
u8 packing (0 raw, 1 zstd), the ids. The index is a Parquet table (doc_id, file, offset, length, n_tokens), made from the
files; `read_record` fetches a single record by it, `fetch_records` any number in any order.

Defined results: a null text is an empty one (the end id alone); a null doc_id sorts first; repeated rows are written as
often as they come; equal doc_ids come in the order of the first 64 characters of their texts, then in that of the input,
and any number of them is spread over files; an empty table writes no record and reads back no row.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomrank.llm.common import bound_batches, chunks, give_back, scratch_path
from loomrank.session import settled

MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
BODY = struct.Struct("<BqIBB")
READ_SCHEMA = "file string, offset long, length long, doc_id long, n_tokens long, ids_crc32 long"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record without the closing line feed."""
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked_crc(size)), payload, struct.pack("<I", masked_crc(payload))))


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of each record of a file; raises ValueError where a length or checksum is wrong."""
    at = 0
    while at < len(data):
        size, crc = HEAD.unpack_from(data, at)
        if masked_crc(data[at : at + 8]) != crc:
            raise ValueError(f"bad length at {at}")
        payload = data[at + 12 : at + 12 + size]
        (crc,) = struct.unpack_from("<I", data, at + 12 + size)
        if masked_crc(payload) != crc or data[at + 16 + size : at + 17 + size] != b"\n":
            raise ValueError(f"bad record at {at}")
        yield at, payload
        at += 17 + size


def pack(doc_id: int | None, ids: np.ndarray, wide: bool, packer: zstandard.ZstdCompressor) -> bytes:
    raw = ids.astype("<u4" if wide else "<u2").tobytes()
    small = packer.compress(raw) if len(raw) > 64 else raw
    packed = len(small) < len(raw)
    return BODY.pack(doc_id is None, doc_id or 0, len(ids), 4 if wide else 2, packed) + (small if packed else raw)


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    null, doc_id, n, width, packed = BODY.unpack_from(payload)
    raw = payload[BODY.size :]
    if packed:
        raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=n * width)
    return None if null else doc_id, np.frombuffer(raw, dtype=f"<u{width}", count=n).astype("<u4")


#: The pattern by which a tokenizer of the kind that `WordEncoder` splits finds its pieces (fixed value of its file).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_at_space(description: dict) -> bool:
    """Whether a tokenizer, by its own description, lowers its input, drops white space, and joins nothing across it."""
    steps = (description.get("normalizer") or {}).get("normalizers") or []
    form = [(x["type"], x.get("pattern"), x.get("content")) for x in steps]
    cuts = ((description.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (
        form == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
        and (cuts.get("type"), cuts.get("pattern"), cuts.get("behavior"), cuts.get("invert")) == ("Split", {"Regex": PIECES}, "Removed", True)
        and not description.get("post_processor")
        and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or " " in x["content"] for x in description["added_tokens"])
    )


class WordEncoder:
    """encode() of the tokenizers library for whole texts, each distinct chunk between spaces encoded once.

    For a tokenizer that lowers its input, drops white space and never joins text across it (`splits_at_space`), the ids
    of a text are the ids of its chunks in order, and a full stop or comma between an ASCII letter or digit and white space
    is a chunk of its own. So the memory of chunks seen so far gives the same ids as encoding the text at once. A new chunk of
    `simple` characters is cut and lowered here and handed to the model at once, which takes half the time; others are
    encoded together, with a mark between them that has one id of its own. At `most` chunks the memory is cut down to those
    met often. A tokenizer of another kind encodes each text as a whole.
    """

    MARK = "~"
    #: Where simple letters are looked for: none of them composes with another, nor with what else is simple.
    LETTERS = range(0x41, 0x530)
    #: What may be simple beside letters. No apostrophe, as some words are cut there, and no start of a special token's name.
    DIGITS, SIGNS = "0123456789", r"""!"#$%&()*+,-./:;=>?@[\]^_`{|}~"""
    FIXED = r"[A-Z][^\x00-\x7F\pL]|<\|"
    POINT = r"([A-Za-z0-9])([.,])([ \n])"

    def __init__(self, path: str, most: int = 320_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        description = json.loads(self.tokenizer.to_str())
        self.splits_at_space, self.most = splits_at_space(description), most
        self.mark = self._ids(self.MARK)
        self.model = self.tokenizer.model
        self.form = self._forms() if self.splits_at_space else {}
        letters, digits, signs = (re.escape("".join(c for c in map(chr, self.form) if among(c))) for among in (str.isalpha, self.DIGITS.__contains__, self.SIGNS.__contains__))
        some = [f"[{x}]{often}" for x, often in ((letters, "+"), (digits, ""), (signs, "+")) if x]
        self.simple = re.compile(f"[{letters}{digits}{signs}]+" if some else "(?!)").fullmatch
        self.pieces = re.compile("|".join(some)).findall
        if any(self.simple(x["content"]) for x in description["added_tokens"]):  # a chunk may hold one: left to the tokenizer
            self.simple = re.compile("(?!)").fullmatch
        self._keep([], np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _forms(self) -> dict[int, str]:
        """What the tokenizer makes of each simple character before its model, asked of the tokenizer itself: letters join
        letters, signs join signs, digits nothing, and each is lowered by itself."""
        lowered, cut = self.tokenizer.normalizer.normalize_str, self.tokenizer.pre_tokenizer.pre_tokenize_str
        forms = {}
        for c in (*map(chr, self.LETTERS), *self.DIGITS, *self.SIGNS):
            low = lowered(c)
            alone = "".join(x for x, _ in cut(low))
            letter = c.isalpha() and unicodedata.category(c) in ("Lu", "Ll")
            a = cut("a")[0][0]
            if len(low) == 1 and (letter or c in self.DIGITS or c in self.SIGNS):
                joined, twice = [x for x, _ in cut(f"a{low}a")], [x for x, _ in cut(low * 2)]
                wanted = ([a + alone + a], [alone * 2]) if letter else ([a, alone, a], [alone] * 2 if c in self.DIGITS else [alone * 2])
                if (joined, twice) == wanted:
                    forms[ord(c)] = alone
        return forms

    def _keep(self, words: list[str], flat: np.ndarray, counts: np.ndarray, met: np.ndarray) -> None:
        """The memory: chunks, their ids one after another, how many each has, how often it was met."""
        self.index = dict(zip(words, range(len(words)), strict=True))
        self.flat, self.counts, self.met = flat, counts, met

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after another, and the number of each."""
        if len(self.mark) == 1 and not any(self.MARK in w for w in words):
            ids = self._ids(f" {self.MARK} ".join(words))
            marks = np.flatnonzero(ids == self.mark[0])
            if len(marks) == len(words) - 1:
                cuts = np.concatenate([[-1], marks, [len(ids)]])
                return ids[ids != self.mark[0]], np.diff(cuts) - 1
        parts = [self._ids(w) for w in words]
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)

    def _modelled(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """`_encoded` for simple words."""
        run, form, ids, counts = self.model.tokenize, self.form, [], []
        for word in words:
            if word.isascii() and word.isalpha():
                found = [x.id for x in run(word.translate(form))]
            else:
                found = [x.id for piece in self.pieces(word) for x in run(piece.translate(form))]
            ids += found
            counts.append(len(found))
        return np.array(ids, dtype=np.uint32), np.array(counts, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        simple = [w for w in words if self.simple(w)]
        others = [w for w in words if not self.simple(w)] if len(simple) < len(words) else []
        words = simple + others
        parts = [self._modelled(simple), *(self._encoded(others[i : i + 500]) for i in range(0, len(others), 500))]
        first = len(self.index)
        self.index.update(zip(words, range(first, first + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, *(p[0] for p in parts)])
        self.counts = np.concatenate([self.counts, *(p[1] for p in parts)])
        self.met = np.concatenate([self.met, np.zeros(len(words), dtype=np.int64)])

    def _shrink(self) -> None:
        """Keep the half of `most` that was met most often; older meetings count less and less."""
        bar = max(1, int(np.partition(self.met, -(self.most // 2))[-(self.most // 2)]))
        often = self.met > bar
        words = [w for w, keep in zip(self.index, often.tolist(), strict=True) if keep]
        self._keep(words, self.flat[np.repeat(often, self.counts)], self.counts[often], self.met[often] // 2)

    def encode(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """The ids of each text, with the end id appended."""
        if not self.splits_at_space:
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            return [np.array([*x.ids, end_id], dtype=np.uint32) for x in found]
        if len(self.index) > self.most:
            self._shrink()
        # Fewer chunks: A-Z are lowered here, where that changes nothing. A letter before what may be a combining mark may
        # compose with it only when lowered, and a special token's name must not come about; all other letters are left to
        # the tokenizer.
        forms = pa.array(texts, pa.large_string())
        forms = pc.if_else(pc.match_substring_regex(forms, self.FIXED), forms, pc.ascii_lower(forms))
        apart = pc.replace_substring_regex(forms, self.POINT, r"\1 \2\3")
        split = pc.split_pattern(pc.replace_substring(apart, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist() takes several times as long
        rows = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        absent = np.flatnonzero(rows < 0)
        if len(absent):
            new = [words[i] for i in absent.tolist()]
            self._learn(new)
            rows[absent] = [self.index[w] for w in new]
        places = coded.indices.to_numpy()
        self.met[rows] += np.bincount(places, minlength=len(words))
        starts = (np.cumsum(self.counts) - self.counts).astype(np.int32)
        counts = self.counts[rows].astype(np.int32)[places]
        ends = np.cumsum(counts, dtype=np.int32)
        ids = self.flat[np.repeat(starts[rows][places] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int32)]
        cuts = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        end = np.array([end_id], dtype=np.uint32)
        return [np.concatenate([ids[a:b], end]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker, shared by the tasks it runs; nothing but speed depends on its memory."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, file_bytes: int = 128 << 20, least_bytes: int = 24 << 20) -> None:
    """Write docs(doc_id, text) as record files under path, in ascending order of doc_id over the files' numbers. A file takes
    about file_bytes of text; of a small input it takes less, down to least_bytes, so that every core has some."""
    bound_batches(docs.sparkSession)
    docs = settled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-total // min(file_bytes, max(least_bytes, total // (6 * cores)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = encoder(tokenizer_path), zstandard.ZstdCompressor(level=1)
        for part in chunks(batches, "text", 4 << 20):
            ids = part.column(0).to_pylist()
            texts = [t or "" for t in part.column(1).to_pylist()]
            rows = [frame(pack(d, x, coder.wide, packer)) for d, x in zip(ids, coder.encode(texts, end_id), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])
        give_back()

    order = ["doc_id", "head", "row"]  # the row number lets equal rows be cut
    numbered = docs.select("doc_id", "text", F.substring("text", 1, 64).alias("head"), F.monotonically_increasing_id().alias("row"))
    ordered = numbered.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.option("compression", "none").text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the files: where it lies, its doc_id, its number of ids and their CRC-32."""
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for at, payload in frames(content.as_py()):
                    doc_id, ids = unpack(payload)
                    rows.append((file, at, len(payload) + 17, doc_id, len(ids), zlib.crc32(ids.tobytes())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), *[pa.int64()] * 5), strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInArrow(run, READ_SCHEMA)


def read_record(spark: SparkSession, path: str, file: str, offset: int, length: int) -> tuple[int | None, np.ndarray]:
    """The doc_id and ids of the record at this place of the index, from any store that Spark can read; nothing else of the
    file is read. Raises ValueError where a length or checksum is wrong."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(f"{path}/{file}")
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        stream.seek(offset)
        data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, length))
    finally:
        stream.close()
    ((_, payload),) = frames(data)
    return unpack(payload)


def fetch_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(place, doc_id, ids) for wanted(place, file, offset, length), rows of the index in the order of `place`: a shuffled
    epoch, say. Each file that is asked for is read once, by one task, whatever the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, asked in zip(batch.column(0), batch.column(1), strict=True):
                data, rows = memoryview(content.as_buffer()), []
                for x in asked.as_py():
                    ((_, payload),) = frames(bytes(data[x["offset"] : x["offset"] + x["length"]]))
                    rows.append((x["place"], *unpack(payload)))
                place, ids, tokens = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(ids, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], names=["place", "doc_id", "ids"])

    asked = wanted.groupBy("file").agg(F.collect_list(F.struct("place", "offset", "length")).alias("asked"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(asked, "file").select("content", "asked")
    return named.mapInArrow(run, "place long, doc_id long, ids array<long>").orderBy("place")


#: Files whose sums are taken together before sums of sums are.
FILES_TOGETHER = 1024


def with_starts(records: DataFrame) -> DataFrame:
    """Adds start, the ids of all records before each one, files in the order of their numbers. One row for each group of
    files meets in a single task."""
    before = Window.unboundedPreceding, -1
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    files = records.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("number", number).withColumn("batch", F.expr(f"number div {FILES_TOGETHER}"))
    groups = files.groupBy("batch").agg(F.sum("n").alias("n"))
    groups = groups.select("batch", F.coalesce(F.sum("n").over(Window.orderBy("batch").rowsBetween(*before)), F.lit(0)).alias("first"))
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("batch").orderBy("number").rowsBetween(*before)), F.lit(0))
    ahead = files.withColumn("inner", inner).join(groups, "batch").select("file", (F.col("first") + F.col("inner")).alias("ahead"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("file").orderBy("offset").rowsBetween(*before)), F.lit(0))
    return records.withColumn("inside", inside).join(ahead, "file").withColumn("start", F.col("ahead") + F.col("inside")).drop("ahead", "inside")


def token_records(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Write docs as record files under path (a new shared folder if None), read the files back into their offset index
    (doc_id, file, offset, length, n_tokens, ids_crc32), and give the index with start, the ids of all records before."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "records")
    write_records(docs, f"{path}/records", tokenizer_path, **options)
    read_records(spark, f"{path}/records").write.parquet(f"{path}/index")
    index = spark.read.schema(READ_SCHEMA).parquet(f"{path}/index")
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_token_records(spark, sf_dir: str) -> DataFrame:
    return token_records(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), vocabulary())
