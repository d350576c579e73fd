"""Quality rules, sharding, token records, mixing and line dedup against plain Python."""

import bisect
import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomrank.llm import line_dedup, mixing, quality_rules, sharding, token_records

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ quality


def plain_quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)

    def covered(n):
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        return {j for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}

    repeat = len(covered(3))
    out = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": dup, "n_repeat_words": repeat, "base_failed": len(words) < 50 or 100 * repeat > 50 * len(words),
    }
    return out | {f"dup_{n}gram_chars": sum(len(words[j]) for j in covered(n)) for n in quality_rules.LENGTHS}


def test_quality_counts(spark, sf, awkward):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(awkward.select("doc_id", "text"))
    text = sorted(((r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 60_000), key=repr)
    keep = docs.where("coalesce(length(text), 0) < 60000")
    names = list(plain_quality(""))
    assert rows_of(quality_rules.quality_report(keep), "doc_id", *names) == sorted(((d, *plain_quality(t).values()) for d, t in text), key=repr)
    assert quality_rules.quality_report(awkward).count() == awkward.count()


def test_quality_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.1"
    report = quality_rules.op7_quality_rules(spark, sf)
    good = report.where("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1"), "doc_id")
    assert good.where("kept").count() >= 0.99 * good.count() > 0


def test_quality_filter_keeps_columns(spark, awkward, no_docs):
    kept = quality_rules.keep_good(awkward)
    assert kept.schema == awkward.schema
    assert {r.doc_id for r in kept.collect()} == {13}
    assert quality_rules.keep_good(no_docs).count() == 0 == quality_rules.quality_report(no_docs).count()


# ------------------------------------------------------------------ sharding


def check_shards(rows, shards):
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_shards_are_even_and_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.where("doc_id < 300").selectExpr("doc_id + 10000", "repeat('hot group ', 300)"))
    rows = sharding.shard_records(docs, shards=8).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    assert all(r.size == len(text[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in rows)
    check_shards(rows, 8)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)
    shards_of = {}
    for r in rows:
        shards_of.setdefault(text[r.doc_id], set()).add(r.shard)
    for found in shards_of.values():  # a group lies in neighbouring shards
        assert max(found) - min(found) == len(found) - 1


def test_equal_rows_are_cut(spark):
    """Thousands of equal rows without a doc_id, half of all rows: no range holds much more than its share."""
    docs = spark.createDataFrame([(None, "the same text")] * 4000 + [(i, f"text {i} of some length") for i in range(4000)], "doc_id long, text string")
    keyed = sharding.keys_of(sharding._numbered(docs)).cache()
    ranged, sizes = sharding.ranges(keyed, 8)
    assert sum(sizes.values()) == ranged.agg({"size": "sum"}).first()[0]
    assert max(sizes.values()) < 8 * sum(sizes.values()) / 128
    fine, _ = sharding.ranges(keyed, 2, fine=2, range_rows=100)
    assert max(r["count"] for r in fine.groupBy("part").count().collect()) < 1000
    rows = sharding.shard_records(docs, shards=8).collect()
    assert len(rows) == 8000
    check_shards(rows, 8)
    of = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    assert max(of) - min(of) <= 2 * max(r.size for r in rows)


def test_many_boundaries_inside_one_text(spark):
    docs = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i}") for i in range(3000)], "doc_id long, text string")
    keyed = sharding.keys_of(sharding._numbered(docs)).cache()
    keys = sorted((r.h, r.tie, r.row) for r in keyed.collect())
    cuts = keys[5::7]
    found = {(r.h, r.tie, r.row): r.part for r in sharding._with_range(keyed, cuts).collect()}
    assert all(found[k] == bisect.bisect_right(cuts, k) for k in keys)


def test_the_sharding_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sharding.op3_sharding(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)} and {r.shard for r in rows} <= set(range(40))
    check_shards(rows, 40)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(40)]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)
    assert all((r.size, r.text_crc32) == (len(docs[r.doc_id].encode()) + 16, zlib.crc32(docs[r.doc_id].encode())) for r in rows)


def test_shards_are_written_whole(spark, awkward, tmp_path):
    sharding.write_shards(awkward, str(tmp_path / "shards"), shards=3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    names = [c for c in awkward.columns if c != "shard"]
    assert rows_of(back, *names) == rows_of(awkward, *names)
    check_shards(back.collect(), 3)


def test_shards_of_awkward_rows(spark, awkward, no_docs):
    rows = sharding.shard_records(awkward, shards=4).collect()
    assert len(rows) == awkward.count()
    check_shards(rows, 4)
    assert sharding.shard_records(no_docs).count() == 0


# ------------------------------------------------------------------ token records


def test_token_records_equal_whole_text_encoding(spark, sf, awkward):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(awkward.select("doc_id", "text"))
    tokenizer = Tokenizer.from_file(token_records.vocabulary())
    data = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    expected, start = [], 0
    for doc_id, text in data:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    found = token_records.token_records(docs, token_records.vocabulary(), file_bytes=200_000, least_bytes=200_000)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found.collect()), key=lambda x: x[1])
    assert got == expected
    assert len({r.file for r in found.collect()}) > 1


def test_lowering_is_left_to_the_tokenizer(spark):
    from tokenizers import Tokenizer

    texts = ["\u039f\u0394\u039f\u03a3 \u039b\u039f\u0393\u039f\u03a3.", "J\u030c", "x H\u0331, T\u0308 y W\u030a\u0323", "\u0130stanbul \u1e9e \u01c5 \u212a\u030c", "E\u0301 \u00c9 e\u0301", "A \u03a3 a\u03a3. \u03a3\u0301", "<|ENDOFTEXT|> A", "J\u0323\u030c. Z", "a\u0130. b"]
    tokenizer = Tokenizer.from_file(token_records.vocabulary())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.ids_crc32 for r in token_records.token_records(docs, token_records.vocabulary()).collect()}
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert got[i] == zlib.crc32(np.array(ids, dtype="<u4").tobytes()), text


ODD = st.sampled_from([*"aAbZ.,'~ \n\t", "\u03a3", "\u0130", "\u0131", "\u030c", "\u0323", "\u0301", "\u00a0", "\u2003", "\x1c", "\x85", "\u00c9", "J", "\u1e9e", "\u01c5", "\u212a", "<|endoftext|>", "<|ENDOFTEXT|>",
                       "<|startoftext|>", "'s ", "it's. ", "\U0001f600", "7", "\u0660", "\u4e2d", "\u00df. ", "\u0130. ", "e\u0301, ", "\u20dd", "\u0345 "])


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.lists(st.one_of(ODD, ODD, ODD, st.text(max_size=2)), max_size=12).map("".join), min_size=1, max_size=6))
def test_ids_are_those_of_whole_texts(texts):
    """Final sigma, letters that grow when lowered, combining marks, special tokens and all kinds of white space."""
    coder = token_records.encoder(token_records.vocabulary())
    assert coder.splits_at_space
    for text, ids in zip(texts, coder.encode(texts, 2), strict=True):
        assert ids.tolist() == [*coder.tokenizer.encode(text, add_special_tokens=False).ids, 2], ascii(text)


def test_simple_chunks_are_left_to_the_model(monkeypatch):
    """Letters, digits and signs that the tokenizer changes one by one; all else goes through the whole tokenizer."""
    coder = token_records.WordEncoder(token_records.vocabulary())
    through, encoded = [], coder._encoded
    monkeypatch.setattr(coder, "_encoded", lambda words: through.extend(words) or encoded(words))
    odd = ["it's", "a<b", "J\u030c", "\u0130x", "\u4e2d", "e\u0301", "<|endoftext|>"]
    text = " ".join(["Plain words,", "\u00d1and\u00fa.###", "x12-y_3", "\u039f\u0394\u039f\u03a3", "\u0436\u0416", "~~", *odd])
    assert coder.encode([text], 2)[0].tolist() == [*coder.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert set(through) - {""} == set(odd)


def test_every_simple_character_gives_the_ids_of_whole_texts():
    coder = token_records.WordEncoder(token_records.vocabulary())
    simple = [*map(chr, coder.form)]
    assert {*"azAZ09.,#~", "\u00f1", "\u00d1", "\u0444"} <= set(simple) and not {"'", "<", "\u0130"} & set(simple)
    texts = [f"{c} a{c}b {c}{c}, 1{c}2 {c}{d}.{c} {d}s{c}" for c, d in zip(simple, simple[7:] + simple[:7], strict=True)]
    for text, ids in zip(texts, coder.encode(texts, 2), strict=True):
        assert ids.tolist() == [*coder.tokenizer.encode(text, add_special_tokens=False).ids, 2], ascii(text)


def test_special_tokens_of_simple_characters_are_found(tmp_path):
    coder = token_records.WordEncoder(token_records.vocabulary())
    coder.tokenizer.add_special_tokens(["[x]"])
    coder.tokenizer.save(str(tmp_path / "t.json"))
    coder = token_records.WordEncoder(str(tmp_path / "t.json"))
    text = "one a[x]b two [x]"
    assert coder.splits_at_space
    assert coder.encode([text], 2)[0].tolist() == [*coder.tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_other_tokenizers_encode_whole_texts():
    coder = token_records.WordEncoder(token_records.vocabulary("byte_bpe_50k.json"))
    assert not coder.splits_at_space
    texts = ["two  words\n\n and more.", "", " x"]
    assert [x.tolist() for x in coder.encode(texts, 9)] == [[*coder.tokenizer.encode(t, add_special_tokens=False).ids, 9] for t in texts]


def test_a_full_memory_changes_no_ids():
    coder = token_records.WordEncoder(token_records.vocabulary(), most=50)
    for i in range(20):
        text = " ".join(f"word{j}x{i % 3}, The End." for j in range(i, i + 30))
        assert coder.encode([text], 2)[0].tolist() == [*coder.tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_starts_follow_the_numbers_of_files(spark):
    """Names on both sides of 100,000, where the order of names as text is another one."""
    numbers = [0, 7, 9_999, 10_001, 99_999, 100_000, 100_001, 1_000_000]
    rows = [(f"part-{n:05d}-abc-c000.txt", at, n + at) for n in numbers for at in (0, 50, 1000)]
    found = {(r.file, r.offset): r.start for r in token_records.with_starts(spark.createDataFrame(rows[::-1], "file string, offset long, n_tokens long")).collect()}
    start = 0
    for file, at, n in rows:
        assert found[file, at] == start
        start += n


def test_records_are_fetched_in_any_order(spark, sf, awkward, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(awkward.select("doc_id", "text"))
    index = token_records.token_records(docs, token_records.vocabulary(), str(tmp_path / "r"), file_bytes=100_000, least_bytes=100_000)
    wanted = index.where("doc_id IS NOT NULL").select("doc_id", "file", "offset", "length", "n_tokens", "ids_crc32", F.xxhash64("file", "offset").alias("key"))
    wanted = wanted.withColumn("place", F.row_number().over(Window.orderBy("key")).cast("long"))
    rows = wanted.orderBy("place").collect()
    got = token_records.fetch_records(spark, str(tmp_path / "r/records"), wanted).collect()
    assert [(r.place, r.doc_id, len(r.ids), zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())) for r in got] == [(r.place, r.doc_id, r.n_tokens, r.ids_crc32) for r in rows]
    for r in rows[:7]:
        doc_id, ids = token_records.read_record(spark, str(tmp_path / "r/records"), r.file, r.offset, r.length)
        assert (doc_id, zlib.crc32(ids.tobytes())) == (r.doc_id, r.ids_crc32)
    with pytest.raises(ValueError):
        token_records.read_record(spark, str(tmp_path / "r/records"), rows[0].file, rows[0].offset + 1 if rows[0].offset else 1, 40)


def test_equal_rows_are_spread_over_files(spark):
    docs = spark.createDataFrame([(None, "same text again")] * 4000 + [(5, "x")], "doc_id long, text string")
    found = token_records.token_records(docs, token_records.vocabulary(), file_bytes=8000, least_bytes=8000)
    sizes = [r["count"] for r in found.groupBy("file").count().collect()]
    assert sum(sizes) == 4001 and len(sizes) > 4 and max(sizes) < 1500
    starts = sorted((r.start, r.n_tokens) for r in found.collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_frames_notice_damage():
    data = token_records.frame(b"abc") + b"\n" + token_records.frame(b"") + b"\n"
    assert [p for _, p in token_records.frames(data)] == [b"abc", b""]
    for i in (0, 9, 13, len(data) - 6):
        broken = bytearray(data)
        broken[i] ^= 1
        with pytest.raises(ValueError):
            list(token_records.frames(bytes(broken)))


def test_no_token_records(spark, no_docs):
    assert token_records.token_records(no_docs, token_records.vocabulary()).count() == 0


# ------------------------------------------------------------------ mixing


def test_mixing_rates_and_means(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as source", "'abcd' as text", "1 as n")
    weights = spark.createDataFrame([("hot", 1.0), ("s1", 2.0), ("s2", 1.0)], "source string, weight double")
    out = mixing.mix(docs, mixing.source_rates(docs, weights))
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert set(n) == {"hot", "s1", "s2"}
    assert abs(n["s1"] - 10_000) < 600 and abs(n["hot"] - 5_000) < 400 and abs(n["s2"] - 5_000) < 400
    keys = [r.mix_key for r in out.select("mix_key").collect()]
    assert keys == sorted(keys)


def test_mixing_awkward_rows(spark, awkward, no_docs):
    out = mixing.mix(awkward, mixing.source_rates(awkward))
    assert set(awkward.columns) < set(out.columns)
    assert out.where("doc_id = 12").count() % 2 == 0
    assert mixing.mix(no_docs, mixing.source_rates(no_docs)).count() == 0
    nulls = awkward.selectExpr("doc_id", "cast(null as string) as source", "text")
    assert mixing.mix(nulls, mixing.source_rates(nulls)).count() > 0


def test_mixing_draws_rates_above_500(spark):
    docs = spark.range(1000).selectExpr("id as doc_id", "if(id < 100, 'rare', 'hot') as source", "if(id < 100, 'a', repeat('b', 500)) as text")
    rates = mixing.source_rates(docs, spark.createDataFrame([("rare", 1.0), ("hot", 2.0)], "source string, weight double"))
    rate = {r.source: r.rate for r in rates.collect()}["rare"]
    assert 1500 < rate < 1502
    copies = [r["count"] for r in mixing.mix(docs, rates).where("source = 'rare'").groupBy("doc_id").count().collect()]
    assert len(copies) == 100 and abs(np.mean(copies) - rate) < 5 * (rate / 100) ** 0.5 and 0.5 * rate < np.var(copies) < 1.7 * rate


def test_mixing_of_a_tiny_source(spark):
    """Characters to the power 0.5: a source of one character beside many."""
    docs = spark.createDataFrame([(0, "odd", "x"), *((i, "main", "y" * 10_000) for i in range(1, 401))], "doc_id long, source string, text string")
    out = mixing.mix(docs, mixing.source_rates(docs))
    assert abs(out.where("source = 'odd'").count() - 1999) < 250 and out.where("doc_id = 0").select("copy_no").distinct().count() > 1700


def test_mixing_sql_follows_high_rates(spark, tmp_path):
    """Rates below one, of several hundred and of several draws, repeated rows and null sources: the same as the SQL."""
    rows = [(i, "main", "y" * 40_000) for i in range(300)] + [(1000 + i, "small", "abc") for i in range(5)] + [(2000, "odd", "x"), (2000, "odd", "x"), (None, "odd", "z"), (3000, None, "null source " * 9), (3001, "empty", None)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    names = "doc_id, source, copy_no, mix_key, chars"
    expected = con.sql(mixing.SQL).project(names).fetchall()
    got = mixing.op9_mixing(spark, str(tmp_path)).select(*names.split(", ")).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert sum(r[1] == "odd" for r in expected) > 2 * 500


def test_mixing_runs_no_python(spark, sf):
    plan = mixing.op9_mixing(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ line dedup


def plain_line_dedup(docs):
    first, cover = {}, {}
    for doc_id, text in sorted((x for x in docs if x[0] is not None), key=lambda x: x[0]):
        lines = (text or "").split("\n")
        for i in range(len(lines) - 2):
            w = "\n".join(lines[i : i + 3])
            if re.search("[^ \t-\r]", w) and first.setdefault(w, (doc_id, i)) != (doc_id, i):
                cover.setdefault(doc_id, set()).update(range(i, i + 3))
    out = []
    for doc_id, text in docs:
        lines = text.split("\n") if text is not None else []
        gone = cover.get(doc_id, set()) if text is not None else set()
        out.append((doc_id, len(lines), len(gone), None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return sorted(out, key=repr)


def test_line_dedup(spark, sf, awkward):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(awkward.selectExpr("doc_id + 1000000", "text"))
    expected = plain_line_dedup([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(line_dedup.dedup_lines(docs), "doc_id", "n_lines", "n_removed", "kept_text") == expected


def test_line_dedup_inside_one_text_and_empty(spark, no_docs):
    docs = spark.createDataFrame([(1, "a\nb\nc\na\nb\nc\nd"), (2, "b\nc\nd"), (3, None), (4, "a\nb\nc")], "doc_id long, text string")
    found = {r.doc_id: (r.n_lines, r.n_removed, r.kept_text) for r in line_dedup.dedup_lines(docs).collect()}
    assert found == {1: (7, 3, "a\nb\nc\nd"), 2: (3, 3, ""), 3: (0, 0, None), 4: (3, 3, "")}
    assert line_dedup.dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op5_chat_format", "op6_line_dedup", "op7_quality_rules", "op9_mixing"])
def test_sql_agrees(spark, sf, name):
    from loomrank.llm import queries

    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    expected = con.sql(queries.ORACLE_SQL[name])
    names = sorted(expected.columns)
    ours = queries.QUERIES[name](spark, sf)
    assert sorted(ours.columns) == names
    assert rows_of(ours, *names) == sorted((tuple(r) for r in expected.project(", ".join(names)).fetchall()), key=repr)


def test_kept_digest(spark, sf):
    row = line_dedup.op6_line_dedup(spark, sf).where("n_removed = 0").orderBy("doc_id").first()
    text = spark.read.parquet(f"{sf}/documents.parquet").where(f"doc_id = {row.doc_id}").first().text
    assert row.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()
