"""Substring dedup, LM scoring and decontamination against brute force."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from loomrank.llm import blocks, decontaminate, lm_scoring, queries, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ blocks


def test_packed_keys_come_back():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        values = [np.arange(len(keys)) - 5, rng.integers(-(1 << 62), 1 << 62, len(keys))]
        got, back = blocks.unpack(blocks.pack(keys, values))
        assert (got == keys).all() and all((a == b).all() for a, b in zip(values, back, strict=True))
        wanted = np.concatenate([keys[::3], np.array([1, 3], dtype=np.uint64)])
        row = blocks.look_up(keys, wanted)
        assert (row[-2:] == -1).all() and (keys[row[:-2]] == wanted[:-2]).all()


def test_keys_that_differ_in_their_checks_alone():
    keys, checks, docs = np.array([7, 5, 7, 7, 5], dtype=np.uint64), np.array([2, 1, 1, 2, 1]), np.array([10, 20, 30, 4, 50])
    key, least, most, check = blocks.least_and_most(keys, docs, docs, checks)
    assert (key.tolist(), check.tolist(), least.tolist(), most.tolist()) == ([5, 7, 7], [1, 1, 2], [20, 30, 4], [50, 30, 10])
    wanted, by = np.array([7, 7, 5, 7, 6], dtype=np.uint64), np.array([2, 1, 1, 3, 1])
    assert blocks.look_up(key, wanted, check, by).tolist() == [2, 1, 0, -1, -1]
    assert blocks.places(key, wanted[:3], check, by[:3]).tolist() == [2, 1, 0]


def test_blocks_are_even_whatever_the_rows(spark):
    """Thousands of equal rows, with and without an id: no block and no group is larger than another."""
    docs = spark.createDataFrame([(1, "same words here")] * 3000 + [(None, "same words here")] * 3000 + [(2, None)] * 10, "doc_id long, text string")
    made = blocks.Blocks(docs, block_bytes=3000)
    sizes = [len(blocks.unpack_docs(r.docs)[0]) for r in made.rows.collect()]
    assert sum(sizes) == 6010 and max(sizes) <= 211 and len(sizes) >= 28
    found = lm_scoring.score_corpus(docs, block_bytes=3000)
    assert found.count() == 6010 and found.where("n_words = 3").select("score").distinct().count() == 1


def test_rows_exchanged_grow_with_the_input(spark):
    """The rows of the exchange are bounded by blocks times buckets, and the buckets by the partitions or the bytes."""
    rows = []
    for copies in (1, 2, 4):
        docs = spark.range(400 * copies).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 200), x -> concat('w', hash(id, x) % 5000))) as text")
        made = blocks.Blocks(docs, block_bytes=20_000, bucket_bytes=10 << 20)
        asked = made.ask_first(lambda ids, texts: lm_scoring.Grams(texts, 2, 2).ask())
        rows.append(asked.count())
    assert rows[2] < 5 * rows[0]


def test_scratch_order_is_settled_before_numbering(spark, sf):
    """Rows that come out of a shuffle are written before they are numbered."""
    from loomrank.session import moves_rows, settled

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert not moves_rows(docs.where("doc_id > 3").union(docs)) and moves_rows(docs.distinct()) and moves_rows(docs.orderBy("doc_id"))
    assert not moves_rows(settled(docs.distinct()))


# ------------------------------------------------------------------ substrings


def plain_substrings(docs, window):
    first = {}
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        if doc_id is not None:
            for i in range(len(words) - window + 1):
                w = tuple(words[i : i + window])
                first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        gone = set()
        if doc_id is not None:
            for i in range(len(words) - window + 1):
                if first[tuple(words[i : i + window])] < doc_id:
                    gone.update(range(i, i + window))
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def as_rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [16 << 20, 60_000])
def test_substrings_of_documents(spark, sf, awkward, block_bytes):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(awkward.selectExpr("doc_id + 1000000", "text"))
    expected = plain_substrings([(r.doc_id, r.text) for r in docs.collect()], 50)
    assert sum(r[2] for r in expected) > 1000
    assert as_rows(substring_dedup.dedup_substrings(docs, block_bytes=block_bytes)) == expected


def test_substrings_at_every_offset(spark):
    """Shared passages of all lengths about the window, at the ends and in the middle, in few-word and repetitive texts."""
    rng = np.random.default_rng(5)
    docs = []
    for i in range(150):
        n_symbols = int(rng.choice([2, 5, 1000]))
        words = [f"v{x}" for x in rng.integers(0, n_symbols, rng.integers(0, 90))]
        if docs and rng.random() < 0.8:
            source = docs[rng.integers(0, len(docs))][1].split()
            a = int(rng.integers(0, max(1, len(source))))
            piece = source[a : a + int(rng.integers(8, 30))]
            at = int(rng.integers(0, len(words) + 1))
            words = words[:at] + piece + words[at:]
        docs.append((int(rng.integers(0, 100)), " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for window in (10, 20):
        assert as_rows(substring_dedup.dedup_substrings(frame, window, 2000)) == plain_substrings(docs, window)


def test_nothing_in_nothing_out(spark, no_docs):
    assert substring_dedup.dedup_substrings(no_docs).count() == 0 == lm_scoring.score_corpus(no_docs).count()


def test_anchors_are_few_and_shared():
    rng = np.random.default_rng(6)
    shared = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    words = np.concatenate([rng.integers(0, 1 << 63, 300, dtype=np.uint64), shared, rng.integers(0, 1 << 63, 77, dtype=np.uint64), shared])
    owner = np.repeat([0, 1], [700, 477])
    starts, keys = substring_dedup.anchors(words, owner, 2, 50)
    by_start = dict(zip(starts.tolist(), keys.tolist(), strict=True))
    assert all(by_start[300 + i] == by_start[777 + i] for i in range(351))
    assert len(np.unique(keys)) < len(words) / 6


# ------------------------------------------------------------------ language model


def plain_scores(docs, order=3, least=2, backoff=0.4):
    lists = [(d, WORD.findall(t or "")) for d, t in docs]
    count = Counter(tuple(ws[i : i + n]) for _, ws in lists for n in range(1, order + 1) for i in range(len(ws) - n + 1))
    total = sum(len(ws) for _, ws in lists)

    def s(gram):
        if len(gram) == 1:
            return count[gram] / total
        if count[gram] >= least:
            return count[gram] / count[gram[:-1]]
        return backoff * s(gram[1:])

    out = []
    for d, ws in lists:
        logs = [math.log10(s(tuple(ws[max(0, i - order + 1) : i + 1]))) for i in range(len(ws))]
        missed = sum(min(i, order - 1) >= 1 and count[tuple(ws[max(0, i - order + 1) : i + 1])] < least for i in range(len(ws)))
        out.append((d, len(ws), missed, round(sum(logs) / len(logs), 6) if logs else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order,block_bytes", [(2, 16 << 20), (3, 60_000), (4, 200_000), (1, 60_000)])
def test_scores(spark, sf, awkward, order, block_bytes):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(awkward.select("doc_id", "text"))
    expected = plain_scores([(r.doc_id, r.text) for r in docs.collect()], order)
    found = lm_scoring.score_corpus(docs, order=order, block_bytes=block_bytes).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_backoff, None if r.score is None else round(r.score, 6)) for r in found), key=repr)
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        assert a[:3] == b[:3]
        assert a[3] == b[3] or abs(a[3] - b[3]) < 2e-6


def test_scores_by_least_count(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").select("doc_id", "text")
    for least in (1, 3):
        expected = plain_scores([(r.doc_id, r.text) for r in docs.collect()], 3, least)
        found = lm_scoring.score_corpus(docs, least_count=least, block_bytes=30_000).collect()
        for a, b in zip(sorted(found, key=lambda r: r.doc_id), sorted(expected), strict=True):
            assert (a.doc_id, a.n_words, a.n_backoff) == b[:3] and (a.score is None) == (b[3] is None)
            assert b[3] is None or abs(a.score - b[3]) < 2e-6


def test_least_count_is_for_longer_ngrams(spark):
    docs = spark.createDataFrame([(1, "a b a")], "doc_id long, text string")
    row = lm_scoring.score_corpus(docs, least_count=3).first()
    expected = np.log10([2 / 3, 0.4 / 3, 0.4**2 * 2 / 3]).mean()
    assert row.n_backoff == 2 and abs(row.score - expected) < 1e-9


def test_scores_agree_with_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = con.sql(queries.ORACLE_SQL["op4_lm_scoring"]).project("doc_id, n_words, n_backoff, score").fetchall()
    got = [tuple(r) for r in queries.QUERIES["op4_lm_scoring"](spark, sf).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


# ------------------------------------------------------------------ decontamination


def edit_distance_within(item, text):
    """Smallest edit distance of item to any part of text, the whole table."""
    row = np.zeros(len(text) + 1, dtype=np.int64)
    b = np.frombuffer(text, dtype=np.uint8)
    steps = np.arange(len(text) + 1)
    for i, c in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (b != c), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = int(rng.integers(0, len(out)))
        kind = rng.integers(0, 3)
        if kind == 0:
            out[at] = "q"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, "z")
    return "".join(out)


def test_every_region_within_the_budget_is_found(spark, awkward):
    rng = np.random.default_rng(7)
    letters = list("abcdefgh   ")

    def prose(n):
        return " ".join("".join(rng.choice(letters, n)).split())

    items = [prose(int(rng.integers(60, 260))) for _ in range(25)] + ["short one", None, ""]
    docs = []
    for i in range(160):
        text = prose(int(rng.integers(100, 600)))
        if i % 2:
            item = items[int(rng.integers(0, 25))]
            at = int(rng.integers(0, len(text)))
            text = text[:at] + " " + edited(rng, item, int(rng.integers(0, 1 + int(0.14 * len(item))))) + " " + text[at:]
        docs.append((i, text.replace(" ", "\n", 3).upper() if i % 4 == 1 else text))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    expected = {}
    for d, text in docs:
        for i, item in enumerate(items[:25]):
            form, whole = decontaminate.normalised(item.encode()), decontaminate.normalised(text.encode())
            distance = edit_distance_within(form, whole)
            if distance <= decontaminate.budget(len(form)):
                expected[d, i] = distance
    for block_bytes in (1 << 20, 300):
        found = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaks(frame, bench, block_bytes=block_bytes).collect()}
        assert found == expected
    assert len(expected) > 30 and any(expected.values())
    kept = {r.doc_id for r in decontaminate.drop_leaks(frame, bench).collect()}
    assert kept == set(range(160)) - {d for d, _ in expected}


def test_decontamination_of_awkward_rows(spark, awkward, no_docs):
    bench = spark.createDataFrame([(1, "rep eat " * 10), (None, "rep eat " * 9), (2, None)], "item_id long, text string")
    found = decontaminate.leaks(awkward, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in found) == [(11, 1, 0), (12, 1, 0), (12, 1, 0)]
    left = decontaminate.drop_leaks(awkward, bench)
    assert left.schema == awkward.schema and left.count() == awkward.count() - 3
    assert decontaminate.leaks(no_docs, bench).count() == 0 == decontaminate.drop_leaks(no_docs, bench).count()
    assert decontaminate.drop_leaks(awkward, bench.where("false")).count() == awkward.count()


def test_short_items_and_items_without_id(spark):
    items = ["Who wrote Hamlet?", "art", "a", "is 7 * 6", "twelve b", "exactly eight+ bytes and more!!", "(x)", "\u00e9t\u00e9", None, " ", "abababab"]
    texts = ["He asked: who  WROTE\nhamlet? Nobody", "party of one", "modern art, again", "xwho wrote hamlet?", "this is 7 * 6.", "twelve bees", "ends in twelve b", "EXACTLY eight+ bytes and more!!",
             "f(x)y", "l'\u00e9t\u00e9", "\u00e9t\u00e9s", None, "", "ababababab abababab", "it is a", "art", "whole sentence without an id", "a"]
    form = decontaminate.normalised

    def holds(item, text):
        at = text.find(item)
        while at >= 0:
            wordy = lambda c: c.isalnum() or c >= b"\x80"
            before, after = text[at - 1 : at] if at else b"", text[at + len(item) : at + len(item) + 1]
            if not (before and wordy(before) and wordy(item[:1])) and not (after and wordy(after) and wordy(item[-1:])):
                return True
            at = text.find(item, at + 1)
        return False

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) if t and x and x.strip() and holds(form(x.encode()), form(t.encode()))}
    assert {(0, 0), (2, 1), (4, 3), (6, 4), (7, 5), (8, 6), (9, 7), (13, 10), (14, 2)} <= expected and not {(1, 1), (3, 0), (5, 4), (10, 7)} & expected
    for block_bytes in (1 << 20, 12):
        found = decontaminate.leaks(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), block_bytes=block_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in found} == expected and all(r.distance == 0 for r in found)
    unnamed = spark.createDataFrame([(None, "whole sentence without"), (None, "A sentence of some length, without an id.")], "item_id long, text string")
    more = docs.union(spark.createDataFrame([(99, "here: a sentence of some length, without an id.")], "doc_id long, text string"))
    assert decontaminate.leaks(more, unnamed).count() == 0
    assert {r.doc_id for r in decontaminate.drop_leaks(more, unnamed).collect()} == set(range(len(texts))) - {16}


def test_frequent_qgrams_are_held_a_few_at_a_time():
    """Texts and items that repeat few q-grams: the same verdicts however few matches are held, and those of brute force."""
    rng = np.random.default_rng(9)

    def poor(n, letters):
        return "".join(rng.choice(list(letters), n))

    items = [poor(60, "ab"), "ab" * 40, "a" * 90, poor(120, "abcdefgh"), "the same words " * 6, poor(200, "abc")]
    texts = []
    for i in range(24):
        item = items[i % len(items)]
        texts.append(poor(int(rng.integers(0, 300)), "abcdefgh"[: 2 + i % 6]) + edited(rng, item, int(rng.integers(0, 1 + len(item) // 8))) + poor(150, "ab") + ("a" * 200 if i % 5 == 0 else ""))
    texts += ["ab" * 800, "a" * 1500, "the same words " * 70, None, ""]
    forms = [decontaminate.normalised(x.encode()) for x in items]
    whole = decontaminate.prepare(list(range(len(items))), forms, decontaminate.ERRORS)
    expected = {}
    for d, text in enumerate(texts):
        for i, form in enumerate(forms):
            distance = edit_distance_within(form, decontaminate.normalised((text or "").encode()))
            if distance <= decontaminate.budget(len(form)):
                expected[d, i] = distance
    assert len(expected) > 25 and any(expected.values())
    for most in (1 << 20, 5000, 300, 20):
        found = decontaminate.judge([t and t.encode() for t in texts], whole, most)
        assert {(d, i): x[0] for d, got in enumerate(found) for i, x in got.items()} == expected, most


def test_a_text_of_several_megabytes(spark):
    rng = np.random.default_rng(10)
    words = [f"word{i}" for i in range(3000)]
    item = " ".join(rng.choice(words, 30))
    long = " ".join(rng.choice(words, 500_000)) + " " + edited(rng, item, 9) + " " + "same again " * 200_000
    docs = spark.createDataFrame([(1, long), (2, "short"), (3, "x " + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, item), (6, "same again " * 40), (7, "not there at all, whatever one does with it")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaks(docs, bench).collect()}
    form = decontaminate.normalised
    near = edit_distance_within(form(item.encode()), form(long.encode()))
    assert 0 < near <= 9 and found == {(1, 5): near, (1, 6): 0, (3, 5): 0}


def test_whole_query_against_brute_force(spark, tmp_path):
    """All columns of the query, over tables with edited items, two items in one document, and rows without an id."""
    rng = np.random.default_rng(12)
    items = [" ".join("".join(rng.choice(list("abcdefgh "), 90)).split()) for _ in range(8)]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(list("abcdefgh "), 200))
        for item in rng.choice(items, int(rng.integers(0, 3)), replace=False):
            text += " " + edited(rng, str(item), int(rng.integers(0, 12))) + " " + "".join(rng.choice(list("abcdefgh "), 50))
        rows.append((i if i % 20 else None, text))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i * 10, x) for i, x in enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    expected = {}
    for doc_id, text in rows:
        for i, item in enumerate(items):
            distance = edit_distance_within(decontaminate.normalised(item.encode()), decontaminate.normalised(text.encode()))
            if distance <= decontaminate.budget(len(decontaminate.normalised(item.encode()))):
                expected.setdefault(doc_id, {}).setdefault(i * 10, []).append(distance)
    wanted = sorted(((d, ",".join(map(str, sorted(x))), len(x), min(min(y) for y in x.values())) for d, x in expected.items()), key=repr)
    got = queries.QUERIES["op10_decontamination"](spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.item_ids, r.n_items, r.least_distance) for r in got), key=repr) == wanted
    assert len(wanted) > 15


def test_verbatim_items_in_the_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    form = decontaminate.normalised
    expected = {d.doc_id for d in docs if any(form(i.text.encode()) in form((d.text or "").encode()) for i in items)}
    assert {r.doc_id for r in queries.QUERIES["op10_decontamination"](spark, sf).where("least_distance = 0").collect()} == expected
