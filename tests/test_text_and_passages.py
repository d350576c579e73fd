from pyspark.sql import functions as F

from loomrank.functions import text as tx
from loomrank.functions import vector
from loomrank.operators import passages


def values(spark, column, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def test_white_space_is_pythons(spark):
    texts = ["a b", "\x1ca \x85 b\x1f", "", "  ", "x y　z", "one"]
    assert values(spark, tx.words(F.col("t")), *texts) == [t.split() for t in texts]
    assert values(spark, tx.strip(F.col("t")), *texts) == [t.strip() for t in texts]
    assert values(spark, tx.word_count(F.col("t")), *texts) == [len(t.split()) for t in texts]


def test_truncation_keeps_short_texts(spark):
    assert values(spark, tx.truncate_words(F.col("t"), 3), "a  b\nc", "a  b\nc d") == ["a  b\nc", "a b c"]


def test_alpha_ratio_and_boilerplate(spark):
    assert values(spark, tx.alpha_ratio(F.col("t")), "ab12", "é ñ", "", "....") == [0.5, 1.0, 0.0, 0.0]
    assert values(spark, tx.has_boilerplate(F.col("t")), "Click HERE now", "Copyright © x", "copyright x", "PRIVACY policy") == [True, True, False, True]


def test_ids_and_hashes(spark):
    assert [r[0] for r in spark.createDataFrame([(7,), (1234567,)], "n long").select(tx.query_id(F.col("n"))).collect()] == ["q000007", "q1234567"]
    assert values(spark, tx.query_hash(F.col("t")), "abc") == ["900150983cd24fb0"]
    assert values(spark, tx.dedup_key(F.col("t")), "\U0001f600" * 200 + "a") == values(spark, tx.dedup_key(F.col("t")), "\U0001f600" * 200 + "b")


def test_sanitized_cuts_first(spark):
    assert values(spark, tx.sanitized(F.col("t"), 6), "a\r\nb\0\rc") == ["a\nb\n"]


def test_truthy(spark):
    rows = spark.createDataFrame([("", 0, "x"), ("0", 5, None), (None, 5, "y"), (None, None, None)], "a string, b int, c string")
    assert [r[0] for r in rows.select(tx.first_truthy((F.col("a"), "string"), (F.col("b"), "int"), (F.col("c"), "string"))).collect()] == ["x", "0", "5", None]


def test_terms(spark):
    assert values(spark, tx.terms(F.col("t")), "The Cat, a x2 über_cat CAT!") == [["cat", "x2", "über_cat", "cat"]]


def test_duration(spark):
    assert [r[0] for r in spark.createDataFrame([(0.0,), (3661.5,), (90000.0,)], "s double").select(tx.duration(F.col("s"))).collect()] == ["0h 0m", "1h 1m", "25h 0m"]


def test_vectors(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    got = row.select(vector.normalized(F.col("a")), vector.normalized(F.col("z")), vector.dot(F.col("a"), F.col("a"))).first()
    assert list(got) == [[0.6000000000000001, 0.8], [0.0, 0.0], 25.0] or [round(x, 9) for x in got[0]] == [0.6, 0.8]


def plain_chunks(text, size=160, stride=80, least=20):
    words = text.split()
    out, start = [], 0
    while start < len(words):
        piece = words[start : start + size]
        if len(piece) >= least:
            out.append(" ".join(piece))
        start += stride
    return out


def docs_of(spark, texts):
    return spark.createDataFrame([(i, f"d{i}", t) for i, t in enumerate(texts)], "doc_pos long, doc_id string, text string")


def test_chunks_at_the_edges(spark):
    texts = [" ".join(f"w{j}" for j in range(n)) for n in (0, 19, 20, 99, 100, 159, 160, 161, 179, 180, 500)] + [None]
    got = {}
    for r in passages.chunked(docs_of(spark, texts)).orderBy("doc_pos", "chunk_idx").collect():
        assert r.doc_id == f"{r.source_doc_id}_chunk_{r.chunk_idx}"
        got.setdefault(r.doc_pos, []).append(r.text)
    assert got == {i: plain_chunks(t) for i, t in enumerate(texts) if t and plain_chunks(t)}


def test_length_filter_uses_stripped_characters(spark):
    texts = ["x" * 49, "x" * 50, " " * 30 + "x" * 49, " " + "x" * 50, None, ""]
    assert [r.doc_pos for r in passages.long_enough(docs_of(spark, texts)).orderBy("doc_pos").collect()] == [1, 3]


def test_quality_comes_before_dedup(spark):
    same = "clean words here " * 15
    rows = [(0, 0, "a", same + "x" * 10, "s"), (0, 1, "b", same + "y" * 10, "s"), (1, 0, "c", "privacy policy " + same, "s"), (2, 0, "d", same.upper(), "s"), (3, 0, "e", "1 2 " * 20, "s"), (4, 0, "f", "short", "s")]
    frame = spark.createDataFrame(rows, "doc_pos long, chunk_idx int, doc_id string, text string, source_doc_id string")
    kept = passages.first_copies(passages.good(frame))
    assert sorted(r.doc_id for r in kept.collect()) == ["a", "d", "e"]
    reasons = {r.doc_id: r.why for r in frame.select("doc_id", passages.reject_reason(F.col("text")).alias("why")).collect()}
    assert reasons == {"a": None, "b": None, "c": "boilerplate", "d": None, "e": None, "f": "short"}


def test_empty_corpus(spark):
    assert passages.passages_of(docs_of(spark, []).where("false") if False else docs_of(spark, [None])).count() == 0
    assert passages.removal_counts(docs_of(spark, ["a privacy policy " * 10])).collect()[0].n == 1


def test_windows_do_not_slice_all_words(spark):
    """Windows of any size and stride are the words they cover; those of few blocks are not cut out of the whole array."""
    words = [f"w{i}" if i % 3 else "é😀" for i in range(95)]
    for size, stride in ((160, 80), (10, 5), (6, 4), (4, 4), (17, 3), (3, 5), (20, 1)):
        rule = passages.Chunking(size=size, stride=stride, least_words=2)
        made = passages.chunked(docs_of(spark, [" \t" + "  ".join(words[:n]) + "\n" for n in (1, 2, 10, 95)]), rule)
        expected = [(d, k, " ".join(words[:n][k * stride : k * stride + size])) for d, n in enumerate((1, 2, 10, 95)) for k in range((n - 2) // stride + 1 if n > 1 else 0)]
        assert [tuple(r) for r in made.select("doc_pos", "chunk_idx", "text").orderBy("doc_pos", "chunk_idx").collect()] == expected
    plan = passages.chunked(docs_of(spark, ["a"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" not in plan


def test_length_of_stripped_texts(spark):
    cases = [" " * 500 + "x" * 50, " " * 500 + "x" * 49 + " " * 500, "x" + " " * 300 + "y", "x" * 49, "x" * 50, ""]
    assert values(spark, tx.stripped_at_least(F.col("t"), 50), *cases) == [True, False, True, False, True, False]
