import json
import math
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from loomrank.operators import bm25, judging, mining, ranking


def passages_of(spark, texts):
    return spark.createDataFrame([(i, 0, f"d{i}", t) for i, t in enumerate(texts)], "doc_pos long, chunk_idx int, doc_id string, text string")


TEXTS = ["red apple red", "green apple", "blue sky blue sky", "apple", "the and of"]


def test_bm25_by_hand(spark):
    index = bm25.Index.over(passages_of(spark, TEXTS))
    queries = spark.createDataFrame([("q1", "red apple"), ("q2", "apple apple"), ("q3", "the of"), ("q4", "nothing")], "query_id string, text string")
    lengths = [3, 2, 4, 1, 0]
    mean = sum(lengths) / 5

    def weight(df, tf, dl):
        return math.log(1 + (5 - df + 0.5) / (df + 0.5)) * tf / (tf + 0.9 * (1 - 0.4 + 0.4 * dl / mean))

    got = {(r.query_id, r.doc_pos): (r.bm25_score, r.bm25_rank) for r in index.top(queries).collect()}
    assert got["q1", 0] == (round(weight(1, 2, 3) + weight(3, 1, 3), 6), 1)
    assert got["q1", 3] == (round(weight(3, 1, 1), 6), 2)
    assert got["q1", 1] == (round(weight(3, 1, 2), 6), 3)
    assert got["q2", 3] == (round(2 * weight(3, 1, 1), 6), 1)
    assert {k[0] for k in got} == {"q1", "q2"}
    assert {(r.query_id, r.doc_id) for r in index.search(queries, 1).collect()} == {("q1", "d0"), ("q2", "d3")}


def test_only_terms_of_queries_are_exchanged(spark, tmp_path):
    """Nothing moves between the scan of the passages and the join with the queries' terms."""
    bm25.tokenized(passages_of(spark, TEXTS * 50)).write.parquet(str(tmp_path / "tokens"))
    index = bm25.Index(spark.read.parquet(str(tmp_path / "tokens")), bm25.DEFAULT)
    queries = spark.createDataFrame([("q1", "red apple"), ("q2", "sky")], "query_id string, text string")
    plan = index.scored(queries)._jdf.queryExecution().executedPlan().toString()
    assert "explode(terms" in plan
    deepest = plan[plan.index("explode(terms") :]
    assert "Exchange" not in deepest[: deepest.index("FileScan")]


def test_counts_of_terms(spark):
    rows = bm25.tokenized(passages_of(spark, ["bb aa bb, bb cc", "the of"])).orderBy("doc_pos").select("dl", "norm2", "chars").collect()
    assert [tuple(r) for r in rows] == [(5, 11, 15), (0, 0, 6)]


def test_a_frequent_term_is_cut(spark, tmp_path):
    """The postings of a term that every passage has lie in several files of a stored index."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = bm25.Index.build(passages_of(spark, [f"common word{i}" for i in range(2000)]), str(tmp_path / "index"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = index.postings.where("term = 'common'").select(F.input_file_name().alias("file")).groupBy("file").count().collect()
    assert len(files) > 2 and sum(r["count"] for r in files) == 2000


def test_broadcasts_are_checked_by_bytes(spark):
    wide = spark.range(100).selectExpr("id", "repeat('x', 10000) as text", "array(1.0D, 2.0D) as v", "array(struct(id, 'abc' as s)) as w")
    few = lambda **most: bm25.checked(wide, **most)[1] is F.broadcast
    assert few() and not few(most=99) and not few(most_bytes=900_000) and few(most_bytes=1_100_000)
    assert bm25.checked(wide.where("id < 0"), most_bytes=0)[1] is F.broadcast


def test_stemmer(spark):
    class Cut:
        name = "cut"

        def load(self):
            return lambda w: w[:4]

    index = bm25.Index.over(passages_of(spark, ["running runners", "walk"]), bm25.Bm25(stemmer=Cut()))
    rows = index.top(spark.createDataFrame([("q", "runnable")], "query_id string, text string")).collect()
    assert [r.doc_pos for r in rows] == [0]
    assert ranking.default_device() == "cpu"
    vectors = spark.createDataFrame([([1.0, 2.0],), (None,)], "embedding array<float>")
    assert tuple(ranking.embedding_stats(vectors).first()) == (1, 8)


def test_equal_scores_go_by_corpus_order(spark):
    index = bm25.Index.over(passages_of(spark, ["cat dog", "dog cat", "cat fox"]))
    rows = index.top(spark.createDataFrame([("q", "cat")], "query_id string, text string")).orderBy("bm25_rank").collect()
    assert [r.doc_pos for r in rows] == [0, 1, 2]


def test_index_is_rebuilt_when_its_input_changes(spark, tmp_path):
    path = str(tmp_path / "index")
    queries = spark.createDataFrame([("q", "apple")], "query_id string, text string")
    first = bm25.Index.build(passages_of(spark, TEXTS), path)
    assert first.top(queries).count() == 3
    again = bm25.Index.open(passages_of(spark, TEXTS), path)
    assert again.top(queries).count() == 3
    grown = bm25.Index.open(passages_of(spark, [*TEXTS, "apple pie"]), path)
    found = grown.top(queries).collect()
    assert len(found) == 4
    other = bm25.Index.open(passages_of(spark, [*TEXTS, "apple pie"]), path, bm25.Bm25(k1=2.0))
    assert other.top(queries).collect() != found


@pytest.mark.parametrize("n,expected", [(0, 0), (9, 9), (10, 10), (11, 11), (30, 20), (31, 21), (40, 25), (60, 25)])
def test_bands(spark, n, expected):
    rows = spark.createDataFrame([("q", f"d{i}", i) for i in range(1, n + 1)], "query_id string, doc_id string, ce_rank int")
    got = ranking.banded_sample(rows).orderBy("cand_pos").collect()
    assert len(got) == expected and [r.cand_pos for r in got] == list(range(1, expected + 1))
    assert [r.ce_rank for r in got[:10]] == list(range(1, min(n, 10) + 1))
    assert len({r.doc_id for r in got}) == expected
    assert [r.doc_id for r in ranking.banded_sample(rows.repartition(3)).orderBy("cand_pos").collect()] == [r.doc_id for r in got]
    if n == 40:
        other = [r.doc_id for r in ranking.banded_sample(rows, seed="x").orderBy("cand_pos").collect()]
        assert other != [r.doc_id for r in got]


def test_models_plug_in(spark):
    class Lengths:
        def load(self):
            return lambda texts: [[float(len(t)), 1.0] for t in texts]

    class Overlap:
        def load(self):
            return lambda queries, texts: [float(len(set(q.split()) & set(t.split()))) for q, t in zip(queries, texts, strict=True)]

    texts = spark.createDataFrame([("a", "xx"), ("b", None)], "id string, text string")
    assert {r.id: r.embedding for r in ranking.embedded(texts, Lengths()).collect()} == {"a": [2.0, 1.0], "b": [0.0, 1.0]}
    queries = spark.createDataFrame([("1", "xx"), ("2", "xx")], "query_id string, text string")
    assert ranking.embedded_queries(queries, Lengths()).count() == 2
    pairs = spark.createDataFrame([("a b", "b c"), ("a", None)], "query string, text string")
    assert sorted(r.ce_score for r in ranking.pair_scored(pairs, Overlap()).collect()) == [0.0, 1.0]


def test_cascade_with_models(spark):
    from loomrank.plans import cascade

    class Lengths:
        def load(self):
            return lambda texts: [[1.0 / len(t), 1.0] for t in texts]

    class Ends:
        def load(self):
            return lambda queries, texts: [float(t[-1]) for t in texts]

    index = bm25.Index.over(passages_of(spark, [f"apple number {i}" + " pie" * (i % 3) + f" {i}" for i in range(8)]))
    queries = spark.createDataFrame([("q", "apple")], "query_id string, text string")
    got = cascade.candidates(index, queries, cascade.Cascade(embedder=Lengths(), scorer=Ends())).orderBy("ce_rank").collect()
    assert [r.ce_score for r in got] == [7.0, 6.0, 5.0, 4.0, 3.0, 2.0, 1.0, 0.0]
    assert sorted(r.dense_rank for r in got) == list(range(1, 9)) and got[0].text.endswith("7")


def test_vector_ties_prefer_short_texts_then_rank(spark):
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<float>")
    rows = [("q", "a", [1.0, 0.0], 9, 1), ("q", "b", [1.0, 0.0], 5, 3), ("q", "c", [1.0, 0.0], 5, 2), ("q", "d", [0.0, 1.0], 1, 4)]
    given = spark.createDataFrame(rows, "query_id string, doc_id string, embedding array<float>, length int, bm25_rank int")
    assert [r.doc_id for r in ranking.vector_top(queries, given, 3).orderBy("dense_rank").collect()] == ["c", "b", "a"]


PAIRS = "query_id string, query string, doc_id string, text string, cand_pos int, ce_score double"
LONG = " ".join(f"w{i}" for i in range(40))


def pairs_of(spark):
    late = " ".join(f"w{i}" for i in range(100)) + " target"
    rows = [
        ("q", "W5 here", "ok", LONG, 1, 0.9), ("q", "w5", "short", " ".join(f"w{i}" for i in range(29)), 2, 0.9), ("q", "zzz", "apart", LONG, 3, 0.9),
        ("q", "target", "late", late, 4, 0.9), ("q", "", "empty", LONG, 5, 0.9), ("q", "w99", "edge", late, 6, 0.1),
    ]
    return spark.createDataFrame(rows, PAIRS)


def test_prefilter(spark):
    got = {r.doc_id: r.reject for r in judging.with_reject(pairs_of(spark)).collect()}
    assert got == {"ok": False, "short": True, "apart": True, "late": True, "empty": True, "edge": False}


def test_judge_and_prefilter_rows(spark):
    got = {r.doc_id: (r.relevance_score, r.answerable, r.confidence, r.source) for r in judging.judged_by(pairs_of(spark), judging.CoverageJudge()).collect()}
    assert got["ok"] == (3, True, 1.0, "judge") and got["edge"] == (0, False, 0.0, "judge")
    assert got["short"] == got["apart"] == got["late"] == got["empty"] == (0, False, 0.0, "prefilter")
    free = judging.judged_by(pairs_of(spark), judging.CoverageJudge(), use_prefilter=False)
    assert free.where("source = 'judge'").count() == 6


def test_cache_wins_and_the_newest_counts(spark):
    judge = judging.CoverageJudge()
    rows = judging.judged(pairs_of(spark), None, judge)
    old = judging.cache_rows(rows, judge.judge_id, 1)
    newer = old.where("doc_id = 'ok'").withColumn("relevance_score", F.lit(1)).withColumn("batch_id", F.lit(2).cast("long"))
    foreign = old.withColumn("judge_id", F.lit("other")).withColumn("relevance_score", F.lit(2))
    again = judging.judged(pairs_of(spark), old.union(newer).union(foreign).where("doc_id <> 'edge'"), judge).collect()
    got = {r.doc_id: (r.relevance_score, r.source) for r in again}
    assert got["ok"] == (1, "cache") and got["edge"] == (0, "judge") and got["short"] == (0, "cache") and len(again) == 6
    assert judging.cache_stats(old).first() == (6, 6)


@pytest.mark.parametrize("body,yes", [("YES", True), (" yes.", True), ("No", False), ("YES and NO", True)])
def test_verdicts(spark, body, yes):
    reply = json.dumps({"choices": [{"message": {"content": body}}]})
    rows = spark.createDataFrame([(reply,), ("{broken",), ('{"choices": []}',), (None,)], "b string")
    assert [r[0] for r in rows.select(judging.is_yes(judging.response_text(F.col("b")))).collect()] == [yes, False, False, False]


class Server(BaseHTTPRequestHandler):
    seen: list = []

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Server.seen.append(body)
        asked = body["messages"][0]["content"]
        if "w5 fails" in asked:
            self.send_response(500)
            self.end_headers()
            return
        reply = json.dumps({"choices": [{"message": {"content": "YES" if "w5" in asked.split("\n")[0] else "no"}}]}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(reply)

    def log_message(self, *_):
        pass


def test_chat_judge(spark):
    server = ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    judge = judging.ChatJudge(f"http://127.0.0.1:{server.server_port}/v1/chat/completions", "stub", concurrency=3)
    rows = [(f"q{i}", q, f"d{i}", LONG, i, 0.0) for i, q in enumerate(["w5 a", "w6 b", "w5 fails", "w7"])]
    got = {r.doc_id: r for r in judging.judged_by(spark.createDataFrame(rows, PAIRS), judge).collect()}
    server.shutdown()
    assert [got[f"d{i}"].relevance_score for i in range(4)] == [3, 0, 0, 0]
    assert "500" in got["d2"].error and got["d0"].error is None
    assert len(Server.seen) == 4
    assert Server.seen[0]["temperature"] == 0.0 and Server.seen[0]["max_tokens"] == 3 and Server.seen[0]["stop"] == ["\n", "."] and "model" not in Server.seen[0]
    kept = judging.cache_rows(spark.createDataFrame([tuple(r) for r in got.values()], PAIRS + ", relevance_score int, answerable boolean, confidence double, error string, source string"), "stub", 0)
    assert kept.count() == 3


JUDGED = "query_id string, query string, doc_id string, cand_pos int, relevance_score int, answerable boolean, bm25_rank int, dense_rank int"


def test_mining(spark):
    rows = [("q", "text", "p2", 2, 3, True, 1, 1), ("q", "text", "p1", 1, 2, True, 1, 1), ("q", "text", "weak", 3, 3, False, 1, 30), ("q", "text", "one", 4, 1, False, 1, 1), ("q", "text", "both", 5, 0, False, 20, 20),
            ("q", "text", "dense", 6, 0, False, None, 20), ("q", "text", "none", 7, 0, False, 21, None), ("q", "text", "nulls", 8, None, None, 3, None)]
    rows += [("r", "other", f"n{i:02}", i, 0, False, 1, 99) for i in range(15)]
    judged = spark.createDataFrame(rows, JUDGED)
    triple = mining.triples(judged).collect()
    assert len(triple) == 1
    assert (triple[0].positive_doc_ids, triple[0].positive_scores, triple[0].hard_negative_doc_ids) == (["p1", "p2"], [2, 3], ["weak", "one", "dense", "nulls"])
    negatives = mining.hard_negatives(judged).where("query_id = 'r'").orderBy("neg_pos").collect()
    assert [r.doc_id for r in negatives] == [f"n{i:02}" for i in range(10)]
    assert {(r.doc_id, r.relevance_score) for r in mining.qrels(judged).collect()} == {("p1", 2), ("p2", 3)}


def test_top_keeps_few_rows_in_a_task(spark, tmp_path, monkeypatch):
    """Hits are ranked inside the scan: no more than k rows of a query leave a task, and they are the best of all hits."""
    from loomrank.operators import best

    texts = [" ".join(f"t{(i * j) % 7}" for j in range(1, 2 + i % 9)) for i in range(600)] + ["t1"] * 50 + ["none", ""]
    bm25.with_terms(passages_of(spark, texts)).repartition(3).write.parquet(str(tmp_path / "tokens"))
    tokens = spark.read.parquet(str(tmp_path / "tokens"))
    queries = spark.createDataFrame([(f"q{i}", " ".join(f"t{j}" for j in range(i))) for i in range(9)], "query_id string, text string")
    monkeypatch.setattr(best, "CELLS", 64)
    monkeypatch.setattr(best, "QUERY_BLOCK", 5)
    fields = ["query_id", "doc_pos", "chunk_idx", "bm25_score", "matched"]
    every = sorted((tuple(r) for r in bm25.Index(tokens, bm25.DEFAULT).scored(queries).select(*fields).collect()), key=lambda r: (r[0], -r[3], r[1], r[2]))
    expected = [r for q in range(9) for r in [x for x in every if x[0] == f"q{q}"][:20]]
    index = bm25.Index(tokens, bm25.DEFAULT)
    got = index.top(queries, 20)
    assert sorted((tuple(r) for r in got.select(*fields).collect()), key=lambda r: (r[0], -r[3], r[1], r[2])) == expected
    asked = index.asked(queries)
    kept = bm25.best_of(tokens, asked, index.idfs(asked.terms), 4.0, bm25.DEFAULT, 20, queries.schema["query_id"])
    assert kept.count() <= tokens.rdd.getNumPartitions() * 20 * 9 < len(every)
    monkeypatch.setattr(bm25, "MOST_BROADCAST_ROWS", 1)
    many = bm25.Index(tokens, bm25.DEFAULT)
    monkeypatch.setattr(bm25, "checked", lambda df, *most: (df, lambda other: other))
    assert many.asked(queries) is None
    assert sorted((tuple(r) for r in many.top(queries, 20).select(*fields).collect()), key=lambda r: (r[0], -r[3], r[1], r[2])) == expected


def test_hits_are_the_broadcast_side(spark, tmp_path):
    """The passages' texts do not move: bounded hits are sent to them."""
    from loomrank.plans import cascade

    index = bm25.Index.build(passages_of(spark, TEXTS * 50), str(tmp_path / "index"))
    queries = spark.createDataFrame([("q1", "red apple"), ("q2", "sky")], "query_id string, text string")
    plan = cascade.candidates(index, queries, cascade.Cascade())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "HashedRelationBroadcastMode" in plan
    assert not cascade.candidates(index, queries.where("query_id = 'q3'"), cascade.Cascade()).collect()


def test_vector_search_ranks_inside_the_scan(spark, monkeypatch):
    """As many rows as k a query and task leave the scan, and they are what ranking all pairs gives: ties, nulls, vectors of
    another width, NaN and repeated ids included."""
    from loomrank.operators import best

    vectors = [[float(i * j % 5), float(j), 1.0] for j in range(4) for i in range(60)]
    vectors = [*vectors, None, [1.0], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [-1e-7, 0.0, 0.0]]
    rows = spark.createDataFrame([(f"e{i % 200}", v, i % 3, i) for i, v in enumerate(vectors)], "doc_id string, embedding array<float>, length int, bm25_rank int").repartition(3, "bm25_rank").cache()
    asked = spark.createDataFrame([(f"q{i}", [1.0, -0.5, float(i)], f"e{i}") for i in range(7)] + [("n", None, None), ("w", [2.0], "e41")], "query_id string, embedding array<float>, skip string")
    monkeypatch.setattr(best, "CELLS", 32)
    monkeypatch.setattr(best, "QUERY_BLOCK", 4)
    fields = ["query_id", "doc_id", "sim", "dense_rank", "bm25_rank"]
    given = rows.join(asked.select("query_id", "skip"), ~F.col("doc_id").eqNullSafe(F.col("skip"))).drop("skip")
    expected = sorted((tuple(r) for r in ranking.vector_top(asked, given, 9).select(*fields).collect()), key=repr)
    found = ranking.vector_search(asked, rows, 9)
    assert repr(sorted((tuple(r) for r in found.select(*fields).collect()), key=repr)) == repr(expected) and len(expected) == 81
    assert "NestedLoopJoin" not in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(bm25, "checked", lambda df, *most: (df, lambda other: other))
    assert repr(sorted((tuple(r) for r in ranking.vector_search(asked, rows, 9).select(*fields).collect()), key=repr)) == repr(expected)
    monkeypatch.undo()
    assert ranking.vector_search(asked.where("query_id = 'x'"), rows, 9).count() == 0
