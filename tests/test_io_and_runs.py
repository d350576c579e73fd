import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomrank import schemas, session
from loomrank.operators import bm25, judging, passages
from loomrank.plans import cascade, config, prepare
from loomrank.sources import readers, sinks
from loomrank.streaming import incremental


def write(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_tolerant_and_strict_lines(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"doc_id":"1","text":"x"}\n\n{bad\n{"doc_id":"2","text":"y"}\n')
    assert {r.doc_id for r in readers.jsonl(spark, path, schemas.CORPUS).collect()} == {"1", "2"}
    assert readers.jsonl(spark, str(tmp_path / "none"), schemas.CORPUS).count() == 0
    assert readers.count_lines(spark, path) == 3 and readers.count_lines(spark, str(tmp_path / "none")) == 0
    with pytest.raises(Exception):
        readers.jsonl_strict(spark, path, schemas.CORPUS).collect()
    with pytest.raises(FileNotFoundError):
        readers.jsonl_strict(spark, str(tmp_path / "none"), schemas.CORPUS)


def test_qrels_lines(spark, tmp_path):
    path = write(tmp_path / "q.tsv", "q1\t0\td1\t3\n\nq2\t0\td2\nq3\t0\td3\t1\ttrain\n q4\t0\td4\t2\t\n")
    assert {tuple(r) for r in readers.qrels(spark, path).collect()} == {("q1", "d1", 3), ("q4", "d4", 2)}
    with pytest.raises(Exception):
        readers.qrels(spark, write(tmp_path / "b.tsv", "q\t0\td\tx\n")).collect()
    five = write(tmp_path / "f.tsv", "q1\t0\td1\t3\ttrain\n\n")
    assert [tuple(r) for r in readers.qrels_with_split(spark, five).collect()] == [("q1", 0, "d1", 3, "train")]
    with pytest.raises(Exception):
        readers.qrels_with_split(spark, five, skip_blank=False).collect()
    with pytest.raises(Exception):
        readers.qrels_with_split(spark, path).collect()


def test_wiki_job(spark, tmp_path):
    write(tmp_path / "raw/Topic A/pages/one.txt", "  first\npage  ")
    write(tmp_path / "raw/B/pages/two.txt", "second")
    write(tmp_path / "raw/B/notes/no.txt", "left out")
    queries = write(tmp_path / "q.jsonl", '{"query":"a","topic":"t","source_doc":"s"}\n\n{"query":"b","topic":"","source_doc":null}\n')
    out = str(tmp_path / "out")
    assert prepare.wiki(spark, str(tmp_path / "raw"), queries, out)
    assert not prepare.wiki(spark, str(tmp_path / "raw"), queries, out)
    assert {(r.doc_id, r.text) for r in readers.jsonl_strict(spark, f"{out}/corpus.jsonl", schemas.CORPUS).collect()} == {("Topic A__one", "first\npage"), ("B__two", "second")}
    got = readers.jsonl_strict(spark, f"{out}/queries.jsonl", schemas.QUERIES_WITH_TOPIC).orderBy("query_id").collect()
    assert [tuple(r) for r in got] == [("q000000", "a", "t", "s"), ("q000002", "b", None, None)]
    lines = [json.loads(x) for f in Path(out, "queries.jsonl").glob("part-*") for x in f.read_text().splitlines()]
    assert {"query_id": "q000002", "text": "b"} in lines


def test_split_job(spark, tmp_path):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    corpus = frame([("d1", "x")], schemas.CORPUS)
    train = frame([("q1", "a")], schemas.QUERIES), frame([("q1", "d1", 1)], "query_id string, doc_id string, relevance int")
    dev = frame([("q2", "b")], schemas.QUERIES), frame([("q2", "d1", 0)], "query_id string, doc_id string, relevance int")
    out = str(tmp_path / "ms")
    assert prepare.with_splits(corpus, train, dev, out) and not prepare.with_splits(corpus, train, dev, out)
    assert prepare.build_tables(spark, out, str(tmp_path / "tables")) == {"corpus": 1, "queries": 2, "qrels": 2}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "tables/qrels")).collect()} == {("q1", 0, "d1", 1, "train"), ("q2", 0, "d1", 0, "dev")}


def test_normalized_queries(spark):
    raw = spark.createDataFrame([("", 0, "z", "t"), (None, 7, None, "u"), ("0", 1, None, None), (None, 0, None, "v"), ("k", None, None, "")], "query_id string, id long, _id string, text string")
    assert {tuple(r) for r in readers.normalized_queries(raw).collect()} == {("z", "t"), ("7", "u")}


def test_sinks(spark, tmp_path):
    qrels = spark.createDataFrame([("q", 0, "d", 3), ("q", 0, "e", None)], schemas.QRELS)
    path = str(tmp_path / "qrels")
    sinks.write_qrels(qrels, path)
    sinks.write_qrels(qrels, path)
    assert readers.qrels(spark, path).count() == 4 and readers.qrels(spark, path).where("relevance_score = 3").count() == 4
    triples = spark.createDataFrame([("q", "text é", ["d"], [3], []), ("r", "none", [], [], ["x"])], schemas.TRIPLES)
    tpath = str(tmp_path / "triples")
    sinks.write_triples(triples, tpath)
    assert [r.query_id for r in readers.triples(spark, tpath).collect()] == ["q"]
    sinks.write_lucene(spark.createDataFrame([("1", "x")], schemas.CORPUS), str(tmp_path / "lucene"))
    assert tuple(spark.read.schema(schemas.LUCENE).json(str(tmp_path / "lucene")).first()) == ("1", "x")

    calls = []

    class Box:
        def publish(self, *a):
            calls.append(a)

    counts = sinks.export_labels(spark, path, tpath, str(tmp_path / "export"), Box(), token="t")
    assert counts == {"qrels": 4, "triples": 1} and [c[0] for c in calls] == ["labels-qrels", "labels-triples"]
    with pytest.raises(FileNotFoundError):
        sinks.export_labels(spark, path, str(tmp_path / "no"), str(tmp_path / "export"))


GOOD = """
dataset: {corpus: {name: c, split: train}, queries: {name: q, split: train}}
paths: {a: %s}
corpus: {passage_tokens: 40, passage_stride: 20}
bm25: {k1: 0.9, b: 0.4}
dense: {}
llm: {}
agent: {global_top_k_bm25: 50, max_queries: 5}
output: {}
"""


def test_config(tmp_path):
    path = write(tmp_path / "c.yaml", GOOD % (tmp_path / "made/here"))
    got = config.load(path)
    assert got.get("bm25.k1") == 0.9 and got.get("bm25.k1.x", 7) == 7 and got.get("no.way") is None
    got.make_folders()
    assert (tmp_path / "made/here").is_dir()
    with pytest.raises(FileNotFoundError):
        config.load(str(tmp_path / "none.yaml"))
    with pytest.raises(ValueError):
        config.load(write(tmp_path / "d.yaml", (GOOD % "x").replace("llm: {}", "")))
    with pytest.raises(ValueError):
        config.load(write(tmp_path / "e.yaml", (GOOD % "x").replace("name: q, ", "")))


@pytest.fixture(scope="module")
def small_world(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("doc_pos"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    queries = spark.read.parquet(f"{sf}/benchmark.parquet").selectExpr("concat('q', item_id) as query_id", "text").where("query_id like 'q1%'")
    return docs, queries


def test_run_resumes_and_repeats_nothing(spark, small_world, tmp_path):
    docs, queries = small_world
    index = bm25.Index.build(passages.passages_of(docs), str(tmp_path / "index"))
    run = incremental.Run(spark, str(tmp_path / "run"), index, cascade.Cascade())
    nothing = spark.createDataFrame([("qx", "zzzzqqq")], schemas.QUERIES)
    run.batch(queries.limit(4).union(nothing))
    assert run.processed().count() == 5 and run.processed().where("query_id = 'qx'").count() == 1
    before = run.qrels().count(), run.triples().count()
    run.batch(queries.limit(4))
    assert (run.qrels().count(), run.triples().count()) == before
    run.run(queries, 2)
    assert run.remaining(queries).count() == 0
    whole = cascade.judged(index, queries, cascade.Cascade())
    expected = {(r.query_id, r.doc_id) for r in cascade.labels(whole, cascade.Cascade())[0].collect()}
    assert {(r.query_id, r.doc_id) for r in run.qrels().collect()} == expected
    stats = run.report(queries).first()
    assert stats.queries_processed == queries.count() and stats.positives_found == len(expected)
    assert run.cache().count() > 0
    # a batch that was cut off before its end does not count
    number = run.next_batch()
    run._put("qrels", spark.createDataFrame([("lost", 0, "d", 3)], schemas.QRELS), number)
    assert run.next_batch() == number + 1
    assert run.qrels().where("query_id = 'lost'").count() == 0
    run.clear_cache()
    assert run.cache().count() == 0 and run.processed().count() > 0


class Failing(judging.CoverageJudge):
    def answers(self, pairs):
        return super().answers(pairs).withColumn("error", F.when(F.col("query_id") == "q10", "no answer"))


def test_failed_queries_are_asked_again(spark, small_world, tmp_path):
    docs, queries = small_world
    index = bm25.Index.over(passages.passages_of(docs))
    run = incremental.Run(spark, str(tmp_path / "run"), index, cascade.Cascade(judge=Failing()))
    run.batch(queries.where("query_id in ('q10', 'q11')"))
    assert {r.query_id for r in run.processed().collect()} == {"q11"}
    again = incremental.Run(spark, str(tmp_path / "run"), index, cascade.Cascade())
    again.batch(queries.where("query_id in ('q10', 'q11')"))
    assert {r.query_id for r in again.processed().collect()} == {"q10", "q11"}


class Refusing(judging.CoverageJudge):
    """Says nothing but errors: whatever comes back was answered before."""

    def answers(self, pairs):
        return super().answers(pairs).withColumn("answer", F.lit(None).cast("string")).withColumn("error", F.lit("no answer"))


def test_answers_of_a_cut_off_batch_are_used(spark, small_world, tmp_path):
    docs, queries = small_world
    queries = queries.where("query_id in ('q10', 'q11')")
    index = bm25.Index.over(passages.passages_of(docs))
    run = incremental.Run(spark, str(tmp_path / "run"), index, cascade.Cascade())

    def cut(name, rows, batch, put=run._put):
        put(name, rows, batch)
        raise RuntimeError("lost")

    run._put = cut
    with pytest.raises(RuntimeError):
        run.batch(queries)
    again = incremental.Run(spark, str(tmp_path / "run"), index, cascade.Cascade(judge=Refusing()))
    assert again.processed().count() == 0 and again.paid().count() > 0
    assert again.batch(queries) == 1
    assert again.processed().count() == 2
    expected = {(r.query_id, r.doc_id) for r in cascade.labels(cascade.judged(index, queries, cascade.Cascade()), cascade.Cascade())[0].collect()}
    assert {(r.query_id, r.doc_id) for r in again.qrels().collect()} == expected
    again.clear_cache()
    assert again.cache().count() == 0


def test_stream_of_query_files(spark, small_world, tmp_path):
    docs, queries = small_world
    index = bm25.Index.over(passages.passages_of(docs))
    run = incremental.Run(spark, str(tmp_path / "run"), index, cascade.Cascade())
    sinks.write_jsonl(queries.where("query_id in ('q10', 'q11')"), str(tmp_path / "in"))
    run.follow(str(tmp_path / "in"), str(tmp_path / "check")).awaitTermination(300)
    assert {r.query_id for r in run.processed().collect()} == {"q10", "q11"}
    sinks.write_jsonl(queries.where("query_id in ('q11', 'q12')"), str(tmp_path / "in"))
    run.follow(str(tmp_path / "in"), str(tmp_path / "check")).awaitTermination(300)
    assert {r.query_id for r in run.processed().collect()} == {"q10", "q11", "q12"}


def test_label_job(spark, small_world, tmp_path):
    docs, queries = small_world
    got = config.load(write(tmp_path / "c.yaml", GOOD % tmp_path))
    run = prepare.label(spark, got, docs, queries.withColumnRenamed("query_id", "id"), str(tmp_path / "job"))
    assert run.processed().count() == 5
    assert readers.qrels(spark, str(tmp_path / "job/qrels.tsv")).count() == run.qrels().count()


def test_command_line(spark, small_world, tmp_path, monkeypatch):
    from loomrank.__main__ import main, numbered

    monkeypatch.chdir(tmp_path)  # for the log; Spark keeps the folder it was started in
    docs, queries = small_world
    at = {n: str(tmp_path / n) for n in ("corpus", "queries", "out", "export")}
    docs.select(F.col("doc_pos").alias("doc_id"), "text").limit(50).write.parquet(at["corpus"])
    queries.limit(2).write.parquet(at["queries"])
    settings = write(tmp_path / "c.yaml", GOOD % tmp_path)
    main(["label", "--config", settings, "--corpus", at["corpus"], "--queries", at["queries"], "--out", at["out"]])
    assert readers.exists(spark, at["out"] + "/qrels.tsv") and "queries processed: 2" in (tmp_path / "logs/agent.log").read_text()
    main(["export", "--qrels", at["out"] + "/qrels.tsv", "--triples", at["out"] + "/triples.jsonl", "--out", at["export"]])
    assert readers.exists(spark, at["export"] + "/labels-qrels/data")
    monkeypatch.setenv("HF_TOKEN", "t")
    main(["export", "--qrels", at["out"] + "/qrels.tsv", "--triples", at["out"] + "/triples.jsonl", "--out", at["export"], "--publish-to", str(tmp_path / "box"), "--private"])
    assert spark.read.parquet(str(tmp_path / "box/labels-qrels/data")).count() == spark.read.parquet(at["export"] + "/labels-qrels/data").count()
    assert json.loads(spark.read.text(str(tmp_path / "box/labels-qrels/card")).first()[0]) == {"name": "labels-qrels", "private": True}
    lines = {"c.jsonl": '{"doc_id":"d","text":"x"}', "tq.jsonl": '{"query_id":"q","text":"a"}', "tr.tsv": "q\t0\td\t1", "dq.jsonl": '{"query_id":"p","text":"b"}', "dr.tsv": "p\t0\td\t0"}
    made = {n: write(tmp_path / "in" / n, text + "\n") for n, text in lines.items()}
    main(["splits", "--corpus", made["c.jsonl"], "--train-queries", made["tq.jsonl"], "--train-qrels", made["tr.tsv"], "--dev-queries", made["dq.jsonl"], "--dev-qrels", made["dr.tsv"], "--out", str(tmp_path / "ms")])
    main(["tables", "--folder", str(tmp_path / "ms"), "--out", str(tmp_path / "ms-tables"), "--publish-to", str(tmp_path / "box"), "--repo-id", "ms"])
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "box/ms/qrels")).collect()} == {("q", 0, "d", 1, "train"), ("p", 0, "d", 0, "dev")}
    named = spark.createDataFrame([("x", "a"), ("y", "b")], schemas.CORPUS)
    assert [tuple(r) for r in numbered(named).orderBy("doc_pos").collect()] == [(0, "x", "a"), (1, "y", "b")]


def test_files(tmp_path):
    from loomrank.functions import files

    path = write(tmp_path / "a/b.txt", "x" * (1 << 20))
    assert files.file_exists(path) and files.file_size_mb(path) == 1.0 and files.file_size_mb(path + "no") == 0.0
    assert not files.file_exists(write(tmp_path / "empty", "")) and files.ensure_dir(str(tmp_path / "c/d")).is_dir()


def test_rows_are_numbered_in_order(spark, tmp_path):
    frame = spark.range(1000, numPartitions=7).selectExpr("id * 3 as x")
    assert [tuple(r) for r in session.row_numbers(frame, "n").orderBy("n").collect()] == [(3 * i, i) for i in range(1000)]
    assert [tuple(r) for r in session.row_numbers(frame.orderBy(F.desc("x")), "n").orderBy("n").collect()] == [(3 * (999 - i), i) for i in range(1000)]
    assert session.row_numbers(frame.where("x < 0"), "n").count() == 0
    # files in the order of their names, whatever their sizes; blank lines count
    write(tmp_path / "q/a.jsonl", '{"query":"one"}\n\n')
    write(tmp_path / "q/b.jsonl", "".join('{"query":"more"}\n' for _ in range(50)))
    got = readers.raw_queries(spark, str(tmp_path / "q")).orderBy("query_id").collect()
    assert [(r.query_id, r.text) for r in got] == [("q000000", "one"), *((f"q{i:06d}", "more") for i in range(2, 52))]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Nothing:
        def __getattr__(self, name):
            return lambda *a: Nothing() if name not in ("isDefined", "get") else None

    class Context(Nothing):
        master, _jsc = "spark://there:7077", Nothing()

    class Session(Nothing):
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError):
        session.scratch_root(Session())


def test_session(spark):
    assert session.build().conf.get("spark.sql.session.timeZone") == "UTC"
