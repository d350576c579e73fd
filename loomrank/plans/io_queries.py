"""Queries over files and runs: each writes real files to the shared scratch folder and reads them back.

The lines come from the driver's tables; blank, broken and short ones are made among them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomrank import schemas
from loomrank.functions import text as tx
from loomrank.operators import bm25, judging, mining, ranking
from loomrank.plans import cascade, prepare, registry
from loomrank.session import scratch_path
from loomrank.sources import readers, sinks
from loomrank.streaming import incremental

query = registry.query


def text_file(lines: DataFrame, name: str) -> str:
    path = scratch_path(lines.sparkSession, name)
    lines.select("value").write.text(path)
    return path


def document_lines(spark, sf, *, broken: bool) -> DataFrame:
    """documents as JSON lines, every seventh blank and, if asked for, every fifth cut off."""
    whole = F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), "text"))
    d = F.col("doc_id")
    value = F.when(d % 7 == 0, F.lit("  ")).when((d % 5 == 0) & F.lit(broken), F.concat(F.lit("{"), F.substring(whole, 1, 12))).otherwise(whole)
    return registry.documents(spark, sf).select(value.alias("value"))


# ------------------------------------------------------------------ files


@query
def jsonl_tolerant(spark, sf):
    return readers.jsonl(spark, text_file(document_lines(spark, sf, broken=True), "tolerant"), schemas.CORPUS)


@query
def jsonl_strict(spark, sf):
    return readers.jsonl_strict(spark, text_file(document_lines(spark, sf, broken=False), "strict"), schemas.CORPUS)


@query
def jsonl_missing_file(spark, sf):
    """A tolerant read of a missing file is an empty table."""
    return readers.jsonl(spark, scratch_path(spark, "missing"), schemas.CORPUS).agg(F.count("*").alias("n"))


@query
def count_lines_file(spark, sf):
    path = text_file(document_lines(spark, sf, broken=True), "lines")
    return spark.range(1).select(F.lit(readers.count_lines(spark, path)).cast("long").alias("n"))


@query
def qrels_file(spark, sf):
    """Lines of other than four fields, made among those of the sink, are passed over."""
    lines = sinks.qrels_lines(mining.qrels(registry.synthetic_judgments(spark, sf)))
    odd = lines.select(F.concat("value", F.lit("\tdev")).alias("value")).union(lines.select(F.lit("").alias("value")))
    return readers.qrels(spark, text_file(lines.union(odd), "qrels"))


def split_qrels(spark, sf) -> DataFrame:
    rows = registry.synthetic_judgments(spark, sf)
    part = rows.select("query_id", F.lit(0).alias("iter"), "doc_id", F.col("relevance_score").alias("relevance"), F.col("batch_id"))
    return readers.with_split(part.where("batch_id > 0").drop("batch_id"), part.where("batch_id = 0").drop("batch_id"))


@query
def qrels_split_file(spark, sf):
    path = scratch_path(spark, "split-qrels")
    sinks.write_qrels_with_split(split_qrels(spark, sf), path)
    return readers.qrels_with_split(spark, path)


@query
def triples_file(spark, sf):
    path = scratch_path(spark, "triples")
    sinks.write_triples(mining.triples(registry.synthetic_judgments(spark, sf)), path)
    return registry.joined_arrays(readers.triples(spark, path))


@query
def lucene_file(spark, sf):
    path = scratch_path(spark, "lucene")
    sinks.write_lucene(registry.corpus(spark, sf), path)
    return spark.read.schema(schemas.LUCENE).json(path)


@query
def page_tree(spark, sf):
    """One file for each of three topics, items as lines; a file beside the pages is left out. The stem is the writer's."""
    root = scratch_path(spark, "tree")
    items = registry.benchmark(spark, sf)
    for topic in range(3):
        lines = items.where(F.col("item_id") % 3 == topic).repartition(1).sortWithinPartitions("item_id").select("text")
        lines.write.text(f"{root}/topic {topic}/{'pages' if topic else 'notes'}")
    found = readers.page_texts(spark, root)
    return found.select(F.split("doc_id", "__")[0].alias("topic"), F.md5("text").alias("text_md5"))


@query
def raw_query_file(spark, sf):
    """Query lines in one file, every fourth blank, with optional fields missing, empty or given."""
    n = F.col("item_id")
    body = F.to_json(F.struct(F.col("text").alias("query"), F.when(n % 3 > 0, F.when(n % 3 == 1, "").otherwise("t")).alias("topic"), F.when(n % 2 == 0, F.concat(F.lit("s"), n)).alias("source_doc")))
    lines = registry.benchmark(spark, sf).repartition(1).sortWithinPartitions("item_id").select(F.when(n % 4 == 0, F.lit("")).otherwise(body).alias("value"))
    return readers.raw_queries(spark, text_file(lines, "raw-queries"))


@query
def split_tables(spark, sf):
    """The job that joins both parts, then the job that makes tables; rows of each."""
    path = scratch_path(spark, "prepared")
    asked = registry.search_queries(spark, sf)
    judged = registry.synthetic_judgments(spark, sf).select("query_id", "doc_id", F.col("relevance_score").alias("relevance"))
    parts = [(asked.where(cond), judged.where(f"NOT ({cond})")) for cond in ("query_id < 'q000010'", "query_id >= 'q000010'")]
    written = prepare.with_splits(registry.corpus(spark, sf), *parts, path)
    again = prepare.with_splits(registry.corpus(spark, sf), *parts, path)
    counts = prepare.build_tables(spark, path, f"{path}/tables")
    return spark.createDataFrame([*counts.items(), ("written", int(written)), ("again", int(again))], "name string, n long")


@query
def published_tables(spark, sf):
    """Label files exported, published to a folder, and counted there."""
    path = scratch_path(spark, "labels")
    rows = registry.synthetic_judgments(spark, sf)
    sinks.write_qrels(mining.qrels(rows), f"{path}/qrels.tsv")
    sinks.write_triples(mining.triples(rows), f"{path}/triples.jsonl")
    sinks.export_labels(spark, f"{path}/qrels.tsv", f"{path}/triples.jsonl", f"{path}/out", sinks.FolderPublisher(spark, f"{path}/box"), token="none")
    read = lambda kind: spark.read.parquet(f"{path}/box/labels-{kind}/data").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return read("qrels").union(read("triples"))


# ------------------------------------------------------------------ models and judges


@query
def chat_payload(spark, sf):
    """The request bodies of all candidates, taken apart again."""
    body = judging.payload(judging.prompt(F.col("query"), F.col("text")))
    at = lambda path: F.get_json_object("body", path)
    rows = registry.candidates(spark, sf).select("query_id", "doc_id", body.alias("body"))
    return rows.select("query_id", "doc_id", at("$.messages[0].role").alias("role"), F.md5(at("$.messages[0].content")).alias("content_md5"), at("$.temperature").cast("double").alias("temperature"), at("$.max_tokens").cast("int").alias("max_tokens"), at("$.stop[1]").alias("stop"))


class LetterEmbedder:
    """Length and number of e's; shows the Arrow interface, not quality."""

    def load(self) -> Callable[[list[str]], list[list[float]]]:
        return lambda texts: [[float(len(t)), float(t.count("e"))] for t in texts]


class LengthScorer:
    def load(self) -> Callable[[list[str], list[str]], list[float]]:
        return lambda queries, texts: [len(q) / max(1, len(t)) for q, t in zip(queries, texts, strict=True)]


class PluralStemmer:
    name = "plural"

    def load(self) -> Callable[[str], str]:
        return lambda term: term.removesuffix("s")


@query
def encoder_vectors(spark, sf):
    """Each distinct query text goes through the encoder once."""
    made = ranking.embedded_queries(registry.search_queries(spark, sf), LetterEmbedder())
    return made.select("query_id", F.col("embedding")[0].cast("double").alias("chars"), F.col("embedding")[1].cast("double").alias("es"))


@query
def pair_scores(spark, sf):
    pairs = registry.candidates(spark, sf).drop("ce_score")
    return ranking.pair_scored(pairs, LengthScorer()).select("query_id", "doc_id", "ce_score")


@query
def stemmed_terms(spark, sf):
    rule = bm25.Bm25(stemmer=PluralStemmer())
    return registry.documents(spark, sf).select("doc_id", F.array_join(rule.terms(F.col("text")), " ").alias("terms"))


@query
def embedding_stats(spark, sf):
    return ranking.embedding_stats(readers.table(spark, f"{sf}/embeddings.parquet"))


@query
def judged_with_cache(spark, sf):
    """Cached verdicts, then the prefilter, then the judge."""
    rows = registry.candidates(spark, sf)
    return judging.judged(rows, registry.made_cache(rows), registry.PLAN.judge).select("query_id", "doc_id", "relevance_score", "answerable", "source")


@query
def judged_without_prefilter(spark, sf):
    return judging.judged(registry.candidates(spark, sf), None, registry.PLAN.judge, use_prefilter=False).select("query_id", "doc_id", "relevance_score", "source")


# ------------------------------------------------------------------ runs


def run_at(spark, name: str) -> incremental.Run:
    return incremental.Run(spark, scratch_path(spark, name), None, cascade.Cascade())


@query
def run_remaining(spark, sf):
    """What a run asks next: all queries but those that finished batches have processed."""
    run, rows = run_at(spark, "remaining"), registry.search_queries(spark, sf)
    part = F.substring("query_id", 2, 99).cast("int") % 3
    for batch in (0, 1):
        run._put("processed", rows.where(part == batch).select("query_id"), batch)
    return run.remaining(rows)


@query
def run_finished_only(spark, sf):
    """Labels of two batches, one of which was cut off before its processed ids; with the number of the next batch."""
    run, rows = run_at(spark, "cut-off"), registry.synthetic_judgments(spark, sf)
    for batch in (0, 1):
        run._put("qrels", mining.qrels(rows.where(F.col("batch_id") == batch)), batch)
    run._put("processed", rows.where("batch_id = 0").select("query_id").distinct(), 0)
    return run.qrels().select("query_id", "doc_id", "relevance_score", F.lit(run.next_batch()).cast("long").alias("next_batch"))


@query
def run_cache(spark, sf):
    """The cache of a run: rows of finished batches, and answers of one that was cut off."""
    run, rows = run_at(spark, "cache"), registry.synthetic_judgments(spark, sf)
    run._put("cache", registry.synthetic_cache(spark, sf).where("batch_id = 0"), 0)
    run._put("cache", registry.synthetic_cache(spark, sf).where("batch_id = 1"), 1)
    run._put("processed", rows.where("batch_id = 0").select("query_id").distinct(), 0)
    answer = F.when(F.col("relevance_score") > 1, "yes").otherwise("No")
    error = F.when(F.col("relevance_score") == 1, "timeout")
    run._put("answers", rows.where("batch_id = 2").select("query", "doc_id", answer.alias("answer"), error.alias("error"), F.lit("j").alias("judge_id")), 2)
    return run.cache().select("query_hash", "doc_id", "relevance_score", "answerable", "judge_id", "batch_id")


@query
def run_of_nothing(spark, sf):
    """A run without any state: empty tables, and batch 0 next."""
    run = run_at(spark, "nothing")
    counts = [("qrels", run.qrels().count()), ("triples", run.triples().count()), ("cache", run.cache().count()), ("processed", run.processed().count()), ("next", run.next_batch())]
    return spark.createDataFrame(counts, "name string, n long")
