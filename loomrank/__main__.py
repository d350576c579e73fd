"""Command line: label, export, wiki, splits, tables.

python -m loomrank label --config c.yaml --corpus corpus.parquet --queries queries.parquet --out out [--batches 10] [--judge-url URL]
python -m loomrank export --qrels out/qrels.tsv --triples out/triples.jsonl --out export [--repo-id labels] [--token T] [--private] [--publish-to folder]
python -m loomrank wiki --root raw --queries queries.jsonl --out prepared
python -m loomrank splits --corpus c.jsonl --train-queries tq.jsonl --train-qrels tr.tsv --dev-queries dq.jsonl --dev-qrels dr.tsv --out prepared
python -m loomrank tables --folder prepared --out tables [--repo-id corpus] [--token T] [--private] [--publish-to folder]
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from loomrank import schemas, session
from loomrank.functions import files
from loomrank.operators import judging
from loomrank.plans import config, prepare
from loomrank.sources import readers, sinks


def numbered(corpus):
    """The corpus with doc_pos: its own column of that name, a numeric doc_id, or the order of the input."""
    if "doc_pos" in corpus.columns:
        return corpus.select("doc_pos", F.col("doc_id").cast("string").alias("doc_id"), "text")
    if isinstance(corpus.schema["doc_id"].dataType, LongType):
        return corpus.select(F.col("doc_id").alias("doc_pos"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    return session.row_numbers(corpus.select(F.col("doc_id").cast("string").alias("doc_id"), "text"), "doc_pos").select("doc_pos", "doc_id", "text")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loomrank", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    label = commands.add_parser("label")
    for name in ("config", "corpus", "queries", "out"):
        label.add_argument(f"--{name}", required=True)
    label.add_argument("--batches", type=int, default=1)
    label.add_argument("--judge-url")
    export = commands.add_parser("export")
    for name in ("qrels", "triples", "out"):
        export.add_argument(f"--{name}", required=True)
    wiki = commands.add_parser("wiki")
    for name in ("root", "queries", "out"):
        wiki.add_argument(f"--{name}", required=True)
    splits = commands.add_parser("splits")
    for name in ("corpus", "train-queries", "train-qrels", "dev-queries", "dev-qrels", "out"):
        splits.add_argument(f"--{name}", required=True)
    tables = commands.add_parser("tables")
    for name in ("folder", "out"):
        tables.add_argument(f"--{name}", required=True)
    for command, name in ((export, "labels"), (tables, "corpus")):
        command.add_argument("--repo-id", default=name)
        command.add_argument("--token")
        command.add_argument("--private", action="store_true")
        command.add_argument("--publish-to")
    given = parser.parse_args(arguments)
    spark = session.build()
    log = files.log_to("logs")
    if given.command == "label":
        settings = config.load(given.config)
        more = {}
        if given.judge_url:
            more["judge"] = judging.ChatJudge(given.judge_url, settings.get("llm.model", "chat"), settings.get("llm.timeout", 30.0), settings.get("llm.max_concurrent", 20))
        corpus = numbered(readers.table(spark, given.corpus))
        run = prepare.label(spark, settings, corpus, readers.table(spark, given.queries), given.out, given.batches, **more)
        log.info("\n%s", run.summary())
    elif given.command == "export":
        box = sinks.FolderPublisher(spark, given.publish_to) if given.publish_to else None
        log.info("exported %s", sinks.export_labels(spark, given.qrels, given.triples, given.out, box, given.repo_id, given.token, given.private))
    elif given.command == "wiki":
        log.info("written" if prepare.wiki(spark, given.root, given.queries, given.out) else "all files are there")
    elif given.command == "splits":
        parts = [(readers.jsonl_strict(spark, q, schemas.QUERIES), readers.qrels(spark, r).withColumnRenamed("relevance_score", "relevance")) for q, r in ((given.train_queries, given.train_qrels), (given.dev_queries, given.dev_qrels))]
        made = prepare.with_splits(readers.jsonl_strict(spark, given.corpus, schemas.CORPUS), *parts, given.out)
        log.info("written" if made else "all files are there")
    else:
        log.info("rows: %s", prepare.build_tables(spark, given.folder, given.out))
        if given.publish_to:
            sinks.published(sinks.FolderPublisher(spark, given.publish_to), {given.repo_id: given.out}, given.token, given.private)


if __name__ == "__main__":
    main()
