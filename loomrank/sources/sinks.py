"""Writers. All of them write in parallel, one file for each partition, and append unless told otherwise."""

from __future__ import annotations

import json
import os
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomrank.sources import readers


def qrels_lines(qrels: DataFrame) -> DataFrame:
    """(value): query, 0, document and score between tabs."""
    score = F.coalesce(F.col("relevance_score"), F.lit(3)).cast("string")
    return qrels.select(F.concat_ws("\t", "query_id", F.lit("0"), "doc_id", score).alias("value"))


def write_qrels(qrels: DataFrame, path: str, mode: str = "append") -> None:
    qrels_lines(qrels).write.mode(mode).text(path)


def write_qrels_with_split(qrels: DataFrame, path: str, mode: str = "append") -> None:
    columns = [F.col(c).cast("string") for c in ("query_id", "iter", "doc_id", "relevance", "split")]
    qrels.select(F.concat_ws("\t", *columns).alias("value")).write.mode(mode).text(path)


def write_jsonl(rows: DataFrame, path: str, mode: str = "append") -> None:
    """One object a line; null fields are left out."""
    rows.write.mode(mode).option("ignoreNullFields", "true").json(path)


def write_triples(triples: DataFrame, path: str, mode: str = "append") -> None:
    write_jsonl(triples.where(F.size("positive_doc_ids") > 0), path, mode)


def lucene_rows(corpus: DataFrame) -> DataFrame:
    return corpus.selectExpr("doc_id AS id", "text AS contents")


def write_lucene(corpus: DataFrame, path: str) -> None:
    """Input of an external search indexer."""
    write_jsonl(lucene_rows(corpus), path, "overwrite")


def export_if_absent(frames: dict[str, DataFrame]) -> bool:
    """Write each frame as JSON lines unless all paths are there; whether anything was written."""
    missing = [p for p, df in frames.items() if not readers.exists(df.sparkSession, p)]
    if not missing:
        return False
    for path, df in frames.items():
        write_jsonl(df, path, "overwrite")
    return True


class Publisher(Protocol):
    """Takes a finished folder to where data sets are kept."""

    def publish(self, name: str, path: str, token: str, private: bool) -> None: ...


class FolderPublisher:
    """Publishes to a folder of any store that Spark can write to: <root>/<name>, replaced as a whole, with a card that says
    whether it is private. The token is not kept."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def publish(self, name: str, path: str, token: str, private: bool) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        there = target.getFileSystem(conf)
        there.delete(target, True)
        there.mkdirs(target.getParent())
        if not jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, there, target, False, conf):
            raise OSError(f"could not copy {path}")
        card = self.spark.createDataFrame([(json.dumps({"name": name, "private": private}),)], "value string")
        card.coalesce(1).write.mode("overwrite").text(f"{self.root}/{name}/card")


def published(publisher: Publisher, folders: dict[str, str], token: str | None, private: bool) -> None:
    """Give each folder to the publisher, which needs a token, given or in HF_TOKEN."""
    token = token or os.environ.get("HF_TOKEN")
    if not token:
        raise ValueError("a token is needed: give one or set HF_TOKEN")
    for name, path in folders.items():
        publisher.publish(name, path, token, private)


def export_labels(spark, qrels_path: str, triples_path: str, out: str, publisher: Publisher | None = None, repo: str = "labels", token: str | None = None, private: bool = False) -> dict[str, int]:
    """Both label files as Parquet with the raw files beside them, under <out>/<repo>-qrels and -triples. A publisher needs a
    token, given or in HF_TOKEN."""
    for path in (qrels_path, triples_path):
        if not readers.exists(spark, path):
            raise FileNotFoundError(path)
    counts = {}
    for kind, path, frame in (("qrels", qrels_path, readers.qrels(spark, qrels_path)), ("triples", triples_path, readers.triples(spark, triples_path))):
        folder = f"{out}/{repo}-{kind}"
        frame.write.mode("overwrite").parquet(f"{folder}/data")
        spark.read.text(path).write.mode("overwrite").text(f"{folder}/raw")
        counts[kind] = spark.read.parquet(f"{folder}/data").count()
    if publisher is not None:
        published(publisher, {f"{repo}-{kind}": f"{out}/{repo}-{kind}" for kind in counts}, token, private)
    return counts
