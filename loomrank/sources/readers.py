"""Readers for the file formats of the labelling data, each with an explicit schema and its own rule for bad lines."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomrank import schemas
from loomrank.functions import text as tx
from loomrank.session import row_numbers

log = logging.getLogger(__name__)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, in whatever store Spark reads it from."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it isn't there."""
    if not exists(spark, path):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [x.getPath().getName() for x in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]


def table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table; lazy."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tolerant: blank and malformed lines are passed over, a missing file is an empty table."""
    if not exists(spark, path):
        log.warning("no file %s", path)
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def jsonl_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Blank lines are passed over, a malformed line ends the job, a missing file raises FileNotFoundError."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        raise FileNotFoundError(path) from error


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines that are not blank; 0 for a missing file."""
    return spark.read.text(path).where(tx.strip(F.col("value")) != "").count() if exists(spark, path) else 0


def fields(lines: DataFrame, column: str = "value") -> DataFrame:
    """Stripped lines cut at tabs, in `f`."""
    return lines.select(F.split(tx.strip(F.col(column)), "\t", -1).alias("f"))


def qrels_of(lines: DataFrame) -> DataFrame:
    """(query_id, doc_id, relevance_score) of the lines with exactly four fields; a score that is no integer ends the job."""
    cut = fields(lines).where(F.size("f") == 4)
    return cut.select(F.col("f")[0].alias("query_id"), F.col("f")[2].alias("doc_id"), F.col("f")[3].cast("int").alias("relevance_score"))


def qrels(spark: SparkSession, path: str) -> DataFrame:
    return qrels_of(spark.read.text(path))


def qrels_with_split(spark: SparkSession, path: str, skip_blank: bool = True) -> DataFrame:
    """(query_id, iter, doc_id, relevance, split); a line of another number of fields ends the job."""
    lines = spark.read.text(path)
    if skip_blank:
        lines = lines.where(tx.strip(F.col("value")) != "")
    f = fields(lines).withColumn("f", F.when(F.size("f") == 5, F.col("f")).otherwise(F.raise_error(F.lit("a line without five fields")).cast("array<string>")))
    item = lambda i: F.col("f")[i]
    return f.select(item(0).alias("query_id"), item(1).cast("int").alias("iter"), item(2).alias("doc_id"), item(3).cast("int").alias("relevance"), item(4).alias("split"))


def triples(spark: SparkSession, path: str) -> DataFrame:
    return jsonl_strict(spark, path, schemas.TRIPLES)


def page_texts(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, text) of root/<topic>/pages/<stem>.txt: topic__stem and the stripped text."""
    files = spark.read.text(f"{root}/*/pages/*.txt", wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    place = lambda i: F.url_decode(F.regexp_extract("path", r"([^/]+)/pages/([^/]+)\.txt$", i))
    return files.select(F.concat_ws("__", place(1), place(2)).alias("doc_id"), tx.strip(F.col("value")).alias("text"))


def raw_queries(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, text, topic, source_id) of query lines; a query's number counts every line before it, blank ones too."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    numbered = row_numbers(lines, "number", "file", "start")
    some = numbered.where(tx.strip(F.col("value")) != "").select("number", F.from_json("value", schemas.RAW_QUERIES, {"mode": "FAILFAST"}).alias("q"))
    text = F.when(F.col("q.query").isNotNull(), F.col("q.query")).otherwise(F.raise_error(F.lit("a line without a query")).cast("string"))
    return some.select(tx.query_id(F.col("number")).alias("query_id"), text.alias("text"), F.nullif(F.col("q.topic"), F.lit("")).alias("topic"), F.nullif(F.col("q.source_doc"), F.lit("")).alias("source_id"))


def normalized_queries(raw: DataFrame) -> DataFrame:
    """(query_id, text) of rows that have any of query_id, id, _id and of text, query, question; each the first that is
    neither null, empty nor 0; rows that lack either are left out."""

    def first(*names: str):
        found = [(F.col(f"`{n}`"), "string" if raw.schema[n].dataType.simpleString() == "string" else "number") for n in names if n in raw.columns]
        return tx.first_truthy(*found) if found else F.lit(None).cast("string")

    rows = raw.select(first("query_id", "id", "_id").alias("query_id"), first("text", "query", "question").alias("text"))
    return rows.where("query_id IS NOT NULL AND text IS NOT NULL")


def with_split(train: DataFrame, dev: DataFrame) -> DataFrame:
    """Both parts, with the name of each in `split`."""
    return train.withColumn("split", F.lit("train")).unionByName(dev.withColumn("split", F.lit("dev")))


def from_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
