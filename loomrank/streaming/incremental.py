"""Incremental runs: micro-batches of queries, resumable and effectively once.

Every batch writes judgments, labels, cache rows and processed ids under its own batch number, the processed ids last.
A batch without them is none: readers pass over it, and a rerun takes a new number. Processed ids come from the queries,
not from their results, so a query without a hit is not asked again; a query whose judging failed is not marked and is
retried. The answers that a batch got before it was cut off are paid for: later batches take them as cached. `follow` runs
the same function over a stream of query files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomrank import schemas
from loomrank.functions import text as tx
from loomrank.operators import bm25, judging, mining
from loomrank.plans import cascade
from loomrank.sources import readers


class Run:
    """State of a run under `path`."""

    def __init__(self, spark: SparkSession, path: str, index: bm25.Index, plan: cascade.Cascade, cache_errors: bool = False):
        self.spark, self.path, self.index, self.plan, self.cache_errors = spark, path.rstrip("/"), index, plan, cache_errors

    # -------------------------------------------------------------- state

    def _table(self, name: str, schema: str) -> DataFrame:
        """All rows of a table, with the batch that wrote them."""
        folder = f"{self.path}/{name}"
        if "batch_id" not in schema:
            schema += ", batch_id LONG"
        return self.spark.read.schema(schema).parquet(folder) if readers.exists(self.spark, folder) else self.spark.createDataFrame([], schema)

    def _put(self, name: str, rows: DataFrame, batch: int) -> None:
        rows.drop("batch_id").write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch}")

    def batches(self) -> DataFrame:
        """(batch_id): finished batches."""
        return self._table("processed", schemas.PROCESSED).select("batch_id").distinct()

    def processed(self) -> DataFrame:
        return self._table("processed", schemas.PROCESSED).where("query_id IS NOT NULL").select("query_id").distinct()

    def _finished(self, name: str, schema: str) -> DataFrame:
        return self._table(name, schema).join(bm25.small(self.batches()), "batch_id", "left_semi")

    def qrels(self) -> DataFrame:
        return self._finished("qrels", schemas.QRELS)

    def triples(self) -> DataFrame:
        return self._finished("triples", schemas.TRIPLES)

    def paid(self) -> DataFrame:
        """Cache rows of the answers, errors left out, that batches without an end have written."""
        rows = self._table("answers", ANSWERS).where("error IS NULL AND answer IS NOT NULL")
        lost = rows.join(bm25.small(self.batches()), "batch_id", "left_anti")
        return lost.select(tx.query_hash(F.col("query")).alias("query_hash"), "doc_id", *judging.verdict(judging.is_yes(F.col("answer"))), "judge_id", "batch_id")

    def cache(self) -> DataFrame:
        return self._finished("cache", schemas.CACHE).unionByName(self.paid())

    def clear_cache(self) -> None:
        """Empty the cache and forget nothing else: later batches start from none."""
        for name, schema in (("cache", schemas.CACHE), ("answers", ANSWERS)):
            empty = self.spark.createDataFrame([], schema).drop("batch_id")
            for row in self._table(name, schema).select("batch_id").distinct().toLocalIterator():
                empty.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={row.batch_id}")

    def stats(self) -> DataFrame:
        return self._finished("judged", JUDGED).drop("batch_id")

    # -------------------------------------------------------------- running

    def remaining(self, queries: DataFrame) -> DataFrame:
        return queries.join(self.processed(), "query_id", "left_anti")

    def next_batch(self) -> int:
        """One more than the largest number that any table has a folder of, be it without rows or without an end."""
        found = [-1]
        for name in ("processed", "judged", "answers", "qrels", "triples", "cache"):
            found += [int(x.removeprefix("batch_id=")) for x in readers.folders(self.spark, f"{self.path}/{name}") if x.startswith("batch_id=")]
        return max(found) + 1

    def batch(self, queries: DataFrame) -> int:
        """Label the queries that are not processed yet; the number of the batch."""
        number = self.next_batch()
        todo = self.remaining(queries)

        def write(answers: DataFrame) -> DataFrame:
            path = f"{self.path}/answers/batch_id={number}"
            answers.withColumn("judge_id", F.lit(self.plan.judge.judge_id)).write.mode("overwrite").parquet(path)
            return self.spark.read.schema(answers.schema).parquet(path)

        self._put("judged", cascade.judged(self.index, todo, self.plan, self.cache(), write).select(*JUDGED_COLUMNS), number)
        rows = self._table("judged", JUDGED).where(F.col("batch_id") == number).drop("batch_id")
        failed = rows.where("error IS NOT NULL").select("query_id").distinct()
        fine = rows.join(failed, "query_id", "left_anti")
        qrels, triples = cascade.labels(fine, self.plan)
        self._put("qrels", qrels, number)
        self._put("triples", triples, number)
        self._put("cache", judging.cache_rows(rows, self.plan.judge.judge_id, number, self.cache_errors), number)
        self._put("processed", todo.select("query_id").distinct().join(failed, "query_id", "left_anti"), number)
        return number

    def run(self, queries: DataFrame, batches: int = 1) -> list[int]:
        """All queries, dealt by a hash of their ids into that many batches."""
        part = F.pmod(F.xxhash64("query_id"), F.lit(batches))
        return [self.batch(queries.where(part == i)) for i in range(batches)]

    def follow(self, folder: str, checkpoint: str) -> StreamingQuery:
        """Label queries from JSON-lines files as they come into the folder; stops when all present ones are done."""
        stream = self.spark.readStream.schema(schemas.QUERIES).json(folder)
        return stream.writeStream.foreachBatch(lambda rows, _: self.batch(rows.dropDuplicates(["query_id"])) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def summary(self, total: int | None = None, seconds: float | None = None) -> str:
        """Counters as text; with the number of all queries and the seconds spent also the pace and the time left."""
        row = mining.run_stats(self.stats(), self.processed()).first().asDict()
        if total and seconds is not None and row["queries_processed"]:
            pace = seconds / row["queries_processed"]
            left = int(pace * max(0, total - row["queries_processed"]))
            row |= {"seconds_per_query": round(pace, 3), "time_left": f"{left // 3600}h {left % 3600 // 60}m"}
        return "\n".join(f"{k.replace('_', ' ')}: {v}" for k, v in row.items())

    def report(self, queries: DataFrame) -> DataFrame:
        """Counters of the whole run."""
        return mining.run_stats(self.stats(), self.processed().join(queries, "query_id", "left_semi"))


JUDGED = (
    "query_id STRING, query STRING, doc_id STRING, text STRING, bm25_rank INT, dense_rank INT, ce_rank INT, ce_score DOUBLE, cand_pos INT, "
    "relevance_score INT, answerable BOOLEAN, confidence DOUBLE, error STRING, source STRING"
)
ANSWERS = "query STRING, doc_id STRING, answer STRING, error STRING, judge_id STRING"
JUDGED_COLUMNS = [c.split()[0] for c in JUDGED.split(", ")]
