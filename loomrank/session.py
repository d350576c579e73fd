"""Session builder for stand-alone use; the operators take whatever session they are given."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def build(app: str = "loomrank", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution and Arrow batches for whole texts; further settings as keyword arguments with
    __ for dots."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver has it from, where they see that folder (local
    runs, shared disks); on other clusters the package is shipped with the job."""
    root = str(Path(__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    known = f"{environment.get('PYTHONPATH', '')}{os.pathsep}{os.environ.get('PYTHONPATH', '')}".split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster, from spark.checkpoint.dir or the context's checkpoint folder. A folder of our own is
    made only where neither is set and the master is a local one (tests); a cluster without a shared folder is an error,
    since each executor would write to its own disk."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            root = known.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            root = tempfile.mkdtemp(prefix="loomrank-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def remove_scratch(spark: SparkSession) -> bool:
    """Delete the intermediate tables that `written` has left in the shared folder, once no result that reads them is needed
    any more; whether there were any."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/loomrank")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def row_numbers(df: DataFrame, name: str, *order: str) -> DataFrame:
    """df with `name`, numbers from 0 without a gap, in the order of the columns `order` (of whole partitions or splits), then
    of partitions, then of rows. A row for each partition meets in one task; the rows don't move."""
    numbered = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_row", 33))
    if moves_rows(df):  # a task that is run again may get its rows in another order: keep the numbers
        numbered = written(numbered, "numbered")
    by = [*order, "_part"]
    parts = numbered.groupBy(*by).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    ahead = F.sum("_n").over(Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("_ahead", F.coalesce(ahead, F.lit(0))).drop("_n")
    return numbered.join(parts, by).withColumn(name, F.col("_ahead") + F.col("_row") - F.col("_first")).select(*df.columns, name)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/loomrank/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it again. options: the writer's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Plan nodes after which rows have moved between partitions, so that their order may differ when they are worked out again.
MOVING = frozenset(("Join", "AsOfJoin", "Aggregate", "Window", "Sort", "Repartition", "RepartitionByExpression", "RebalancePartitions", "Deduplicate", "Distinct", "Intersect", "Except", "GlobalLimit", "InMemoryRelation", "FlatMapGroupsInArrow", "FlatMapGroupsInPandas", "FlatMapCoGroupsInArrow", "FlatMapCoGroupsInPandas"))


def moves_rows(df: DataFrame) -> bool:
    """Whether the plan of df has a node that moves rows between partitions."""
    left = [df._jdf.queryExecution().optimizedPlan()]
    while left:
        node = left.pop()
        if node.getClass().getSimpleName() in MOVING:
            return True
        children = node.children()
        left.extend(children.apply(i) for i in range(children.size()))
    return False


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores: a small file is a single partition, which dear expressions
    would leave to one task. Large inputs have more partitions than that and are not shuffled; nor is what comes out of a
    shuffle, whose partitions can't be counted without running it."""
    if moves_rows(df):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def settled(df: DataFrame) -> DataFrame:
    """df as something that gives the same rows in the same order whenever a task is run again: read straight from its
    source, or else written and read back; in as many partitions as there are cores where a small file is fewer."""
    if moves_rows(df):
        return written(df, "settled")
    wide = spread(df)
    return df if wide is df else written(wide, "settled")
