"""Session helpers that hold on a laptop and on a cluster alike."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder; NTZ timestamps are read as they are stored."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir where the session sets it.

    Only a local session without one gets a temporary folder; on a cluster that is an error, as its executors share no disk.
    """
    conf = spark.sparkContext.getConf()
    found = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not found:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jvm_dir.get() if jvm_dir.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once into the shared folder and read it back, which cuts its lineage.

    A lost executor loses nothing, since the files lie where all executors read them. The job runs when this is called. The
    results that are built on it read the files, so they stay until ``release`` or the owner of the folder deletes them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


def release(spark: SparkSession) -> int:
    """Delete what ``cut`` has written in this process, once the results are stored; returns the number of folders."""
    n = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Repartition a plain scan that has fewer splits than ``tasks`` (the session's parallelism unless given).

    Small single files are spread so; a large input has more splits than that and keeps them, so its texts are not shuffled. An
    input with a join, an aggregate or a shuffle of its own is left as it is, as counting its partitions would run it.
    """
    tasks = tasks or df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if any(step in plan for step in ("Join", "Aggregate", "Repartition", "Window", "Sort", "Limit")):
        return df
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of an Arrow batch, so that a worker holds few whole texts at once; a session setting, as Spark has it."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
