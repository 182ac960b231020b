"""Folders for files that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path that driver and executors share: under the session's ``spark.checkpoint.dir``, or a temporary folder where all
    runs in one process and the setting is unset. On a cluster without it this raises. Files stay, as results read them, until ``release``."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="matchloom-")
    path = f"{at.rstrip('/')}/matchloom-{tag}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


_MADE: list[str] = []


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: computed once, whatever happens to an executor."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_all(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]], tag: str) -> dict[str, DataFrame]:
    """The tables that the functions give, each as ``materialize`` leaves it. Their jobs are handed to Spark together, so that those of one
    table fill the cores that another's short stages and last tasks leave idle."""
    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        done = {k: pool.submit(inheritable_thread_target(spark)(lambda k=k, f=f: materialize(f(), f"{tag}-{k}"))) for k, f in tables.items()}
        return {k: f.result() for k, f in done.items()}


def release(spark: SparkSession) -> int:
    """Delete all folders that ``scratch`` has named so far in this process, once no result that reads them is wanted any more."""
    conf, n = spark.sparkContext._jsc.hadoopConfiguration(), len(_MADE)
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(conf).delete(path, True)
    return n
