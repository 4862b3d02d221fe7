"""Cutting lineage with tables in the cluster's shared folder.

Iterative operators read their own intermediate results several times.  Those are written as
Parquet under ``spark.checkpoint.dir``, which every executor can read, so the loss of an executor
costs nothing but the tasks it was running.  Only when the session names no such folder (tests on
one machine) a temporary folder of this process is set in its place.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDER_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a local one only where the session has none and is local."""
    named = spark.conf.get(_FOLDER_KEY, None) or spark.sparkContext.getConf().get(_FOLDER_KEY)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"set {_FOLDER_KEY} to a folder that every executor can reach")
    folder = f"file://{tempfile.mkdtemp(prefix='quarryweave-')}"
    spark.conf.set(_FOLDER_KEY, folder)
    return folder


_WRITTEN: list[str] = []


def release(spark: SparkSession) -> None:
    """Delete all intermediate tables written so far; results that were not written or collected yet can't be read any more."""
    while _WRITTEN:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of it; removed by ``release``, or when the JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quarryweave/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    _WRITTEN.append(path)
    df.write.mode("overwrite").parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(schema).parquet(path)
