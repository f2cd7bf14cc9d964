"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, kind: str = "runs") -> str:
    """A new folder under spark.checkpoint.dir.  Where that is unset, one of our own in local mode; on a cluster each executor
    would write to its own disk, so there it has to be set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="textgraph-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs at once, instead of when the driver happens to collect garbage."""
    gc.collect()
    spark._jvm.System.gc()


def kept(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Written under a folder and read back: evaluated once, and no executor's loss repeats it."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}", compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
