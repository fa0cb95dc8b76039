"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as the cluster names it.  Only a local session
    without that setting (tests) gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="pixtrend-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage ends there, so a lost executor costs a reread of files, and steps
    that use the table twice do not compute it twice."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the shuffle files of steps that are done: Spark's cleaner does so
    when the driver collects garbage, which a driver with room to spare puts off.
    The scheduler holds on to the last job until the next one."""
    gc.collect()
    spark.range(1).collect()
    time.sleep(0.5)
    spark.sparkContext._jvm.System.gc()
