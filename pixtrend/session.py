"""Spark session helpers and the shared scratch location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a
    # fused stage beyond that would run interpreted.  Spark's documented
    # setting for HotSpot makes such stages fall back to per-operator codegen.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def ensure_jit_friendly_codegen(spark: SparkSession) -> None:
    """Apply the HotSpot huge-method limit to a session that still has Spark's
    default (used by jobs with very wide generated expressions)."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "pixtrend", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs assume."""
    b = SparkSession.builder.appName(app)
    master = master or os.environ.get("PIXTREND_MASTER")
    if master:  # else as spark-submit says
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if partitions:
        conf["spark.sql.shuffle.partitions"] = str(partitions)
    if "PIXTREND_DRIVER_MEMORY" in os.environ:
        conf["spark.driver.memory"] = os.environ["PIXTREND_DRIVER_MEMORY"]
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables and checkpoints.

    Uses ``spark.checkpoint.dir`` from the session.  Only a local-mode session
    without that setting (tests, laptops) gets a private folder; on a cluster
    the setting is required, because a machine-local folder would not survive
    the loss of an executor.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if d.startswith("file:") and not sc.master.startswith("local"):
            raise RuntimeError(f"spark.checkpoint.dir {d} is a folder of one machine; name a shared one")
        if not sc.getCheckpointDir():  # the setting came after the context
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this job")
    d = tempfile.mkdtemp(prefix="pixtrend-")
    sc.setCheckpointDir(d)
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the scratch folder."""
    import uuid

    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder as Parquet and read back: what is used
    several times is computed once, and what follows starts from files."""
    path = new_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
