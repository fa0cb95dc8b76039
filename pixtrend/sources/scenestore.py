"""Scenes stored with their statistics, so that a mask reads the pixels once.

A scene comes in one or more parts (a delivery, a tile row).  ``write_scenes``
stores the pixels under ``path/pixels`` and, beside them, one row of moments per
scene and part under ``path/moments``.  Counts and sums merge by addition, so the
statistics of a scene are those of its parts merged; a part that is written again
replaces its own pixels and its own moments, and nothing else.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixtrend.constants import BANDS, SIGMA_K
from pixtrend.operators.masks import outlier_mask
from pixtrend.operators.moments import merged_moments, scene_moments
from pixtrend.sources.io import write_mosaic

PIXELS, MOMENTS, WRITE = "pixels", "moments", "write_id"


def write_scenes(df: DataFrame, path: str, part: str = "all", scene: str = "scene_id", bands=BANDS) -> None:
    """Store the pixels of ``df`` as ``part`` of their scenes, then their moments.

    ``df`` is computed once: the moments are taken from the files just written,
    known by the name of the write that they hold (other files are passed over by
    their footers).  Writing a scene's part again replaces both; after a failure in between,
    the write is repeated (``unmeasured`` names what awaits it).  Rows without a
    scene are left out, an empty ``df`` stores nothing."""
    write = uuid.uuid4().hex
    rows = df.filter(F.col(scene).isNotNull()).withColumns({"part": F.lit(part), WRITE: F.lit(write)})
    write_mosaic(rows, f"{path}/{PIXELS}", partition_by=("part", scene), mode="overwrite", replace_partitions=True)
    stored = df.sparkSession.read.schema(rows.schema).parquet(f"{path}/{PIXELS}").filter((F.col("part") == part) & (F.col(WRITE) == write))
    moments = scene_moments(stored, ("part", scene, WRITE), bands)
    (moments.repartition("part", scene).write.mode("overwrite").partitionBy("part", scene)
     .option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{MOMENTS}"))


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """All stored pixels, the part as a column."""
    return spark.read.parquet(f"{path}/{PIXELS}").drop(WRITE)


def read_moments(spark: SparkSession, path: str, scene: str = "scene_id", bands=BANDS) -> DataFrame:
    """Moments of every stored scene, merged over its parts: no pixel is read."""
    return merged_moments(spark.read.parquet(f"{path}/{MOMENTS}"), (scene,), bands)


def unmeasured(spark: SparkSession, path: str, scene: str = "scene_id") -> DataFrame:
    """``(part, scene)`` whose pixels come from another write than their moments:
    the write broke off between the two."""
    names = ["part", scene, WRITE]
    written = spark.read.parquet(f"{path}/{PIXELS}").select(*names).distinct()
    return written.join(spark.read.parquet(f"{path}/{MOMENTS}").select(*names), names, "left_anti").select("part", scene)


def masked_scenes(spark: SparkSession, path: str, k: float = SIGMA_K, scene: str = "scene_id", bands=BANDS) -> DataFrame:
    """The stored pixels with the sigma mask of their scenes: one scan of the pixels."""
    return outlier_mask(read_pixels(spark, path), k, (scene,), bands, read_moments(spark, path, scene, bands))
