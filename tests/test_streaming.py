"""Incremental masking job: a rerun processes only scenes that arrived since."""

from pyspark.sql import functions as F

from pixtrend.constants import BANDS
from pixtrend.session import new_scratch_path
from pixtrend.sources.io import write_mosaic
from pixtrend.streaming.incremental import mask_scenes_stream

SCHEMA = "year int, scene_id int, x int, y int, " + ", ".join(f"{b} int" for b in BANDS) + ", scl int"


def _scene(spark, sid, n=40):
    rows = [(2000, sid, x, 0, *[100 + x] * 6, 4) for x in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_rerun_processes_only_new_scenes(spark):
    src, dst, ckpt = (new_scratch_path(spark, p) for p in ("in", "out", "ckpt"))
    write_mosaic(_scene(spark, 1).unionByName(_scene(spark, 2)), src, partition_by=("scene_id",),
                 cluster=("scene_id",), mode="append")
    mask_scenes_stream(spark, src, dst, ckpt)
    first = spark.read.parquet(dst)
    assert first.count() == 80
    write_mosaic(_scene(spark, 3), src, partition_by=("scene_id",), cluster=("scene_id",), mode="append")
    mask_scenes_stream(spark, src, dst, ckpt)
    out = spark.read.parquet(dst)
    assert out.count() == 120                                  # nothing processed twice
    assert sorted(r["scene_id"] for r in out.select("scene_id").distinct().collect()) == [1, 2, 3]


def test_scene_in_two_batches_is_masked_as_a_whole(spark):
    """Half a scene arrives, then the half with an outlier: the statistics of
    the second run see both halves, and nothing is kept from the first."""
    src, dst, ckpt = (new_scratch_path(spark, p) for p in ("in2", "out2", "ckpt2"))
    first = spark.createDataFrame([(2000, 7, x, 0, *[100] * 6, 4) for x in range(30)], SCHEMA)
    second = spark.createDataFrame([(2000, 7, x, 0, *([9000] * 6 if x == 30 else [100] * 6), 4) for x in range(30, 60)], SCHEMA)
    for part in (first, second):
        write_mosaic(part, src, partition_by=("scene_id",), cluster=("scene_id",), mode="append")
        mask_scenes_stream(spark, src, dst, ckpt)
    out = spark.read.parquet(dst)
    assert out.count() == 60
    blank = [r["x"] for r in out.filter(F.col("nir").isNull()).collect()]
    assert blank == [30]
