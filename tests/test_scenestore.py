"""Scenes stored with mergeable statistics."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from pixtrend.constants import BANDS
from pixtrend.operators.masks import outlier_mask
from pixtrend.operators.moments import merged_moments, scene_moments
from pixtrend.session import new_scratch_path
from pixtrend.sources.scenestore import MOMENTS, masked_scenes, read_moments, read_pixels, unmeasured, write_scenes

SCHEMA = "year int, scene_id int, x int, y int, " + ", ".join(f"{b} int" for b in BANDS) + ", scl int"


def _scene(spark, sid, xs, value=100, odd=None):
    rows = [(2000, sid, x, 0, *([9000] * 6 if x == odd else [value + x % 7] * 6), 4) for x in xs]
    return spark.createDataFrame(rows, SCHEMA)


def _pixels(df):
    return sorted(tuple(r) for r in df.select("scene_id", "x", "y", *BANDS).collect())


def test_parts_merge_and_replace(spark):
    path = new_scratch_path(spark, "store")
    write_scenes(_scene(spark, 1, range(30)).unionByName(_scene(spark, 2, range(30))), path, "a")
    write_scenes(_scene(spark, 1, range(30, 60), value=5000), path, "b")       # wrong values
    right = _scene(spark, 1, range(30, 60), odd=40)
    write_scenes(right, path, "b")                                             # replaced
    whole = _scene(spark, 1, range(30)).unionByName(_scene(spark, 2, range(30))).unionByName(right)
    assert _pixels(read_pixels(spark, path)) == _pixels(whole)
    key = lambda r: r["scene_id"]
    want = sorted(scene_moments(whole).collect(), key=key)
    assert sorted(read_moments(spark, path).collect(), key=key) == want
    assert _pixels(masked_scenes(spark, path)) == _pixels(outlier_mask(whole))
    assert [r["x"] for r in masked_scenes(spark, path).filter("nir is null").collect()] == [40]
    assert unmeasured(spark, path).count() == 0


def test_second_scene_of_a_part_keeps_the_first(spark):
    path = new_scratch_path(spark, "store")
    write_scenes(_scene(spark, 1, range(5)), path, "a")
    write_scenes(_scene(spark, 2, range(4)), path, "a")
    assert {r["scene_id"]: r["red_n"] for r in read_moments(spark, path).collect()} == {1: 5, 2: 4}


def test_broken_write_is_named(spark):
    path = new_scratch_path(spark, "store")
    write_scenes(_scene(spark, 1, range(5)).unionByName(_scene(spark, 2, range(5))), path, "a")
    lost = spark.read.parquet(f"{path}/{MOMENTS}").filter("scene_id = 2").withColumn("write_id", F.lit("an earlier one")).toPandas()
    (spark.createDataFrame(lost).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("part", "scene_id").parquet(f"{path}/{MOMENTS}"))
    assert [tuple(r) for r in unmeasured(spark, path).collect()] == [("a", 2)]
    write_scenes(_scene(spark, 2, range(5)), path, "a")
    assert unmeasured(spark, path).count() == 0


def test_one_scan_of_the_pixels(spark):
    path = new_scratch_path(spark, "store")
    write_scenes(_scene(spark, 1, range(50)), path)
    physical = masked_scenes(spark, path)._jdf.queryExecution().sparkPlan().toString()
    assert physical.count("/pixels]") == 1 and physical.count("/moments]") == 1


def test_fractions_nulls_and_no_rows(spark):
    bands = ("red", "nir")
    values = [(1, "a", 0.25, None), (1, "a", 1e6 + 0.5, None), (1, "b", 3.75, 2.0), (1, "b", None, None), (2, "b", None, None)]
    df = spark.createDataFrame(values, "scene_id int, part string, red double, nir double")
    got = {r["scene_id"]: r for r in merged_moments(scene_moments(df, ("part", "scene_id"), bands), ("scene_id",), bands).collect()}
    red = [0.25, 1e6 + 0.5, 3.75]
    assert got[1]["red_n"] == 3 and math.isclose(got[1]["red_mean"], statistics.fmean(red)) and math.isclose(got[1]["red_std"], statistics.pstdev(red))
    assert (got[1]["nir_n"], got[1]["nir_mean"], got[1]["nir_std"]) == (1, 2.0, 0.0)
    assert got[2]["red_n"] == 0 and got[2]["red_mean"] is None and got[2]["red_std"] is None


@pytest.mark.parametrize("sid", [None, 3])
def test_empty_and_nameless_rows_store_nothing_wrong(spark, sid):
    path = new_scratch_path(spark, "store")
    write_scenes(_scene(spark, 1, range(3)), path, "a")
    extra = _scene(spark, 3, range(2)).withColumn("scene_id", F.lit(sid).cast("int"))
    write_scenes(extra if sid is None else extra.limit(0), path, "b")
    assert {r["scene_id"] for r in read_moments(spark, path).collect()} == {1}
