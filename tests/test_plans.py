"""Physical-plan properties the design relies on."""

import re

import __spark_entry__ as E
from pixtrend.sources import fixtures as fx
from pixtrend.plans.trend_map import trend_map

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_outside_the_classifier_hook(spark):
    for name, q in E.queries().items():
        if name in ("classify_tiles", "write_mosaic", "read_scenes", "mask_scenes_stream"):
            continue
        p = plan(q(spark, SF))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name
        assert "FlatMapGroupsInPandas" not in p, name


def test_classifier_runs_as_grouped_arrow(spark):
    assert "FlatMapGroupsInPandas" in plan(E.queries()["classify_tiles"](spark, SF))


def test_trend_map_has_one_pixel_exchange(spark):
    # build on a pre-aggregated stack so only the pipeline's own exchanges count
    obs = spark.read.parquet(_written_obs(spark))
    p = trend_map(obs)._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1, p


def _written_obs(spark):
    from pixtrend.session import new_scratch_path

    path = new_scratch_path(spark, "obs-plan")
    fx.obs(spark, SF).write.parquet(path)
    return path


def test_sigma_mask_broadcasts_statistics(spark):
    df = E.queries()["outlier_mask"](spark, SF)  # lazily planned; the measured size decides
    df.collect()
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_search_filters_reach_the_scan(spark):
    from pixtrend.sources.catalog import search_scenes

    path = _written_scenes(spark)
    df = search_scenes(spark.read.parquet(path), "1997-07-01", "1997-08-31", "MGRS-3", 70)
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in s and "cloud_cover" in s.split("PushedFilters")[1]


def _written_scenes(spark):
    from pixtrend.session import new_scratch_path

    path = new_scratch_path(spark, "scenes-plan")
    fx.scenes(spark, SF).drop("ring").write.parquet(path)
    return path


def test_clip_prunes_columns_and_rows_at_scan(spark):
    from pixtrend.plans.registry import clip_bounds

    obs = spark.read.parquet(_written_obs(spark))
    df = clip_bounds(obs, (300.0, 15.0, 1234.0, 77.0)).select("x", "y", "blue")
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:int,y:int,blue:int>" in s or "struct<x:int,y:int,blue:int>" in s
    assert "GreaterThanOrEqual(x" in s


def test_hot_scene_is_combined_before_the_shuffle(spark):
    """One scene holds most rows: its statistics are partial aggregates before
    any exchange, and the pixel side is never shuffled by scene."""
    from pyspark.sql import functions as F

    from pixtrend.operators.masks import outlier_mask

    hot = spark.range(0, 30000).select(F.lit(1).alias("scene_id"), (F.col("id") % 200).cast("int").alias("x"),
                                       (F.col("id") / 200).cast("int").alias("y"))
    cold = spark.range(0, 300).select((F.col("id") % 30 + 2).cast("int").alias("scene_id"),
                                      (F.col("id") % 10).cast("int").alias("x"), F.lit(0).alias("y"))
    df = hot.unionByName(cold).withColumns({b: ((F.col("x") * 37 + F.col("y")) % 997 + 1).cast("int")
                                            for b in ("blue", "green", "red", "nir", "swir1", "swir2")})
    out = outlier_mask(df)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p
    assert "Exchange hashpartitioning(scene_id" not in p.split("BroadcastExchange")[0]
    assert out.count() == 30300


def test_trend_map_quantile_reducer_keeps_one_exchange(spark):
    obs = spark.read.parquet(_written_obs(spark))
    p = trend_map(obs, reducer="quantile")._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1, p


def _exchanges(spark, df):
    return len(re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_band_stack_needs_one_exchange(spark):
    from pixtrend.operators.mosaic import band_stack

    path = _written_obs(spark)
    long = spark.read.parquet(path).unpivot(["scene_id", "x", "y"], ["blue", "nir"], "band", "v")
    assert _exchanges(spark, band_stack(long)) == 1


def test_missing_years_combines_before_the_shuffle(spark):
    from pixtrend.sources.catalog import missing_years

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = missing_years(spark.read.parquet(_written_obs(spark)), 1990, 2003)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # below the exchange of the pixels' years stands a partial aggregate
    assert re.search(r"Exchange hashpartitioning\(year#\d+.*\n.*HashAggregate", p), p


def test_season_reaches_the_scan(spark, tmp_path):
    from pixtrend.sources.catalog import season_filter

    fx.scenes(spark, SF).write.parquet(str(tmp_path / "s"))
    p = season_filter(spark.read.parquet(str(tmp_path / "s")), [1996, 1997])._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*)", p).group(1)
    assert "Or(" in pushed and "ts" in pushed
