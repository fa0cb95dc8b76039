"""Plans that must not depend on what a small input seems to make."""

from pyspark.sql import functions as F

from pixtrend.operators.spans import clip_polygons


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spans_are_not_sent_to_the_driver(spark):
    px = spark.range(4000).select((F.col("id") % 50).cast("int").alias("x"), F.floor(F.col("id") / 50).cast("int").alias("y"))
    ring = [(0.0, 0.0), (300.0, 0.0), (300.0, 300.0), (0.0, 300.0)]
    polys = spark.createDataFrame([(1, [ring])], "poly_id int, rings array<array<struct<x:double,y:double>>>")
    out = clip_polygons(px, polys)
    assert "BroadcastHashJoin" not in _plan(out)
    assert out.count() == 900
