"""Grid matching tile by tile: values across tile edges, and what is shuffled."""

import pytest

from pixtrend.operators.gridmatch import Grid, match_bilinear


def ramp(spark):
    """A value that rises by one a column, over several tiles and to both sides of 0."""
    return spark.range(140 * 3).selectExpr("cast(1 + id div 1000 as int) as scene_id", "cast(id % 140 - 70 as int) as sx", "cast(id div 140 - 1 as int) as sy", "cast(id % 140 as int) as v")


@pytest.mark.parametrize("target", [Grid(10), Grid(40)])
def test_ramp_across_tiles(spark, target):
    got = match_bilinear(ramp(spark), ["v"], Grid(20), target).collect()
    cells = {(r["x"], r["y"]) for r in got}
    assert len(got) == len(cells) == 140 * 3 * 400 // target.res ** 2 + (35 if target.res == 40 else 0)
    inner = [r for r in got if -60 * 20 // target.res <= r["x"] < 60 * 20 // target.res]
    # the value at a centre, in source columns
    assert all(abs(r["v"] - ((r["x"] + 0.5) * target.res / 20 + 69.5)) < 1e-9 for r in inner)


@pytest.mark.parametrize("target", [Grid(10), Grid(40)])
def test_cells_are_shuffled_once_and_by_tile(spark, target):
    extent = spark.createDataFrame([(1, -500, 500, -500, 500)], "scene_id int, x0 int, x1 int, y0 int, y1 int")
    plan = match_bilinear(ramp(spark), ["v"], Grid(20), target, extent=extent)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(scene_id" in plan and "_tx" in plan.split("Exchange hashpartitioning")[1].split(")")[0]
    assert "SortMergeJoin" not in plan
