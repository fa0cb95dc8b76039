"""Scenes of two zones on one grid: against positions computed in plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from pixtrend.functions import geo as G
from pixtrend.operators.gridmatch import Grid
from pixtrend.operators.reproject import grid_cells, located, reproject

TARGET, SOURCE = Grid(10, 812_000, 2_214_000), Grid(20, 184_000, 2_213_800)
ZONES = {32605: Grid(20, 812_000, 2_214_000), 32606: SOURCE}


def test_located_round_trips_through_lonlat(spark):
    at = located(grid_cells(spark, 0, 9, -2, 3), TARGET, 32605, ZONES)
    rows = at.where("epsg = 32606").collect()
    assert len(rows) == 60
    back = spark.createDataFrame([(r["x"], r["y"], SOURCE.x0 + r["u"] * 20, SOURCE.y0 + r["v"] * 20) for r in rows], "x int, y int, e double, n double")
    back = G.with_lonlat(back, "e", "n", F.lit(32606))
    back = G.with_utm(back, {"p": ("lon", "lat")}, F.lit(32605)).collect()
    for r in back:
        assert abs(r["p"]["x"] - (TARGET.x0 + (r["x"] + 0.5) * 10)) < 1e-3 and abs(r["p"]["y"] - (TARGET.y0 + (r["y"] + 0.5) * 10)) < 1e-3
    same = {(r["x"], r["y"]): (r["u"], r["v"]) for r in at.where("epsg = 32605").collect()}
    assert same[4, -2] == (2.25, -0.75)


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_a_plane_stays_a_plane(spark, method):
    """Values that are linear in the source cell come out linear in the position."""
    at = {(r["x"], r["y"]): (r["u"], r["v"]) for r in located(grid_cells(spark, 0, 19, 0, 9), TARGET, 32605, {32606: SOURCE}).collect()}
    us, vs = [u for u, _ in at.values()], [v for _, v in at.values()]
    cells = [(7, 32606, sx, sy, 3 * sx + 5 * sy, None) for sx in range(math.floor(min(us)) - 1, math.ceil(max(us)) + 2) for sy in range(math.floor(min(vs)) - 1, math.ceil(max(vs)) + 2)]
    cells += [(8, 32607, 0, 0, 1, 1)]
    df = spark.createDataFrame(cells, "scene_id int, epsg int, sx int, sy int, a int, b int")
    got = {(r["x"], r["y"]): r["a"] for r in reproject(df, ["a", "b"], grid_cells(spark, 0, 19, 0, 9), TARGET, 32605, {32606: SOURCE}, method=method).collect()}
    assert set(got) == set(at)
    for k, (u, v) in at.items():
        want = 3 * math.floor(u) + 5 * math.floor(v) if method == "nearest" else 3 * (u - 0.5) + 5 * (v - 0.5)
        assert got[k] == pytest.approx(want, abs=1e-6)


def test_missing_cells_and_nulls_are_left_out(spark):
    at = located(grid_cells(spark, 0, 0, 0, 0), TARGET, 32605, {32606: SOURCE}).first()
    bx, by = math.floor(at["u"] - 0.5), math.floor(at["v"] - 0.5)
    df = spark.createDataFrame([(1, 32606, bx, by, 10), (1, 32606, bx + 1, by, None), (2, 32606, bx + 40, by, 3)], "scene_id int, epsg int, sx int, sy int, a int")
    got = reproject(df, ["a"], grid_cells(spark, 0, 0, 0, 0), TARGET, 32605, {32606: SOURCE}, method="bilinear").collect()
    assert [(r["scene_id"], r["a"]) for r in got] == [(1, 10.0)]
    assert reproject(df, ["a"], grid_cells(spark, 0, -1, 0, 5), TARGET, 32605, {32606: SOURCE}).collect() == []
    with pytest.raises(ValueError):
        reproject(df, ["a"], grid_cells(spark, 0, 0, 0, 0), TARGET, 32605, {32606: SOURCE}, method="cubic")
