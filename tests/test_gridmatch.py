"""Grid matching against a plain numpy gather."""

import numpy as np
import pytest

from pixtrend.operators.gridmatch import Grid, match_bilinear, match_nearest

PAIRS = [(Grid(20), Grid(10)), (Grid(60), Grid(10, 5, -15)), (Grid(60, 7, 3), Grid(20)), (Grid(10), Grid(10)), (Grid(10), Grid(10, 3, 0)),
         (Grid(10), Grid(25, 5, 5)), (Grid(10), Grid(60, -20, 10)), (Grid(15, -4, 9), Grid(10, 100, 1)), (Grid(7), Grid(3))]


def centres(grid, index, axis):
    return grid.origin(axis) + (np.asarray(index) + 0.5) * grid.res


def window(cells, source, target, axis):
    lo, hi = min(cells), max(cells) + 1
    a, b = source.origin(axis) + lo * source.res, source.origin(axis) + hi * source.res
    t = np.arange(-2000, 2000)
    c = centres(target, t, axis)
    return t[(c >= a) & (c < b)]


def expected(cells, source, target):
    """{(x, y): value} by weights of centre distances in metres."""
    reach = max(source.res, target.res)
    out = {}
    for x in window([k[0] for k in cells], source, target, "x"):
        for y in window([k[1] for k in cells], source, target, "y"):
            num = den = 0.0
            for (sx, sy), v in cells.items():
                w = max(0, reach - abs(centres(source, sx, "x") - centres(target, x, "x"))) * max(0, reach - abs(centres(source, sy, "y") - centres(target, y, "y")))
                if w > 0 and v is not None:
                    num, den = num + w * v, den + w
            if den:
                out[int(x), int(y)] = num / den
    return out


@pytest.fixture(scope="module")
def cells():
    rng = np.random.default_rng(3)
    keep = {(x, y): int(rng.integers(1, 9000)) for x in range(-3, 5) for y in range(2, 8) if rng.random() > 0.15}
    return {k: (None if rng.random() < 0.1 else v) for k, v in keep.items()}


@pytest.mark.parametrize("source,target", PAIRS)
@pytest.mark.parametrize("kind", ["int", "double"])
def test_bilinear(spark, cells, source, target, kind):
    scale = 1 if kind == "int" else 0.125
    rows = [("a", x, y, None if v is None else (v if kind == "int" else v * scale), "other") for (x, y), v in cells.items()] + [("b", 0, 0, 7 if kind == "int" else 7.0, "other")]
    df = spark.createDataFrame(rows, f"scene_id string, sx int, sy int, v {kind}, more string")
    got = match_bilinear(df, ["v"], source, target).collect()
    want = expected(cells, source, target)
    a = {(r["x"], r["y"]): r["v"] for r in got if r["scene_id"] == "a"}
    assert set(a) == set(want)
    assert all(abs(a[k] - want[k] * scale) < 1e-9 for k in want)
    assert {r["v"] for r in got if r["scene_id"] == "b"} <= {7.0}


@pytest.mark.parametrize("source,target", PAIRS)
def test_nearest(spark, cells, source, target):
    df = spark.createDataFrame([("a", x, y, v) for (x, y), v in cells.items()], "scene_id string, sx int, sy int, v int")
    got = {(r["x"], r["y"]): r["v"] for r in match_nearest(df, ["v"], source, target).collect()}
    want = {}
    for x in window([k[0] for k in cells], source, target, "x"):
        for y in window([k[1] for k in cells], source, target, "y"):
            s = tuple(int(np.floor((centres(target, i, a) - source.origin(a)) / source.res)) for i, a in ((x, "x"), (y, "y")))
            if s in cells:
                want[int(x), int(y)] = cells[s]
    assert got == want


def test_extent_and_empty(spark):
    df = spark.createDataFrame([("a", 0, 0, 4), ("a", 1, 0, 8)], "scene_id string, sx int, sy int, v int")
    ext = spark.createDataFrame([("a", 1, 2, 0, 0)], "scene_id string, x0 int, x1 int, y0 int, y1 int")
    got = {(r["x"], r["y"]): r["v"] for r in match_bilinear(df, ["v"], Grid(20), Grid(10), extent=ext).collect()}
    assert got == {(1, 0): 5.0, (2, 0): 7.0}
    assert match_bilinear(df.limit(0), ["v"], Grid(20), Grid(10)).collect() == []


def test_one_shuffle_of_four_rows_a_cell(spark):
    df = spark.range(40_000).selectExpr("'a' as scene_id", "cast(id % 200 as int) as sx", "cast(id div 200 as int) as sy", "cast(id as int) as v")
    plan = match_bilinear(df, ["v"], Grid(60), Grid(10))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1 and "Python" not in plan
