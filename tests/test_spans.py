"""Scanline spans against even-odd ray casting at every pixel centre."""

import numpy as np

from pixtrend.operators.spans import clip_polygons, polygon_spans

RINGS = "array<array<struct<x:double,y:double>>>"


def inside(rings, x, y):
    hit = False
    for r in rings or []:
        for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                hit = not hit
    return hit


def shapes():
    rng = np.random.default_rng(4)
    out = [[[(0.0, 0.0), (40.0, 0.0), (40.0, 40.0), (0.0, 40.0)], [(10.0, 10.0), (10.0, 30.0), (30.0, 30.0), (30.0, 10.0)]],
           [[(5.0, 5.0), (35.0, 5.0), (35.0, 35.0), (5.0, 35.0)]],                # edges through pixel centres
           [[(-33.0, -21.0), (250.0, -20.0), (-30.0, 260.0)]], [[(0.0, 3.0), (9.0, 3.0), (5.0, 3.0)]], [], None, [[]],
           [[(0.0, 0.0), (50.0, 50.0), (50.0, 0.0), (0.0, 50.0)]]]                 # crosses itself
    out += [[[tuple(p) for p in (rng.random((int(rng.integers(3, 9)), 2)) * 300 - 40).tolist()] for _ in range(int(rng.integers(1, 4)))] for _ in range(30)]
    return out


def test_spans_hold_the_centres_inside(spark):
    polys = shapes()
    spans = polygon_spans(spark.createDataFrame(list(enumerate(polys)), f"poly_id int, rings {RINGS}")).collect()
    got = [(r["poly_id"], x, r["y"]) for r in spans for x in range(r["x0"], r["x1"] + 1)]
    assert len(got) == len(set(got))
    assert set(got) == {(i, x, y) for i, p in enumerate(polys) for x in range(-6, 28) for y in range(-6, 28) if inside(p, x * 10 + 5.0, y * 10 + 5.0)}


def test_clip_keeps_columns_and_multiplicity(spark):
    polys = shapes()
    px = [(x, y, f"s{x % 3}", x * y, "clash") for x in range(-3, 26) for y in range(-3, 26)] + [(0, 0, "again", 7, None)]
    df = spark.createDataFrame(px, "x int, y int, scene_id string, v int, x0 string")
    got = clip_polygons(df, spark.createDataFrame(list(enumerate(polys)), f"poly_id int, rings {RINGS}"))
    assert got.columns == ["poly_id", *df.columns]
    want = [(i, *p) for i, r in enumerate(polys) for p in px if inside(r, p[0] * 10 + 5.0, p[1] * 10 + 5.0)]
    assert sorted(map(str, [tuple(r) for r in got.collect()])) == sorted(map(str, want))


def test_a_join_on_rows_and_blocks_without_vertex_predicates(spark):
    df = spark.range(5000).selectExpr("cast(id % 100 as int) as x", "cast(id div 100 as int) as y")
    polys = spark.createDataFrame(list(enumerate(shapes())), f"poly_id int, rings {RINGS}")
    plan = clip_polygons(df, polys)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and plan.count("Join Inner") == 1 and "_block" in plan
