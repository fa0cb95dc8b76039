"""Quadtree join, areas by edges, inverse projection."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixtrend.functions import geo as G
from pixtrend.operators import quadtree as Q
from pixtrend.operators import spatial as S

BOXES = "west double, south double, east double, north double"


def boxes(rng, n, small=0.01, large=200.0):
    out = []
    for i in range(n):
        w, h = np.exp(rng.uniform(math.log(small), math.log(large), 2)).tolist()
        x, y = float(rng.uniform(-180, 180)), float(rng.uniform(-90, 90))
        out.append((i, x, y, x + w, y + min(h, 90)))
    return out


def touch(a, b):
    return {(i[0], j[0]) for i in a for j in b if max(i[1], j[1]) <= min(i[3], j[3]) and max(i[2], j[2]) <= min(i[4], j[4])}


def joined(spark, a, b, **kw):
    l = spark.createDataFrame(a, f"l_id int, {', '.join('l_' + c.strip() for c in BOXES.split(','))}")
    r = spark.createDataFrame(b, f"r_id int, {', '.join('r_' + c.strip() for c in BOXES.split(','))}")
    return Q.touching(l, r, "l_", "r_", **kw)


@pytest.mark.parametrize("part_rows", [2_000, 3])
def test_quadtree_pairs_equal_all_pairs(spark, part_rows):
    rng = np.random.default_rng(7)
    a, b = boxes(rng, 120), boxes(rng, 90, 0.5, 4.0)
    a += [(900, 0.0, 0.0, 0.0, 0.0), (901, 45.0, 22.5, 90.0, 45.0), (902, None, 0.0, 1.0, 1.0)]
    b += [(900, 0.0, 0.0, 0.0, 0.0), (901, -180.0, -90.0, 180.0, 90.0), (902, 90.0, 45.0, 91.0, 46.0)]
    got = [(r["l_id"], r["r_id"]) for r in joined(spark, a, b, part_rows=part_rows).collect()]
    assert len(got) == len(set(got))
    assert set(got) == touch([x for x in a if x[1] is not None], b)


def test_one_cell_with_all_boxes_is_split(spark):
    rng = np.random.default_rng(1)
    a = [(i, 10.0 + float(rng.random()) / 100, 10.0, 10.5, 10.4) for i in range(4000)]
    b = [(i, 10.0, 10.0, 10.5, 10.4) for i in range(20)]
    out = joined(spark, a, b, part_rows=100)
    assert out.count() == 80_000
    la = spark.createDataFrame(a, f"l_id int, {', '.join('l_' + c.strip() for c in BOXES.split(','))}")
    la = Q._cells(Q.with_level(la, "l_"), "l_", F.array("l_level"))
    n = la.select(F.count(F.lit(1))).scalar()
    dealt = Q._dealt(la, Q._hot(la, n, "_pa", 100), "_pa", True)
    sizes = [r["count"] for r in dealt.groupBy(*Q.KEY, "_pa_at").count().collect()]
    assert max(sizes) < 10 * sorted(sizes)[len(sizes) // 2] and max(sizes) < 200


def test_large_boxes_post_few_cells(spark):
    a = spark.createDataFrame([(1, -180.0, -90.0, 180.0, 90.0), (2, 1.0, 1.0, 1.001, 1.002)], f"l_id int, {', '.join('l_' + c.strip() for c in BOXES.split(','))}")
    n = Q._cells(Q.with_level(a, "l_"), "l_", F.array("l_level")).groupBy("l_id").count().collect()
    assert all(r["count"] <= 4 for r in n)


def ring(*points):
    return [(float(x), float(y)) for x, y in points]


def inside(poly, x, y):
    hit = False
    for r in poly:
        for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                hit = not hit
    return hit


def overlap(spark, p, q):
    pts = "array<array<struct<x:double,y:double>>>"
    df = spark.createDataFrame([(p, q)], f"p {pts}, q {pts}").select(G.rings_edges("p").alias("pe"), G.rings_edges("q").alias("qe"))
    df = df.select(G.edges_area_signed("pe").alias("pa"), G.edges_area_signed("qe").alias("qa"), F.explode("pe").alias("e"), "qe").select("pa", "qa", "e", F.explode("qe").alias("f"))
    r = G.trapezoid_overlap(df, "e", "f").groupBy("pa", "qa").agg(F.sum("overlap").alias("o")).first()
    return r["o"] * np.sign(r["pa"]) * np.sign(r["qa"]), abs(r["pa"]), abs(r["qa"])


SQUARE = [ring((0, 0), (4, 0), (4, 4), (0, 4))]
HOLED = [ring((1, 1), (6, 1), (6, 6), (1, 6)), ring((2, 2), (2, 3), (3, 3), (3, 2))]
CONCAVE = [ring((0, 0), (5, 0), (5, 5), (2.5, 1), (0, 5))]
PARTS = [ring((0, 0), (1, 0), (1, 1), (0, 1)), ring((3, 3), (5, 3), (5, 5), (3, 5))]


@pytest.mark.parametrize("p,q,area", [
    (SQUARE, SQUARE, 16.0), (SQUARE, HOLED, 8.0), (HOLED, SQUARE, 8.0), (SQUARE, [ring((5, 5), (6, 5), (6, 6))], 0.0),
    (SQUARE, PARTS, 2.0), (HOLED, HOLED, 24.0), (SQUARE, [SQUARE[0][::-1]], 16.0), ([SQUARE[0] + SQUARE[0][:1]], HOLED, 8.0),
    (SQUARE, [ring((4, 0), (8, 0), (8, 4), (4, 4))], 0.0), (SQUARE, [ring((-1, 2), (5, 2), (5, 9), (-1, 9))], 8.0)])
def test_overlap_of_known_shapes(spark, p, q, area):
    got, pa, qa = overlap(spark, p, q)
    assert got == pytest.approx(area, abs=1e-12)


def test_overlap_of_random_shapes_against_a_grid(spark):
    rng = np.random.default_rng(5)
    for shape in (CONCAVE, HOLED):
        other = [ring(*(rng.random((5, 2)) * 0.2 + [[0, 0], [4, 1], [5, 4], [2, 5], [2, 2]]))]
        got, _, _ = overlap(spark, shape, other)
        n = 160
        c = (np.arange(n) + 0.5) / n * 7 - 0.5
        hits = sum(inside(shape, x, y) and inside(other, x, y) for x in c for y in c)
        assert got == pytest.approx(hits * (7 / n) ** 2, rel=0.03)


def test_coverage_of_holes_parts_and_concave_footprints(spark):
    w, s, e, n = -153.5, 20.0, -153.3, 20.2
    mid = (w + e) / 2

    def box(a, b, c, d):
        return [(a, b), (c, b), (c, d), (a, d)]
    rows = [(1, w, s, e, n, [box(w - 1, s - 1, e + 1, n + 1)]), (2, w, s, mid, n, [box(w, s, mid, n)]),
            (3, w, s, e, n, [box(w - 1, s - 1, e + 1, n + 1), box(w, s, mid, n)[::-1]]), (4, w, s, e, n, [box(w, s, w + 0.05, n), box(mid, s, e, n)]),
            (5, w, s, e, n, []), (6, w, s, e, n, None), (7, e + 3, s, e + 4, n, [box(e + 3, s, e + 4, n)])]
    scenes = spark.createDataFrame(rows, f"item_id int, {BOXES}, rings array<array<struct<x:double,y:double>>>")
    aoi = spark.createDataFrame([(1, w, s, e, n)], f"aoi_id int, {BOXES}")
    got = {r["item_id"]: r["coverage_ratio"] for r in S.aoi_coverage(scenes, aoi).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    for item, ratio in ((1, 1.0), (2, 0.5), (3, 0.5), (4, 0.75), (5, 0.0), (6, 0.0)):
        assert got[item] == pytest.approx(ratio, abs=2e-4)
    assert {r["item_id"] for r in S.aoi_coverage(scenes, aoi, min_ratio=0.4).collect()} == {1, 2, 3, 4}


def test_inverse_projection_is_within_a_millimetre(spark):
    pts = [(lon, lat, 32600 + int((lon + 180) // 6) + 1 + (100 if lat < 0 else 0)) for lon in (-179.9, -153.2, -150.0, -0.5, 3.0, 5.99, 104.7, 179.5) for lat in (-79.9, -33.3, -0.001, 0.0, 20.0, 45.5, 70.7, 83.9)]
    pts += [(-150.2, 20.0, 32606), (-149.9, 20.0, 32605), (8.9, 60.0, 32631)]  # a neighbour's zone
    df = spark.createDataFrame(pts, "lon0 double, lat0 double, epsg int")
    df = df.withColumn("p", G.utm_xy("lon0", "lat0", "epsg")).select("lon0", "lat0", "epsg", "p.x", "p.y")
    for r in G.with_lonlat(df, "x", "y", F.col("epsg")).collect():
        east = (r["lon"] - r["lon0"]) * math.cos(math.radians(r["lat0"])) * 111_320
        north = (r["lat"] - r["lat0"]) * 111_320
        assert abs(east) < 1e-3 and abs(north) < 1e-3
