"""Coverage is summed where the join makes a pair: no exchange of pairs, the same ratios."""

import random

import pytest
from pyspark.sql import functions as F

from pixtrend.functions import geo as G
from pixtrend.operators import spatial as S

SCENE = "item_id long, west double, south double, east double, north double, ring array<struct<x:double,y:double>>"
AOI = "aoi_id long, west double, south double, east double, north double"


def _scene(i, w, s):
    return (i, w, s, w + 4, s + 3, [(w, s), (w + 4, s), (w + 3, s + 2), (w, s + 3)])


def _tables(spark):
    rng = random.Random(3)
    scenes = [_scene(i, float(rng.randint(-8, 8)), float(rng.randint(-4, 4))) for i in range(60)]
    aois = [(i, w, s, w + 0.5, s + 0.5) for i in range(40) for w, s in [(rng.randint(-8, 10) + 0.25, rng.randint(-4, 5) + 0.25)]]
    return spark.createDataFrame(scenes, SCENE), spark.createDataFrame(aois, AOI)


def test_as_by_clipping_over_zones_and_hemispheres(spark):
    scenes, aois = _tables(spark)
    got = {(r["aoi_id"], r["item_id"]): (r["epsg"], r["coverage_ratio"]) for r in S.aoi_coverage(scenes, aois).collect()}
    a = aois.select("aoi_id", *[F.col(c).alias(f"a_{c}") for c in S.BOX]).withColumn("epsg", G.utm_epsg((F.col("a_west") + F.col("a_east")) / 2, (F.col("a_south") + F.col("a_north")) / 2))
    touch = (F.col("west") <= F.col("a_east")) & (F.col("a_west") <= F.col("east")) & (F.col("south") <= F.col("a_north")) & (F.col("a_south") <= F.col("north"))
    brute = scenes.crossJoin(a).where(touch).select("aoi_id", "item_id", "epsg", G.coverage_ratio("ring", *[f"a_{c}" for c in S.BOX], "epsg").alias("r")).collect()
    assert len(brute) == len(got) > 100 and len({e for e, _ in got.values()}) > 2
    assert all(got[r["aoi_id"], r["item_id"]] == (r["epsg"], pytest.approx(r["r"], abs=1e-9)) for r in brute)


def test_pairs_are_not_dealt_again(spark):
    scenes, aois = _tables(spark)
    plan = S.aoi_coverage(scenes, aois)._jdf.queryExecution().executedPlan().toString()
    assert "item_id" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning(aoi_id" in line)


def test_ids_that_come_again_count_as_one_polygon(spark):
    aois = spark.createDataFrame([(1, 0.25, 0.25, 0.75, 0.75)], AOI)
    halves = [(7, 0.0, 0.0, 1.0, 1.0, [(0.0, 0.0), (0.5, 0.0), (0.5, 1.0), (0.0, 1.0)]), (7, 0.5, 0.0, 1.0, 1.0, [(0.5, 0.0), (1.0, 0.0), (1.0, 1.0), (0.5, 1.0)]),
              _scene(8, -1.0, -1.0), (9, 0.0, 0.0, 1.0, 1.0, []), (10, 0.0, 0.0, 1.0, 1.0, None)]
    got = {r["item_id"]: r["coverage_ratio"] for r in S.aoi_coverage(spark.createDataFrame(halves, SCENE), aois).collect()}
    assert got == {7: pytest.approx(1.0, abs=1e-6), 8: pytest.approx(1.0, abs=1e-6), 9: 0.0, 10: 0.0}


def test_any_number_of_edges_in_a_batch(spark, monkeypatch):
    monkeypatch.setattr(S, "EDGE_PAIRS", 3)
    import pyarrow as pa

    box = [0.0, 0.0, 1.0, 0.0, 1.0, 0.0, 1.0, 1.0, 1.0, 1.0, 0.0, 1.0, 0.0, 1.0, 0.0, 0.0]
    x, y = G.utm_points(*[__import__("numpy").array([v]) for v in (0.0, 0.0, 32631)])
    n = 3
    batch = pa.RecordBatch.from_pydict({"aoi_id": [1] * n, "item_id": [1, 2, 3], "epsg": pa.array([32631] * n, pa.int32()), "a_area": [1.0] * n, "_ox": [x[0]] * n, "_oy": [y[0]] * n,
                                        "a_edges": pa.array([[v * 1e6 for v in box]] * n), "s_edges": pa.array([box, [], box])})
    (out,) = S._shared_areas(iter([batch]))
    both, area = out.column("_both").to_pylist(), out.column("_s_area").to_pylist()
    assert area[1] is None and both[1] == 0 and both[0] == both[2] == pytest.approx(area[0], rel=0.02)
