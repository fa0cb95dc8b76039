"""Footprints and AOIs of a cell are paired inside its task: the same ratios as pair by pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixtrend.operators import quadtree as Q
from pixtrend.operators import spatial as S

SCENE = "item_id long, west double, south double, east double, north double, rings array<array<struct<x:double,y:double>>>"
AOI = "aoi_id long, west double, south double, east double, north double"


def _star(rng, x, y, r):
    """A ring around (x, y), concave, in either direction."""
    ring = [(x + r * f * math.cos(t), y + r * f * math.sin(t)) for k in range(rng.randint(3, 9)) for t, f in [(k * 0.68, rng.uniform(0.3, 1.0))]]
    return ring if rng.random() < 0.5 else ring[::-1]


def _scenes(spark, n=120):
    rng, rows = random.Random(5), []
    for i in range(n):
        x, y, r = rng.uniform(-8, 8), rng.uniform(-5, 5), rng.choice([0.1, 0.6, 2.0, 3.0])
        ring = _star(rng, x, y, r)
        rings = [ring, [(x + (px - x) / 4, y + (py - y) / 4) for px, py in ring[::-1]]] if i % 3 == 0 else [ring, None] if i % 7 == 0 else [ring[:2] + [(None, 1.0)] + ring[2:]] if i % 11 == 0 else [ring]
        rows.append((i if i else None, x - r, y - r, x + r, y + r, rings if i % 13 else None))
    return spark.createDataFrame(rows, SCENE)


def _aois(spark):
    rng = random.Random(6)
    rows = [(i, w, s, w + d, s + d) for i in range(150) for w, s, d in [(rng.uniform(-8, 8), rng.uniform(-5, 5), rng.choice([0.05, 0.5, 3.0]))]]
    return spark.createDataFrame([*rows, (None, 0.0, 0.0, 0.5, 0.5), (900, 1.0, 1.0, 1.0, 1.0), (901, None, 0.0, 1.0, 1.0)], AOI)


def _rows(df):
    return {(r["aoi_id"], r["item_id"], r["epsg"]): r["coverage_ratio"] for r in df.collect()}


@pytest.mark.parametrize("part_rows,pairs", [(Q.PART_ROWS, Q.PAIRS), (3, 7)])
def test_as_summed_pair_by_pair(spark, monkeypatch, part_rows, pairs):
    monkeypatch.setattr(Q, "PAIRS", pairs)
    scenes, aois = _scenes(spark), _aois(spark)
    empty = scenes.withColumn("rings", F.array().cast(scenes.schema["rings"].dataType))  # ids that come again are summed by pair
    got, summed = _rows(S.aoi_coverage(scenes, aois, part_rows=part_rows)), _rows(S.aoi_coverage(scenes.unionByName(empty), aois))
    assert set(got) == set(summed) and len(got) > 1000 and len({e for _, _, e in got}) > 2
    assert all(got[k] == pytest.approx(summed[k], abs=1e-7) for k in got)
    assert 0 < sum(0.01 < v < 0.99 for v in got.values()) and any(v > 0.999 for v in got.values()) and any(v == 0 for v in got.values())


def test_no_pair_is_made_by_a_join(spark):
    plan = S.aoi_coverage(_scenes(spark), _aois(spark))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_touching_rows_equal_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(20):
        a, b = (np.column_stack([w, s, w + rng.choice([0.0, 1.0, 2.5], n), s + rng.choice([0.0, 1.0, 2.5], n)]) for n in (40, 30) for w, s in [rng.integers(0, 8, (2, n)).astype(float)])
        a = a[np.argsort(a[:, 1], kind="stable")]
        got = [p for i, j in Q.touching_rows(a, b, (4.0, 0, 1)) for p in zip(i.tolist(), j.tolist(), strict=True)]
        want = [(i, j) for i, u in enumerate(a) for j, v in enumerate(b) for w, s in [np.maximum(u[:2], v[:2])] if w <= min(u[2], v[2]) and s <= min(u[3], v[3]) and w // 4 == 0 and s // 4 == 1]
        assert sorted(got) == want and want
