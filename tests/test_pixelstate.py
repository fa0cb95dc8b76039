"""Stored pixel states against the reducers on the whole stack."""

import numpy as np
import pytest

from pixtrend.constants import BANDS
from pixtrend.functions.indices import tasseled_cap
from pixtrend.operators import pixelstate as PS
from pixtrend.operators.mosaic import median_mosaic, quantile_mosaic
from pixtrend.operators.trend import linear_trend

SCHEMA = "year int, scene_id int, x int, y int, " + ", ".join(f"{b} int" for b in BANDS)


@pytest.fixture(scope="module")
def stack(spark):
    rng = np.random.default_rng(2)
    rows = []
    for year in range(1995, 2001):
        for scene in range(6):
            for x in range(4):
                if rng.random() < 0.8:
                    rows.append((year, year * 10 + scene, x, 0, *[None if rng.random() < 0.2 else int(rng.integers(0, 12000) if rng.random() < 0.8 else 500) for _ in BANDS]))
    rows += [(2001, 20010, 0, 0, *[None] * 6), (2001, 20011, 1, 0, 1, 2, 3, 4, 5, 6)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.select(sorted(df.columns)).collect())))


def test_scenes_added_and_taken_back(spark, stack, tmp_path):
    path = str(tmp_path / "state")
    PS.write_batch(PS.histogram(stack.where("scene_id % 10 < 4")), path, "first")
    for scene in (4, 5):
        PS.write_batch(PS.histogram(stack.where(f"scene_id % 10 = {scene}")), path, f"scene-{scene}")
    PS.write_batch(PS.histogram(stack.where("scene_id % 10 = 4")), path, "scene-4")  # again, after a failure
    state = PS.read_state(spark, path, PS.HISTOGRAM_SUMS)
    assert rows_of(PS.median_of(state)) == rows_of(median_mosaic(stack))
    assert rows_of(PS.median_of(state, pack=False)) == rows_of(median_mosaic(stack, pack=False))
    PS.write_batch(PS.negated(PS.histogram(stack.where("scene_id % 10 in (1, 5)")), PS.HISTOGRAM_SUMS), path, "taken-back")
    rest = stack.where("scene_id % 10 not in (1, 5)")
    state = PS.read_state(spark, path, PS.HISTOGRAM_SUMS)
    assert rows_of(PS.median_of(state)) == rows_of(median_mosaic(rest))
    PS.compact(spark, path, str(tmp_path / "compact"), PS.HISTOGRAM_SUMS)
    small = PS.read_state(spark, str(tmp_path / "compact"), PS.HISTOGRAM_SUMS)
    assert rows_of(small) == rows_of(state) and small.where("c <= 0").count() == 0
    q = {b: 0.25 for b in BANDS}
    assert rows_of(PS.quantile_of(state, q)) == rows_of(quantile_mosaic(rest, q, method="midpoint"))


def test_state_is_smaller_than_repeated_scenes(stack):
    many = stack.union(stack).union(stack)
    assert PS.histogram(many).count() == PS.histogram(stack).count()


def test_a_new_year_reads_that_year_only(spark, stack, tmp_path):
    path = str(tmp_path / "trend")
    tc = tasseled_cap(median_mosaic(stack), exact=True)
    PS.write_batch(PS.trend_state(tc.where("year < 1999")), path, "first")
    for year in (1999, 2000, 2001):
        PS.write_batch(PS.trend_state(tc.where(f"year = {year}")), path, str(year))
    got = PS.trend_of(PS.read_state(spark, path, PS.TREND_SUMS))
    assert rows_of(got) == rows_of(linear_trend(tc))
    PS.write_batch(PS.negated(PS.trend_state(tc.where("year = 1996")), PS.TREND_SUMS), path, "without-1996")
    assert rows_of(PS.trend_of(PS.read_state(spark, path, PS.TREND_SUMS))) == rows_of(linear_trend(tc.where("year <> 1996")))


def test_empty_state(spark, stack):
    assert PS.median_of(PS.histogram(stack.limit(0))).collect() == []
