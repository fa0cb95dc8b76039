"""Random small stacks: Spark reducers against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixtrend.constants import BANDS
from pixtrend.operators.mosaic import median_mosaic, quantile_mosaic
from pixtrend.operators.trend import linear_trend


def _stack(seed, n_px=40, n_sc=9, p_missing=0.3):
    rng = np.random.default_rng(seed)
    vals = rng.integers(1, 10001, size=(n_sc, n_px)).astype(float)
    vals[rng.random((n_sc, n_px)) < p_missing] = np.nan
    return vals


def _df(spark, vals):
    n_sc, n_px = vals.shape
    rows = []
    for s in range(n_sc):
        for p in range(n_px):
            v = None if np.isnan(vals[s, p]) else int(vals[s, p])
            rows.append((2000, s, p, 0, *([v] * 6)))
    return spark.createDataFrame(rows, "year int, scene_id int, x int, y int, "
                                 + ", ".join(f"{b} int" for b in BANDS))


@pytest.mark.parametrize("seed", [1, 2])
def test_median_matches_numpy(spark, seed):
    vals = _stack(seed)
    got = {r["x"]: r["blue"] for r in median_mosaic(_df(spark, vals), pack=False).collect()}
    with np.errstate(all="ignore"):
        import warnings
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            exp = np.nanmedian(vals, axis=0)
    for p in range(vals.shape[1]):
        if np.isnan(exp[p]):
            assert got[p] is None
        else:
            assert got[p] == pytest.approx(exp[p])


@pytest.mark.parametrize("method", ["nearest", "lower", "higher", "midpoint", "linear"])
@pytest.mark.parametrize("q", [0.25, 0.5, 0.75])
def test_quantile_matches_numpy(spark, method, q):
    vals = _stack(7)
    out = quantile_mosaic(_df(spark, vals), {"blue": q}, method=method, pack=False)
    got = {r["x"]: r["blue"] for r in out.collect()}
    for p in range(vals.shape[1]):
        col = vals[:, p][~np.isnan(vals[:, p])]
        if len(col) == 0:
            assert got[p] is None
        else:
            assert got[p] == pytest.approx(np.quantile(col, q, method=method))


def test_trend_matches_polyfit(spark):
    rng = np.random.default_rng(3)
    rows, exp = [], {}
    for p in range(30):
        years = sorted(rng.choice(np.arange(2015, 2025), size=rng.integers(2, 9), replace=False))
        ys = rng.integers(-30_000_000, 60_000_000, size=len(years))
        rows += [(int(yr), p, 0, int(v)) for yr, v in zip(years, ys)]
        exp[p] = np.polyfit(np.array(years, float), ys / 1e8, 1)[0] * 10
    df = spark.createDataFrame(rows, "year int, x int, y int, v_e8 bigint")
    got = {r["x"]: r["v_slope"] for r in linear_trend(df, values=["v"]).collect()}
    for p, e in exp.items():
        assert got[p] == pytest.approx(e, rel=1e-9, abs=1e-12)


def test_median_of_constant_line_is_line(spark):
    vals = np.tile(np.arange(1, 41, dtype=float), (5, 1))
    got = median_mosaic(_df(spark, vals)).agg(F.sum(F.col("blue") - F.col("x") - 1)).first()[0]
    assert got == 0
