"""Per-pixel linear trend over years and its 8-bit picture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixtrend.constants import SLOPE_SCALE
from pixtrend.functions.indices import TC_NAMES
from pixtrend.functions.pixel import stretch_u8

E8 = 100_000_000


def linear_trend(df: DataFrame, values=TC_NAMES, keys=("x", "y"), t: str = "year",
                 scale: int = SLOPE_SCALE, value_scale: int = E8, suffix: str = "_e8") -> DataFrame:
    """Least-squares slope of ``value`` against integer ``t`` per pixel.

    Input columns are ``{value}{suffix}`` integers equal to ``value * value_scale``
    (e.g. ``tcb_e8``).  The slope is ``(n*Sxy - Sx*Sy) / (n*Sxx - Sx^2)`` over
    the rows where the value is present, built from exact BIGINT sums with a
    single final division, multiplied by ``scale`` (per decade).  Fewer than
    two points -> NULL.  ``n_{value}`` is the number of points used.
    """
    return slopes(trend_sums(df, values, keys, t, suffix), values, keys, scale, value_scale)


def trend_sums(df: DataFrame, values=TC_NAMES, keys=("x", "y"), t: str = "year", suffix: str = "_e8") -> DataFrame:
    """Per pixel and value: n, Sx, Sxx, Sy, Sxy over the rows where it is present,
    and ``_rows``, all rows of the pixel.  Sums of two sets of years add up to those of both."""
    tt = F.col(t).cast("bigint")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for v in values:
        y = F.col(f"{v}{suffix}").cast("bigint")
        x = F.when(y.isNotNull(), tt)
        zero = F.lit(0).cast("bigint")
        aggs += [F.count(y).alias(f"_n_{v}"), *[F.coalesce(F.sum(e), zero).alias(f"_{p}_{v}") for p, e in (("sx", x), ("sxx", x * x), ("sy", y), ("sxy", x * y))]]
    return df.groupBy(*keys).agg(*aggs)


def slopes(sums: DataFrame, values=TC_NAMES, keys=("x", "y"), scale: int = SLOPE_SCALE, value_scale: int = E8) -> DataFrame:
    """Slopes and numbers of points from ``trend_sums``."""
    out = [F.col(k) for k in keys]
    for v in values:
        n, sx, sxx, sy, sxy = (F.col(f"_{p}_{v}") for p in ("n", "sx", "sxx", "sy", "sxy"))
        num = n * sxy - sx * sy
        den = n * sxx - sx * sx
        slope = F.when(n >= 2, (num * scale).cast("double") / (den * value_scale).cast("double"))
        out += [slope.alias(f"{v}_slope"), n.cast("int").alias(f"n_{v}")]
    return sums.select(*out)


def trend_visual(trend: DataFrame, values=TC_NAMES, keys=("x", "y")) -> DataFrame:
    """0-255 picture of the per-decade slopes (clip +-0.3, truncate)."""
    return trend.select(*keys, *[stretch_u8(f"{v}_slope").alias(f"{v}_u8") for v in values])
