"""Moments of the bands of each scene, shared by the statistics and the sigma mask."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from pixtrend.constants import BANDS


def scene_moments(df: DataFrame, by=("scene_id",), bands=BANDS) -> DataFrame:
    """Per scene and band, missing skipped: ``_n``, ``_s1``, ``_s2`` (count, sum, sum of
    squares), ``_mean`` and ``_std`` (population sigma); NULL where nothing is present.

    Integer bands have exact sums, and the difference ``n*s2 - s1^2`` is taken in
    DECIMAL(38, 0) once per scene, so no digits cancel in a scene of 1.2e8
    pixels.  Other bands are averaged as doubles, the sigma around the running mean.
    """
    aggs, cols = [], []
    for b in bands:
        n, s1, s2, mean, std = (f"{b}_{m}" for m in ("n", "s1", "s2", "mean", "std"))
        if isinstance(df.schema[b].dataType, IntegralType):
            v = F.col(b).cast("bigint")
            aggs += [F.count(b).alias(n), F.sum(v).alias(s1), F.sum(v * v).alias(s2)]
            en, e1, e2 = (F.col(c).cast("decimal(19,0)") for c in (n, s1, s2))
            some = F.nullif(F.col(n), F.lit(0)).cast("double")
            cols += [n, s1, s2, (F.col(s1).cast("double") / some).alias(mean), (F.sqrt((en * e2 - e1 * e1).cast("double")) / some).alias(std)]
        else:
            v = F.col(b).cast("double")
            aggs += [F.count(b).alias(n), F.sum(v).alias(s1), F.sum(v * v).alias(s2), F.avg(v).alias(mean), F.stddev_pop(v).alias(std)]
            cols += [n, s1, s2, mean, std]
    return df.groupBy(*by).agg(*aggs).select(*by, *cols)


def merged_moments(parts: DataFrame, by=("scene_id",), bands=BANDS) -> DataFrame:
    """Moments of scenes from those of their parts (several rows of
    ``scene_moments`` a scene); as ``scene_moments`` of all pixels at once.

    Exact for integer bands.  For others the sigma of the parts is widened by how
    far their means lie from the scene's, so no squares of values are subtracted."""
    whole = Window.partitionBy(*by)
    aggs, cols, means = [], [], {}
    for b in bands:
        n, s1, s2, mean, std = (f"{b}_{m}" for m in ("n", "s1", "s2", "mean", "std"))
        count = F.sum(n).alias(n)
        aggs += [count, F.sum(s1).alias(s1), F.sum(s2).alias(s2)]
        some = F.nullif(F.col(n), F.lit(0)).cast("double")
        if isinstance(parts.schema[s1].dataType, IntegralType):
            en, e1, e2 = (F.col(c).cast("decimal(19,0)") for c in (n, s1, s2))
            cols += [n, s1, s2, (F.col(s1).cast("double") / some).alias(mean), (F.sqrt((en * e2 - e1 * e1).cast("double")) / some).alias(std)]
        else:
            means[f"_{b}_mean"] = F.sum(F.col(mean) * F.col(n)).over(whole) / F.nullif(F.sum(n).over(whole), F.lit(0))
            off = F.col(mean) - F.col(f"_{b}_mean")
            aggs += [F.first(f"_{b}_mean").alias(mean), F.sum(F.col(n) * (F.col(std) * F.col(std) + off * off)).alias(f"_{b}_m2")]
            cols += [n, s1, s2, mean, F.sqrt(F.col(f"_{b}_m2") / some).alias(std)]
    return parts.withColumns(means).groupBy(*by).agg(*aggs).select(*by, *cols)
