"""Clips: integer pixel ranges (prunable in the scan), polygons, other images."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixtrend.functions import geo as G
from pixtrend.operators.masks import all_missing


def clip_index_range(bounds, x0: float = 0.0, y0: float = 0.0, res: float = 10):
    """Integer pixel ranges whose cell centre lies within bounds +- res/2."""
    xmin, ymin, xmax, ymax = bounds
    return (math.ceil((xmin - x0) / res - 1), math.ceil((ymin - y0) / res - 1),
            math.floor((xmax - x0) / res), math.floor((ymax - y0) / res))


def clip_bounds(df: DataFrame, bounds, x0: float = 0.0, y0: float = 0.0, res: float = 10) -> DataFrame:
    """Clip to projected bounds: integer range predicates (parquet-prunable)."""
    i0, j0, i1, j1 = clip_index_range(bounds, x0, y0, res)
    return df.filter(F.col("x").between(i0, i1) & F.col("y").between(j0, j1))


def clip_polygon(df: DataFrame, coords, res: float = 10) -> DataFrame:
    """Pixels whose centre is inside the polygon, after the bbox range predicate."""
    xs, ys = [c[0] for c in coords], [c[1] for c in coords]
    df = clip_bounds(df, (min(xs), min(ys), max(xs), max(ys)), res=res)
    cx = F.col("x") * res + res / 2
    cy = F.col("y") * res + res / 2
    return df.filter(G.point_in_polygon_lit(cx, cy, coords))


def clip_to_extent(df: DataFrame, image: DataFrame, by=("scene_id",)) -> DataFrame:
    """Clip ``df`` to the per-scene extent of another image's valid pixels."""
    valid = image.filter(~all_missing(image))
    ext = valid.groupBy(*by).agg(F.min("x").alias("_x0"), F.max("x").alias("_x1"),
                                 F.min("y").alias("_y0"), F.max("y").alias("_y1"))
    return df.join(ext, list(by)).filter(
        F.col("x").between(F.col("_x0"), F.col("_x1")) & F.col("y").between(F.col("_y0"), F.col("_y1"))) \
        .drop("_x0", "_x1", "_y0", "_y1")
