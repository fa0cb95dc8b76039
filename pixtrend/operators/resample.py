"""Resampling between the 20 m and 10 m grids of a scene: the two grids share
their origin, so a 20 m cell ``s`` covers the 10 m cells ``2s`` and ``2s+1``.
``gridmatch`` does the work for any two grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixtrend.operators.gridmatch import Grid, match_bilinear, match_nearest

#: Cell sizes in metres of the resolution names.
GRIDS = {"10m": Grid(10), "20m": Grid(20)}


def resample_bilinear(df: DataFrame, bands, keys=("scene_id",), sx: str = "sx", sy: str = "sy",
                      factor: int = 2, extent: DataFrame | None = None, scene=("scene_id",)) -> DataFrame:
    """Upsample ``bands`` from the coarse grid ``(sx, sy)`` to the ``factor`` times finer grid ``(x, y)``.

    Targets outside the scene's own fine grid are dropped: ``extent`` has one
    row ``(scene keys, x0, x1, y0, y1)`` per scene; the default is what the
    scene's coarse cells cover.  Values keep their precision (integers are
    summed exactly, other types as doubles).
    """
    return match_bilinear(df, bands, Grid(factor), Grid(1), keys, sx, sy, extent, scene)


def resample_nearest(df: DataFrame, cols, keys=("scene_id",), sx: str = "sx", sy: str = "sy",
                     factor: int = 2) -> DataFrame:
    """Nearest-neighbour upsampling (class codes): each coarse cell becomes its
    ``factor x factor`` children.  A narrow generator, no shuffle."""
    return match_nearest(df, cols, Grid(factor), Grid(1), keys, sx, sy)


def align_to_grid(long: DataFrame, keys=("scene_id",), band: str = "band", res: str = "res",
                  value: str = "v", fine: str = "10m", grids: dict[str, Grid] | None = None, extent: DataFrame | None = None) -> DataFrame:
    """Bring every band of a scene onto one grid, resampling only where needed.

    ``long`` rows are ``(keys, band, res, sx, sy, v)`` with cell indices on the
    band's own grid (``grids``: the grid of each name in ``res``).  Scenes that have a ``fine`` band keep those as they are
    and get all other bands interpolated onto that grid; scenes without one keep
    their own grids (no resampling).  A resolution without a grid is left out.  Output is
    ``(keys, band, x, y, v)``; pivot with ``band_stack`` for the wide row.
    The fine band's extent is a small aggregate per scene; upsampled values
    outside it are dropped, so all bands share one grid.  ``extent`` (keys, x0,
    x1, y0, y1) replaces it where ``long`` holds parts of the scenes only.
    """
    grids = grids or GRIDS
    grid = extent if extent is not None else long.filter(F.col(res) == fine).groupBy(*keys).agg(
        F.min("sx").alias("x0"), F.max("sx").alias("x1"), F.min("sy").alias("y0"), F.max("sy").alias("y1"))
    coarse = long.filter(F.col(res) != fine)
    keep = long.filter(F.col(res) == fine).unionByName(coarse.join(grid, list(keys), "left_anti"))
    out = keep.select(*keys, band, F.col("sx").alias("x"), F.col("sy").alias("y"), F.col(value).cast("double").alias(value))
    for name, own in grids.items():
        if name != fine:
            # the join with the grid drops scenes without a fine band
            rows = long.filter(F.col(res) == name).select(*keys, band, "sx", "sy", value)
            out = out.unionByName(match_bilinear(rows, [value], own, grids[fine], keys=(*keys, band), extent=grid, scene=keys))
    return out
