"""The whole job: scene catalogue -> chosen scenes -> pixels -> trend map."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixtrend.constants import (AOI_CLOUD_THRESH, AOI_MIN_COVERAGE, AOI_MIN_COVERAGE_RATIO, BANDS,
                                SCENE_MAX_CLOUD, SEASON)
from pixtrend.functions.pixel import mask_nodata, year_of
from pixtrend.operators.clip import clip_bounds, clip_index_range
from pixtrend.operators.masks import mask_chain
from pixtrend.operators.mosaic import band_stack
from pixtrend.operators.quality import aoi_filter, complete_scenes
from pixtrend.operators.resample import align_to_grid, resample_nearest
from pixtrend.operators.spatial import aoi_coverage
from pixtrend.plans.trend_map import trend_map
from pixtrend.session import written
from pixtrend.sources.catalog import pending, require_asset, search_scenes, season_filter


def choose_scenes(scenes: DataFrame, assets: DataFrame, aois: DataFrame, done: DataFrame, years,
                  season=SEASON, grid: str | None = None, max_cloud: float = SCENE_MAX_CLOUD,
                  min_ratio: float = AOI_MIN_COVERAGE_RATIO, epsg: int | None = None, collection: str | None = None) -> DataFrame:
    """``(scene_id, year)`` of the items worth reading: in season, clear enough
    by the catalogue, not finished yet, covering an AOI, with a class layer and
    all bands.  Nothing here touches pixels."""
    years = list(years)
    items = search_scenes(scenes, f"{min(years)}-01-01", f"{max(years)}-12-31", grid, max_cloud, collection)
    items = pending(season_filter(items, years, *season), done)
    items = require_asset(items, assets).join(complete_scenes(assets).select("item_id"), "item_id", "left_semi")
    items = written(items, "items")  # the spatial join reads them several times
    covering = aoi_coverage(items, aois, epsg=epsg, min_ratio=min_ratio).select("item_id").distinct()
    return items.join(covering, "item_id", "left_semi").select(
        F.col("item_id").alias("scene_id"), year_of("ts").alias("year"))


def scene_stack(chosen: DataFrame, bands: DataFrame, classes: DataFrame, bounds=None) -> DataFrame:
    """Wide pixel rows ``(year, scene_id, x, y, bands, scl)`` of the chosen
    scenes: coarse bands resampled onto the scene's fine grid, classes by
    nearest neighbour.  Only the chosen scenes' rows pass the first join.

    ``bounds`` (grid metres) are cut out before anything is resampled: of the fine
    rows those inside, of the coarse ones one cell more on each side, which the
    interpolation at the edge needs.  The scene's extent is that of all its fine rows.
    """
    fine, coarse = F.col("res") == "10m", F.col("res") != "10m"
    long = bands.join(chosen.select("scene_id"), "scene_id", "left_semi")
    # nodata never takes part in an interpolation
    long = long.withColumn("v", F.when(F.col("v") != 0, F.col("v")))
    classes = classes.join(chosen.select("scene_id"), "scene_id", "left_semi")
    extent = None
    if bounds is not None:
        x0, y0, x1, y1 = clip_index_range(bounds)
        extent = long.filter(fine).groupBy("scene_id").agg(
            F.greatest(F.min("sx"), F.lit(x0)).alias("x0"), F.least(F.max("sx"), F.lit(x1)).alias("x1"),
            F.greatest(F.min("sy"), F.lit(y0)).alias("y0"), F.least(F.max("sy"), F.lit(y1)).alias("y1"))
        inside = F.col("sx").between(x0, x1) & F.col("sy").between(y0, y1)
        around = F.col("sx").between(x0 // 2 - 1, x1 // 2 + 1) & F.col("sy").between(y0 // 2 - 1, y1 // 2 + 1)
        long = long.filter((fine & inside) | (coarse & around))
        classes = classes.filter(around)
    wide = band_stack(align_to_grid(long, extent=extent))
    out = wide.join(resample_nearest(classes, ["scl"]), ["scene_id", "x", "y"], "left").join(chosen, "scene_id")
    return out if bounds is None else clip_bounds(out, bounds)


def catalogue_trend(scenes: DataFrame, assets: DataFrame, aois: DataFrame, done: DataFrame, bands: DataFrame,
                    classes: DataFrame, years, bounds, expected: float, grid: str | None = None,
                    epsg: int | None = None, mask: Callable[[DataFrame], DataFrame] = mask_chain,
                    cloud_thresh: float = AOI_CLOUD_THRESH, min_coverage: float = AOI_MIN_COVERAGE,
                    collection: str | None = None) -> DataFrame:
    """Trend map of the pixels inside ``bounds`` (grid metres) from everything
    the catalogue offers: choose scenes, stack them, clip, drop scenes that are
    too cloudy or too empty over the AOI (``expected`` pixels), mask, reduce
    and fit.

    Three tables are written on the way, the items that the catalogue leaves, the chosen scenes
    (a few rows each year) and their clipped stack: each is used several times by what follows, and a
    lost executor goes back to them and no further.
    """
    chosen = written(choose_scenes(scenes, assets, aois, done, years, grid=grid, epsg=epsg, collection=collection), "chosen")
    stack = written(scene_stack(chosen, bands, classes, bounds), "stack")
    good = aoi_filter(stack, expected, cloud_thresh, min_coverage)
    return trend_map(good.withColumns({b: mask_nodata(b) for b in BANDS}), mask=mask)
