"""Scene-level aggregates: AOI quality, scene statistics, bbox union, EPSG pick,
band completeness, status and run summary.

All of them reduce pixels or assets to one small row per scene (or per year)
with partial aggregation before the shuffle; the per-scene tables are joined
back to pixels by plain joins, which Spark turns into broadcasts by measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixtrend.constants import (AOI_CLOUD_THRESH, AOI_MIN_COVERAGE, BANDS, SCL_CLOUD)
from pixtrend.functions.geo import utm_epsg
from pixtrend.operators.moments import scene_moments


def aoi_quality(scl: DataFrame, expected, by=("scene_id",), scl_col: str = "scl",
                cloud=SCL_CLOUD) -> DataFrame:
    """Per scene over the AOI's classification pixels.

    valid = class present and != 0, bad = valid and class in ``cloud``;
    ``coverage = valid / expected``, ``cloud_ratio = bad / valid`` (NULL when
    nothing is valid), plus ``n_present`` to detect scenes with no data.
    ``expected`` is a number or a column (e.g. a scalar subquery).
    """
    s = F.col(scl_col)
    valid = s.isNotNull() & (s != 0)
    g = scl.groupBy(*by).agg(
        F.count(s).alias("n_present"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(valid & s.isin(list(cloud))).alias("n_bad"),
    )
    exp = expected if not isinstance(expected, (int, float)) else F.lit(float(expected))
    return g.withColumns({
        "expected": exp.cast("double"),
        "coverage": F.col("n_valid").cast("double") / exp.cast("double"),
        "cloud_ratio": F.col("n_bad").cast("double") / F.nullif(F.col("n_valid"), F.lit(0)).cast("double"),
    })


def keep_scene(cloud_thresh: float = AOI_CLOUD_THRESH, min_coverage: float = AOI_MIN_COVERAGE):
    """Predicate on ``aoi_quality`` rows: some valid data, clear enough, enough coverage."""
    return ((F.col("n_present") > 0) & (F.col("n_valid") > 0)
            & (F.col("cloud_ratio") <= cloud_thresh) & (F.col("coverage") >= min_coverage))


def aoi_filter(obs: DataFrame, expected, cloud_thresh: float = AOI_CLOUD_THRESH,
               min_coverage: float = AOI_MIN_COVERAGE, by=("scene_id",)) -> DataFrame:
    """Pixels of the scenes that pass the AOI quality test (semi join)."""
    q = aoi_quality(obs, expected, by).filter(keep_scene(cloud_thresh, min_coverage))
    return obs.join(q.select(*by), list(by), "left_semi")


def scene_stats(df: DataFrame, by=("scene_id",), bands=BANDS) -> DataFrame:
    """Per scene and band: count, sums, mean and population sigma (missing
    skipped); the statistics that ``masks.outlier_mask`` goes by."""
    return scene_moments(df, by, bands)


def bbox_union(items: DataFrame, by=(), override: tuple | None = None) -> DataFrame:
    """Union bbox of the items (min west/south, max east/north); an override
    bbox replaces it."""
    g = items.groupBy(*by).agg(F.min("west").alias("west"), F.min("south").alias("south"),
                               F.max("east").alias("east"), F.max("north").alias("north"))
    if override is not None:
        g = g.withColumns({k: F.lit(float(v)) for k, v in zip(("west", "south", "east", "north"),
                                                               override)})
    return g


def detect_epsg(items: DataFrame, by=(), order=("ts", "item_id"),
                override: tuple | None = None) -> DataFrame:
    """EPSG of the first item (by ``order``) that carries one, else the UTM
    zone of the bbox centre.  ``from_item`` says which rule applied."""
    first = F.min_by(F.col("proj_epsg"), F.when(F.col("proj_epsg").isNotNull(),
                                                F.struct(*[F.col(c) for c in order])))
    g = items.groupBy(*by).agg(first.alias("_first"), F.min("west").alias("west"),
                               F.min("south").alias("south"), F.max("east").alias("east"),
                               F.max("north").alias("north"))
    if override is not None:
        g = g.withColumns({k: F.lit(float(v)) for k, v in zip(("west", "south", "east", "north"),
                                                               override)})
    lon = (F.col("west") + F.col("east")) / 2.0
    lat = (F.col("south") + F.col("north")) / 2.0
    return g.select(*by, F.coalesce("_first", utm_epsg(lon, lat)).alias("epsg"),
                    F.col("_first").isNotNull().alias("from_item"),
                    "west", "south", "east", "north")


def complete_scenes(assets: DataFrame, bands=BANDS, key: str = "item_id") -> DataFrame:
    """Items that have all ``bands`` (one row per item with its band count)."""
    return assets.filter(F.col("band").isin(list(bands))).groupBy(key) \
        .agg(F.count_distinct("band").alias("n_bands")) \
        .filter(F.col("n_bands") == len(bands))


def scene_status(quality: DataFrame, alignment: DataFrame | None = None, by=("scene_id",),
                 cloud_thresh: float = AOI_CLOUD_THRESH,
                 min_coverage: float = AOI_MIN_COVERAGE) -> DataFrame:
    """Validity rules as a status column instead of exceptions: ``no_data``,
    ``no_valid``, ``cloudy``, ``low_coverage``, ``misaligned`` or ``ok``."""
    q = quality
    if alignment is not None:
        q = q.join(alignment.select(*by, "aligned"), list(by), "left")
    else:
        q = q.withColumn("aligned", F.lit(True))
    st = (F.when(F.col("n_present") == 0, "no_data")
          .when(F.col("n_valid") == 0, "no_valid")
          .when(F.col("cloud_ratio") > cloud_thresh, "cloudy")
          .when(F.col("coverage") < min_coverage, "low_coverage")
          .when(~F.coalesce(F.col("aligned"), F.lit(False)), "misaligned")
          .otherwise("ok"))
    return q.withColumn("status", st)


def run_summary(status: DataFrame, year: str = "year") -> DataFrame:
    """Scenes per year with ok / failed counts, sorted by year."""
    ok = F.col("status") == "ok"
    return status.groupBy(year).agg(F.count(F.lit(1)).alias("n_scenes"),
                                    F.count_if(ok).alias("n_ok"),
                                    F.count_if(~ok).alias("n_failed")).orderBy(year)
