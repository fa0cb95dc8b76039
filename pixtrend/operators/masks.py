"""Masks: predicates that blank bands (set them NULL) instead of dropping rows.

All masks keep the row and rewrite the band columns, so a chain of masks is a
single projection that Catalyst fuses into one codegen stage.  Every predicate
is wrapped in ``coalesce(..., false)`` before negation: with NULL bands the
reference's numpy comparisons are False, while SQL's are NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from pixtrend.operators.moments import scene_moments
from pixtrend.constants import (BANDS, BRIGHT_THRESHOLD, LOW_MAX_VALID, LOW_THRESHOLD,
                                SCL_BAD, SCL_CLOUD, SIGMA_K)


def blank_where(df: DataFrame, cond: Column, bands=BANDS) -> DataFrame:
    """Set every band NULL where ``cond`` is true (NULL counts as false)."""
    drop = F.coalesce(cond, F.lit(False))
    return df.withColumns({b: F.when(~drop, F.col(b)) for b in bands})


def scl_mask_optional(df: DataFrame, bad=SCL_BAD, scl: str = "scl", bands=BANDS, by=("scene_id",)) -> DataFrame:
    """``scl_mask`` for scenes that carry a class layer; scenes without any
    class value stay as they are."""
    has = df.groupBy(*by).agg((F.count(scl) > 0).alias("_has_scl"))
    j = df.join(has, list(by))
    bad_class = F.coalesce(F.col(scl), F.lit(0)).isin(list(bad))
    return blank_where(j, F.col("_has_scl") & bad_class, bands).drop("_has_scl")


def scl_mask(df: DataFrame, bad=SCL_BAD, scl: str = "scl", bands=BANDS) -> DataFrame:
    """Blank pixels whose class is in ``bad``; a missing class reads as 0."""
    return blank_where(df, F.coalesce(F.col(scl), F.lit(0)).isin(list(bad)), bands)


def scl_mask_invalid(df: DataFrame, bad=SCL_CLOUD, scl: str = "scl", bands=BANDS) -> DataFrame:
    """Variant with the cloud/shadow set only (class 0 stays valid)."""
    return scl_mask(df, bad, scl, bands)


def brightness_mask(df: DataFrame, thr: int = BRIGHT_THRESHOLD, bands=BANDS) -> DataFrame:
    """Blank pixels where red, green and blue all exceed ``thr``."""
    c = (F.col("red") > thr) & (F.col("green") > thr) & (F.col("blue") > thr)
    return blank_where(df, c, bands)


def low_reflectance_mask(df: DataFrame, thr: int = LOW_THRESHOLD,
                         max_valid: int = LOW_MAX_VALID, bands=BANDS) -> DataFrame:
    """Blank pixels where at least ``len(bands) - max_valid`` bands are <= thr."""
    n_low = reduce(lambda a, b: a + b,
                   [F.coalesce((F.col(b) <= thr).cast("int"), F.lit(0)) for b in bands])
    return blank_where(df, n_low >= len(bands) - max_valid, bands)


def all_zero_mask(df: DataFrame, bands=BANDS) -> DataFrame:
    """Blank pixels whose bands are all exactly 0 (tile-edge strips)."""
    cond = reduce(lambda a, b: a & b, [F.col(b) == 0 for b in bands])
    return blank_where(df, cond, bands)


def all_missing(df: DataFrame, bands=BANDS) -> Column:
    """True where every band is missing."""
    return F.coalesce(*[F.col(b) for b in bands]).isNull()


def outlier_mask(df: DataFrame, k: float = SIGMA_K, by=("scene_id",), bands=BANDS,
                 stats: DataFrame | None = None) -> DataFrame:
    """Per scene and per band, keep ``mean - k*sigma <= v <= mean + k*sigma``.

    The statistics are one small row per scene (partial aggregation, no pixel
    shuffle), joined back by the scene key; Spark broadcasts them by measured
    size.  Each band is blanked on its own.  Integer bands use exact moments:
    ``|n*v - s1| <= k * sqrt(n*s2 - s1^2)`` is the same inequality multiplied by
    ``n``; the difference of products is taken in DECIMAL(38, 0), once per
    scene, so a full scene of 1.2e8 pixels does not overflow.  Fractional bands
    use the mean and the population sigma as doubles.  ``stats``: the moments of
    ``df`` where they are known (``sources.scenestore``), so ``df`` is read once.
    """
    stats = scene_moments(df, by, bands) if stats is None else stats
    out, keep = {}, []
    for b in bands:
        n, s1, s2, mean, std = (F.col(f"{b}_{m}") for m in ("n", "s1", "s2", "mean", "std"))
        if isinstance(df.schema[b].dataType, IntegralType):
            en, e1, e2 = (c.cast("decimal(19,0)") for c in (n, s1, s2))
            keep += [n.alias(f"_{b}_n"), s1.alias(f"_{b}_c"), (F.lit(float(k)) * F.sqrt((en * e2 - e1 * e1).cast("double"))).alias(f"_{b}_w")]
            dev = F.abs(F.col(f"_{b}_n") * F.col(b).cast("bigint") - F.col(f"_{b}_c")).cast("double")
        else:
            keep += [n.alias(f"_{b}_n"), mean.alias(f"_{b}_c"), (F.lit(float(k)) * std).alias(f"_{b}_w")]
            dev = F.abs(F.col(b).cast("double") - F.col(f"_{b}_c"))
        out[b] = F.when(dev <= F.col(f"_{b}_w"), F.col(b))
    drop = [f"_{b}_{m}" for b in bands for m in ("n", "c", "w")]
    return df.join(stats.select(*by, *keep), list(by), "left").withColumns(out).drop(*drop)


def apply_class_mask(df: DataFrame, mask: DataFrame, keys=("scene_id", "x", "y"),
                     bands=BANDS, keep_class: int = 0) -> DataFrame:
    """Keep a pixel only where the predicted class equals ``keep_class``.

    Pixels without a mask value are blanked (fail closed).  Equi join on the
    integer pixel key; tables bucketed by that key (``bucketBy``) join without
    an exchange, others are shuffled once per side.
    """
    m = mask.select(*keys, F.col("cls").alias("_cls"))
    j = df.join(m, list(keys), "left")
    return blank_where(j, ~F.coalesce(F.col("_cls") == keep_class, F.lit(False)), bands).drop("_cls")


def nonzero_mask(df: DataFrame, mask: DataFrame, keys=("scene_id", "x", "y"),
                 bands=BANDS) -> DataFrame:
    """Blank a pixel where the mask says non-zero; a pixel without a mask value
    stays (the opposite of ``apply_class_mask`` for holes in the mask)."""
    m = mask.select(*keys, F.col("cls").alias("_cls"))
    j = df.join(m, list(keys), "left")
    return blank_where(j, F.col("_cls") != 0, bands).drop("_cls")


def select_mask_layer(mask: DataFrame, by=("scene_id",)) -> DataFrame:
    """Layer choice of a class mask: one layer -> 0; three layers -> 1."""
    n = mask.groupBy(*by).agg((F.max("layer") + 1).alias("_n_layers"))
    j = mask.join(n, list(by))
    return j.filter(F.col("layer") == F.when(F.col("_n_layers") == 3, 1).otherwise(0)) \
        .drop("_n_layers")


def mask_alignment(df: DataFrame, mask: DataFrame, keys=("scene_id", "x", "y"),
                   by=("scene_id",)) -> DataFrame:
    """Per scene: pixels in the scene, in the mask, and in only one of them.

    Written as a union + two aggregations (both partially combined) instead
    of a full outer join.
    """
    tagged = df.select(*keys, F.lit(1).alias("_t")).unionByName(
        mask.select(*keys, F.lit(2).alias("_t")))
    per_px = tagged.groupBy(*keys).agg(F.bit_or("_t").alias("_t"))
    t = F.col("_t")
    return per_px.groupBy(*by).agg(
        F.count_if(t.bitwiseAND(1) == 1).alias("n_scene"),
        F.count_if(t.bitwiseAND(2) == 2).alias("n_mask"),
        F.count_if(t != 3).alias("n_unmatched"),
    ).withColumn("aligned", F.col("n_unmatched") == 0)


def mask_chain(df: DataFrame, bad=SCL_BAD, thr: int = BRIGHT_THRESHOLD, k: float = SIGMA_K,
               bands=BANDS) -> DataFrame:
    """SCL -> brightness -> sigma, the sigma statistics taken on masked values."""
    return outlier_mask(brightness_mask(scl_mask(df, bad, bands=bands), thr, bands), k,
                        bands=bands)
