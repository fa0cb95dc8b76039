"""Annual mosaics: per-pixel median / quantile over the scenes of a year."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixtrend.constants import BAND_ASSETS, BANDS, QUANTILE_BY_BAND
from pixtrend.functions.pixel import pack_u16, zero_to_null

PIXEL_KEYS = ("year", "x", "y")


def median_mosaic(obs: DataFrame, keys=PIXEL_KEYS, bands=BANDS, pack: bool = True) -> DataFrame:
    """Exact per-pixel median of each band, missing values skipped.

    ``median`` is a holistic aggregate whose buffer is a value->count map: for
    integer reflectance it holds at most 10,001 entries per group however many
    scenes are stacked, and it is combined map-side before the shuffle.
    Non-positive values are missing (``arr.where(arr > 0)``).  With
    ``pack=True`` the result is uint16-packed (missing -> 0, truncation).
    """
    aggs = []
    for b in bands:
        m = F.median(zero_to_null(b))
        aggs.append((pack_u16(m) if pack else m).alias(b))
    return obs.groupBy(*keys).agg(*aggs)


def quantile_mosaic(obs: DataFrame, q_by_band: dict | None = None, keys=PIXEL_KEYS,
                    method: str = "nearest", pack: bool = True) -> DataFrame:
    """Per-pixel, per-band quantile with its own ``q`` for every band.

    Exact and bounded in memory: values are first counted per
    ``(pixel, band, value)`` (map-side combined, at most 10,001 rows per pixel
    and band for integer reflectance, however many copies are stacked), a
    running count over value order then locates the order statistic(s), and
    the bands are pivoted back.  ``method`` is one of numpy's ``nearest``,
    ``lower``, ``higher``, ``midpoint``, ``linear``.
    """
    q_by_band = dict(q_by_band or QUANTILE_BY_BAND)
    bands = list(q_by_band)
    long = obs.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(b).alias("band"), zero_to_null(b).alias("v")) for b in bands
    ])).alias("_e")).select(*keys, "_e.band", "_e.v")
    hist = long.groupBy(*keys, "band", "v").agg(F.count(F.lit(1)).alias("c"))
    cnt = F.when(F.col("v").isNotNull(), F.col("c")).otherwise(F.lit(0))
    part = Window.partitionBy(*keys, "band")
    ordered = part.orderBy(F.col("v").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    q = reduce(lambda acc, b: acc.when(F.col("band") == b, F.lit(float(q_by_band[b]))),
               bands[1:], F.when(F.col("band") == bands[0], F.lit(float(q_by_band[bands[0]]))))
    h = hist.withColumns({"_n": F.sum(cnt).over(part), "_hi": F.sum(cnt).over(ordered),
                          "_q": q})
    h = h.withColumn("_lo", F.col("_hi") - cnt)  # values of this row occupy [_lo, _hi)
    pos = (F.col("_n") - 1).cast("double") * F.col("_q")
    i_lo = F.floor(pos).cast("long")
    i_hi = F.ceil(pos).cast("long")
    if method == "nearest":
        i_lo = i_hi = F.rint(pos).cast("long")
    elif method == "lower":
        i_hi = i_lo
    elif method == "higher":
        i_lo = i_hi
    elif method not in ("midpoint", "linear"):
        raise ValueError(f"unknown quantile method {method!r}")
    covers = lambda i: (F.col("v").isNotNull() & (F.col("_lo") <= i) & (i < F.col("_hi")))
    h = h.withColumns({"_a": F.when(covers(i_lo), F.col("v")),
                       "_b": F.when(covers(i_hi), F.col("v")),
                       "_w": pos - F.floor(pos)})
    out = []
    for b in bands:
        is_b = F.col("band") == b
        a = F.max(F.when(is_b, F.col("_a")))
        c = F.max(F.when(is_b, F.col("_b")))
        w = F.max(F.when(is_b, F.col("_w")))
        if method in ("nearest", "lower", "higher"):
            val = a.cast("double")
        elif method == "midpoint":
            val = (a + c) / 2.0
        else:
            val = a + (c - a) * w
        out.append((pack_u16(val) if pack else val).alias(b))
    return h.groupBy(*keys).agg(*out)


def annual_mosaic(obs: DataFrame, reducer: str = "median", **kw) -> DataFrame:
    """Reducer selector of the workflow: ``median`` or ``quantile``."""
    if reducer.lower() == "median":
        return median_mosaic(obs, **kw)
    return quantile_mosaic(obs, **kw)


def stack_scenes(*dfs: DataFrame) -> DataFrame:
    """Bag union of scene tables; bands absent from a piece become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def band_stack(long: DataFrame, keys=("scene_id", "x", "y"), bands=BANDS,
               band_col: str = "band", value_col: str = "v") -> DataFrame:
    """Long ``(keys, band, v)`` -> one wide row per pixel, bands by name.

    Same as a full outer join of the per-band rasters on the pixel key, as one
    aggregation: a conditional maximum per band, combined before one shuffle.
    """
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col(band_col) == b, F.col(value_col))).alias(b) for b in bands])


def band_labels(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """Rename asset-named band columns to band labels, by name, canonical order."""
    mapping = mapping or dict(zip(BAND_ASSETS, BANDS))
    present = {k: v for k, v in mapping.items() if k in df.columns}
    other = [c for c in df.columns if c not in present]
    out = df.withColumnsRenamed(present)
    return out.select(*other, *[b for b in BANDS if b in present.values()])
