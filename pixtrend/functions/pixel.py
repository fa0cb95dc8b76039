"""Per-pixel column expressions (all built-in, codegen friendly).

NULL is the only "missing" marker inside the engine: NaN and nodata values are
turned into NULL at the scan, and every mask is written so that a NULL band
never blanks the other bands by accident (three-valued logic).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pixtrend.constants import REFLECTANCE_MAX, STRETCH_HI, STRETCH_LO


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL (no-op for integer columns)."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def mask_nodata(c, nodata=0) -> Column:
    """Nodata value and NaN -> NULL, the masked read of a raster band."""
    c = col(c)
    return F.when((c != F.lit(nodata)) & ~F.isnan(c), c)


def zero_to_null(c) -> Column:
    """Keep strictly positive values, everything else (0, negatives) -> NULL."""
    c = col(c)
    return F.when(c > 0, c)


def pack_u16(c, hi: int = REFLECTANCE_MAX) -> Column:
    """Missing -> 0, clip to 0..hi, truncate to an integer.

    ``coalesce`` is innermost: ``least``/``greatest`` skip NULLs, so clipping
    first would turn a missing value into ``hi``.
    """
    c = col(c)
    return F.greatest(F.lit(0), F.least(F.lit(hi), F.coalesce(c, F.lit(0)))).cast("int")


def stretch_u8(c, lo: float = STRETCH_LO, hi: float = STRETCH_HI) -> Column:
    """Clip to [lo, hi], map linearly to 0..255, truncate; missing -> 0."""
    c = col(c)
    v = F.greatest(F.lit(lo), F.least(F.lit(hi), c))
    return F.when(c.isNotNull(), ((v - F.lit(lo)) / F.lit(hi - lo) * 255).cast("int")) \
        .otherwise(F.lit(0))


def year_of(ts) -> Column:
    return F.year(col(ts)).cast("int")


def mid_season_date(year, month: int = 7, day: int = 15) -> Column:
    """Date stamp the reference gives to a year's mosaic ({year}-07-15)."""
    return F.make_date(col(year), F.lit(month), F.lit(day))


def scene_date(ts) -> Column:
    """``datetime.split('T')[0]`` as a string."""
    return F.date_format(col(ts), "yyyy-MM-dd")


def scene_key(item_id, ts, suffix: str = ".tif") -> Column:
    """Output name ``{id}_{date}{suffix}``."""
    return F.concat(col(item_id).cast("string"), F.lit("_"), scene_date(ts), F.lit(suffix))


def strip_safe(name) -> Column:
    return F.regexp_replace(col(name), r"\.SAFE$", "")


def expected_pixels(width, height, res) -> Column:
    """Pixel count of an extent at a resolution, as the float the reference uses."""
    return (col(width) / F.lit(res)) * (col(height) / F.lit(res))
