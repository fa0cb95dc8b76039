"""The end-to-end job: masked scene stack -> annual mosaic -> indices -> trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixtrend.constants import BANDS, SCL_BAD
from pixtrend.functions.indices import TC_NAMES, tasseled_cap
from pixtrend.functions.pixel import mask_nodata, stretch_u8
from pixtrend.operators.masks import scl_mask
from pixtrend.operators.mosaic import annual_mosaic
from pixtrend.operators.trend import linear_trend


def trend_map(obs: DataFrame, mask=None, reducer: str = "median",
              partitions: int | None = None, bad=SCL_BAD, repartition: bool = True) -> DataFrame:
    """Per-pixel tasselled-cap trend (per decade) and its 8-bit picture.

    One lazy plan.  ``repartition(x, y)`` before the mosaic is the only
    exchange of pixel rows: hash(x, y) satisfies both the per-(year, x, y)
    mosaic and the per-(x, y) trend, and the indices in between are a narrow
    projection fused into the same stage.  ``repartition=False`` for a stack
    that is already hash-partitioned (or bucketed) by ``(x, y)``: then the job
    needs no exchange of its own.
    """
    mask = mask or (lambda d: scl_mask(d, bad))
    clean = mask(obs.withColumns({b: mask_nodata(b) for b in BANDS}))
    if repartition:
        clean = clean.repartition(partitions, "x", "y") if partitions else clean.repartition("x", "y")
    mosaic = annual_mosaic(clean, reducer)
    tc = tasseled_cap(mosaic, keys=("year", "x", "y"), exact=True)
    tr = linear_trend(tc)
    return tr.select(
        "x", "y",
        *[F.col(f"{v}_slope") for v in TC_NAMES],
        F.col("n_tcb").alias("n_years"),
        *[stretch_u8(f"{v}_slope").alias(f"{v}_u8") for v in TC_NAMES],
    )
