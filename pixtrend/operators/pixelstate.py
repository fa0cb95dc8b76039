"""Mosaics and trends kept as mergeable states.

A median cannot be updated from a median, but it can from how often each value
stands at a pixel: the state of a mosaic is a table of counts per (pixel, band,
value), and that of a trend the sums of its normal equations per pixel.  Both
merge by addition, so a new scene or year is added, and a wrong one taken back
(its counts with the other sign), without the stack being read again.

A stored state is a folder of batches, each written once under its own name: a
batch that is written again after a failure replaces itself, never counts
twice.  Reading sums the batches; ``compact`` writes that sum as one batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixtrend.constants import BANDS
from pixtrend.functions.indices import TC_NAMES
from pixtrend.functions.pixel import pack_u16, zero_to_null
from pixtrend.operators.mosaic import PIXEL_KEYS
from pixtrend.operators.trend import slopes, trend_sums

#: Partitions of a batch's pixels, twice as many of a whole state's; not merged, which keeps the tables of one task small.
PARTS = 128


# --------------------------------------------------------------------------- states
def histogram(obs: DataFrame, keys=PIXEL_KEYS, bands=BANDS) -> DataFrame:
    """``(keys, band, v, c)``: how often each value stands at a pixel.  Missing
    and non-positive values are counted as NULL, so that a pixel without any value is known.
    At most one row a value, 10,001 for integer reflectance, however many scenes."""
    values = F.array(*[F.struct(F.lit(b).alias("band"), zero_to_null(b).alias("v")) for b in bands])
    # wide rows are shuffled, by pixel; a pixel's values are counted where they then are
    return obs.select(*keys, *bands).repartition(PARTS, *keys).select(*keys, F.inline(values)).groupBy(*keys, "band", "v").agg(F.count(F.lit(1)).alias("c"))


def negated(state: DataFrame, sums) -> DataFrame:
    """The state that takes ``state`` back."""
    return state.withColumns({c: -F.col(c) for c in sums})


def merged(states, sums, by=None) -> DataFrame:
    """Sum of states, grouped by all columns but ``sums``; what comes to nothing is gone.
    ``by``: some of the grouping columns that what follows groups by; rows are shuffled by these, once for both."""
    both = reduce(DataFrame.unionByName, states)
    if by:
        both = both.repartition(2 * PARTS, *by)
    keys = [c for c in both.columns if c not in sums]
    out = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    return out.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in sums]))


HISTOGRAM_SUMS = ["c"]


def quantile_of(state: DataFrame, q: dict[str, float], keys=PIXEL_KEYS, pack: bool = True) -> DataFrame:
    """One row a pixel: the mean of the two order statistics around position
    ``q * (n - 1)`` of each band (``q`` 0.5: the median)."""
    part = Window.partitionBy(*keys, "band")
    order = part.orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    counted = F.when(F.col("v").isNotNull(), F.col("c")).otherwise(0)
    at = reduce(lambda a, b: a.when(F.col("band") == b, F.lit(float(q[b]))), q, F)
    h = state.withColumns({"_n": F.sum(counted).over(part), "_to": F.sum(counted).over(order), "_q": at})
    place = (F.col("_n") - 1) * F.col("_q")
    here = lambda i: F.col("v").isNotNull() & (F.col("_to") - F.col("c") <= i) & (i < F.col("_to"))
    h = h.withColumns({"_a": F.when(here(F.floor(place)), F.col("v")), "_b": F.when(here(F.ceil(place)), F.col("v"))})
    out = []
    for b in q:
        low, high = (F.max(F.when(F.col("band") == b, F.col(c))) for c in ("_a", "_b"))
        v = (low + high) / 2.0
        out.append((pack_u16(v) if pack else v).alias(b))
    return h.groupBy(*keys).agg(*out)


def median_of(state: DataFrame, keys=PIXEL_KEYS, bands=BANDS, pack: bool = True) -> DataFrame:
    """The median mosaic of all that the state has counted; equal to ``median_mosaic`` of the stack."""
    return quantile_of(state, {b: 0.5 for b in bands}, keys, pack)


def trend_state(tc: DataFrame, values=TC_NAMES, keys=("x", "y"), t: str = "year") -> DataFrame:
    """Sums of the normal equations per pixel over the years of ``tc``."""
    return trend_sums(tc, values, keys, t)


TREND_SUMS = [f"_{p}_{v}" for v in TC_NAMES for p in ("n", "sx", "sxx", "sy", "sxy")] + ["_rows"]


def trend_of(state: DataFrame, values=TC_NAMES, keys=("x", "y")) -> DataFrame:
    """Slopes of all that the state has summed; equal to ``linear_trend`` of all years."""
    return slopes(state, values, keys)


# --------------------------------------------------------------------------- stored states
def write_batch(state: DataFrame, path: str, batch: str) -> None:
    """Add ``state`` to the stored one as ``batch``; the same name again replaces it."""
    state.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_state(spark: SparkSession, path: str, sums, by=None) -> DataFrame:
    """Sum of the batches stored under ``path``, shuffled ``by`` as ``merged`` says."""
    return merged([spark.read.parquet(path).drop("batch")], sums, by)


def compact(spark: SparkSession, path: str, to: str, sums) -> None:
    """The stored state as one batch under ``to``; readers go on with ``path`` until they are told."""
    write_batch(read_state(spark, path, sums), to, "all")
