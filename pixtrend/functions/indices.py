"""Tasselled-cap transform as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixtrend.constants import BANDS, TC_COEFFS_E4

TC_NAMES = list(TC_COEFFS_E4)  # tcb, tcg, tcw


def tc_e8(name: str, bands=BANDS) -> Column:
    """``10^8 * index`` as an exact BIGINT from packed integer bands.

    Bands are packed reflectance (0 = nodata); any missing band makes the
    index missing, as NaN did in the reference.  The coefficients have four
    decimals, so ``coef*10^4 * band`` summed is exact.
    """
    terms = []
    for c, b in zip(TC_COEFFS_E4[name], bands):
        v = F.col(b).cast("bigint")
        terms.append(F.when(v != 0, v) * F.lit(c))
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def tasseled_cap(df: DataFrame, keys=("year", "x", "y"), exact: bool = False) -> DataFrame:
    """Brightness / greenness / wetness from six packed bands.

    ``exact=True`` also returns the BIGINT ``*_e8`` columns.  The indices are
    ``tc_e8 / 10^8`` (one rounding), i.e. reflectance scaled by 1/10000.
    """
    cols = [F.col(k) for k in keys]
    for n in TC_NAMES:
        e8 = tc_e8(n)
        if exact:
            cols.append(e8.alias(f"{n}_e8"))
        cols.append((e8.cast("double") / F.lit(1e8)).alias(n))
    return df.select(*cols)
