"""Scenes of neighbouring UTM zones on one reference grid.

Every cell of the reference grid is projected once into each zone in use (inverse
to lon/lat, forward into the zone), which gives the source cells it lies among: a
table of grid cells, whatever the number of scenes.  Scenes are then gathered
through that table by an equi-join on (zone, source cell).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixtrend.functions.geo import with_lonlat, with_utm
from pixtrend.operators.gridmatch import Grid
from pixtrend.session import written


#: Positions are rounded to a millionth of a cell, far below what the projection is
#: good for, so that they do not hang on the last digits of a platform's functions.
DIGITS = 6


def grid_cells(spark: SparkSession, x0: int, x1: int, y0: int, y1: int) -> DataFrame:
    """``(x, y)`` of every cell with index ``x0`` to ``x1`` and ``y0`` to ``y1``, both ends in it."""
    wide, high = max(x1 - x0 + 1, 0), max(y1 - y0 + 1, 0)
    n = F.col("id")
    return spark.range(wide * high).select((n % max(wide, 1) + x0).cast("int").alias("x"), (F.floor(n / max(wide, 1)) + y0).cast("int").alias("y"))


def located(cells: DataFrame, target: Grid, target_epsg: int, zones: dict[int, Grid]) -> DataFrame:
    """``(x, y, epsg, u, v)``: where the centre of each cell of ``target`` lies in each
    zone, on the scale on which the zone's source cell ``s`` covers ``[s, s + 1)``.

    The table is written: it serves all scenes, and a predicate on positions would
    otherwise be pushed below the projection with its series written out in full.
    """
    at = cells.withColumns({"_e": F.lit(float(target.x0)) + (F.col("x") + 0.5) * target.res, "_n": F.lit(float(target.y0)) + (F.col("y") + 0.5) * target.res})
    geo = with_lonlat(at, "_e", "_n", F.lit(target_epsg), "_lon", "_lat")
    parts = []
    for epsg, grid in sorted(zones.items()):
        if epsg == target_epsg:
            east, north, rows = F.col("_e"), F.col("_n"), at
        else:
            rows = with_utm(geo, {"_at": ("_lon", "_lat")}, F.lit(epsg))
            east, north = F.col("_at.x"), F.col("_at.y")
        parts.append(rows.select("x", "y", F.lit(epsg).alias("epsg"), *[F.round((at - o) / grid.res, DIGITS).alias(n) for at, o, n in ((east, grid.x0, "u"), (north, grid.y0, "v"))]))
    return written(reduce(DataFrame.unionByName, parts), "located")


def reproject(df: DataFrame, bands, cells: DataFrame, target: Grid, target_epsg: int, zones: dict[int, Grid], keys=("scene_id",),
              sx: str = "sx", sy: str = "sy", epsg: str = "epsg", method: str = "nearest") -> DataFrame:
    """``bands`` of the scenes' cells ``(keys, epsg, sx, sy)`` at ``cells`` ``(x, y)``
    of the ``target`` grid in zone ``target_epsg``; ``zones`` has the grid of each
    source zone.

    ``nearest`` takes the source cell in which a target's centre lies, with all its columns in
    ``bands`` (class codes too).  ``bilinear`` weighs the four source cells around it, those
    that are missing or null left out, and a target without any has no row.
    Rows of other zones, or outside the cells, do not appear.
    """
    at = located(cells, target, target_epsg, zones)
    rows = df.select(*keys, F.col(epsg).alias("epsg"), F.col(sx).cast("long").alias("_sx"), F.col(sy).cast("long").alias("_sy"), *bands)
    if method == "nearest":
        at = at.select("x", "y", "epsg", F.floor("u").alias("_sx"), F.floor("v").alias("_sy"))
        return rows.join(at, ["epsg", "_sx", "_sy"]).select(*keys, "x", "y", *bands)
    if method != "bilinear":
        raise ValueError(f"unknown method {method!r}")
    base = at.withColumns({"_bx": F.floor(F.col("u") - 0.5), "_by": F.floor(F.col("v") - 0.5)})
    base = base.withColumns({"_fx": F.col("u") - 0.5 - F.col("_bx"), "_fy": F.col("v") - 0.5 - F.col("_by")})
    taps = F.array(*[F.struct((F.col("_bx") + i).alias("_sx"), (F.col("_by") + j).alias("_sy"),
                              ((F.col("_fx") if i else 1 - F.col("_fx")) * (F.col("_fy") if j else 1 - F.col("_fy"))).alias("_w")) for j in (0, 1) for i in (0, 1)])
    near = rows.join(base.select("x", "y", "epsg", F.inline(taps)), ["epsg", "_sx", "_sy"]).where("_w > 0")
    sums = [F.sum(F.col(b) * F.col("_w")).alias(f"_{b}_s") for b in bands] + [F.sum(F.when(F.col(b).isNotNull(), F.col("_w"))).alias(f"_{b}_w") for b in bands]
    out = near.groupBy(*keys, "x", "y").agg(*sums).where(F.coalesce(*[F.col(f"_{b}_w") for b in bands]).isNotNull())
    return out.select(*keys, "x", "y", *[(F.col(f"_{b}_s") / F.col(f"_{b}_w")).alias(b) for b in bands])
