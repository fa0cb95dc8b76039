"""Clipping pixels to a table of polygons by scanline spans.

Every edge meets the centre lines of some pixel rows; the crossings of a
polygon with a line, sorted, bound its spans there in pairs (even-odd, so holes
and parts need no special case).  A polygon thus becomes rows (y, x0, x1), and
the clip is an equi-join on the pixel row and a block of columns with a range
condition: no predicate per vertex, and any number of polygons at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixtrend.functions.geo import rings_edges

#: Columns of a block; a span is posted once for every block it reaches into.
BLOCK = 64


def _first_centre(v: Column, origin: float, res: float) -> Column:
    """Least index whose cell centre is at or after ``v``."""
    return F.ceil((v - origin) / res - 0.5).cast("long")


def polygon_spans(polygons: DataFrame, key: str = "poly_id", rings: str = "rings", x0: float = 0.0, y0: float = 0.0, res: float = 10) -> DataFrame:
    """``(key, y, x0, x1)``: the pixels of row ``y`` from ``x0`` to ``x1``, both in it,
    whose centres lie inside the polygon; spans of a row do not overlap.

    ``rings`` (arrays of points in grid metres) count by the even-odd rule; a centre on a left or
    lower edge is inside, on a right or upper one outside.  Null or empty rings have no spans.
    Keys must be distinct.
    """
    e = polygons.select(key, F.explode(rings_edges(rings)).alias("e")).select(key, "e.*").where("ay <> by")
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    first, last = _first_centre(low, y0, res), _first_centre(high, y0, res) - 1
    e = e.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("y"))
    centre = (F.col("y") + 0.5) * res + y0
    crossings = e.select(key, "y", ((F.col("bx") - F.col("ax")) * (centre - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax")).alias("c"))
    line = Window.partitionBy(key, "y").orderBy("c")
    pairs = crossings.select(key, "y", "c", F.lead("c").over(line).alias("d"), F.row_number().over(line).alias("n")).where("n % 2 = 1")
    spans = pairs.select(key, F.col("y").cast("int").alias("y"), _first_centre(F.col("c"), x0, res).cast("int").alias("x0"),
                         (_first_centre(F.col("d"), x0, res) - 1).cast("int").alias("x1"))
    return spans.where("x0 <= x1")


def clip_polygons(df: DataFrame, polygons: DataFrame, key: str = "poly_id", rings: str = "rings", x0: float = 0.0, y0: float = 0.0, res: float = 10) -> DataFrame:
    """The pixels of ``df`` (x, y and any other columns) inside each polygon, one row for
    each polygon that holds them, with its ``key``."""
    spans = polygon_spans(polygons, key, rings, x0, y0, res).withColumnsRenamed({"x0": "_x0", "x1": "_x1"})
    spans = spans.select("*", F.explode(F.sequence(F.floor(F.col("_x0") / BLOCK), F.floor(F.col("_x1") / BLOCK))).alias("_block"))
    px = df.withColumn("_block", F.floor(F.col("x") / BLOCK))
    # a small table of polygons can make any number of spans, which its size does not tell: never sent to the driver
    return px.join(spans.hint("merge"), ["y", "_block"]).where(F.col("x").between(F.col("_x0"), F.col("_x1"))).select(key, *df.columns)
