"""Matching a raster to any reference grid of the same projection.

A grid is a cell size and an origin, both whole numbers of one unit, so the
position of a target cell among the source cells is a fraction that repeats
with the phase of the target index.  All index arithmetic and weights are
integers: interpolated values are one exact sum over another, and the same
whatever the partitioning.

Cells are shuffled once, by tile: those at the edge of a tile go to the next one
as well, so little more than one row a cell moves, and all that follows stays
in the partition.  ``PARTS`` partitions, not merged, keep the tables of one task small.

* Onto equal or finer cells, bilinear interpolation has two taps an axis.  Each
  source cell is part of four 2x2 neighbourhoods (a conditional maximum per
  corner), and a neighbourhood makes all the target cells whose centres lie
  between its four centres, however many the ratio gives.
* Onto coarser cells, the triangle is as wide as the target cell; every source
  cell adds to two targets an axis.
* Nearest neighbour is a narrow generator either way.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from pixtrend.session import ensure_jit_friendly_codegen

#: Edge of a tile, in source cells (onto coarser cells: in targets), and the partitions that tiles are dealt to.
TILE = 64
PARTS = 256


@dataclass(frozen=True)
class Grid:
    """Cell ``i`` covers ``[x0 + i * res, x0 + (i + 1) * res)`` along x, and so with y0 along y."""
    res: int
    x0: int = 0
    y0: int = 0

    def origin(self, axis: str) -> int:
        return self.x0 if axis == "x" else self.y0


@dataclass(frozen=True)
class Axis:
    """Target centre ``t`` lies at ``(step * t + shift) / unit`` on the scale on which
    source cell ``s`` has its lower edge at ``s`` and its centre at ``s + 1/2``."""
    step: int
    shift: int
    unit: int

    @classmethod
    def between(cls, source: Grid, target: Grid, axis: str) -> "Axis":
        step, shift, unit = 2 * target.res, 2 * (target.origin(axis) - source.origin(axis)) + target.res, 2 * source.res
        g = gcd(step, shift, unit)
        step, shift, unit = (step // g, shift // g, unit // g)
        return cls(2 * step, 2 * shift, 2 * unit) if unit % 2 else cls(step, shift, unit)  # half a cell stays whole

    @property
    def centred(self) -> int:
        """``shift`` on the scale on which source centres are whole numbers."""
        return self.shift - self.unit // 2

    def phases(self) -> list[int]:
        """Remainders that the position between two source centres takes."""
        return sorted({(self.step * t + self.centred) % self.unit for t in range(self.unit // gcd(self.step, self.unit))})

    def first_at_or_after(self, s, shift: int) -> Column:
        """Least ``t`` with ``step * t + shift >= s * unit``."""
        return _ceil_div(_c(s) * self.unit - shift, self.step)


def _c(v) -> Column:
    return F.col(v).cast("long") if isinstance(v, str) else v


def _floor_div(a: Column, b: int) -> Column:
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def _ceil_div(a: Column, b: int) -> Column:
    return -_floor_div(-a, b)


def covered(df: DataFrame, source: Grid, target: Grid, scene=("scene_id",), sx: str = "sx", sy: str = "sy") -> DataFrame:
    """``(scene, x0, x1, y0, y1)``: target cells whose centres lie inside what each scene's cells span."""
    ax, ay = (Axis.between(source, target, a) for a in "xy")
    e = df.groupBy(*scene).agg(F.min(sx).alias("_a"), F.max(sx).alias("_b"), F.min(sy).alias("_c"), F.max(sy).alias("_d"))
    return e.select(*scene, ax.first_at_or_after("_a", ax.shift).alias("x0"), (ax.first_at_or_after(_c("_b") + 1, ax.shift) - 1).alias("x1"),
                    ay.first_at_or_after("_c", ay.shift).alias("y0"), (ay.first_at_or_after(_c("_d") + 1, ay.shift) - 1).alias("y1"))


def match_nearest(df: DataFrame, cols, source: Grid, target: Grid, keys=("scene_id",), sx: str = "sx", sy: str = "sy") -> DataFrame:
    """Each target cell takes the source cell in which its centre lies: a source
    cell becomes the targets whose centres it holds, possibly none."""
    out = df.select(*keys, sx, sy, *cols)
    for axis, s, t in (("x", sx, "x"), ("y", sy, "y")):
        a = Axis.between(source, target, axis)
        lo, hi = a.first_at_or_after(s, a.shift), a.first_at_or_after(_c(s) + 1, a.shift) - 1
        out = out.select("*", F.explode(F.when(lo <= hi, F.sequence(lo, hi))).alias(f"_{t}"))
    index = [F.col(f"_{t}").cast(df.schema[s].dataType).alias(t) for t, s in (("x", sx), ("y", sy))]
    return out.select(*keys, *index, *cols)


def match_bilinear(df: DataFrame, bands, source: Grid, target: Grid, keys=("scene_id",), sx: str = "sx", sy: str = "sy",
                   extent: DataFrame | None = None, scene=("scene_id",)) -> DataFrame:
    """``bands`` of the cells ``(keys, sx, sy)`` on ``source``, interpolated at
    the cells ``(x, y)`` of ``target``.

    Missing cells and null values take no part: weights are renormalised over
    what is there, and a target without any has no row.  Targets outside
    ``extent`` (``scene`` keys, x0, x1, y0, y1) are left out; the default is
    ``covered``.  Cells of a key must be distinct; all bands ride together.
    """
    if extent is None:
        extent = covered(df, source, target, scene, sx, sy)
    box = extent.select(*scene, *[F.col(c).cast("long").alias(f"_{c}") for c in ("x0", "x1", "y0", "y1")])
    ax, ay = (Axis.between(source, target, a) for a in "xy")
    cells = df.select(*keys, F.col(sx).cast("long").alias("_sx"), F.col(sy).cast("long").alias("_sy"),
                      *[F.col(b).cast("bigint" if isinstance(df.schema[b].dataType, IntegralType) else "double").alias(b) for b in bands])
    finer = target.res <= source.res
    ensure_jit_friendly_codegen(df.sparkSession)
    out = (_gather if finer else _scatter)(cells, bands, ax, ay, keys, box, scene)
    return out.select(*keys, *[F.col(t).cast(df.schema[s].dataType) for t, s in (("x", sx), ("y", sy))], *bands)


def _dealt(cells: DataFrame, keys, low: dict[str, Column], reach: dict[str, int]) -> DataFrame:
    """Cells in the tiles (``_tx``, ``_ty``) of all that they add to, ``low`` to ``low + reach`` on each axis."""
    for t, first in low.items():
        cells = cells.select("*", F.explode(F.sequence(_floor_div(first, TILE), _floor_div(first + reach[t], TILE))).alias(f"_t{t}"))
    return cells.repartition(PARTS, *keys, "_tx", "_ty")


def _own(t: str, at: str) -> Column:
    """``at`` lies in the row's tile."""
    return F.col(at).between(F.col(f"_t{t}") * TILE, F.col(f"_t{t}") * TILE + (TILE - 1))


def _gather(cells: DataFrame, bands, ax: Axis, ay: Axis, keys, box: DataFrame, scene) -> DataFrame:
    taps = [[0] if a.phases() == [0] else [0, 1] for a in (ax, ay)]
    corners = [(i, j) for i in taps[0] for j in taps[1]]
    reach = {"x": taps[0][-1], "y": taps[1][-1]}
    cells = _dealt(cells, keys, {t: F.col(f"_s{t}") - reach[t] for t in "xy"}, reach)
    to = F.array(*[F.struct((F.col("_sx") - i).alias("bx"), (F.col("_sy") - j).alias("by"), F.lit(n).alias("n")) for n, (i, j) in enumerate(corners)])
    quads = (cells.select(*keys, "_tx", "_ty", *bands, F.inline(to)).filter(_own("x", "bx") & _own("y", "by")).groupBy(*keys, "_tx", "_ty", "bx", "by")
             .agg(*[F.max(F.when(F.col("n") == n, F.col(b))).alias(f"_{b}_{n}") for b in bands for n in range(len(corners))]))
    # one small row a scene is sent to the rows, never the rows to it
    quads = quads.join(F.broadcast(box), list(scene))
    for a, base, t, lo, hi in ((ax, "bx", "x", "_x0", "_x1"), (ay, "by", "y", "_y0", "_y1")):
        first = F.greatest(a.first_at_or_after(base, a.centred), F.col(lo))
        last = F.least(a.first_at_or_after(_c(base) + 1, a.centred) - 1, F.col(hi))
        quads = quads.select("*", F.explode(F.when(first <= last, F.sequence(first, last))).alias(t))
    part = {t: F.col(t) * a.step + a.centred - F.col(base) * a.unit for a, base, t in ((ax, "bx", "x"), (ay, "by", "y"))}
    quads = quads.withColumns({"_fx": part["x"], "_fy": part["y"]})

    def weight(i: int, j: int) -> Column:
        return (F.col("_fx") if i else F.lit(ax.unit) - F.col("_fx")) * (F.col("_fy") if j else F.lit(ay.unit) - F.col("_fy"))

    quads = quads.withColumns({f"_w{n}": weight(i, j) for n, (i, j) in enumerate(corners)})
    sums = {}
    for b in bands:
        here = [(F.col(f"_{b}_{n}"), F.col(f"_w{n}")) for n in range(len(corners))]
        sums[f"_{b}_s"] = sum((F.coalesce(v * w, F.lit(0)) for v, w in here[1:]), F.coalesce(here[0][0] * here[0][1], F.lit(0)))
        present = [F.when(v.isNotNull(), w).otherwise(0) for v, w in here]
        sums[f"_{b}_w"] = sum(present[1:], present[0])
    return _divided(quads.withColumns(sums), bands)


def _scatter(cells: DataFrame, bands, ax: Axis, ay: Axis, keys, box: DataFrame, scene) -> DataFrame:
    low = {"x": _floor_div(F.col("_sx") * ax.unit - ax.centred, ax.step), "y": _floor_div(F.col("_sy") * ay.unit - ay.centred, ay.step)}
    rows = _dealt(cells, keys, low, {"x": 1, "y": 1}).join(F.broadcast(box), list(scene))
    for a, s, t, lo, hi in ((ax, "_sx", "x", "_x0", "_x1"), (ay, "_sy", "y", "_y0", "_y1")):
        # the triangle around target t reaches step / unit source cells to either side
        below = _floor_div(F.col(s) * a.unit - a.centred, a.step)
        rows = rows.select("*", F.explode(F.array(below, below + 1)).alias(t)).filter(F.col(t).between(F.col(lo), F.col(hi)) & _own(t, t))
        rows = rows.withColumn(f"_w{t}", F.lit(a.step) - F.abs(F.col(s) * a.unit - a.centred - F.col(t) * a.step))
    weight = F.col("_wx") * F.col("_wy")
    sums = []
    for b in bands:
        sums += [F.sum(F.col(b) * weight).alias(f"_{b}_s"), F.sum(F.when(F.col(b).isNotNull(), weight)).alias(f"_{b}_w")]
    return _divided(rows.filter(weight > 0).groupBy(*keys, "_tx", "_ty", "x", "y").agg(*sums), bands)


def _divided(df: DataFrame, bands) -> DataFrame:
    some = F.greatest(*[F.coalesce(F.col(f"_{b}_w"), F.lit(0)) for b in bands], F.lit(0)) > 0
    return df.filter(some).withColumns({b: F.col(f"_{b}_s").cast("double") / F.nullif(F.col(f"_{b}_w"), F.lit(0)).cast("double") for b in bands})
