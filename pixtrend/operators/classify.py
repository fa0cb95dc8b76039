"""User pixel classifier over scene tiles (the one place Python runs on executors).

The reference calls a neural cloud classifier on whole (R, G, NIR) scene
arrays.  Here the caller's function receives one tile at a time: Spark groups
pixels by ``(scene_id, tile_y, tile_x)``, so a group is at most one tile of
one scene (bounded by the tile size, never by the data size), Arrow ships the
columns and the function sees a dense ``(3, H, W)`` float array with NaN for
missing pixels.  Pixels within ``halo`` of a tile edge are also sent to the
neighbouring tiles as context and only each tile's own pixels are returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType

OUT_SCHEMA = "scene_id int, x int, y int, cls int"


def normalise_layers(pred: np.ndarray) -> np.ndarray:
    """``(1, H, W)`` -> layer 0; ``(3, H, W)`` -> layer 1; ``(H, W)`` as is."""
    if pred.ndim == 3:
        if pred.shape[0] == 1:
            return pred[0]
        if pred.shape[0] == 3:
            return pred[1]
    return pred


def _tile_runner(fn: Callable[[np.ndarray], np.ndarray], bands, kw: dict):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x0, y0 = int(pdf["x"].min()), int(pdf["y"].min())
        h, w = int(pdf["y"].max()) - y0 + 1, int(pdf["x"].max()) - x0 + 1
        arr = np.full((len(bands), h, w), np.nan, dtype="float32")
        iy, ix = pdf["y"].to_numpy() - y0, pdf["x"].to_numpy() - x0
        for k, b in enumerate(bands):
            arr[k, iy, ix] = pdf[b].to_numpy(dtype="float64", na_value=np.nan)
        pred = normalise_layers(np.asarray(fn(arr, **kw)))
        if pred.shape != (h, w):
            raise ValueError(f"mask shape {pred.shape} does not match tile shape {(h, w)}")
        core = pdf["_core"].to_numpy(dtype=bool)
        return pd.DataFrame({"scene_id": pdf["scene_id"].to_numpy()[core],
                             "x": pdf["x"].to_numpy()[core], "y": pdf["y"].to_numpy()[core],
                             "cls": pred[iy[core], ix[core]].astype("int32")})
    return run


def _spread(obs: DataFrame, tile: int, halo: int, bands) -> DataFrame:
    """Rows of ``obs`` with the tile ``(_ty, _tx)`` they go to; ``_core`` marks the tile's own pixels."""
    tx = F.floor(F.col("x") / tile).cast("int")
    ty = F.floor(F.col("y") / tile).cast("int")
    base = obs.select("scene_id", "x", "y", *bands)
    if halo > 0:
        # every pixel goes to its own tile and, within ``halo`` of an edge, to
        # each neighbouring tile once: an offset is kept only if every shifted
        # axis really lands in another tile (no duplicates, no aggregation)
        off = F.sequence(F.lit(-1), F.lit(1))
        ex = base.select("*", F.explode(off).alias("_dx")).select("*", F.explode(off).alias("_dy"))
        ntx = F.floor((F.col("x") + F.col("_dx") * halo) / tile).cast("int")
        nty = F.floor((F.col("y") + F.col("_dy") * halo) / tile).cast("int")
        ex = ex.select(*base.columns, "_dx", "_dy", ntx.alias("_tx"), nty.alias("_ty"), tx.alias("_ox"),
                       ty.alias("_oy"))
        ex = ex.filter(((F.col("_dx") == 0) | (F.col("_tx") != F.col("_ox"))) &
                       ((F.col("_dy") == 0) | (F.col("_ty") != F.col("_oy"))))
        ex = ex.withColumn("_core", (F.col("_dx") == 0) & (F.col("_dy") == 0))
    else:
        ex = base.select("*", tx.alias("_tx"), ty.alias("_ty"), F.lit(True).alias("_core"))
    return ex.select("scene_id", "x", "y", *bands, "_tx", "_ty", "_core")


def classify_tiles(obs: DataFrame, fn: Callable[..., np.ndarray], tile: int = 512, halo: int = 0,
                   bands=("red", "green", "nir"), fn_kwargs: dict | None = None) -> DataFrame:
    """Class raster ``(scene_id, x, y, cls)`` from a user function over tiles."""
    return _spread(obs, tile, halo, bands).groupBy("scene_id", "_ty", "_tx").applyInPandas(
        _tile_runner(fn, list(bands), fn_kwargs or {}), OUT_SCHEMA)


class _Assembler:
    """Turns rows that come tile by tile into dense tiles and hands them to the
    model ``size`` at a time, whichever scenes they belong to.  Holds ``size``
    tiles at most, each of ``tile + 2 * halo`` pixels a side."""

    def __init__(self, fn, bands, tile: int, halo: int, size: int, kw: dict):
        self.fn, self.kw, self.bands, self.tile, self.halo, self.size = fn, kw, bands, tile, halo, size
        side = tile + 2 * halo
        self.pixels = np.full((size, len(bands), side, side), np.nan, dtype="float32")
        self.own = np.zeros((size, side, side), dtype=bool)
        self.names: list[tuple] = []

    def add(self, name: tuple, rows: pa.RecordBatch) -> None:
        """Rows of tile ``name``, more of the last one or of a new one."""
        if not self.names or self.names[-1] != name:
            self.names.append(name)
        at = len(self.names) - 1
        iy = rows["y"].to_numpy(zero_copy_only=False) - (name[1] * self.tile - self.halo)
        ix = rows["x"].to_numpy(zero_copy_only=False) - (name[2] * self.tile - self.halo)
        for k, b in enumerate(self.bands):
            self.pixels[at, k, iy, ix] = rows[b].cast(pa.float64()).to_numpy(zero_copy_only=False)
        self.own[at, iy, ix] = rows["_core"].to_numpy(zero_copy_only=False)

    def full(self, name: tuple) -> bool:
        return len(self.names) == self.size and self.names[-1] != name

    def classes(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Classes of the tiles held, one batch of rows a tile; holds none afterwards."""
        n = len(self.names)
        if n == 0:
            return
        pred = np.asarray(self.fn(self.pixels[:n], **self.kw))
        if pred.ndim == 4:
            pred = np.stack([normalise_layers(p) for p in pred])
        if pred.shape != self.own[:n].shape:
            raise ValueError(f"mask shape {pred.shape} does not match the batch {self.own[:n].shape}")
        for i, (scene, ty, tx) in enumerate(self.names):
            iy, ix = np.nonzero(self.own[i])
            cols = [[scene] * len(iy), ix + (tx * self.tile - self.halo), iy + (ty * self.tile - self.halo), pred[i, iy, ix].astype("int32")]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
        self.pixels[:n], self.own[:n] = np.nan, False
        self.names.clear()


def classify_batches(obs: DataFrame, fn: Callable[..., np.ndarray], tile: int = 512, halo: int = 0, batch_size: int = 8,
                     bands=("red", "green", "nir"), fn_kwargs: dict | None = None) -> DataFrame:
    """Class raster ``(scene_id, x, y, cls)`` from a model that takes batches of tiles.

    ``fn`` gets up to ``batch_size`` tiles as ``(N, bands, side, side)``, all of one
    shape (``side = tile + 2 * halo``, NaN where there is no pixel, at the edges
    of a scene too), and returns ``(N, side, side)`` or layers of that.  A task
    sorts its rows by tile, so that tiles are put together as they stream by: a
    task holds one batch of tiles, however many tiles or scenes it has.  The
    answer is the same for every batch size if ``fn`` treats tiles alike.

    One row a pixel: of rows that repeat a pixel the largest values count (by
    ``bands``, in their order).  Rows without scene or place are left out; an
    empty table gives no rows."""
    bands = list(bands)
    if tile < 1 or batch_size < 1 or not 0 <= halo <= tile:
        raise ValueError("tile and batch_size start from 1, halo lies in [0, tile]")
    placed = obs.filter(F.col("scene_id").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull())
    rows = (_spread(placed, tile, halo, bands).repartition("scene_id", "_ty", "_tx")
            .sortWithinPartitions("scene_id", "_ty", "_tx", "y", "x", *bands))
    kinds = dict(obs.dtypes)
    out = ", ".join([*[f"{c} {kinds[c]}" for c in ("scene_id", "x", "y")], "cls int"])
    schema = to_arrow_schema(DataType.fromDDL(out))
    kw = fn_kwargs or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Assembler(fn, bands, tile, halo, batch_size, kw)
        for rows in batches:
            if rows.num_rows == 0:
                continue
            new = np.zeros(rows.num_rows, dtype=bool)
            for c in ("scene_id", "_ty", "_tx"):
                new[1:] |= pc.not_equal(rows[c][1:], rows[c][:-1]).to_numpy(zero_copy_only=False)
            edges = [0, *np.nonzero(new)[0].tolist(), rows.num_rows]
            for lo, hi in zip(edges, edges[1:], strict=False):
                name = tuple(rows[c][lo].as_py() for c in ("scene_id", "_ty", "_tx"))
                if held.full(name):
                    yield from held.classes(schema)
                held.add(name, rows.slice(lo, hi - lo))
        yield from held.classes(schema)

    return rows.mapInArrow(run, out)


def bright_rule(arr: np.ndarray, thr: float = 3000.0) -> np.ndarray:
    """A rule-based stand-in classifier: class 1 where the three bands sum to
    more than ``3 * thr``, else 0 (a missing band -> 0)."""
    with np.errstate(invalid="ignore"):
        return (arr.sum(axis=0) > 3 * thr).astype("int32")


def bright_surroundings(arr: np.ndarray, thr: float = 3000.0) -> np.ndarray:
    """A rule that needs a halo of one: class 1 where the three bands, summed over
    the pixels of the 3 x 3 neighbourhood that have all of them, exceed ``3 * thr``
    a pixel.  ``(N, 3, H, W)`` -> ``(N, H, W)``."""
    total = arr.sum(axis=1)
    there = ~np.isnan(total)
    parts = [np.pad(a, ((0, 0), (1, 1), (1, 1))) for a in (np.where(there, total, 0), there.astype("float32"))]
    h, w = total.shape[1:]
    s, n = (sum(p[:, i:i + h, j:j + w] for i in range(3) for j in range(3)) for p in parts)
    return (s > 3 * thr * n).astype("int32")
