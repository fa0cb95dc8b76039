"""AOI x catalogue spatial join and footprint coverage, without a cross join.

Pairs whose boxes touch come from the quadtree join (``quadtree``).  What a
footprint and an AOI share is one sum over pairs of their edges, which serves
rings of any shape, with holes or in several parts.  The sum is taken where the
join makes the pair: pairs are many times the input and are not dealt again.  A task gets the
footprints and AOIs of a cell and pairs them itself, so an edge is projected once a zone; of a footprint's edges
only those that cross the AOI's box are summed edge by edge.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pixtrend.constants import AOI_MIN_COVERAGE_RATIO
from pixtrend.functions import geo as G
from pixtrend.operators.quadtree import BOX, PART_ROWS, cell_groups, touching, touching_rows

POINTS = "array<array<struct<x:double,y:double>>>"


def _rings(df: DataFrame, corners: list[Column] | None = None) -> Column:
    """The polygon of a row as rings: ``rings``, or the one ring ``ring``, or the box."""
    if "rings" in df.columns:
        return F.col("rings").cast(POINTS)
    return F.array(F.col("ring") if "ring" in df.columns else G.bbox_ring(*[F.col(c) for c in BOX])).cast(POINTS)


def aoi_scene_pairs(scenes: DataFrame, aois: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """``(aoi_id, item_id, boxes and rings of both)`` for every AOI and scene whose bboxes touch."""
    s = scenes.select("item_id", *[F.col(c).alias(f"s_{c}") for c in BOX], _rings(scenes).alias("s_rings"))
    a = aois.select("aoi_id", *[F.col(c).alias(f"a_{c}") for c in BOX], _rings(aois).alias("a_rings"))
    return touching(s, a, "s_", "a_", part_rows)


def _projected(df: DataFrame, edge: str, epsg: str) -> DataFrame:
    """``edge`` (lon/lat) in metres of zone ``epsg``, from the point ``_o``."""
    df = G.with_utm(df, {"_p": (f"{edge}.ax", f"{edge}.ay"), "_q": (f"{edge}.bx", f"{edge}.by")}, epsg)
    at = F.struct(*[(F.col(f"{n}.{c}") - F.col(f"_o.{c}")).alias(f"{end}{c}") for end, n in (("a", "_p"), ("b", "_q")) for c in "xy"])
    return df.withColumn(edge, at)


def aoi_coverage(scenes: DataFrame, aois: DataFrame, epsg=None, min_ratio: float | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Coverage ratio, area(footprint ∩ AOI) / area(AOI), of every (AOI, scene)
    pair whose bboxes touch; 0 if they share nothing.

    Both are projected to ``epsg`` (a number or a column of ``aois``), by default the UTM
    zone of the AOI's centre.  Footprints and AOIs are polygons in ``rings`` (holes
    run against the ring around them), or ``ring``; an AOI may be a box.  ``min_ratio``
    keeps pairs at or above it: pairs whose boxes overlap by less than half of
    that are dropped before any projection if the AOI is a box (areas stretch far less than twofold inside an AOI).

    The edges of an AOI are projected once, before the join; those of a footprint once
    for each cell and zone it has pairs in.  Footprints of one ``item_id`` count as one
    polygon: ids that come more than once are summed by pair, all others need no exchange after the join.
    """
    boxed = not {"ring", "rings"} & set(aois.columns)
    if epsg is None:
        epsg = G.utm_epsg((F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2)
    elif isinstance(epsg, int):
        epsg = F.lit(epsg)
    a = aois.withColumns({"_epsg": epsg.cast("int"), "_edges": G.rings_edges(_rings(aois))})
    a = a.select("aoi_id", *[F.col(c).alias(f"a_{c}") for c in BOX], F.col("_epsg").alias("epsg"), F.posexplode_outer("_edges").alias("_i", "_e"))
    # the AOI's edges in metres, from its box's south-west corner, back in one row
    a = _projected(G.with_utm(a, {"_o": ("a_west", "a_south")}, "epsg"), "_e", "epsg")
    a = a.groupBy("aoi_id", *[f"a_{c}" for c in BOX], "epsg", "_o").agg(F.collect_list("_e").alias("a_edges"))
    a = a.withColumn("a_area", G.edges_area_signed("a_edges")).withColumn("a_edges", _flat("a_edges"))
    a = a.withColumns({"_ox": F.col("_o.x"), "_oy": F.col("_o.y")}).drop("_o")
    s = scenes.select("item_id", *[F.col(c).alias(f"s_{c}") for c in BOX], G.rings_edges(_rings(scenes)).alias("s_edges")).withColumn("s_edges", _flat("s_edges"))

    def shared_areas(s: DataFrame) -> DataFrame:
        p = touching(s, a, "s_", "a_", part_rows)
        if min_ratio is not None and boxed:
            shared = ((F.least("s_east", "a_east") - F.greatest("s_west", "a_west")) * (F.least("s_north", "a_north") - F.greatest("s_south", "a_south")))
            p = p.filter(shared >= (F.col("a_east") - F.col("a_west")) * (F.col("a_north") - F.col("a_south")) * (min_ratio / 2))
        p = p.select("aoi_id", "item_id", "epsg", "a_area", "_ox", "_oy", "a_edges", "s_edges")
        kept = p.select("aoi_id", "item_id", "epsg", "a_area").schema
        return p.mapInArrow(_shared_areas, kept.add("_both", "double").add("_s_area", "double"))

    def ratios(s: DataFrame) -> DataFrame:
        rows = cell_groups(s, a, "s_", "a_", part_rows)
        kept = StructType([StructField(f.name, f.dataType) for f in rows.select("aoi_id", "item_id", "epsg").schema]).add("coverage_ratio", "double")
        return rows.mapInArrow(_ratios(min_ratio if boxed else None), kept)

    again = s.groupBy("item_id").count().where("count > 1").select(F.col("item_id").alias("_again"))
    if again.isEmpty():
        out = ratios(s)
    else:
        same = F.col("item_id").eqNullSafe(F.col("_again"))
        g = shared_areas(s.join(again, same, "left_semi")).groupBy("aoi_id", "item_id", "epsg", "a_area").agg(F.sum("_both").alias("_both"), F.sum("_s_area").alias("_s_area"))
        # the directions of both polygons cancel out of the shared area
        ratio = F.col("_both") * F.signum("_s_area") / F.nullif(F.col("a_area"), F.lit(0.0))
        out = g.select("aoi_id", "item_id", "epsg", F.coalesce(ratio, F.lit(0.0)).alias("coverage_ratio")).unionByName(ratios(s.join(again, same, "left_anti")))
    return out if min_ratio is None else coverage_filter(out, min_ratio)


#: Pairs of edges that a task takes up at once.
EDGE_PAIRS = 1 << 16


def _flat(edges: str) -> Column:
    """The coordinates of a column of edges, those without nulls, in one array."""
    whole = F.filter(edges, lambda e: e["ax"].isNotNull() & e["ay"].isNotNull() & e["bx"].isNotNull() & e["by"].isNotNull())
    return F.flatten(F.transform(whole, lambda e: F.array(e["ax"], e["ay"], e["bx"], e["by"])))


def _edges(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, coordinates)`` of all edges of a column of ``_flat`` ones, in order of the rows."""
    flat = lists.flatten().to_numpy().reshape(-1, 4)
    return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy() // 4), flat


def _in_metres(row: np.ndarray, edge: np.ndarray, epsg: np.ndarray) -> np.ndarray:
    """``edge`` (lon/lat) of pair ``row`` in the pair's zone.  Pairs that follow each other often have the same
    edges: those of a run are projected once for each zone."""
    pairs, first, n = np.unique(row, return_index=True, return_counts=True)
    back = np.arange(len(row)) - np.repeat(n, n)  # the same edge of the pair before, if it has as many
    like = (edge == edge[np.maximum(back, 0)]).all(axis=1) & (back >= 0)
    like = np.logical_and.reduceat(like, first) & (n == np.concatenate([[0], n[:-1]]))
    zones, zone = np.unique(epsg[pairs], return_inverse=True)
    _, one, which = np.unique(np.cumsum(~like) * len(zones) + zone, return_index=True, return_inverse=True)
    start = np.cumsum(n[one]) - n[one]
    at = np.arange(n[one].sum()) + np.repeat(first[one] - start, n[one])
    x, y = G.utm_points(edge[at][:, 0::2].ravel(), edge[at][:, 1::2].ravel(), np.repeat(epsg[row[at]], 2))
    flat = np.column_stack([x, y]).reshape(-1, 4)
    return flat[np.arange(len(row)) + np.repeat(start[which] - first, n)]


def _shared_areas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_both`` and ``_s_area``, the signed areas that both share and of the footprint, of each pair."""
    for batch in batches:
        size = batch.num_rows
        both, s_area, some = np.zeros(size), np.zeros(size), np.zeros(size, dtype=bool)
        a_row, f = _edges(batch.column("a_edges"))
        row, lonlat = _edges(batch.column("s_edges"))
        with np.errstate(all="ignore"):
            if len(row):
                origin = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("_ox", "_oy")] * 2)
                e = _in_metres(row, lonlat, batch.column("epsg").to_numpy(zero_copy_only=False)) - origin[row]
                s_area = np.bincount(row, (e[:, 0] * e[:, 3] - e[:, 2] * e[:, 1]) / 2, size)
                some[row] = True
                n = np.bincount(a_row, minlength=size)
                first, n = (np.cumsum(n) - n)[row], n[row]
                end = np.cumsum(n)
                i = 0
                while i < len(row):
                    before = end[i - 1] if i else 0
                    j = max(i + 1, int(np.searchsorted(end, before + EDGE_PAIRS, "right")))
                    k = np.repeat(np.arange(i, j), n[i:j])
                    at = np.arange(len(k)) + np.repeat(first[i:j] - (end[i:j] - n[i:j] - before), n[i:j])
                    area, which = G.trapezoids_shared(e[i:j], f, k - i, at)
                    both += np.bincount(row[k[which]], area, size)
                    i = j
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(both), pa.array(s_area, mask=~some)],
                                         names=["aoi_id", "item_id", "epsg", "a_area", "_both", "_s_area"])


def _expanded(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each ``k``, ``n[k]`` numbers from ``first[k]`` on; and which k they are of."""
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) + np.repeat(first - np.cumsum(n) + n, n), of


def _metres(lonlat: np.ndarray, epsg: int) -> np.ndarray:
    """Edges (lon/lat) in metres of a zone; a point that ends one edge and begins the next is projected once."""
    chained = np.append((lonlat[:-1, 2:] == lonlat[1:, :2]).all(axis=1), False)[:len(lonlat)]
    loose = np.flatnonzero(~chained)
    x, y = G.utm_points(np.append(lonlat[:, 0], lonlat[loose, 2]), np.append(lonlat[:, 1], lonlat[loose, 3]), np.full(len(lonlat) + len(loose), epsg))
    out, n = np.empty_like(lonlat), len(lonlat)
    out[:, 0], out[:, 1] = x[:n], y[:n]
    out[:-1, 2:] = out[1:, :2]
    out[loose, 2], out[loose, 3] = x[n:], y[n:]
    return out


def _both(e: np.ndarray, first: np.ndarray, n: np.ndarray, f: np.ndarray, f_first: np.ndarray, f_n: np.ndarray, origin: np.ndarray, area: np.ndarray, box: np.ndarray) -> np.ndarray:
    """Signed areas shared by the polygons of pairs: the ``n`` edges of ``e`` (metres) from ``first`` on
    with those of ``f`` (from ``origin``) of an AOI of signed ``area`` and bounds ``box`` (from ``origin``).

    Over the common range of x an edge below the AOI bounds nothing of it.  One above all of it from side to
    side bounds it whole.  All others are summed against the AOI's edges."""
    k, of = _expanded(first, n)
    ax, bx = e[k, 0] - origin[of, 0], e[k, 2] - origin[of, 0]
    west, east = box[of, 0], box[of, 2]
    lo, hi = np.maximum(np.minimum(ax, bx), west), np.minimum(np.maximum(ax, bx), east)
    near = np.flatnonzero(hi > lo)
    k, of, ax, bx, lo, hi = k[near], of[near], ax[near], bx[near], lo[near], hi[near]
    ay, by = e[k, 1] - origin[of, 1], e[k, 3] - origin[of, 1]
    slope = (by - ay) / (bx - ax)
    y0, y1 = ay + slope * (lo - ax), ay + slope * (hi - ax)
    below = np.maximum(y0, y1) <= box[of, 1]
    whole = (np.minimum(y0, y1) >= box[of, 3]) & (lo == west[near]) & (hi == east[near])
    both = np.bincount(of[whole], np.sign(ax - bx)[whole] * area[of[whole]], len(n)).astype(float)
    cross = np.flatnonzero(~(below | whole))
    of, edges = of[cross], np.column_stack([ax[cross], ay[cross], bx[cross], by[cross]])
    size = f_n[of]
    end, i = np.cumsum(size), 0
    while i < len(of):
        j = max(i + 1, int(end.searchsorted((end[i - 1] if i else 0) + EDGE_PAIRS, "right")))
        at, row = _expanded(f_first[of[i:j]], size[i:j])
        shared, which = G.trapezoids_shared(edges[i:j], f, row, at)
        both += np.bincount(of[i:j][row[which]], shared, len(n))
        i = j
    return both


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Blocks of whole cells from batches sorted by ``_cell``, and where these begin and the last one ends."""
    def starts(t: pa.Table) -> list[int]:
        cell = t.column("_cell").to_numpy()
        return [*np.flatnonzero(np.append(True, cell[1:] != cell[:-1])).tolist(), len(cell)]

    held: list[pa.RecordBatch] = []  # rows of one cell that may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and batch.column(0)[-1] == held[0].column(0)[0]:
            held.append(batch)
            continue
        t = pa.Table.from_batches([*held, batch]).combine_chunks()
        cut = starts(t)
        held = t.slice(cut[-2]).to_batches()
        if len(cut) > 2:
            yield t.slice(0, cut[-2]), cut[:-1]
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, starts(t)


def _ratios(min_ratio: float | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Coverage ratios of the pairs among rows of ``cell_groups``; pairs whose boxes share less than half of ``min_ratio`` left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, starts in _whole_cells(batches):
            of_b = block.column("_of_b").to_numpy()
            boxes, where = (np.column_stack([block.column(c).to_numpy() for c in names]) for names in (BOX, ("_side", "_cx", "_cy")))
            for i, j in pairwise(starts):
                m = i + int(np.count_nonzero(~of_b[i:j]))
                if i < m < j:
                    yield from _cell_ratios(block.slice(i, m - i), boxes[i:m], block.slice(m, j - m), boxes[m:j], tuple(where[i].tolist()), min_ratio)

    return run


def _cell_ratios(s: pa.Table, s_box: np.ndarray, a: pa.Table, a_box: np.ndarray, cell: tuple[float, int, int], min_ratio: float | None) -> Iterator[pa.RecordBatch]:
    order = np.argsort(s_box[:, 1], kind="stable")
    s, s_box = s.take(order), s_box[order]
    item, aoi, zone = s.column("item_id").combine_chunks(), a.column("aoi_id").combine_chunks(), a.column("epsg").combine_chunks()
    epsg = pc.fill_null(zone, -1).to_numpy(zero_copy_only=False)
    f_row, f = _edges(a.column("a_edges").combine_chunks())
    f_n = np.bincount(f_row, minlength=len(a))
    f_first = np.cumsum(f_n) - f_n
    box = np.full((len(a), 4), np.nan)  # of the AOI's edges, in metres from its origin
    some = np.flatnonzero(f_n)
    if len(some):
        x, y = (np.column_stack([np.minimum(f[:, c], f[:, c + 2]), np.maximum(f[:, c], f[:, c + 2])]) for c in (0, 1))
        for c, reduced in enumerate((np.minimum.reduceat(x[:, 0], f_first[some]), np.minimum.reduceat(y[:, 0], f_first[some]), np.maximum.reduceat(x[:, 1], f_first[some]), np.maximum.reduceat(y[:, 1], f_first[some]))):
            box[some, c] = reduced
    origin = np.column_stack([a.column(c).to_numpy() for c in ("_ox", "_oy")]).astype(float)
    area = a.column("a_area").to_numpy().astype(float)  # null: nan
    e_row, lonlat = _edges(s.column("s_edges").combine_chunks())
    n = np.bincount(e_row, minlength=len(s))
    first = np.cumsum(n) - n
    # where edges are missing the area depends on the point it is taken from
    open_ = np.zeros(len(s), bool)
    for c in (0, 1):
        open_ |= np.abs(np.bincount(e_row, lonlat[:, c] - lonlat[:, c + 2], len(s))) > 1e-9
    with np.errstate(all="ignore"):
        for z in np.unique(epsg).tolist():
            mine = np.flatnonzero(epsg == z)
            e = _metres(lonlat, z) if len(lonlat) else lonlat
            p = e[first[e_row]]  # the footprint's first edge
            areas = np.bincount(e_row, ((e[:, 0] - p[:, 0]) * (e[:, 3] - p[:, 1]) - (e[:, 2] - p[:, 0]) * (e[:, 1] - p[:, 1])) / 2, len(s))
            for i, j in touching_rows(s_box, a_box[mine], cell):
                j = mine[j]
                if min_ratio is not None:
                    u, v = s_box[i], a_box[j]
                    both = (np.minimum(u[:, 2], v[:, 2]) - np.maximum(u[:, 0], v[:, 0])) * (np.minimum(u[:, 3], v[:, 3]) - np.maximum(u[:, 1], v[:, 1]))
                    keep = both >= (v[:, 2] - v[:, 0]) * (v[:, 3] - v[:, 1]) * (min_ratio / 2)
                    i, j = i[keep], j[keep]
                both = _both(e, first[i], n[i], f, f_first[j], f_n[j], origin[j], area[j], box[j])
                s_area, some = areas[i], np.flatnonzero(open_[i])
                if len(some):
                    k, of = _expanded(first[i[some]], n[i[some]])
                    o = origin[j[some]][of]
                    s_area[some] = np.bincount(of, ((e[k, 0] - o[:, 0]) * (e[k, 3] - o[:, 1]) - (e[k, 2] - o[:, 0]) * (e[k, 1] - o[:, 1])) / 2, len(some))
                # the directions of both polygons cancel out of the shared area
                ratio = np.where((n[i] > 0) & (area[j] != 0) & ~np.isnan(area[j]), both * np.sign(s_area) / area[j], 0.0)
                yield pa.RecordBatch.from_arrays([aoi.take(pa.array(j)), item.take(pa.array(i)), zone.take(pa.array(j)), pa.array(ratio)], names=["aoi_id", "item_id", "epsg", "coverage_ratio"])


def coverage_filter(coverage: DataFrame, min_ratio: float = AOI_MIN_COVERAGE_RATIO) -> DataFrame:
    """Pairs whose footprint covers at least ``min_ratio`` of the AOI."""
    return coverage.filter(F.col("coverage_ratio") >= min_ratio)
