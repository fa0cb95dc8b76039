"""Geometry as column expressions: UTM zone, WGS84 -> UTM forward projection,
convex polygon clipping, polygon area and point-in-polygon.

Nothing here leaves the JVM: the projection is the published Krüger series of
the transverse Mercator (coefficients derived below from the flattening),
rings are ``array<struct<x double, y double>>`` and polygon algorithms are
higher-order functions (``transform`` / ``aggregate``).
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixtrend.constants import (UTM_FALSE_EASTING, UTM_FALSE_NORTHING_SOUTH, UTM_K0, WGS84_A,
                                WGS84_F)


# --------------------------------------------------------------------------- UTM
def utm_zone(lon) -> Column:
    return (F.floor((_c(lon) + 180) / 6) + 1).cast("int")


def utm_epsg(lon, lat) -> Column:
    """326xx north of the equator (lat >= 0), 327xx south."""
    z = utm_zone(lon)
    return F.when(_c(lat) >= 0, 32600 + z).otherwise(32700 + z).cast("int")


def _krueger_alpha(n: float, order: int = 6) -> list[float]:
    """Forward series coefficients alpha_1..alpha_6 of the third flattening n
    (Krüger 1912, as tabulated by Karney 2011, eq. 35)."""
    table = {
        1: [(1, Fraction(1, 2)), (2, Fraction(-2, 3)), (3, Fraction(5, 16)), (4, Fraction(41, 180)),
            (5, Fraction(-127, 288)), (6, Fraction(7891, 37800))],
        2: [(2, Fraction(13, 48)), (3, Fraction(-3, 5)), (4, Fraction(557, 1440)),
            (5, Fraction(281, 630)), (6, Fraction(-1983433, 1935360))],
        3: [(3, Fraction(61, 240)), (4, Fraction(-103, 140)), (5, Fraction(15061, 26880)),
            (6, Fraction(167603, 181440))],
        4: [(4, Fraction(49561, 161280)), (5, Fraction(-179, 168)), (6, Fraction(6601661, 7257600))],
        5: [(5, Fraction(34729, 80640)), (6, Fraction(-3418889, 1995840))],
        6: [(6, Fraction(212378941, 319334400))],
    }
    return [sum(float(c) * n ** p for p, c in table[j]) for j in range(1, order + 1)]


_N = WGS84_F / (2 - WGS84_F)
_E = 2 * _N ** 0.5 / (1 + _N)                       # first eccentricity
_RECT_A = WGS84_A / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64 + _N ** 6 / 256)
_ALPHA = _krueger_alpha(_N)
UTM_SERIES = {"e": _E, "A": _RECT_A, "alpha": _ALPHA}


def _c(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit(v)


def let(expr, fn) -> Column:
    """Evaluate ``expr`` once and pass it to ``fn`` as a lambda variable.

    Expressions captured inside higher-order-function lambdas are evaluated
    at every access; a lambda variable is evaluated once per row.
    """
    return F.element_at(F.transform(F.array(_c(expr)), fn), 1)


def utm_xy(lon, lat, epsg, bind: bool = False) -> Column:
    """``struct(x, y)`` UTM easting/northing (m) of WGS84 lon/lat in zone ``epsg``.

    ``bind=True`` evaluates the shared terms once through lambda variables
    (for use inside higher-order functions, where codegen's common
    subexpression elimination does not reach).
    """
    lon, lat, epsg = _c(lon), _c(lat), _c(epsg)
    zone = epsg % 100
    lon0 = zone * 6 - 183
    lam = F.radians(lon - lon0)
    phi = F.radians(lat)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(_E) * F.atanh(F.lit(_E) * s))
    xi_p = F.atan2(t, F.cos(lam))
    eta_p = F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + t * t))
    if bind:
        return let(F.struct(xi_p.alias("xi"), eta_p.alias("eta")),
                   lambda v: _utm_series(v["xi"], v["eta"], epsg))
    return _utm_series(xi_p, eta_p, epsg)


def _utm_series(xi_p, eta_p, epsg) -> Column:
    xi, eta = xi_p, eta_p
    for j, a in enumerate(_ALPHA, start=1):
        xi = xi + F.lit(a) * F.sin(2 * j * xi_p) * F.cosh(2 * j * eta_p)
        eta = eta + F.lit(a) * F.cos(2 * j * xi_p) * F.sinh(2 * j * eta_p)
    k = F.lit(UTM_K0 * _RECT_A)
    x = F.lit(UTM_FALSE_EASTING) + k * eta
    y = F.when(epsg >= 32700, F.lit(UTM_FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0)) + k * xi
    return F.struct(x.alias("x"), y.alias("y"))


def with_utm(df: DataFrame, points: dict[str, tuple], epsg) -> DataFrame:
    """``df`` with a column ``name``, ``struct(x, y)`` as ``utm_xy`` gives it, for every
    ``name: (lon, lat)``: in stages of plain columns, so that the series' arguments are
    computed once and the plan stays small."""
    epsg, first, second, last = _c(epsg), {}, {}, {}
    for name, (lon, lat) in points.items():
        s = F.sin(F.radians(_c(lat)))
        t, lam, xi, eta = (f"_{name}_{k}" for k in ("t", "l", "x", "e"))
        first |= {t: F.sinh(F.atanh(s) - F.lit(_E) * F.atanh(F.lit(_E) * s)), lam: F.radians(_c(lon) - ((epsg % 100) * 6 - 183))}
        second |= {xi: F.atan2(F.col(t), F.cos(lam)), eta: F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + F.col(t) * F.col(t)))}
        last[name] = _utm_series(F.col(xi), F.col(eta), epsg)
    return df.withColumns(first).withColumns(second).withColumns(last).drop(*first, *second)


def utm_points(lon: np.ndarray, lat: np.ndarray, epsg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Easting and northing as ``utm_xy`` gives them, of arrays inside a task."""
    lam, s = np.radians(lon - (epsg % 100 * 6 - 183)), np.sin(np.radians(lat))
    t = np.sinh(np.arctanh(s) - _E * np.arctanh(_E * s))
    xi_p, eta_p = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1.0 + t * t))
    xi, eta = xi_p.copy(), eta_p.copy()
    for j, a in enumerate(_ALPHA, start=1):
        xi += a * np.sin(2 * j * xi_p) * np.cosh(2 * j * eta_p)
        eta += a * np.cos(2 * j * xi_p) * np.sinh(2 * j * eta_p)
    k = UTM_K0 * _RECT_A
    return UTM_FALSE_EASTING + k * eta, np.where(epsg >= 32700, UTM_FALSE_NORTHING_SOUTH, 0.0) + k * xi


def _inverse_series(n: float) -> tuple[list[float], list[float]]:
    """Coefficients beta_1..beta_6 of the inverse series and delta_1..delta_6 from
    conformal to geodetic latitude (Krüger 1912, as tabulated by Karney 2011, eq. 36, and Kawase 2011)."""
    beta = {
        1: [(1, Fraction(1, 2)), (2, Fraction(-2, 3)), (3, Fraction(37, 96)), (4, Fraction(-1, 360)),
            (5, Fraction(-81, 512)), (6, Fraction(96199, 604800))],
        2: [(2, Fraction(1, 48)), (3, Fraction(1, 15)), (4, Fraction(-437, 1440)),
            (5, Fraction(46, 105)), (6, Fraction(-1118711, 3870720))],
        3: [(3, Fraction(17, 480)), (4, Fraction(-37, 840)), (5, Fraction(-209, 4480)), (6, Fraction(5569, 90720))],
        4: [(4, Fraction(4397, 161280)), (5, Fraction(-11, 504)), (6, Fraction(-830251, 7257600))],
        5: [(5, Fraction(4583, 161280)), (6, Fraction(-108847, 3991680))],
        6: [(6, Fraction(20648693, 638668800))],
    }
    delta = {
        1: [(1, Fraction(2)), (2, Fraction(-2, 3)), (3, Fraction(-2)), (4, Fraction(116, 45)), (5, Fraction(26, 45)), (6, Fraction(-2854, 675))],
        2: [(2, Fraction(7, 3)), (3, Fraction(-8, 5)), (4, Fraction(-227, 45)), (5, Fraction(2704, 315)), (6, Fraction(2323, 945))],
        3: [(3, Fraction(56, 15)), (4, Fraction(-136, 35)), (5, Fraction(-1262, 105)), (6, Fraction(73814, 2835))],
        4: [(4, Fraction(4279, 630)), (5, Fraction(-332, 35)), (6, Fraction(-399572, 14175))],
        5: [(5, Fraction(4174, 315)), (6, Fraction(-144838, 6237))],
        6: [(6, Fraction(601676, 22275))],
    }
    return tuple([sum(float(c) * n ** p for p, c in t[j]) for j in sorted(t)] for t in (beta, delta))


_BETA, _DELTA = _inverse_series(_N)
UTM_SERIES |= {"beta": _BETA, "delta": _DELTA}


def with_lonlat(df: DataFrame, x: str, y: str, epsg, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``df`` with the WGS84 lon/lat (degrees) of UTM easting/northing columns in zone
    ``epsg``: the inverse of ``utm_xy``, in stages of plain columns."""
    epsg = _c(epsg)
    k = F.lit(UTM_K0 * _RECT_A)
    south = F.when(epsg >= 32700, F.lit(UTM_FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))
    df = df.withColumns({"_xi": (F.col(y) - south) / k, "_eta": (F.col(x) - UTM_FALSE_EASTING) / k})
    xi, eta = F.col("_xi"), F.col("_eta")
    for j, b in enumerate(_BETA, start=1):
        xi = xi - F.lit(b) * F.sin(2 * j * F.col("_xi")) * F.cosh(2 * j * F.col("_eta"))
        eta = eta - F.lit(b) * F.cos(2 * j * F.col("_xi")) * F.sinh(2 * j * F.col("_eta"))
    df = df.withColumns({"_xp": xi, "_ep": eta}).withColumn("_chi", F.asin(F.sin("_xp") / F.cosh("_ep")))
    phi = F.col("_chi")
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + F.lit(d) * F.sin(2 * j * F.col("_chi"))
    lam = F.degrees(F.atan2(F.sinh("_ep"), F.cos("_xp"))) + ((epsg % 100) * 6 - 183)
    return df.withColumns({lon: lam, lat: F.degrees(phi)}).drop("_xi", "_eta", "_xp", "_ep", "_chi")


def project_ring(ring, epsg) -> Column:
    return F.transform(_c(ring), lambda p: utm_xy(p["x"], p["y"], epsg, bind=True))


def bbox_ring(w, s, e, n) -> Column:
    """Counter-clockwise ring of a lon/lat or metric box."""
    w, s, e, n = _c(w), _c(s), _c(e), _c(n)
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(pt(w, s), pt(e, s), pt(e, n), pt(w, n))


def aoi_bounds(w, s, e, n, epsg) -> Column:
    """Projected AOI bounds from the SW and NE corners only (min/max of both)."""
    a, b = utm_xy(w, s, epsg), utm_xy(e, n, epsg)
    return F.struct(F.least(a["x"], b["x"]).alias("xmin"), F.least(a["y"], b["y"]).alias("ymin"),
                    F.greatest(a["x"], b["x"]).alias("xmax"),
                    F.greatest(a["y"], b["y"]).alias("ymax"))


# --------------------------------------------------------------------------- polygons
def ring_area_signed(ring) -> Column:
    """Shoelace area; positive for counter-clockwise rings."""
    def area(r):
        n = F.size(r)
        idx = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
        acc = F.aggregate(idx, F.lit(0.0), lambda a, i: a + (
            F.get(r, i)["x"] * F.get(r, (i + 1) % n)["y"]
            - F.get(r, (i + 1) % n)["x"] * F.get(r, i)["y"]))
        return F.when(n >= 3, acc / 2).otherwise(F.lit(0.0))
    return let(ring, area)


def ring_area(ring) -> Column:
    return F.abs(ring_area_signed(ring))


def clip_convex(subject, clip, orient=None) -> Column:
    """Sutherland–Hodgman: ``subject`` ring (any simple polygon) clipped by the
    convex ``clip`` ring (either orientation).  Returns the clipped ring
    (possibly empty).  ``orient`` (+1/-1, the clip ring's orientation) may be
    passed as a precomputed column; lambdas do not share subexpressions."""
    subj, clip = _c(subject), _c(clip)
    orient = _c(orient) if orient is not None else F.signum(ring_area_signed(clip))
    return let(F.struct(clip.alias("c"), orient.alias("o")),
               lambda b: _clip_bound(subj, b["c"], b["o"]))


def _clip_bound(subj, clp, orient) -> Column:
    m = F.size(clp)
    edges = F.transform(F.sequence(F.lit(0), F.greatest(m - 1, F.lit(0))),
                        lambda j: F.struct(F.get(clp, j).alias("a"),
                                           F.get(clp, (j + 1) % m).alias("b")))

    def clip_edge(poly, e):
        a, b = e["a"], e["b"]
        ux, uy = b["x"] - a["x"], b["y"] - a["y"]
        side = lambda p: (ux * (p["y"] - a["y"]) - uy * (p["x"] - a["x"])) * orient
        k = F.size(poly)

        def per_vertex(i):
            pq = F.struct(F.get(poly, i).alias("p"), F.get(poly, (i + 1) % k).alias("q"))

            def emit(v):
                p, q = v["p"], v["q"]
                return let(F.struct(side(p).alias("sp"), side(q).alias("sq")), lambda d: _emit(p, q, d))

            return let(pq, emit)

        def _emit(p, q, d):
            sp, sq = d["sp"], d["sq"]
            t = sp / (sp - sq)
            cut = F.struct((p["x"] + t * (q["x"] - p["x"])).alias("x"),
                           (p["y"] + t * (q["y"] - p["y"])).alias("y"))
            qq = F.struct(q["x"].alias("x"), q["y"].alias("y"))
            return (F.when((sq >= 0) & (sp < 0), F.array(cut, qq))
                    .when(sq >= 0, F.array(qq))
                    .when(sp >= 0, F.array(cut))
                    .otherwise(F.array().cast("array<struct<x:double,y:double>>")))

        return F.when(k == 0, poly).otherwise(
            F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0))), per_vertex)))

    start = F.transform(subj, lambda p: F.struct(p["x"].cast("double").alias("x"),
                                                 p["y"].cast("double").alias("y")))
    return F.aggregate(edges, start, clip_edge)


def coverage_ratio_projected(fp_proj, aoi_proj, orient=None) -> Column:
    """area(footprint ∩ AOI) / area(AOI) for rings already in metres; 0 if empty."""
    inter = ring_area(clip_convex(fp_proj, aoi_proj, orient))
    return F.coalesce(inter / F.nullif(ring_area(aoi_proj), F.lit(0.0)), F.lit(0.0))


def coverage_ratio(ring_ll, aoi_w, aoi_s, aoi_e, aoi_n, epsg) -> Column:
    """area(footprint ∩ AOI) / area(AOI), both projected to ``epsg``; 0 if empty.

    For large inputs project the rings into columns first and call
    ``coverage_ratio_projected`` (see ``operators.spatial``), so each vertex
    is projected once.
    """
    aoi = project_ring(bbox_ring(aoi_w, aoi_s, aoi_e, aoi_n), epsg)
    return coverage_ratio_projected(project_ring(ring_ll, epsg), aoi)


def point_in_polygon(px, py, ring) -> Column:
    """Even-odd ray casting of point (px, py) against a ring column."""
    px, py = _c(px), _c(py)

    def run(r):
        n = F.size(r)

        def step(acc, i):
            a, b = F.get(r, i), F.get(r, (i + 1) % n)
            crosses = ((a["y"] > py) != (b["y"] > py)) & (
                px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"])
            return acc != F.coalesce(crosses, F.lit(False))

        return F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(False), step)

    return let(ring, run)


def point_in_polygon_lit(px, py, coords) -> Column:
    """Same rule with a literal polygon, unrolled into plain codegen'd predicates."""
    px, py = _c(px), _c(py)
    inside = F.lit(False)
    k = len(coords)
    for i in range(k):
        (ax, ay), (bx, by) = coords[i], coords[(i + 1) % k]
        if ay == by:
            continue  # horizontal edges never cross the ray
        crosses = ((py < ay) != (py < by)) & (px < F.lit(float(bx - ax)) * (py - ay) / float(by - ay) + ax)
        inside = inside != crosses
    return inside


# --------------------------------------------------------------------------- areas by edges
EDGES = "array<struct<ax:double,ay:double,bx:double,by:double>>"


def ring_edges(ring) -> Column:
    """Edges of a ring, from each point to the next and from the last to the
    first.  A ring closed by its first point gets an edge of no length, which counts for nothing."""
    def edges(r):
        n = F.size(r)
        return F.transform(r, lambda p, i: F.struct(p["x"].cast("double").alias("ax"), p["y"].cast("double").alias("ay"),
                                                    F.get(r, (i + 1) % n)["x"].cast("double").alias("bx"), F.get(r, (i + 1) % n)["y"].cast("double").alias("by")))
    return F.coalesce(let(_c(ring), edges), F.array().cast(EDGES))


def rings_edges(rings) -> Column:
    """Edges of several rings.  Holes run against the direction of the ring
    around them; which of the two directions is meant does not matter."""
    return F.coalesce(F.flatten(F.transform(_c(rings), ring_edges)), F.array().cast(EDGES))


def edges_area_signed(edges) -> Column:
    """Area inside the edges; positive if they run counter-clockwise."""
    return F.aggregate(_c(edges), F.lit(0.0), lambda a, e: a + (e["ax"] * e["by"] - e["bx"] * e["ay"]) / 2)


def trapezoid_overlap(df: DataFrame, e: str, f: str, out: str = "overlap") -> DataFrame:
    """``df`` with the signed area that the trapezoids under edge columns ``e`` and
    ``f`` (structs ax, ay, bx, by) share.

    Each edge bounds a trapezoid down to a line below everything, positive if it runs
    right to left.  The trapezoids of a polygon add up to it, so those shared by two polygons
    add up to what the polygons share: the integral of the lower of the two edges
    over their common range of x, whatever the line (it cancels).
    """
    lo = F.greatest(F.least(f"{e}.ax", f"{e}.bx"), F.least(f"{f}.ax", f"{f}.bx"))
    hi = F.least(F.greatest(f"{e}.ax", f"{e}.bx"), F.greatest(f"{f}.ax", f"{f}.bx"))

    def at(edge: str, x: str) -> Column:
        a, b, c, d = (F.col(f"{edge}.{k}") for k in ("ax", "ay", "bx", "by"))
        return F.when(F.col("_hi") > F.col("_lo"), b + (d - b) * ((F.col(x) - a) / (c - a)))

    df = df.withColumns({"_lo": lo, "_hi": hi}).withColumns({"_e0": at(e, "_lo"), "_e1": at(e, "_hi"), "_f0": at(f, "_lo"), "_f1": at(f, "_hi")})
    d0, d1 = F.col("_e0") - F.col("_f0"), F.col("_e1") - F.col("_f1")
    t, low = F.col("_t"), F.least("_e0", "_f0") + F.least("_e1", "_f1")
    cross = F.col("_e0") + t * (F.col("_e1") - F.col("_e0"))
    mean = F.when(t.isNull(), low / 2).otherwise((t * F.least("_e0", "_f0") + (1 - t) * F.least("_e1", "_f1") + cross) / 2)
    sign = F.signum(F.col(f"{e}.ax") - F.col(f"{e}.bx")) * F.signum(F.col(f"{f}.ax") - F.col(f"{f}.bx"))
    area = F.coalesce(sign * mean * (F.col("_hi") - F.col("_lo")), F.lit(0.0))
    keep = [F.col(c) for c in df.columns if c not in ("_lo", "_hi", "_e0", "_e1", "_f0", "_f1")]
    return df.withColumn("_t", F.when(d0 * d1 < 0, d0 / (d0 - d1))).select(*keep, area.alias(out))


def trapezoids_shared(e: np.ndarray, f: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``trapezoid_overlap``, inside a task: the areas shared by edges ``i`` of ``e`` and ``j`` of ``f``
    (columns ax, ay, bx, by) where they have a common range of x, and the places of those in ``i``."""
    (ea, eb, ec, ed), (fa, fb, fc, fd) = (np.ascontiguousarray(x.T) for x in (e, f))
    lo = np.maximum(np.minimum(ea, ec)[i], np.minimum(fa, fc)[j])
    hi = np.minimum(np.maximum(ea, ec)[i], np.maximum(fa, fc)[j])
    common = np.flatnonzero(hi > lo)
    lo, hi, i, j = lo[common], hi[common], i[common], j[common]
    x, y, slope = ea[i], eb[i], ((ed - eb) / (ec - ea))[i]
    e0, e1 = y + slope * (lo - x), y + slope * (hi - x)
    x, y, slope = fa[j], fb[j], ((fd - fb) / (fc - fa))[j]
    f0, f1 = y + slope * (lo - x), y + slope * (hi - x)
    mean = (np.minimum(e0, f0) + np.minimum(e1, f1)) / 2
    d0, d1 = e0 - f0, e1 - f1
    x = np.flatnonzero(d0 * d1 < 0)  # the edges cross between lo and hi
    t = d0[x] / (d0[x] - d1[x])
    cross = e0[x] + t * (e1[x] - e0[x])
    mean[x] = (t * np.minimum(e0, f0)[x] + (1 - t) * np.minimum(e1, f1)[x] + cross) / 2
    return np.sign(ea - ec)[i] * np.sign(fa - fc)[j] * mean * (hi - lo), common
