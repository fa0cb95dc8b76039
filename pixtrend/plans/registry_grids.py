"""Registered queries of the geometry operators: grid matching, reprojection,
polygon tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixtrend.operators.classify import bright_surroundings, classify_batches
from pixtrend.operators.gridmatch import Grid, match_bilinear, match_nearest
from pixtrend.operators import pixelstate as PS
from pixtrend.operators.mosaic import PIXEL_KEYS, median_mosaic
from pixtrend.operators.reproject import grid_cells, reproject
from pixtrend.operators.spans import clip_polygons
from pixtrend.functions.indices import TC_NAMES, tasseled_cap
from pixtrend.plans import oracle as O
from pixtrend.constants import BANDS
from pixtrend.plans.registry import _sigma_sql, register
from pixtrend.session import new_scratch_path
from pixtrend.sources import fixtures as fx
from pixtrend.sources.scenestore import masked_scenes, write_scenes
from pixtrend.streaming.completeness import last_status, release_scenes_stream

# --------------------------------------------------------------------------- J6/J7 any reference grid
#: A 60 m band and the class mask's 20 m cells, on grids that share no origin with the reference.
COARSE, FINE, WIDE, ODD = Grid(60), Grid(10, 5, -15), Grid(25, 5, 5), Grid(15, -10, 5)

O.cte("bands_60m", "select scene_id, x // 6 as sx, y // 6 as sy, red, nir from nd where x % 6 = 0 and y % 6 = 0", "nd")


def _extent_sql(src: str, s: Grid, t: Grid) -> str:
    def first(edge: str, axis: str) -> str:
        shift = 2 * (t.origin(axis) - s.origin(axis)) + t.res
        return f"cast(ceil(({edge} * {2 * s.res} - ({shift})) / {2.0 * t.res}e0) as bigint)"

    return (f"select scene_id, x, unnest(range(y0, y1)) as y from (select scene_id, unnest(range(x0, x1)) as x, y0, y1 from ("
            f"select scene_id, {first('min(sx)', 'x')} as x0, {first('(max(sx) + 1)', 'x')} as x1, {first('min(sy)', 'y')} as y0, "
            f"{first('(max(sy) + 1)', 'y')} as y1 from {src} group by scene_id) e0) e1")


def _match_sql(src: str, bands, s: Grid, t: Grid) -> str:
    """Independent form: distances of cell centres in metres, triangle weights."""
    half = 2 * max(s.res, t.res)

    def weight(axis: str) -> str:
        return f"greatest({half} - abs(({2 * s.res} * b.s{axis} + {s.res + 2 * s.origin(axis)}) - ({2 * t.res} * g.{axis} + {t.res + 2 * t.origin(axis)})), 0)"

    vals = ", ".join(f"sum({b} * wx * wy)::double / sum(case when {b} is not null then wx * wy end)::double as {b}" for b in bands)
    return (f"select scene_id, x, y, {vals} from (select g.*, {', '.join(f'b.{b}' for b in bands)}, {weight('x')} as wx, {weight('y')} as wy "
            f"from ({_extent_sql(src, s, t)}) g join {src} b on b.scene_id = g.scene_id) w where wx > 0 and wy > 0 group by scene_id, x, y "
            f"having " + " or ".join(f"count({b}) > 0" for b in bands))


def _bands_60m(spark, sf_dir):
    from pixtrend.plans.registry import nd_obs

    nd = nd_obs(spark, sf_dir).filter((F.col("x") % 6 == 0) & (F.col("y") % 6 == 0))
    return nd.select("scene_id", F.floor(F.col("x") / 6).cast("int").alias("sx"), F.floor(F.col("y") / 6).cast("int").alias("sy"), "red", "nir")


@register("resample_match", O.with_ctes(_match_sql("bands_60m", ["red", "nir"], COARSE, FINE), "bands_60m"))
def q_resample_match(spark, sf_dir):
    """60 m bands on a 10 m reference grid with another origin."""
    return match_bilinear(_bands_60m(spark, sf_dir), ["red", "nir"], COARSE, FINE)


O.cte("cells_10m", "select scene_id, x as sx, y as sy, red, nir from nd", "nd")


@register("resample_match_down", O.with_ctes(_match_sql("cells_10m", ["red", "nir"], Grid(10), WIDE), "cells_10m"))
def q_resample_match_down(spark, sf_dir):
    """10 m bands on a 25 m reference grid with another origin."""
    from pixtrend.plans.registry import nd_obs

    cells = nd_obs(spark, sf_dir).select("scene_id", F.col("x").alias("sx"), F.col("y").alias("sy"), "red", "nir")
    return match_bilinear(cells, ["red", "nir"], Grid(10), WIDE)


def _nearest_sql(src: str, s: Grid, t: Grid) -> str:
    def cell(axis: str) -> str:
        return f"cast(floor(({2 * t.res} * g.{axis} + {t.res + 2 * t.origin(axis) - 2 * s.origin(axis)}) / {2.0 * s.res}e0) as bigint)"

    return (f"select g.scene_id, g.x, g.y, b.cls from ({_extent_sql(src, s, t)}) g join {src} b on b.scene_id = g.scene_id "
            f"and b.sx = {cell('x')} and b.sy = {cell('y')}")


O.cte("class_cells", "select scene_id, x as sx, y as sy, cls from class_mask", "class_mask")


@register("resample_match_nearest", O.with_ctes(_nearest_sql("class_cells", Grid(20), ODD), "class_cells"))
def q_resample_match_nearest(spark, sf_dir):
    """20 m classes on a 15 m reference grid with another origin."""
    cells = fx.class_mask(spark, sf_dir).withColumnsRenamed({"x": "sx", "y": "sy"})
    return match_nearest(cells, ["cls"], Grid(20), ODD)


# --------------------------------------------------------------------------- P5 two zones on one grid
#: The reference grid lies in zone 5 beside the meridian -150; every second scene comes in zone 6.
ZONE, NEXT_ZONE = 32605, 32606
REFERENCE = Grid(10, 812_000, 2_214_000)
NEXT_GRID = Grid(10, 184_140, 2_214_030)
ZONES = {ZONE: REFERENCE, NEXT_ZONE: NEXT_GRID}


def lonlat_sql(x: str, y: str, epsg: int, src: str, keep: str) -> str:
    """Inverse of ``oracle.utm_sql`` in stages, columns ``lon`` and ``lat`` added to ``keep``."""
    from pixtrend.constants import UTM_FALSE_EASTING, UTM_FALSE_NORTHING_SOUTH, UTM_K0
    from pixtrend.functions.geo import UTM_SERIES as S

    k = repr(UTM_K0 * S["A"])
    south = UTM_FALSE_NORTHING_SOUTH if epsg >= 32700 else 0.0
    xi, eta, phi = "xi", "eta", "chi"
    for j, (b, d) in enumerate(zip(S["beta"], S["delta"], strict=True), start=1):
        xi += f" - {b!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)"
        eta += f" - {b!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)"
        phi += f" + {d!r} * sin({2 * j} * chi)"
    return (f"select {keep}, degrees(atan2(sinh(ep), cos(xp))) + {epsg % 100 * 6 - 183} as lon, degrees({phi}) as lat from ("
            f"select *, asin(sin(xp) / cosh(ep)) as chi from (select *, {xi} as xp, {eta} as ep from ("
            f"select *, ({y} - {south!r}) / {k} as xi, ({x} - {UTM_FALSE_EASTING!r}) / {k} as eta from ({src}) s0) s1) s2) s3")


_NX, _NY = O.utm_sql("lon", "lat", str(NEXT_ZONE))
O.cte("ref_cells", "select x, y, x + 0.5e0 as u0, y + 0.5e0 as v0 from range(0, 200) a(x), (select unnest(range(0, max(y) + 1)) as y from obs) b", "obs")
O.cte("ref_zones", f"select x, y, {ZONE} as epsg, u0 as u, v0 as v from ref_cells union all "
      f"select x, y, {NEXT_ZONE}, round(({_NX} - {NEXT_GRID.x0}) / {NEXT_GRID.res}, 6), round(({_NY} - {NEXT_GRID.y0}) / {NEXT_GRID.res}, 6) from ("
      + lonlat_sql(f"({REFERENCE.x0} + u0 * {REFERENCE.res})", f"({REFERENCE.y0} + v0 * {REFERENCE.res})", ZONE, "select * from ref_cells", "x, y") + ") l", "ref_cells")
O.cte("zoned", f"select *, case when scene_id % 2 = 0 then {ZONE} else {NEXT_ZONE} end as epsg from nd", "nd")
_ZB = ["red", "nir"]


def _zoned(spark, sf_dir):
    from pixtrend.plans.registry import nd_obs

    nd = nd_obs(spark, sf_dir).withColumn("epsg", F.when(F.col("scene_id") % 2 == 0, ZONE).otherwise(NEXT_ZONE))
    top = nd.agg(F.max("y")).first()[0]
    return nd, -1 if top is None else top


@register("reproject_scenes", O.with_ctes(
    "select s.year, s.scene_id, r.x, r.y, s.red, s.nir, s.scl from zoned s join ref_zones r on r.epsg = s.epsg "
    "and cast(floor(r.u) as int) = s.x and cast(floor(r.v) as int) = s.y", "zoned", "ref_zones"))
def q_reproject_scenes(spark, sf_dir):
    """Scenes of two zones gathered onto the grid of one, by nearest neighbour."""
    nd, top = _zoned(spark, sf_dir)
    cells = grid_cells(spark, 0, 199, 0, top)
    return reproject(nd, ["red", "nir", "scl"], cells, REFERENCE, ZONE, ZONES, keys=("year", "scene_id"), sx="x", sy="y")


@register("two_zone_mosaic", O.with_ctes(
    "select year, x, y, " + ", ".join(f"cast(floor(avg(v{b}) * 1000 + 0.3137e0) as bigint) as {b}_milli, count(v{b}) as n_{b}" for b in _ZB) + " from ("
    "select year, scene_id, x, y, " + ", ".join(f"sum({b} * w) / sum(case when {b} is not null then w end) as v{b}" for b in _ZB) + " from ("
    "select s.year, s.scene_id, r.x, r.y, s.red, s.nir, greatest(1 - abs(r.u - s.x - 0.5e0), 0) * greatest(1 - abs(r.v - s.y - 0.5e0), 0) as w "
    "from zoned s join ref_zones r on r.epsg = s.epsg and s.x between cast(floor(r.u - 0.5e0) as int) and cast(floor(r.u - 0.5e0) as int) + 1 "
    "and s.y between cast(floor(r.v - 0.5e0) as int) and cast(floor(r.v - 0.5e0) as int) + 1) t where w > 0 group by year, scene_id, x, y) m "
    "where coalesce(" + ", ".join(f"v{b}" for b in _ZB) + ") is not null group by year, x, y", "zoned", "ref_zones"))
def q_two_zone_mosaic(spark, sf_dir):
    """Annual mean mosaic over scenes of two zones, interpolated onto the grid of one;
    in thousandths, cut where no tie of a mean of few integers falls."""
    nd, top = _zoned(spark, sf_dir)
    px = reproject(nd, _ZB, grid_cells(spark, 0, 199, 0, top), REFERENCE, ZONE, ZONES, keys=("year", "scene_id"), sx="x", sy="y", method="bilinear")
    return px.groupBy("year", "x", "y").agg(*[c for b in _ZB for c in (F.floor(F.avg(b) * 1000 + 0.3137).cast("bigint").alias(f"{b}_milli"), F.count(b).alias(f"n_{b}"))])


# --------------------------------------------------------------------------- P10 polygons as a table
def _edges_sql() -> str:
    out = []
    for points, where in ((fx.OUTLINE, "true"), (fx.HOLE, "true"), (fx.PART, "c_custkey % 5 = 0")):
        for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1], strict=True):
            out.append(f"select c_custkey as poly_id, ox + {ax!r}e0 as x1, oy + {ay!r}e0 as y1, ox + {bx!r}e0 as x2, oy + {by!r}e0 as y2 from corner where {where}")
    return " union all ".join(out)


O.cte("corner", "select c_custkey, cast((c_custkey * 37) % 190 * 10 as double) as ox, cast(c_custkey // 150 * 10 - 20 as double) as oy from customer")
O.cte("poly_edges", _edges_sql(), "corner")
# every pixel centre against every edge of the polygons whose box may hold it: an odd number of crossings to its right
O.cte("poly_pixels", "select poly_id, x, y from (select p.x, p.y, e.*, p.x * 10 + 5.0e0 as px, p.y * 10 + 5.0e0 as py from (select distinct x, y from nd) p "
      "join corner c on p.x * 10 between c.ox - 10 and c.ox + 110 and p.y * 10 between c.oy - 10 and c.oy + 70 join poly_edges e on e.poly_id = c.c_custkey) t "
      "where (y1 > py) <> (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 group by poly_id, x, y having count(*) % 2 = 1", "nd", "corner", "poly_edges")


@register("clip_polygons", O.with_ctes(
    "select poly_id, year, count(*) as n_pixels, count(distinct nd.x * 100000 + nd.y) as n_cells, sum(red) as red, sum(nir) as nir "
    "from poly_pixels join nd using (x, y) group by poly_id, year", "poly_pixels", "nd"))
def q_clip_polygons(spark, sf_dir):
    """Pixels inside each of a table of polygons with holes and parts, summed per polygon and year."""
    from pixtrend.plans.registry import nd_obs

    px = clip_polygons(nd_obs(spark, sf_dir).select("year", "x", "y", "red", "nir"), fx.polygons(spark, sf_dir))
    return px.groupBy("poly_id", "year").agg(F.count(F.lit(1)).alias("n_pixels"), F.count_distinct(F.col("x") * 100000 + F.col("y")).alias("n_cells"),
                                             F.sum("red").alias("red"), F.sum("nir").alias("nir"))


# --------------------------------------------------------------------------- A4/A7 mergeable states
@register("median_state", O.with_ctes("select year, x, y, " + ", ".join(
    f"{O.pack(f'median(case when {b} > 0 then {b} end)')} as {b}" for b in O.BANDS) + " from clean where scene_id % 10 <> 7 group by year, x, y", "clean"))
def q_median_state(spark, sf_dir):
    """Median mosaic from a stored state: most scenes, one lot added later, one taken back."""
    from pixtrend.plans.registry import clean_obs

    obs, path = clean_obs(spark, sf_dir), new_scratch_path(spark, "median-state")
    lot = lambda n: obs.filter(F.col("scene_id") % 10 == n)
    PS.write_batch(PS.histogram(obs.filter(F.col("scene_id") % 10 != 3)), path, "first")
    PS.write_batch(PS.histogram(lot(3)), path, "late")
    PS.write_batch(PS.negated(PS.histogram(lot(7)), PS.HISTOGRAM_SUMS), path, "taken-back")
    return PS.median_of(PS.read_state(spark, path, PS.HISTOGRAM_SUMS, by=PIXEL_KEYS))


@register("trend_state", O.with_ctes("select * from trend", "trend"))
def q_trend_state(spark, sf_dir):
    """Trend from a stored state to which each later half of the years was added by itself."""
    from pixtrend.plans.registry import clean_obs

    obs, path = clean_obs(spark, sf_dir), new_scratch_path(spark, "trend-state")
    for name, years in (("until-1996", F.col("year") <= 1996), ("since-1997", F.col("year") > 1996)):
        tc = tasseled_cap(median_mosaic(obs.filter(years)), exact=True)
        PS.write_batch(PS.trend_state(tc, TC_NAMES), path, name)
    return PS.trend_of(PS.read_state(spark, path, PS.TREND_SUMS))


# --------------------------------------------------------------------------- U1 batches of tiles
@register("classify_batches", O.with_ctes(
    "select p.scene_id, p.x, p.y, cast(case when coalesce(sum(q.red + q.green + q.nir) > 9000 * count(q.red + q.green + q.nir), false) then 1 else 0 end as int) as cls "
    "from (select scene_id, x, y, unnest([-1, 0, 1]) as dx from nd) p0 join (select scene_id as s2, x as x2, y as y2, unnest([-1, 0, 1]) as dy from nd) p1 "
    "on p0.scene_id = p1.s2 and p0.x = p1.x2 and p0.y = p1.y2 join nd p on p.scene_id = p0.scene_id and p.x = p0.x and p.y = p0.y "
    "left join nd q on q.scene_id = p.scene_id and q.x = p.x + dx and q.y = p.y + dy group by p.scene_id, p.x, p.y", "nd"))
def q_classify_batches(spark, sf_dir):
    """A rule on 3 x 3 neighbourhoods over batches of tiles of any scenes."""
    from pixtrend.plans.registry import nd_obs

    return classify_batches(nd_obs(spark, sf_dir), bright_surroundings, tile=fx.TILE, halo=1, batch_size=5)


# --------------------------------------------------------------------------- M4/A6 statistics kept by the sink
@register("outlier_mask_stored", O.with_ctes(_sigma_sql("nd"), "nd"))
def q_outlier_mask_stored(spark, sf_dir):
    """Scenes stored in two parts, one of them first with other values, masked by the stored statistics."""
    from pixtrend.plans.registry import PX, nd_obs

    nd, path = nd_obs(spark, sf_dir), new_scratch_path(spark, "scene-store")
    west, east = nd.filter(F.col("x") < fx.TILE), nd.filter(F.col("x") >= fx.TILE)
    write_scenes(west.withColumns({b: F.col(b) * 2 for b in BANDS}), path, "west")
    write_scenes(east, path, "east")
    write_scenes(west, path, "west")
    return masked_scenes(spark, path).select(*PX, *BANDS)


# --------------------------------------------------------------------------- P19/S13 completeness by stateful streaming
#: Layers arrive in three waves an hour apart; a scene may take 90 minutes.
O.cte("arrivals", "select item_id, band, (item_id + ord) % 5 % 3 as wave from assets union all "
      "select item_id, band, 2 from assets where (item_id + ord) % 5 % 3 = 0 and item_id % 4 = 0", "assets")


@register("complete_scenes_stream", O.with_ctes(
    "select item_id, case when n < 7 then 'incomplete' when last - first <= 1 then 'complete' else 'late' end as status, "
    "cast(case when n < 7 then in_time else 7 end as int) as n_layers, epoch_ms(case when n < 7 then first * 3600000 + 9000000 else last * 3600000 + 3600000 end) as at from ("
    "select item_id, count(*) as n, min(first) as first, max(wave) as last, count(*) filter (where wave <= first + 1) as in_time from ("
    "select item_id, wave, min(wave) over (partition by item_id) as first from (select item_id, band, min(wave) as wave from arrivals group by item_id, band) a) b "
    "group by item_id) c", "arrivals"))
def q_complete_scenes_stream(spark, sf_dir):
    """Scenes released by a stream as their layers arrive in waves, some twice; the last report of each."""
    src, dst, ckpt = (new_scratch_path(spark, n) for n in ("arrivals", "reports", "arrivals-ckpt"))
    wave = (F.col("item_id") + F.col("ord")) % 5 % 3
    cols = lambda w: ["item_id", "band", F.timestamp_millis(((w + 1) * 3600000).cast("long")).alias("ts")]
    assets = fx.assets(spark, sf_dir)
    clock = spark.range(1).select(F.lit(-1).cast("long").alias("item_id"), F.lit(None).cast("string").alias("band"), F.lit(9).alias("wave"))
    schema = assets.select(*cols(wave)).schema
    for w in range(3):
        came = assets.filter(wave == w)
        again = assets.filter((wave == 0) & (F.col("item_id") % 4 == 0)) if w == 2 else came.limit(0)
        came.unionByName(again).select(*cols(F.lit(w))).write.mode("append").parquet(src)
        release_scenes_stream(spark, src, dst, ckpt, schema, 5400, 7200, key="item_id")
    clock.select(*cols(F.col("wave"))).write.mode("append").parquet(src)
    release_scenes_stream(spark, src, dst, ckpt, schema, 5400, 7200, key="item_id")
    return last_status(spark.read.parquet(dst), "item_id").select("item_id", "status", "n_layers", F.col("at").cast("timestamp_ntz").alias("at"))
