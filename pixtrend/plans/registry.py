"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and their
DuckDB oracle SQL in ``ORACLE[name]`` (absent for rows-only checks)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixtrend.constants import AOI_MIN_COVERAGE_RATIO, BAND_ASSETS, BANDS, DEFAULT_AOI, QUANTILE_BY_BAND, SCL_BAD, SCL_CLOUD, SIGMA_K
from pixtrend.functions import geo as G
from pixtrend.functions import pixel as P
from pixtrend.functions.indices import TC_NAMES, tasseled_cap
from pixtrend.functions.pixel import mask_nodata
from pixtrend.operators import masks as M
from pixtrend.operators import quality as Q
from pixtrend.operators import resample as R
from pixtrend.operators import spatial as SP
from pixtrend.operators.classify import bright_rule, classify_tiles
from pixtrend.operators.clip import clip_bounds, clip_index_range, clip_polygon, clip_to_extent
from pixtrend.operators.mosaic import band_labels, band_stack, median_mosaic, quantile_mosaic, stack_scenes
from pixtrend.operators.trend import linear_trend, trend_visual
from pixtrend.plans import oracle as O
from pixtrend.plans.catalogue_trend import catalogue_trend
from pixtrend.plans.trend_map import trend_map
from pixtrend.session import new_scratch_path
from pixtrend.sources import catalog as C
from pixtrend.sources import fixtures as fx
from pixtrend.sources.io import read_mosaic, read_scenes, write_mosaic
from pixtrend.streaming.incremental import mask_scenes_stream

def _codes(classes) -> str:
    return ", ".join(map(str, classes))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def clean_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture stack with nodata -> NULL and the SCL mask applied."""
    ob = fx.obs(spark, sf_dir)
    return M.scl_mask(ob.withColumns({b: mask_nodata(b) for b in BANDS}))


# --------------------------------------------------------------------------- flagship
@register("trend_map", O.with_ctes(
    "select x, y, tcb_slope, tcg_slope, tcw_slope, n_tcb as n_years, "
    + ", ".join(f"{O.stretch_sql(f'{n}_slope')} as {n}_u8" for n in TC_NAMES)
    + " from trend", "trend"))
def q_trend_map(spark, sf_dir):
    return trend_map(fx.obs(spark, sf_dir))


@register("median_mosaic", O.with_ctes("select * from median", "median"))
def q_median_mosaic(spark, sf_dir):
    return median_mosaic(clean_obs(spark, sf_dir))


@register("tasseled_cap", O.with_ctes(
    "select year, x, y, " + ", ".join(
        f"{n}_e8, cast({n}_e8 as double) / 1e8 as {n}" for n in TC_NAMES) + " from tc", "tc"))
def q_tasseled_cap(spark, sf_dir):
    return tasseled_cap(median_mosaic(clean_obs(spark, sf_dir)), exact=True)


@register("tc_trend", O.with_ctes("select * from trend", "trend"))
def q_tc_trend(spark, sf_dir):
    return linear_trend(tasseled_cap(median_mosaic(clean_obs(spark, sf_dir)), exact=True))


@register("trend_visual", O.with_ctes(
    "select x, y, " + ", ".join(f"{O.stretch_sql(f'{n}_slope')} as {n}_u8" for n in TC_NAMES)
    + " from trend", "trend"))
def q_trend_visual(spark, sf_dir):
    tr = linear_trend(tasseled_cap(median_mosaic(clean_obs(spark, sf_dir)), exact=True))
    return trend_visual(tr)


# --------------------------------------------------------------------------- shared inputs
PX = ["year", "scene_id", "x", "y"]
_B = ", ".join(BANDS)


def nd_obs(spark, sf_dir):
    """Stack after the masked read (nodata 0 -> NULL)."""
    return fx.obs(spark, sf_dir).withColumns({b: P.mask_nodata(b) for b in BANDS})


def scenes_y(spark, sf_dir):
    return fx.scenes(spark, sf_dir).withColumn("year", P.year_of("ts"))


def grid_expected(ob):
    """Expected pixels of the AOI = the grid's extent (scalar subquery)."""
    return ob.select(((F.max("x") - F.min("x") + 1) * (F.max("y") - F.min("y") + 1))
                     .cast("double")).scalar()


# --------------------------------------------------------------------------- 2.1 sources
@register("search_scenes", O.with_ctes(
    "select item_id, strftime(ts, '%Y-%m-%d') as date, cloud_cover, grid_code, proj_epsg from scenes "
    "where ts >= timestamp '1997-07-01' and ts < timestamp '1997-09-01' "
    "and cloud_cover <= 70 and grid_code = 'MGRS-3'", "scenes"))
def q_search_scenes(spark, sf_dir):
    s = C.search_scenes(fx.scenes(spark, sf_dir), "1997-07-01", "1997-08-31", "MGRS-3", 70)
    return s.select("item_id", P.scene_date("ts").alias("date"), "cloud_cover", "grid_code", "proj_epsg")


@register("search_collection", O.with_ctes(
    "select item_id, cloud_cover, grid_code, collection from scenes where collection = 'surface' "
    "and ts >= timestamp '1996-01-01' and ts < timestamp '1997-01-01' and cloud_cover <= 30", "scenes"))
def q_search_collection(spark, sf_dir):
    """The catalogue search with its first predicate, on a catalogue of two collections."""
    s = C.search_scenes(fx.scenes(spark, sf_dir), "1996-01-01", "1996-12-31", max_cloud=30, collection="surface")
    return s.select("item_id", "cloud_cover", "grid_code", "collection")


@register("query_products", O.with_ctes(
    "select concat('S2_', cast(item_id as varchar), '.SAFE') as name from scenes "
    "where ts >= timestamp '1996-01-01' and ts < timestamp '1997-01-01' and cloud_cover <= 30 "
    "and grid_code = 'MGRS-5' order by name limit 1000", "scenes"))
def q_query_products(spark, sf_dir):
    return C.query_products(fx.scenes(spark, sf_dir), "1996-01-01", "1996-12-31", max_cloud=30,
                            attrs={"grid_code": "MGRS-5"}, top=1000)


@register("prefer_s3_assets", O.with_ctes("""
select item_id, asset, orig_href, coalesce(d, l, orig_href) as href
from (select item_id, asset, json_extract_string(j, '$.href') as orig_href,
             coalesce(json_extract_string(alt, '$.s3.href'), json_extract_string(alt, '$.S3.href')) as d,
             case when json_type(alt) = 'ARRAY' then
               list_filter(json_extract_string(alt, '$[*].href'), lambda h: starts_with(h, 's3://'))[1] end as l
      from (select item_id, asset, j, case when json_type(j -> 'alternate') in ('OBJECT', 'ARRAY') and (j -> 'alternate')::varchar not in ('{}', '[]') then j -> 'alternate' else j -> 'alternates' end as alt
            from (select item_id, asset, assets -> asset as j
                  from (select item_id, assets, unnest(json_keys(assets)) as asset from assets_json where json_valid(assets)) k) k2) k3) k4
""", "assets_json"))
def q_prefer_s3_assets(spark, sf_dir):
    return C.prefer_s3_assets(fx.assets_json(spark, sf_dir))


@register("asset_status", O.with_ctes(
    "select item_id, case when json_valid(assets) then 'ok' else 'bad_json' end as status from assets_json", "assets_json"))
def q_asset_status(spark, sf_dir):
    return C.asset_status(fx.assets_json(spark, sf_dir))


@register("band_assets", O.with_ctes(
    "select a.item_id, a.asset, b.ord, b.band, case when a.asset like '%10m' then '10m' "
    "when a.asset like '%20m' then '20m' end as res from assets a join band_order b "
    "on a.asset = b.asset where b.ord <= 6", "assets"))
def q_band_assets(spark, sf_dir):
    return C.band_assets(fx.assets(spark, sf_dir), C.band_order_df(spark)) \
        .select("item_id", "asset", "ord", "band", "res")


@register("require_asset", O.with_ctes(
    "select item_id, strftime(ts, '%Y-%m-%d') as date, cloud_cover from scenes s where exists "
    "(select 1 from assets a where a.item_id = s.item_id and a.asset = 'SCL_20m')", "scenes", "assets"))
def q_require_asset(spark, sf_dir):
    s = C.require_asset(fx.scenes(spark, sf_dir), fx.assets(spark, sf_dir))
    return s.select("item_id", P.scene_date("ts").alias("date"), "cloud_cover")


@register("product_bands", O.with_ctes("""
select * from (select scene, band, res, min(path) as path
               from (select regexp_extract(path, '^([^/]+)[.]SAFE', 1) as scene,
                            regexp_extract(path, '_(B[0-9]+)_', 1) as band,
                            regexp_extract(path, '/R([0-9]+m)/', 1) as res, path from product_paths) p
               where band in ('B02', 'B03', 'B04', 'B08', 'B11', 'B12') group by scene, band, res) f
where scene in (select scene from (select regexp_extract(path, '^([^/]+)[.]SAFE', 1) as scene,
                                          regexp_extract(path, '_(B[0-9]+)_', 1) as band from product_paths) p
                where band in ('B02', 'B03', 'B04', 'B08', 'B11', 'B12')
                group by scene having count(distinct band) = 6)""", "product_paths"))
def q_product_bands(spark, sf_dir):
    return C.product_bands(fx.product_paths(spark, sf_dir))


@register("mask_nodata", O.with_ctes(f"select year, scene_id, x, y, {_B} from nd", "nd"))
def q_mask_nodata(spark, sf_dir):
    return nd_obs(spark, sf_dir).select(*PX, *BANDS)


@register("pending_scenes", O.with_ctes(
    "select item_id, strftime(ts, '%Y-%m-%d') as date from scenes s where not exists "
    "(select 1 from done d where d.item_id = s.item_id)", "scenes", "done"))
def q_pending_scenes(spark, sf_dir):
    p = C.pending(fx.scenes(spark, sf_dir), fx.done(spark, sf_dir))
    return p.select("item_id", P.scene_date("ts").alias("date"))


@register("missing_years", O.with_ctes(
    "select cast(range as int) as year from range(1993, 2004) "
    "where cast(range as int) not in (select year from median)", "median"))
def q_missing_years(spark, sf_dir):
    return C.missing_years(median_mosaic(clean_obs(spark, sf_dir)), 1993, 2003)


# The stand-in SCL codes are uniform over 0..11, so every scene is ~55 %
# "cloudy"; the workflow's 0.5 would reject all of them.  The fixture queries
# use 0.55 so that scenes fall on both sides.
FIXTURE_CLOUD_THRESH = 0.55


def _status(spark, sf_dir):
    ob = fx.obs(spark, sf_dir)
    q = Q.aoi_quality(ob, grid_expected(ob), by=("year", "scene_id"))
    al = M.mask_alignment(ob, fx.class_mask(spark, sf_dir, ob))
    return Q.scene_status(q, al, cloud_thresh=FIXTURE_CLOUD_THRESH)


@register("scene_status", O.with_ctes(
    "select year, scene_id, n_present, n_valid, n_bad, coverage, cloud_ratio, aligned, status "
    "from status", "status"))
def q_scene_status(spark, sf_dir):
    return _status(spark, sf_dir).select("year", "scene_id", "n_present", "n_valid", "n_bad",
                                         "coverage", "cloud_ratio", "aligned", "status")


@register("run_summary", O.with_ctes(
    "select year, count(*) as n_scenes, count(*) filter (where status = 'ok') as n_ok, "
    "count(*) filter (where status <> 'ok') as n_failed from status group by year order by year",
    "status"))
def q_run_summary(spark, sf_dir):
    return Q.run_summary(_status(spark, sf_dir))


# --------------------------------------------------------------------------- 2.2 expressions
@register("season_filter", O.with_ctes(
    "select item_id, strftime(ts, '%Y-%m-%d') as date, cast(year(ts) as int) as year from scenes "
    "where strftime(ts, '%m-%d') between '07-01' and '08-31' and year(ts) between 1995 and 2001",
    "scenes"))
def q_season_filter(spark, sf_dir):
    s = fx.scenes(spark, sf_dir)
    s = C.season_filter(s, range(1995, 2002))
    return s.select("item_id", P.scene_date("ts").alias("date"), P.year_of("ts").alias("year"))


@register("scene_key", O.with_ctes(
    "select item_id, strftime(ts, '%Y-%m-%d') as scene_date, "
    "cast(item_id as varchar) || '_' || strftime(ts, '%Y-%m-%d') || '.tif' as out_key, "
    "'S2_' || cast(item_id as varchar) as product from scenes", "scenes"))
def q_scene_key(spark, sf_dir):
    s = fx.scenes(spark, sf_dir)
    return s.select("item_id", P.scene_date("ts").alias("scene_date"),
                    P.scene_key("item_id", "ts").alias("out_key"),
                    P.strip_safe(C.product_name("item_id")).alias("product"))


@register("utm_epsg", O.with_ctes(
    "select item_id, " + O.utm_epsg_sql("(west + east) / 2", "(south + north) / 2")
    + " as utm_epsg from scenes", "scenes"))
def q_utm_epsg(spark, sf_dir):
    s = fx.scenes(spark, sf_dir)
    return s.select("item_id", G.utm_epsg((F.col("west") + F.col("east")) / 2,
                                          (F.col("south") + F.col("north")) / 2).alias("utm_epsg"))


@register("detect_epsg", O.with_ctes(
    "select grid_code, year, coalesce(f, " + O.utm_epsg_sql("(west + east) / 2.0", "(south + north) / 2.0")
    + ") as epsg, f is not null as from_item, west, south, east, north from ("
    "select grid_code, cast(year(ts) as int) as year, "
    "first(proj_epsg order by ts, item_id) filter (where proj_epsg is not null) as f, "
    "min(west) as west, min(south) as south, max(east) as east, max(north) as north "
    "from scenes group by grid_code, year(ts)) g", "scenes"))
def q_detect_epsg(spark, sf_dir):
    return Q.detect_epsg(scenes_y(spark, sf_dir), by=("grid_code", "year"))


def _utm_cols(lon, lat, epsg, name):
    p = G.utm_xy(lon, lat, epsg)
    return [F.floor(p["x"] * 1000 + 0.5).cast("bigint").alias(f"{name}_x_mm"),
            F.floor(p["y"] * 1000 + 0.5).cast("bigint").alias(f"{name}_y_mm")]


def _utm_sql_cols(lon, lat, epsg, name):
    x, y = O.utm_sql(lon, lat, epsg)
    return f"{O.mm(x)} as {name}_x_mm, {O.mm(y)} as {name}_y_mm"


@register("utm_xy", O.with_ctes(
    "select item_id, epsg, " + _utm_sql_cols("west", "south", "epsg", "sw") + ", "
    + _utm_sql_cols("east", "north", "epsg", "ne") + " from (select *, "
    + O.utm_epsg_sql("(west + east) / 2", "(south + north) / 2") + " as epsg from scenes) s", "scenes"))
def q_utm_xy(spark, sf_dir):
    s = fx.scenes(spark, sf_dir)
    s = s.withColumn("epsg", G.utm_epsg((F.col("west") + F.col("east")) / 2,
                                        (F.col("south") + F.col("north")) / 2))
    return s.select("item_id", "epsg", *_utm_cols("west", "south", "epsg", "sw"),
                    *_utm_cols("east", "north", "epsg", "ne"))


@register("aoi_bounds", O.with_ctes(
    "select aoi_id, epsg, " + ", ".join(
        f"{O.mm(f'{fn}({a}, {b})')} as {n}_mm" for fn, a, b, n in (
            ("least", "swx", "nex", "xmin"), ("least", "swy", "ney", "ymin"),
            ("greatest", "swx", "nex", "xmax"), ("greatest", "swy", "ney", "ymax")))
    + " from (select aoi_id, epsg, {sw_x} as swx, {sw_y} as swy, {ne_x} as nex, {ne_y} as ney from "
      "(select *, " + O.utm_epsg_sql("(west + east) / 2", "(south + north) / 2")
    + " as epsg from aois) a) p", "aois").format(
        **dict(zip(("sw_x", "sw_y"), O.utm_sql("west", "south", "epsg"))),
        **dict(zip(("ne_x", "ne_y"), O.utm_sql("east", "north", "epsg")))))
def q_aoi_bounds(spark, sf_dir):
    a = fx.aois(spark, sf_dir)
    a = a.withColumn("epsg", G.utm_epsg((F.col("west") + F.col("east")) / 2,
                                        (F.col("south") + F.col("north")) / 2))
    b = G.aoi_bounds("west", "south", "east", "north", "epsg")
    return a.select("aoi_id", "epsg", *[F.floor(b[k] * 1000 + 0.5).cast("bigint").alias(f"{k}_mm")
                                        for k in ("xmin", "ymin", "xmax", "ymax")])


def _ppm(cov):
    """The ratio reported in parts per million (an integer, so the oracle's
    different clipping algorithm compares exactly)."""
    return F.round(F.col("coverage_ratio") * 1000000).cast("bigint").alias("coverage_ppm")


@register("expected_pixels", "select aoi_id, ((xmax_mm - xmin_mm) / 20000.0e0) * ((ymax_mm - ymin_mm) / 20000.0e0) as expected from ("
          + ORACLE["aoi_bounds"] + ") b")
def q_expected_pixels(spark, sf_dir):
    """Pixels of 20 m that each AOI's projected bounds hold (bounds to the millimetre)."""
    b = q_aoi_bounds(spark, sf_dir)
    return b.select("aoi_id", P.expected_pixels(F.col("xmax_mm") - F.col("xmin_mm"), F.col("ymax_mm") - F.col("ymin_mm"), 20000.0).alias("expected"))


@register("coverage_ratio", O.coverage_sql())
def q_coverage_ratio(spark, sf_dir):
    cov = SP.aoi_coverage(fx.scenes(spark, sf_dir), fx.aois(spark, sf_dir))
    return cov.select("aoi_id", "item_id", "epsg", _ppm(cov))


@register("coverage_filter", O.coverage_sql(min_ratio=0.4))
def q_coverage_filter(spark, sf_dir):
    cov = SP.aoi_coverage(fx.scenes(spark, sf_dir), fx.aois(spark, sf_dir), min_ratio=AOI_MIN_COVERAGE_RATIO)
    return cov.select("aoi_id", "item_id", "epsg", _ppm(cov))


CLIP_BOUNDS_M = (300.0, 15.0, 1234.0, 77.0)   # xmin, ymin, xmax, ymax in grid metres


_CI = clip_index_range(CLIP_BOUNDS_M)


@register("clip_bounds", O.with_ctes(
    f"select year, scene_id, x, y, {_B} from nd where x between {_CI[0]} and {_CI[2]} "
    f"and y between {_CI[1]} and {_CI[3]}", "nd"))
def q_clip_bounds(spark, sf_dir):
    return clip_bounds(nd_obs(spark, sf_dir), CLIP_BOUNDS_M).select(*PX, *BANDS)


# concave polygon in grid metres
CLIP_POLYGON_M = [(100.0, 0.0), (1900.0, 50.0), (1500.0, 600.0), (800.0, 300.0), (200.0, 900.0)]


_PB = clip_index_range((100.0, 0.0, 1900.0, 900.0))


@register("clip_polygon", O.with_ctes(
    f"select year, scene_id, x, y, {_B} from nd where x between {_PB[0]} and {_PB[2]} "
    f"and y between {_PB[1]} and {_PB[3]} and "
    + O.pip_sql("(x * 10 + 5.0e0)", "(y * 10 + 5.0e0)", CLIP_POLYGON_M), "nd"))
def q_clip_polygon(spark, sf_dir):
    return clip_polygon(nd_obs(spark, sf_dir), CLIP_POLYGON_M).select(*PX, *BANDS)


@register("clip_to_extent", O.with_ctes(
    "select m.scene_id, m.x, m.y, m.cls from class_mask m join (select scene_id, min(x) as x0, "
    "max(x) as x1, min(y) as y0, max(y) as y1 from clean where coalesce(" + _B + ") is not null "
    "group by scene_id) e on m.scene_id = e.scene_id where m.x between e.x0 and e.x1 "
    "and m.y between e.y0 and e.y1", "class_mask", "clean"))
def q_clip_to_extent(spark, sf_dir):
    ob = fx.obs(spark, sf_dir)
    img = M.scl_mask(ob.withColumns({b: P.mask_nodata(b) for b in BANDS}))
    return clip_to_extent(fx.class_mask(spark, sf_dir, ob), img)


@register("zero_to_null", O.with_ctes(
    "select year, scene_id, x, y, " + ", ".join(f"case when {b} > 0 then {b} end as {b}" for b in BANDS)
    + " from obs", "obs"))
def q_zero_to_null(spark, sf_dir):
    return fx.obs(spark, sf_dir).select(*PX, *[P.zero_to_null(b).alias(b) for b in BANDS])


@register("pack_u16", O.with_ctes(
    "select year, scene_id, x, y, " + ", ".join(
        f"{O.pack(f'case when not coalesce(scl, 0) in (0,1,3,7,8,9,10,11) then {b} end')} as {b}"
        for b in BANDS) + " from obs", "obs"))
def q_pack_u16(spark, sf_dir):
    m = M.scl_mask(fx.obs(spark, sf_dir))
    return m.select(*PX, *[P.pack_u16(b).alias(b) for b in BANDS])


@register("band_labels", O.with_ctes(f"select year, scene_id, x, y, {_B} from obs", "obs"))
def q_band_labels(spark, sf_dir):
    ob = fx.obs(spark, sf_dir)
    # the stack as written by the reader: asset names, scrambled order
    raw = ob.select(*PX, *[F.col(b).alias(a) for a, b in reversed(list(zip(BAND_ASSETS, BANDS)))])
    return band_labels(raw)


@register("complete_scenes", O.with_ctes(
    "select item_id, count(distinct band) as n_bands from assets where band in "
    "('blue', 'green', 'red', 'nir', 'swir1', 'swir2') group by item_id having count(distinct band) = 6",
    "assets"))
def q_complete_scenes(spark, sf_dir):
    return Q.complete_scenes(fx.assets(spark, sf_dir))


@register("year_axis", O.with_ctes(
    "select year, x, y, strftime(make_date(year, 7, 15), '%Y-%m-%d') as time from median", "median"))
def q_year_axis(spark, sf_dir):
    m = median_mosaic(clean_obs(spark, sf_dir))
    return m.select("year", "x", "y", F.date_format(P.mid_season_date("year"), "yyyy-MM-dd").alias("time"))


# --------------------------------------------------------------------------- 2.3 masks
def _mask_sql(cond_keep: str, src: str = "nd") -> str:
    return O.with_ctes("select year, scene_id, x, y, " + ", ".join(
        f"case when {cond_keep} then {b} end as {b}" for b in BANDS) + f" from {src}", src)


@register("scl_mask", _mask_sql("not coalesce(scl, 0) in (" + _codes(SCL_BAD) + ")"))
def q_scl_mask(spark, sf_dir):
    return M.scl_mask(nd_obs(spark, sf_dir)).select(*PX, *BANDS)


@register("scl_mask_invalid", _mask_sql("not coalesce(scl, 0) in (" + _codes(SCL_CLOUD) + ")"))
def q_scl_mask_invalid(spark, sf_dir):
    return M.scl_mask_invalid(nd_obs(spark, sf_dir)).select(*PX, *BANDS)


@register("scl_mask_optional", O.with_ctes(
    "select year, scene_id, x, y, " + ", ".join(
        f"case when h.n = 0 or not coalesce(s.scl, 0) in ({_codes(SCL_BAD)}) then {b} end as {b}" for b in BANDS)
    + " from (select * replace (case when scene_id % 4 <> 1 then scl end as scl) from nd) s join (select scene_id, "
    "count(case when scene_id % 4 <> 1 then scl end) as n from nd group by scene_id) h using (scene_id)", "nd"))
def q_scl_mask_optional(spark, sf_dir):
    nd = nd_obs(spark, sf_dir).withColumn("scl", F.when(F.col("scene_id") % 4 != 1, F.col("scl")))
    return M.scl_mask_optional(nd).select(*PX, *BANDS)


@register("brightness_mask", _mask_sql("not coalesce(red > 2100 and green > 2100 and blue > 2100, false)"))
def q_brightness_mask(spark, sf_dir):
    return M.brightness_mask(nd_obs(spark, sf_dir)).select(*PX, *BANDS)


def _sigma_sql(src: str) -> str:
    mom = ", ".join(O.moments_sql(b) for b in BANDS)
    keep = ", ".join(
        f"case when cast(abs({b}_n * cast({b} as bigint) - {b}_s1) as double) <= "
        f"3.0e0 * sqrt(cast({b}_n * {b}_s2 - {b}_s1 * {b}_s1 as double)) then {b} end as {b}"
        for b in BANDS)
    return (f"select year, scene_id, x, y, {keep} from {src} s left join "
            f"(select scene_id, {mom} from {src} group by scene_id) st using (scene_id)")


@register("outlier_mask", O.with_ctes(_sigma_sql("nd"), "nd"))
def q_outlier_mask(spark, sf_dir):
    return M.outlier_mask(nd_obs(spark, sf_dir)).select(*PX, *BANDS)


@register("class_mask", O.with_ctes(
    "select year, s.scene_id, s.x, s.y, " + ", ".join(
        f"case when coalesce(m.cls = 0, false) then {b} end as {b}" for b in BANDS)
    + " from nd s left join class_mask m on s.scene_id = m.scene_id and s.x = m.x and s.y = m.y",
    "nd", "class_mask"))
def q_class_mask(spark, sf_dir):
    ob = fx.obs(spark, sf_dir)
    nd = ob.withColumns({b: P.mask_nodata(b) for b in BANDS})
    return M.apply_class_mask(nd, fx.class_mask(spark, sf_dir, ob)).select(*PX, *BANDS)


@register("nonzero_mask", O.with_ctes(
    "select year, s.scene_id, s.x, s.y, " + ", ".join(
        f"case when not coalesce(m.cls <> 0, false) then {b} end as {b}" for b in BANDS)
    + " from nd s left join class_mask m on s.scene_id = m.scene_id and s.x = m.x and s.y = m.y",
    "nd", "class_mask"))
def q_nonzero_mask(spark, sf_dir):
    ob = fx.obs(spark, sf_dir)
    nd = ob.withColumns({b: P.mask_nodata(b) for b in BANDS})
    return M.nonzero_mask(nd, fx.class_mask(spark, sf_dir, ob)).select(*PX, *BANDS)


@register("mask_layer", O.with_ctes(
    "select l.scene_id, l.x, l.y, l.cls from class_mask_layers l join (select scene_id, "
    "max(layer) + 1 as n from class_mask_layers group by scene_id) n on l.scene_id = n.scene_id "
    "where l.layer = case when n.n = 3 then 1 else 0 end", "class_mask_layers"))
def q_mask_layer(spark, sf_dir):
    return M.select_mask_layer(fx.class_mask_layers(spark, sf_dir)).select("scene_id", "x", "y", "cls")


@register("mask_alignment", O.with_ctes("select * from alignment", "alignment"))
def q_mask_alignment(spark, sf_dir):
    ob = fx.obs(spark, sf_dir)
    return M.mask_alignment(ob, fx.class_mask(spark, sf_dir, ob))


LOW_FIXTURE_THR = 2000  # the stand-in values are never <= 10; a threshold that fires


@register("low_reflectance_mask", _mask_sql(
    "not (" + " + ".join(f"coalesce(cast({b} <= {LOW_FIXTURE_THR} as int), 0)" for b in BANDS) + " >= 4)"))
def q_low_reflectance_mask(spark, sf_dir):
    return M.low_reflectance_mask(nd_obs(spark, sf_dir), thr=LOW_FIXTURE_THR).select(*PX, *BANDS)


@register("all_zero_mask", O.with_ctes("select year, scene_id, x, y, " + ", ".join(
    f"case when not coalesce({' and '.join(f'{c} = 0' for c in BANDS)}, false) then {b} end as {b}"
    for b in BANDS) + " from obs", "obs"))
def q_all_zero_mask(spark, sf_dir):
    return M.all_zero_mask(fx.obs(spark, sf_dir)).select(*PX, *BANDS)


@register("all_missing", O.with_ctes(
    f"select year, scene_id, x, y, coalesce({_B}) is null as all_missing from clean", "clean"))
def q_all_missing(spark, sf_dir):
    c = clean_obs(spark, sf_dir)
    return c.select(*PX, M.all_missing(c).alias("all_missing"))


O.cte("bright", "select year, scene_id, x, y, " + ", ".join(
    f"case when not coalesce(red > 2100 and green > 2100 and blue > 2100, false) then {b} end as {b}"
    for b in BANDS) + " from clean", "clean")


@register("mask_chain", O.with_ctes(_sigma_sql("bright"), "bright"))
def q_mask_chain(spark, sf_dir):
    return M.mask_chain(nd_obs(spark, sf_dir)).select(*PX, *BANDS)


# --------------------------------------------------------------------------- 2.4 joins / reshapes
@register("band_stack", O.with_ctes(
    "select scene_id, x, y, " + ", ".join(f"max(case when band = '{b}' then v end) as {b}" for b in BANDS)
    + " from obs_long group by scene_id, x, y", "obs_long"))
def q_band_stack(spark, sf_dir):
    return band_stack(fx.obs_long(spark, sf_dir))


def _gather_sql(values, src: str, grid: str, keys: str) -> str:
    """Independent form: every target of the grid gathers its two nearest
    coarse cells per axis, 3/4 and 1/4, over the cells that have a value."""
    w = "(case when b.sx = g.x // 2 then 3 else 1 end * case when b.sy = g.y // 2 then 3 else 1 end)"
    vals = ", ".join(f"sum(b.{v} * {w})::double / sum(case when b.{v} is not null then {w} end)::double as {v}" for v in values)
    return (f"select {keys}, g.x, g.y, {vals} from {grid} g join {src} b on b.scene_id = g.scene_id "
            f"and b.sx between (g.x + 1) // 2 - 1 and (g.x + 1) // 2 and b.sy between (g.y + 1) // 2 - 1 and (g.y + 1) // 2 "
            f"group by {keys}, g.x, g.y having " + " or ".join(f"count(b.{v}) > 0" for v in values))


def _grid_sql(ext: str) -> str:
    return (f"select scene_id, x, unnest(range(y0, y1 + 1)) as y from "
            f"(select scene_id, unnest(range(x0, x1 + 1)) as x, y0, y1 from ({ext}) e0) e1")


O.cte("grid_20m", _grid_sql("select scene_id, min(sx) * 2 as x0, max(sx) * 2 + 1 as x1, min(sy) * 2 as y0, "
                            "max(sy) * 2 + 1 as y1 from bands_20m group by scene_id"), "bands_20m")


@register("resample_bilinear", O.with_ctes(_gather_sql(["swir1", "swir2"], "bands_20m", "grid_20m", "g.scene_id"), "bands_20m", "grid_20m"))
def q_resample_bilinear(spark, sf_dir):
    return R.resample_bilinear(fx.bands_20m(spark, sf_dir), ["swir1", "swir2"])


@register("resample_nearest", O.with_ctes(
    "select scene_id, x * 2 + dx as x, y * 2 + dy as y, cls from class_mask, "
    "(values (0), (1)) a(dx), (values (0), (1)) b(dy)", "class_mask"))
def q_resample_nearest(spark, sf_dir):
    cm = fx.class_mask(spark, sf_dir).withColumnsRenamed({"x": "sx", "y": "sy"})
    return R.resample_nearest(cm, ["cls"])


@register("stack_scenes", O.with_ctes(
    "select year, scene_id, x, y, " + ", ".join(f"max({b}) as {b}" for b in BANDS) + " from ("
    "select year, scene_id, x, y, blue, green, red, nir, null as swir1, null as swir2 from nd "
    "union all select year, scene_id, x, y, null, null, null, null, swir1, swir2 from nd) u "
    "group by year, scene_id, x, y", "nd"))
def q_stack_scenes(spark, sf_dir):
    nd = nd_obs(spark, sf_dir)
    b10 = nd.select(*PX, "blue", "green", "red", "nir")
    b20 = nd.select(*PX, "swir1", "swir2")
    st = stack_scenes(b10, b20)
    return st.groupBy(*PX).agg(*[F.max(b).alias(b) for b in BANDS])


# --------------------------------------------------------------------------- 2.5 aggregates
@register("aoi_quality", O.with_ctes(
    "select year, scene_id, n_present, n_valid, n_bad, expected, coverage, cloud_ratio from quality_r",
    "quality_r"))
def q_aoi_quality(spark, sf_dir):
    ob = fx.obs(spark, sf_dir)
    return Q.aoi_quality(ob, grid_expected(ob), by=("year", "scene_id"))


@register("aoi_filter", O.with_ctes(
    "select year, scene_id, x, y, scl from obs where scene_id in (select scene_id from quality_r "
    "where n_present > 0 and n_valid > 0 and cloud_ratio <= 0.55e0 and coverage >= 0.1e0)",
    "obs", "quality_r"))
def q_aoi_filter(spark, sf_dir):
    ob = fx.obs(spark, sf_dir)
    return Q.aoi_filter(ob, grid_expected(ob), cloud_thresh=FIXTURE_CLOUD_THRESH).select(*PX, "scl")


def _q_sql() -> str:
    cols = ", ".join(f"{O.pack(O.nearest_q_sql(f'case when {b} > 0 then {b} end', q))} as {b}"
                     for b, q in QUANTILE_BY_BAND.items())
    return O.with_ctes(f"select year, x, y, {cols} from clean group by year, x, y", "clean")


@register("quantile_mosaic", _q_sql())
def q_quantile_mosaic(spark, sf_dir):
    return quantile_mosaic(clean_obs(spark, sf_dir))


@register("scene_stats", O.with_ctes("select scene_id, " + ", ".join(
    f"{b}_n, {b}_s1, {b}_s2, cast({b}_s1 as double) / nullif(cast({b}_n as double), 0.0e0) as {b}_mean, "
    f"sqrt(greatest(cast({b}_n as double) * cast({b}_s2 as double) - cast({b}_s1 as double) * "
    f"cast({b}_s1 as double), 0.0e0)) / nullif(cast({b}_n as double), 0.0e0) as {b}_std"
    for b in BANDS) + " from (select scene_id, " + ", ".join(O.moments_sql(b) for b in BANDS)
    + " from nd group by scene_id) m", "nd"))
def q_scene_stats(spark, sf_dir):
    return Q.scene_stats(nd_obs(spark, sf_dir))


@register("scene_stats_fractions", O.with_ctes("select scene_id, " + ", ".join(
    f"count({b}) as {b}_n, sum({b} / 4.0e0) as {b}_s1, sum({b} / 4.0e0) / nullif(count({b}), 0) as {b}_mean, "
    f"round(stddev_pop({b} / 4.0e0), 6) as {b}_std" for b in BANDS) + " from nd group by scene_id", "nd"))
def q_scene_stats_fractions(spark, sf_dir):
    """Scene statistics of reflectance in quarter steps."""
    nd = nd_obs(spark, sf_dir)
    st = Q.scene_stats(nd.withColumns({b: F.col(b) / F.lit(4.0) for b in BANDS}))
    return st.select("scene_id", *[c for b in BANDS for c in (f"{b}_n", f"{b}_s1", f"{b}_mean", F.round(f"{b}_std", 6).alias(f"{b}_std"))])


@register("bbox_union", O.with_ctes(
    "select grid_code, cast(year(ts) as int) as year, min(west) as west, min(south) as south, "
    "max(east) as east, max(north) as north from scenes group by grid_code, year(ts)", "scenes"))
def q_bbox_union(spark, sf_dir):
    return Q.bbox_union(scenes_y(spark, sf_dir), by=("grid_code", "year"))


# --------------------------------------------------------------------------- 2.6 UDF hook
@register("classify_tiles", O.with_ctes(
    "select scene_id, x, y, cast(case when red + green + nir > 9000 then 1 else 0 end as int) as cls "
    "from nd", "nd"))
def q_classify_tiles(spark, sf_dir):
    return classify_tiles(nd_obs(spark, sf_dir), bright_rule, tile=fx.TILE, halo=2)


# --------------------------------------------------------------------------- 2.1 sinks / scans


@register("write_mosaic", O.with_ctes("select * from median", "median"))
def q_write_mosaic(spark, sf_dir):
    """Median mosaic written partitioned by year, clustered by tile; read back."""
    path = new_scratch_path(spark, "median")
    m = median_mosaic(clean_obs(spark, sf_dir)).withColumns({
        "tile_x": F.floor(F.col("x") / fx.TILE).cast("int"),
        "tile_y": F.floor(F.col("y") / fx.TILE).cast("int")})
    write_mosaic(m, path)
    return read_mosaic(spark, path).select("year", "x", "y", *BANDS)


@register("read_scenes", O.with_ctes(f"select year, scene_id, x, y, {_B}, scl, 1 as n_files from nd", "nd"))
def q_read_scenes(spark, sf_dir):
    """Scene stack written by the sink as it is (year folders, nodata kept as
    0), scanned recursively by glob with the nodata-aware read.  ``n_files``:
    each pixel row must come from a file of its own year's folder."""
    path = new_scratch_path(spark, "scenes")
    write_mosaic(fx.obs(spark, sf_dir), path)
    df = read_scenes(spark, path, pattern="*.parquet", recursive=True)
    own = F.col("source_file").contains(F.concat(F.lit("/year="), F.col("year").cast("string"), F.lit("/")))
    return df.select("year", "scene_id", "x", "y", *BANDS, "scl", own.cast("int").alias("n_files"))


@register("mask_scenes_stream", O.with_ctes(_sigma_sql("bright"), "bright"))
def q_mask_scenes_stream(spark, sf_dir):
    """Incremental masking job: scenes land as files, a file stream masks the
    new ones (SCL -> brightness -> sigma), scene by scene."""
    src = new_scratch_path(spark, "incoming")
    nd = nd_obs(spark, sf_dir)
    write_mosaic(nd, src, partition_by=("scene_id",))
    dst = new_scratch_path(spark, "masked")
    mask_scenes_stream(spark, src, dst, new_scratch_path(spark, "stream-ckpt"))
    return spark.read.parquet(dst).select(*PX, *BANDS)


# --------------------------------------------------------------------------- J6/J8 grid alignment
def _long_res(spark, sf_dir):
    """Band rows with their resolution: SWIR on the 20 m grid, the rest 10 m;
    scenes whose id ends in 9 come without 10 m bands (20 m grid kept)."""
    lr = fx.obs_long(spark, sf_dir).withColumn(
        "res", F.when(F.col("band").isin("swir1", "swir2"), "20m").otherwise("10m"))
    lr = lr.filter(~((F.col("res") == "10m") & (F.col("scene_id") % 10 == 9)))
    return lr.select("scene_id", "band", "res", F.col("x").alias("sx"), F.col("y").alias("sy"), "v")


O.cte("long_res", """
select scene_id, band, case when band in ('swir1', 'swir2') then '20m' else '10m' end as res,
       x as sx, y as sy, v
from obs_long where not (band not in ('swir1', 'swir2') and scene_id % 10 = 9)""", "obs_long")


O.cte("grid_10m", _grid_sql("select scene_id, min(sx) as x0, max(sx) as x1, min(sy) as y0, max(sy) as y1 "
                            "from long_res where res = '10m' group by scene_id"), "long_res")
O.cte("coarse", "select * from long_res where res <> '10m'", "long_res")


def _align_sql() -> str:
    kept = ("select scene_id, band, sx as x, sy as y, cast(v as double) as v from long_res "
            "where res = '10m' or scene_id not in (select scene_id from long_res where res = '10m')")
    return O.with_ctes(f"{kept} union all {_gather_sql(['v'], 'coarse', 'grid_10m', 'g.scene_id, b.band')}",
                       "long_res", "coarse", "grid_10m")


@register("align_to_grid", _align_sql())
def q_align_to_grid(spark, sf_dir):
    return R.align_to_grid(_long_res(spark, sf_dir))


# --------------------------------------------------------------------------- U3 catalogue -> trend
#: Columns of the job's window; it is as high as the grid, less the top row.
JOB_X_M = (100.0, 1500.0)
_JB = clip_index_range((JOB_X_M[0], 0.0, JOB_X_M[1], 0.0))
JOB_COVERAGE = 0.01  # the stand-in scenes are sparse,
JOB_CLOUD = 0.65     # and more than half of their classes are cloudy

O.cte("job_top", "select max(y) - 1 as top from obs", "obs")
# every asset of an item, one in 64 missing
O.cte("job_complete", """
select item_id from (select distinct cast(year(l_shipdate) * 100 + l_suppkey % 10 as int) as item_id from lineitem) i, range(1, 8) t(ord)
where (item_id + ord) % 64 <> 0 group by item_id having count(*) = 7""")
O.cte("job_scenes", """
select scene_id, year from (
  select distinct cast(year(l_shipdate) * 100 + l_suppkey % 10 as int) as scene_id, cast(year(l_shipdate) as int) as year from lineitem) s
where year between 1995 and 2001
  and strftime(make_date(year, 6, 25) + cast((scene_id % 9) * 7 as int), '%m-%d') between '07-01' and '08-31'
  and (scene_id * 37) % 101 <= 80 and scene_id % 10 <> 5
  and scene_id % 10 <> 3 and scene_id in (select item_id from job_complete)
  and scene_id % 10 < 9""", "job_complete")  # the other footprints miss the AOI
O.cte("job_long", """
select l.scene_id, l.band, case when l.band in ('swir1', 'swir2') then '20m' else '10m' end as res,
       case when l.band in ('swir1', 'swir2') then l.x // 2 else l.x end as sx,
       case when l.band in ('swir1', 'swir2') then l.y // 2 else l.y end as sy, nullif(l.v, 0) as v
from obs_long l join job_scenes using (scene_id) where l.band not in ('swir1', 'swir2') or (l.x % 2 = 0 and l.y % 2 = 0)""",
      "obs_long", "job_scenes")
O.cte("job_grid", _grid_sql("select scene_id, min(sx) as x0, max(sx) as x1, min(sy) as y0, max(sy) as y1 "
                            "from job_long where res = '10m' group by scene_id"), "job_long")
O.cte("job_coarse", "select * from job_long where res = '20m'", "job_long")
O.cte("job_fine", "select scene_id, band, sx as x, sy as y, cast(v as double) as v from job_long where res = '10m' union all "
      + _gather_sql(["v"], "job_coarse", "job_grid", "g.scene_id, b.band"), "job_long", "job_coarse", "job_grid")
O.cte("job_stack", "select w.*, o.scl, job_scenes.year from (select scene_id, x, y, "
      + ", ".join(f"max(case when band = '{b}' then v end) as {b}" for b in BANDS)
      + " from job_fine group by scene_id, x, y) w join job_scenes using (scene_id) left join obs o on o.scene_id = w.scene_id "
      "and o.x = w.x // 2 * 2 and o.y = w.y // 2 * 2 "
      f"where w.x between {_JB[0]} and {_JB[2]} and w.y between {_JB[1]} and (select top from job_top)", "job_fine", "job_scenes", "job_top", "obs")
O.cte("job_good", "select * from job_stack where scene_id in (select scene_id from job_stack group by scene_id having count(scl) > 0 "
      "and count(*) filter (where scl <> 0) > 0 and cast(count(*) filter (where scl in (3, 7, 8, 9, 10, 11)) as double) "
      f"/ count(*) filter (where scl <> 0) <= {JOB_CLOUD}e0 "
      f"and cast(count(*) filter (where scl <> 0) as double) / (select {_JB[2] - _JB[0] + 1} * (top - {_JB[1]} + 1) from job_top) >= {JOB_COVERAGE}e0)", "job_stack", "job_top")
O.cte("job_bright", "select year, scene_id, x, y, " + ", ".join(
    f"case when not coalesce(scl, 0) in ({_codes(SCL_BAD)}) and not coalesce(red > 2100 and green > 2100 and blue > 2100 "
    f"and not coalesce(scl, 0) in ({_codes(SCL_BAD)}), false) then {b} end as {b}" for b in BANDS) + " from job_good", "job_good")
O.cte("job_clean", "select b.year, b.scene_id, b.x, b.y, " + ", ".join(
    f"case when abs({b} - m_{b}) <= {SIGMA_K} * s_{b} then {b} end as {b}" for b in BANDS) + " from job_bright b join (select scene_id, "
    + ", ".join(f"avg({b}) as m_{b}, stddev_pop({b}) as s_{b}" for b in BANDS) + " from job_bright group by scene_id) s "
    "on s.scene_id = b.scene_id", "job_bright")
O.cte("job_median", "select year, x, y, " + ", ".join(
    f"{O.pack(f'median(case when {b} > 0 then {b} end)')} as {b}" for b in BANDS) + " from job_clean group by year, x, y", "job_clean")
O.cte("job_tc", "select year, x, y, " + ", ".join(f"{O.tc_e8_sql(n)} as {n}_e8" for n in TC_NAMES) + " from job_median", "job_median")
O.cte("job_trend", "select x, y, " + ", ".join(
    f"{O.slope_sql(f'{n}_e8')} as {n}_slope, cast(count({n}_e8) as int) as n_{n}" for n in TC_NAMES) + " from job_tc group by x, y", "job_tc")


@register("catalogue_trend", O.with_ctes(
    "select x, y, " + ", ".join(f"{n}_slope" for n in TC_NAMES) + ", n_tcb as n_years, "
    + ", ".join(f"{O.stretch_sql(f'{n}_slope')} as {n}_u8" for n in TC_NAMES) + " from job_trend", "job_trend"))
def q_catalogue_trend(spark, sf_dir):
    """From the catalogue to the trend map, every step in one job."""
    ob = fx.obs(spark, sf_dir)
    top = fx.grid_top(spark, sf_dir)
    bounds = (JOB_X_M[0], 0.0, JOB_X_M[1], (top - 1) * 10.0)
    x0, y0, x1, y1 = clip_index_range(bounds)
    w, s, e, n = DEFAULT_AOI
    aoi = spark.createDataFrame([(1, w, s, e, n)], "aoi_id int, west double, south double, east double, north double")
    scenes = fx.scene_catalogue(spark, sf_dir)
    finished = scenes.filter(F.col("item_id") % 10 == 5).select("item_id")
    return catalogue_trend(scenes, fx.scene_assets(spark, sf_dir), aoi, finished, fx.scene_bands(spark, sf_dir, ob),
                           fx.scene_classes(spark, sf_dir, ob), range(1995, 2002), bounds, float((x1 - x0 + 1) * (y1 - y0 + 1)), grid="MGRS-5",
                           collection="surface", epsg=32605, cloud_thresh=JOB_CLOUD, min_coverage=JOB_COVERAGE)


from pixtrend.plans import registry_grids  # noqa: E402,F401  (adds to QUERIES and ORACLE)
