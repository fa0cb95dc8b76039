"""Stand-in tables derived from the driver's TPC-H-style parquet.

The reference reads satellite rasters and a remote catalogue; here the same
shapes are derived deterministically from ``lineitem`` / ``orders`` so that
every query grows with the data:

* ``obs``    one wide pixel row per (scene, pixel) from ``lineitem``; the
             pixel grid is ``GRID_W`` wide and as tall as the part keys
             require, so pixels scale with the scale factor.
* ``scenes`` one catalogue item per order.
* ``assets`` the band files of each item (one asset missing for most items).

The SQL twins used by the DuckDB oracle live in ``pixtrend.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixtrend.constants import BAND_ASSETS, BANDS, DEFAULT_AOI, SCL_ASSET

GRID_W = 200      # pixel columns of the stand-in grid
TILE = 50         # tile edge in pixels (production blocking is 512)
PIXEL_M = 10      # pixel size in metres of the stand-in grid
SPIKE, ZERO, SCL_GAP = 200, 97, 13

# asset -> (ord, band column); ord 7 is the classification layer
ASSET_ORDER = [(i + 1, a, b) for i, (a, b) in enumerate(zip(BAND_ASSETS, BANDS))] + [
    (7, SCL_ASSET, "scl")
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide pixel rows ``(year, scene_id, tile_x, tile_y, x, y, 6 bands, scl)``."""
    li = table(spark, sf_dir, "lineitem")
    p = F.floor("l_extendedprice").cast("bigint")
    yr = F.year("l_shipdate")
    keyed = li.select(
        yr.cast("int").alias("year"),
        (yr * 100 + F.col("l_suppkey") % 10).cast("int").alias("scene_id"),
        (F.col("l_partkey") % GRID_W).cast("int").alias("x"),
        F.floor(F.col("l_partkey") / GRID_W).cast("int").alias("y"),
        "l_extendedprice", "l_orderkey",
    )
    # what the rules must meet: an outlier in one row of SPIKE, pixels that are
    # zero in every band, and a missing class in one pixel of SCL_GAP
    spike = F.col("l_orderkey") % SPIKE == 1
    zero = F.col("y") * GRID_W + F.col("x")
    out = keyed.groupBy("year", "scene_id", "x", "y").agg(
        F.max(F.when(spike, 10000).otherwise(p % 4000)).alias("blue"),
        F.max((p * 3) % 4000).alias("green"),
        F.max((p * 7) % 4000).alias("red"),
        F.max((p * 11) % 11000).alias("nir"),
        F.max((p * 13) % 5000).alias("swir1"),
        F.max(F.when(spike, 10000).otherwise((p * 17) % 5000)).alias("swir2"),
        F.max("l_orderkey").alias("k"),
    )
    out = out.withColumns({b: F.when(zero % ZERO == 5, 0).otherwise(F.col(b)).cast("int") for b in BANDS})
    out = out.withColumn("scl", F.when(F.col("k") % SCL_GAP != 0, F.col("k") % 12).cast("int"))
    return out.select(
        "year", "scene_id",
        F.floor(F.col("x") / TILE).cast("int").alias("tile_x"),
        F.floor(F.col("y") / TILE).cast("int").alias("tile_y"),
        "x", "y", *BANDS, "scl",
    )


def grid_top(spark: SparkSession, sf_dir: str) -> int:
    """Greatest ``y`` of ``obs``, without building its pixels; 0 where there is none."""
    top = table(spark, sf_dir, "lineitem").agg(F.max(F.floor(F.col("l_partkey") / GRID_W).cast("int")))
    return top.first()[0] or 0


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue items with footprint bbox and a four-corner ring."""
    o = table(spark, sf_dir, "orders")
    c = F.col("o_custkey")
    west = (F.lit(-180) + (c * 37) % 355).cast("double")
    south = (F.lit(-79) + (c * 13) % 155).cast("double")
    df = o.select(
        F.col("o_orderkey").alias("item_id"),
        F.col("o_orderdate").alias("ts"),
        (F.floor("o_totalprice").cast("bigint") % 101).alias("cloud_cover"),
        F.concat(F.lit("MGRS-"), (c % 10).cast("string")).alias("grid_code"),
        F.when(F.col("o_orderkey") % 7 == 2, "raw").otherwise("surface").alias("collection"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None))
        .otherwise((F.lit(32601) + c % 60).cast("int")).cast("int").alias("proj_epsg"),
        west.alias("west"), south.alias("south"),
        (west + 4).alias("east"), (south + 3).alias("north"),
    )
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    w, s, e, n = F.col("west"), F.col("south"), F.col("east"), F.col("north")
    # footprint: the bbox rectangle with its north-east corner moved inwards
    return df.withColumn("ring", F.array(pt(w, s), pt(e, s), pt(e - 1, n - 1), pt(w, n)))


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, ord, asset, band)``; items miss one asset unless key % 8 == 0."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item_id"))
    entries = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(a).alias("asset"), F.lit(b).alias("band"))
        for i, a, b in ASSET_ORDER
    ])
    return (o.select("item_id", F.inline(entries))
            .filter((F.col("item_id") + F.col("ord")) % 8 != 0))


def band_order(spark: SparkSession) -> DataFrame:
    """The fixed ``(ord, asset, band)`` list (seven rows)."""
    return spark.createDataFrame(ASSET_ORDER, "ord int, asset string, band string")


def class_mask(spark: SparkSession, sf_dir: str, ob: DataFrame | None = None) -> DataFrame:
    """Predicted classes per pixel (0 = clear); every third scene has nodata
    holes where (x+y) % 11 == 0, the others match their scene."""
    ob = ob if ob is not None else obs(spark, sf_dir)
    return ob.filter(((F.col("x") + F.col("y")) % 11 != 0) | (F.col("scene_id") % 3 != 0)).select(
        "scene_id", "x", "y",
        ((F.col("x") * 3 + F.col("y") * 5 + F.col("scene_id")) % 4).cast("int").alias("cls"),
    )


def done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of items whose output already exists."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item_id")) \
        .filter(F.col("item_id") % 5 == 0)


def bands_20m(spark: SparkSession, sf_dir: str, ob: DataFrame | None = None) -> DataFrame:
    """Every obs pixel read as a 20 m cell ``(scene_id, sx, sy, swir1, swir2)``."""
    ob = ob if ob is not None else obs(spark, sf_dir)
    return ob.select("scene_id", F.col("x").alias("sx"), F.col("y").alias("sy"), "swir1", "swir2")


def obs_long(spark: SparkSession, sf_dir: str, ob: DataFrame | None = None) -> DataFrame:
    """``(scene_id, x, y, band, v)`` — one row per band of every obs pixel."""
    ob = ob if ob is not None else obs(spark, sf_dir)
    return ob.unpivot(["scene_id", "x", "y"], BANDS, "band", "v")


def product_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-folder style paths of every asset file."""
    a = assets(spark, sf_dir)
    return a.select(F.concat(
        F.lit("S2_"), F.col("item_id").cast("string"), F.lit(".SAFE/GRANULE/G/IMG_DATA/R"),
        F.substring("asset", -3, 3), F.lit("/T_"), F.col("asset"), F.lit(".jp2"),
    ).alias("path"))


def _asset_json(item: Column, asset: Column) -> Column:
    key = F.concat(item.cast("string"), F.lit("/"), asset)
    href = F.concat(F.lit('{"href":"https://h/'), key, F.lit('"'))
    r = item % 8
    return F.concat(
        F.lit('"'), asset, F.lit('":'), href,
        F.when(r.isin(0, 4), F.concat(F.lit(',"alternate":{"s3":{"href":"s3://b/'), key, F.lit('"}}}')))
        .when(r.isin(1, 5), F.concat(F.lit(',"alternates":[{"href":"http://m/'), key,
                               F.lit('"},{"href":"s3://c/'), key, F.lit('"}]}')))
        .when(r == 3, F.concat(F.lit(',"alternate":{},"alternates":[{"href":"s3://e/'), key, F.lit('"}]}')))
        .when(r == 7, F.concat(F.lit(',"alternate":null,"alternates":{"s3":{"href":"s3://n/'), key, F.lit('"}}}')))
        .when(r == 2, F.concat(F.lit(',"alternate":{"S3":{"href":"s3://u/'), key, F.lit('"}}}')))
        .otherwise(F.lit("}")),
    )


def assets_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, assets)`` with the catalogue's nested JSON asset objects;
    one item in 97 is cut short and is no JSON."""
    a = assets(spark, sf_dir)
    return a.groupBy("item_id").agg(
        F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(
            _asset_json(F.col("item_id"), F.col("asset")))), ","), F.when(F.col("item_id") % 97 != 5, "}").otherwise("")).alias("assets"))


def aois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of interest, one 0.5 x 0.5 degree lon/lat box per customer."""
    c = F.col("c_custkey")
    west = F.lit(-179.75) + ((c * 53) % 359).cast("double")
    south = F.lit(-69.75) + ((c * 7) % 139).cast("double")
    return table(spark, sf_dir, "customer").select(
        c.alias("aoi_id"), west.alias("west"), south.alias("south"),
        (west + 0.5).alias("east"), (south + 0.5).alias("north"))


def scene_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue items of the ``obs`` scenes (``item_id`` = ``scene_id``).  Days
    run past the season, the cloud cover over the whole range; ids ending in 3 are of another collection; the footprints
    of ids ending in 9 miss ``DEFAULT_AOI``, the others contain it."""
    w, s, e, n = DEFAULT_AOI
    li = table(spark, sf_dir, "lineitem")
    yr = F.year("l_shipdate")
    ids = li.select(yr.alias("year"), (yr * 100 + F.col("l_suppkey") % 10).cast("int").alias("item_id")).distinct()
    k = F.col("item_id")
    shift = F.when(k % 10 < 9, 0.0).otherwise(5.0)
    out = ids.select("item_id", F.date_add(F.make_date("year", F.lit(6), F.lit(25)), (k % 9) * 7).cast("timestamp_ntz").alias("ts"),
                     ((k * 37) % 101).alias("cloud_cover"), F.lit("MGRS-5").alias("grid_code"),
                     F.when(k % 10 == 3, "raw").otherwise("surface").alias("collection"), F.lit(32605).alias("proj_epsg"),
                     (F.lit(w - 0.5) + shift).alias("west"), F.lit(s - 0.5).alias("south"),
                     (F.lit(e + 0.5) + shift).alias("east"), F.lit(n + 0.5).alias("north"))
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    mid = F.struct(((F.col("west") + F.col("east")) / 2).alias("x"), (F.col("north") + 0.2).alias("y"))
    # five corners; every third ring is closed by its first point
    ring = [pt(F.col("west"), F.col("south")), pt(F.col("east"), F.col("south")), pt(F.col("east"), F.col("north")), mid,
            pt(F.col("west"), F.col("north"))]
    return out.withColumn("ring", F.when(k % 3 == 0, F.array(*ring, ring[0])).otherwise(F.array(*ring)))


def scene_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets of the ``obs`` scenes; one in 64 is missing."""
    entries = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(a).alias("asset"), F.lit(b).alias("band")) for i, a, b in ASSET_ORDER])
    return (scene_catalogue(spark, sf_dir).select("item_id", F.inline(entries))
            .filter((F.col("item_id") + F.col("ord")) % 64 != 0))


def scene_bands(spark: SparkSession, sf_dir: str, ob: DataFrame | None = None) -> DataFrame:
    """``(scene_id, band, res, sx, sy, v)``: the visible and near-infrared bands
    on the 10 m grid, the short-wave bands on the 20 m grid (every second pixel)."""
    lr = obs_long(spark, sf_dir, ob)
    coarse = F.col("band").isin("swir1", "swir2")
    lr = lr.filter(~coarse | ((F.col("x") % 2 == 0) & (F.col("y") % 2 == 0)))
    half = lambda c: F.when(coarse, F.floor(F.col(c) / 2)).otherwise(F.col(c)).cast("int")
    return lr.select("scene_id", "band", F.when(coarse, "20m").otherwise("10m").alias("res"), half("x").alias("sx"), half("y").alias("sy"), "v")


def scene_classes(spark: SparkSession, sf_dir: str, ob: DataFrame | None = None) -> DataFrame:
    """``(scene_id, sx, sy, scl)`` on the 20 m grid."""
    ob = ob if ob is not None else obs(spark, sf_dir)
    return ob.filter((F.col("x") % 2 == 0) & (F.col("y") % 2 == 0)).select(
        "scene_id", F.floor(F.col("x") / 2).cast("int").alias("sx"), F.floor(F.col("y") / 2).cast("int").alias("sy"), "scl")


def class_mask_layers(spark: SparkSession, sf_dir: str, cm: DataFrame | None = None) -> DataFrame:
    """Class masks as the classifier returns them: three layers for even
    scenes, one layer otherwise; ``(scene_id, x, y, layer, cls)``."""
    cm = cm if cm is not None else class_mask(spark, sf_dir)
    n = F.when(F.col("scene_id") % 2 == 0, 2).otherwise(0)
    return cm.select("scene_id", "x", "y", "cls", F.explode(F.sequence(F.lit(0), n)).alias("layer")) \
        .select("scene_id", "x", "y", "layer", ((F.col("cls") + F.col("layer")) % 4).cast("int").alias("cls"))


#: Outlines of the stand-in polygons, in metres from their corner: a concave one with a hole, and a part beside it.
OUTLINE = [(0.0, 0.0), (60.0, 5.0), (75.0, 48.0), (38.0, 22.0), (12.0, 61.0)]
HOLE = [(20.0, 12.0), (20.0, 20.0), (30.0, 20.0), (30.0, 12.0)]
PART = [(80.0, 0.0), (103.0, 7.0), (90.0, 33.0)]


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(poly_id, rings)`` in grid metres, one polygon per customer, spread over
    the whole grid; every fifth has a second part."""
    c = F.col("c_custkey")
    ox, oy = ((c * 37) % 190 * 10).cast("double"), (F.floor(c / 150) * 10 - 20).cast("double")

    def ring(points):
        return F.array(*[F.struct((ox + x).alias("x"), (oy + y).alias("y")) for x, y in points])

    rings = F.when(c % 5 == 0, F.array(ring(OUTLINE), ring(HOLE), ring(PART))).otherwise(F.array(ring(OUTLINE), ring(HOLE)))
    return table(spark, sf_dir, "customer").select(c.alias("poly_id"), rings.alias("rings"))
