"""Scene catalogue as a table: search, asset selection, run bookkeeping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixtrend.constants import BAND_ASSETS, BANDS, SCL_ASSET, SEASON


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def _day_start(d) -> Column:
    """Midnight of a day as a zone-free timestamp literal (catalogue times are
    TIMESTAMP_NTZ; a zoned literal would shift with the session time zone)."""
    return F.lit(f"{_as_date(d).isoformat()} 00:00:00").cast("timestamp_ntz")


def search_scenes(scenes: DataFrame, start, end, grid: str | None = None,
                  max_cloud: float = 100, collection: str | None = None, ts: str = "ts") -> DataFrame:
    """Items of ``collection`` acquired in ``[start, end]`` (whole end day), cloud cover
    ``<= max_cloud`` and on ``grid``.  Plain predicates on the scan columns,
    so they reach the parquet reader as pushed filters."""
    lo, hi = _day_start(start), _day_start(_as_date(end) + dt.timedelta(days=1))
    cond = (F.col(ts) >= lo) & (F.col(ts) < hi) & (F.col("cloud_cover") <= max_cloud)
    if grid is not None:
        cond = cond & (F.col("grid_code") == grid)
    if collection is not None:
        cond = cond & (F.col("collection") == collection)
    return scenes.filter(cond)


def product_name(item_id) -> Column:
    return F.concat(F.lit("S2_"), F.col(item_id).cast("string"), F.lit(".SAFE"))


def query_products(scenes: DataFrame, start=None, end=None, max_cloud: float | None = None,
                   attrs: dict | None = None, top: int | None = None,
                   aoi: tuple | None = None) -> DataFrame:
    """Product query: optional filters (``None`` = not applied), attribute
    equality map, AOI bbox intersection and, if asked, the first ``top`` names.

    ``orderBy(...).limit(top)`` plans as a top-k (TakeOrderedAndProject), so
    no full sort of the catalogue happens.
    """
    df = scenes
    if start is not None:
        df = df.filter(F.col("ts") >= _day_start(start))
    if end is not None:
        df = df.filter(F.col("ts") < _day_start(_as_date(end) + dt.timedelta(days=1)))
    if max_cloud is not None:
        df = df.filter(F.col("cloud_cover") <= max_cloud)
    for k, v in (attrs or {}).items():
        df = df.filter(F.col(k) == v)
    if aoi is not None:
        w, s, e, n = aoi
        df = df.filter((F.col("west") <= e) & (F.col("east") >= w) &
                       (F.col("south") <= n) & (F.col("north") >= s))
    out = df.select(product_name("item_id").alias("name"))
    if top is not None:
        out = out.orderBy("name").limit(top)
    return out


def prefer_s3_assets(items: DataFrame, assets_col: str = "assets") -> DataFrame:
    """One row per asset with the ``s3://`` alternate href when there is one.

    ``alternate`` (else ``alternates``) may be an object (``s3``/``S3`` ->
    ``href``) or a list (first ``href`` starting with ``s3://``); otherwise
    the original ``href`` stays.  An empty or null ``alternate`` counts as
    absent.  Parsed as VARIANT, so both shapes coexist; items whose text is no
    JSON have no assets here and show up in ``asset_status``.
    """
    v = F.try_parse_json(F.col(assets_col))
    ex = items.select("item_id", F.explode(
        F.try_variant_get(v, "$", "map<string,variant>")).alias("asset", "a"))
    a = F.col("a")
    first = F.try_variant_get(a, "$.alternate", "variant")
    filled = (first.isNotNull() & ~F.is_variant_null(first)
              & (F.coalesce(F.size(F.try_variant_get(first, "$", "map<string,variant>")), F.lit(1)) != 0)
              & (F.coalesce(F.size(F.try_variant_get(first, "$", "array<variant>")), F.lit(1)) != 0))
    alt = F.when(filled, first).otherwise(F.try_variant_get(a, "$.alternates", "variant"))
    from_dict = F.coalesce(F.try_variant_get(alt, "$.s3.href", "string"),
                           F.try_variant_get(alt, "$.S3.href", "string"))
    hrefs = F.transform(F.try_variant_get(alt, "$", "array<variant>"),
                        lambda d: F.try_variant_get(d, "$.href", "string"))
    from_list = F.element_at(F.filter(hrefs, lambda h: h.startswith("s3://")), 1)
    orig = F.try_variant_get(a, "$.href", "string")
    return ex.select("item_id", "asset", orig.alias("orig_href"),
                     F.coalesce(from_dict, from_list, orig).alias("href"))


def asset_status(items: DataFrame, assets_col: str = "assets") -> DataFrame:
    """``ok``, ``no_assets`` or ``bad_json`` per item, so that one bad item
    becomes a status instead of a failed job."""
    n = F.size(F.try_variant_get(F.try_parse_json(F.col(assets_col)), "$", "map<string,variant>"))
    return items.select("item_id", F.when(F.try_parse_json(F.col(assets_col)).isNull(), "bad_json")
                        .when(F.coalesce(n, F.lit(0)) <= 0, "no_assets").otherwise("ok").alias("status"))


def season_filter(scenes: DataFrame, years, start: str = SEASON[0], end: str = SEASON[1], ts: str = "ts") -> DataFrame:
    """Items of ``years`` acquired from ``start`` to ``end`` (MM-DD, both days
    included), as a disjunction of time ranges that reaches the scan."""
    cond = F.lit(False)
    for y in years:
        lo = _day_start(f"{y}-{start}")
        hi = _day_start(_as_date(f"{y}-{end}") + dt.timedelta(days=1))
        cond = cond | ((F.col(ts) >= lo) & (F.col(ts) < hi))
    return scenes.filter(cond)


def band_order_df(spark: SparkSession, assets=BAND_ASSETS, bands=BANDS) -> DataFrame:
    return spark.createDataFrame([(i + 1, a, b) for i, (a, b) in enumerate(zip(assets, bands))],
                                 "ord int, asset string, band string")


def band_assets(assets: DataFrame, band_order: DataFrame) -> DataFrame:
    """Assets of each item that are in the band list, with their resolution
    group (``10m`` read as the grid, ``20m`` resampled).  Absent assets are
    simply missing.  ``band_order`` is a short list; Spark broadcasts it by its size."""
    return assets.select("item_id", "asset").join(band_order, "asset") \
        .withColumn("res", F.when(F.col("asset").endswith("10m"), "10m")
                    .when(F.col("asset").endswith("20m"), "20m"))


def require_asset(items: DataFrame, assets: DataFrame, name: str = SCL_ASSET) -> DataFrame:
    """Items that carry asset ``name`` (semi join)."""
    return items.join(assets.filter(F.col("asset") == name).select("item_id"), "item_id",
                      "left_semi")


def product_bands(paths: DataFrame, bands=("B02", "B03", "B04", "B08", "B11", "B12"),
                  path: str = "path") -> DataFrame:
    """Product folder paths -> ``(scene, band, res, path)``.

    The first file per (scene, band, resolution) by path order is used, and
    products missing one of ``bands`` are skipped.
    """
    p = F.col(path)
    parsed = paths.select(
        F.regexp_extract(p, r"^([^/]+)[.]SAFE", 1).alias("scene"),
        F.regexp_extract(p, r"_(B[0-9]+)_", 1).alias("band"),
        F.regexp_extract(p, r"/R([0-9]+m)/", 1).alias("res"),
        p.alias("path"),
    ).filter(F.col("band").isin(list(bands)))
    first = parsed.groupBy("scene", "band", "res").agg(F.min("path").alias("path"))
    w = Window.partitionBy("scene")
    # a product has at most a few dozen band files: the window partition is bounded
    return first.withColumn("_nb", F.size(F.collect_set("band").over(w))) \
        .filter(F.col("_nb") == len(bands)).drop("_nb")


def pending(items: DataFrame, done: DataFrame, key: str = "item_id",
            overwrite: bool = False) -> DataFrame:
    """Items whose output does not exist yet (anti join with the manifest)."""
    return items if overwrite else items.join(done.select(key), key, "left_anti")


def missing_years(df: DataFrame, y0: int, y1: int, year: str = "year", required: bool = False) -> DataFrame:
    """Expected years ``y0..y1`` that have no rows in ``df``.

    The years of ``df`` are made distinct first (combined before the shuffle),
    so no task sees the pixels of a year.  ``required`` raises if none is missing."""
    spark = df.sparkSession
    years = spark.range(y0, y1 + 1).select(F.col("id").cast("int").alias(year))
    out = years.join(df.select(year).distinct(), year, "left_anti")
    if required and out.isEmpty():
        raise ValueError(f"every year from {y0} to {y1} is there already")
    return out
