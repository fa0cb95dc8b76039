"""Hand-computed micro fixtures for the NULL/NaN and arithmetic rules."""

import math

import pytest
from pyspark.sql import functions as F

from pixtrend.constants import BANDS
from pixtrend.functions import geo as G
from pixtrend.functions import pixel as P
from pixtrend.functions.indices import tasseled_cap
from pixtrend.operators import masks as M
from pixtrend.operators.mosaic import median_mosaic, quantile_mosaic
from pixtrend.operators.resample import resample_bilinear, resample_nearest
from pixtrend.operators.trend import linear_trend

SCHEMA = "year int, scene_id int, x int, y int, " + ", ".join(f"{b} int" for b in BANDS) + ", scl int"


def stack(spark, rows):
    """rows of (scene_id, x, y, [6 bands], scl) in year 2000."""
    return spark.createDataFrame([(2000, s, x, y, *bands, scl) for s, x, y, bands, scl in rows], SCHEMA)


def fx_obs(spark, sf):
    from pixtrend.sources import fixtures as fx

    return fx.obs(spark, sf)


def test_c1_nan_is_not_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "v double")
    assert df.agg(F.median("v")).first()[0] == 3.0          # Spark orders NaN last
    assert df.agg(F.median(P.nan_to_null("v"))).first()[0] == 2.0


def test_c2_pack(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (100.9,), (10001.0,)], "v double")
    assert [r[0] for r in df.select(P.pack_u16("v")).collect()] == [0, 0, 100, 10000]


def test_c3_even_median_truncates(spark):
    rows = [(1, 0, 0, [100] * 6, 4), (2, 0, 0, [101] * 6, 4)]
    m = median_mosaic(stack(spark, rows)).first()
    assert m["blue"] == 100


def test_c4_brightness_null_keeps_other_bands(spark):
    rows = [(1, 0, 0, [3000, 3000, None, 500, 500, 500], 4)]
    out = M.brightness_mask(stack(spark, rows)).first()
    assert out["blue"] == 3000 and out["nir"] == 500 and out["red"] is None


def test_c5_low_reflectance(spark):
    rows = [(1, 0, 0, [0, 5, 10, 10, 500, 600], 4), (1, 1, 0, [0, 5, 10, 11, 500, 600], 4)]
    out = {r["x"]: r for r in M.low_reflectance_mask(stack(spark, rows)).collect()}
    assert out[0]["swir2"] is None
    assert out[1]["swir2"] == 600


@pytest.mark.parametrize("q,expect", [
    (0.25, [0, 0, 0, 1, 1, 1, 2, 2, 2, 2, 2]),
    (0.75, [0, 1, 2, 2, 3, 4, 4, 5, 6, 7, 8]),
])
def test_c6_nearest_quantile(spark, q, expect):
    rows = []
    for n in range(1, 12):
        for i in range(n):
            rows.append((i + 1, n, 0, [i + 1] * 6, 4))    # values 1..n (0 is nodata)
    out = quantile_mosaic(stack(spark, rows), {"blue": q}, pack=False)
    got = {r["x"]: int(r["blue"]) - 1 for r in out.collect()}
    assert [got[n] for n in range(1, 12)] == expect


def test_c7_sigma_blanks_one_band(spark):
    rows = [(1, i, 0, [100, 200, 300, 400, 500, 600], 4) for i in range(20)]
    rows.append((1, 20, 0, [10000, 200, 300, 400, 500, 600], 4))
    out = {r["x"]: r for r in M.outlier_mask(stack(spark, rows)).collect()}
    assert out[20]["blue"] is None and out[20]["green"] == 200
    assert all(out[i]["blue"] == 100 for i in range(20))


def test_c8_trend(spark):
    e8 = 100_000_000
    gap = [(2000 + t, 0, 0, int(round(0.01 * (2000 + t) * e8))) for t in (0, 1, 3, 4)]
    one = [(2000, 1, 0, 5 * e8)]
    none = [(2000, 2, 0, None)]
    df = spark.createDataFrame(gap + one + none, "year int, x int, y int, v_e8 bigint")
    out = {r["x"]: r for r in linear_trend(df, values=["v"]).collect()}
    assert out[0]["v_slope"] == pytest.approx(0.1, abs=1e-12)
    assert out[1]["v_slope"] is None and out[1]["n_v"] == 1
    assert out[2]["v_slope"] is None and out[2]["n_v"] == 0


def test_c9_stretch(spark):
    df = spark.createDataFrame([(-0.5,), (-0.3,), (0.0,), (0.3,), (None,)], "v double")
    assert [r[0] for r in df.select(P.stretch_u8("v")).collect()] == [0, 0, 127, 255, 0]


def test_c10_bilinear_row(spark):
    # 3x3 coarse cells, v = 10*id, id 4 (centre) missing; look at fine row 0
    rows = [(1, i % 3, i // 3, None if i == 4 else 10 * i) for i in range(9)]
    df = spark.createDataFrame(rows, "scene_id int, sx int, sy int, v int")
    out = resample_bilinear(df, ["v"])
    row0 = sorted((r["x"], r["v"]) for r in out.filter("y = 0").collect())
    assert [v for _, v in row0] == pytest.approx([0, 2.5, 7.5, 12.5, 17.5, 20])


def test_bilinear_constant_field(spark):
    rows = [(1, x, y, 700) for x in range(4) for y in range(3)]
    df = spark.createDataFrame(rows, "scene_id int, sx int, sy int, v int")
    vals = {r["v"] for r in resample_bilinear(df, ["v"]).collect()}
    assert vals == {700.0}


def test_nearest_children(spark):
    df = spark.createDataFrame([(1, 2, 3, 7)], "scene_id int, sx int, sy int, cls int")
    got = sorted((r["x"], r["y"]) for r in resample_nearest(df, ["cls"]).collect())
    assert got == [(4, 6), (4, 7), (5, 6), (5, 7)]


def test_c11_convex_clip(spark):
    ring = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)]
    box = [(1, .5), (3, .5), (3, 2), (1, 2)]
    t = "array<struct<x:double,y:double>>"
    df = spark.createDataFrame([([{"x": float(a), "y": float(b)} for a, b in ring],
                                 [{"x": float(a), "y": float(b)} for a, b in box])], f"s {t}, c {t}")
    r = df.select(G.ring_area(G.clip_convex("s", "c")).alias("a"),
                  G.ring_area(G.clip_convex("s", F.reverse("c"))).alias("a_cw")).first()
    assert r["a"] == pytest.approx(7 / 3) and r["a_cw"] == pytest.approx(7 / 3)


def test_coverage_contained_and_disjoint(spark):
    t = "array<struct<x:double,y:double>>"
    fp = [{"x": -155.0, "y": 69.0}, {"x": -151.0, "y": 69.0}, {"x": -151.0, "y": 72.0},
          {"x": -155.0, "y": 72.0}]
    df = spark.createDataFrame([(fp,)], f"ring {t}")
    r = df.select(G.coverage_ratio("ring", -153.5, 70.5, -153.0, 71.0, 32605).alias("inside"),
                  G.coverage_ratio("ring", -140.0, 70.5, -139.5, 71.0, 32605).alias("outside"),
                  G.coverage_ratio("ring", -151.25, 70.5, -150.75, 71.0, 32605).alias("half")).first()
    assert r["inside"] == pytest.approx(1.0, abs=1e-9)
    assert r["outside"] == 0.0
    assert 0.4 < r["half"] < 0.6


def test_c12_utm(spark):
    df = spark.createDataFrame([(-153.5, 70.5), (-153.0, 71.0)], "lon double, lat double")
    got = [(r["p"]["x"], r["p"]["y"]) for r in df.select(G.utm_xy("lon", "lat", 32605).alias("p")).collect()]
    assert got[0] == pytest.approx((481372.525, 7821710.021), abs=0.01)
    assert got[1] == pytest.approx((500000.0, 7877396.767), abs=0.01)


def test_c14_utm_epsg(spark):
    df = spark.createDataFrame([(-153.25, 70.75), (-153.25, -70.75)], "lon double, lat double")
    assert [r[0] for r in df.select(G.utm_epsg("lon", "lat")).collect()] == [32605, 32705]


def test_point_in_polygon_column_and_literal_agree(spark):
    poly = [(100.0, 0.0), (1900.0, 50.0), (1500.0, 600.0), (800.0, 300.0), (200.0, 900.0)]
    pts = [(float(x), float(y)) for x in range(0, 2000, 97) for y in range(0, 1000, 53)]
    ring = [{"x": a, "y": b} for a, b in poly]
    df = spark.createDataFrame([(x, y, ring) for x, y in pts],
                               "px double, py double, ring array<struct<x:double,y:double>>")
    r = df.select((G.point_in_polygon("px", "py", "ring") == G.point_in_polygon_lit("px", "py", poly))
                  .alias("same")).collect()
    assert all(x["same"] for x in r)


def test_scl_missing_reads_as_zero(spark):
    rows = [(1, 0, 0, [500] * 6, None)]
    assert M.scl_mask(stack(spark, rows)).first()["blue"] is None           # 0 is bad
    assert M.scl_mask_invalid(stack(spark, rows)).first()["blue"] == 500    # 0 is valid here


def test_tasseled_cap_missing_band(spark):
    df = spark.createDataFrame([(2000, 0, 0, 1000, 1000, 1000, 1000, 1000, 0)],
                               "year int, x int, y int, " + ", ".join(f"{b} int" for b in BANDS))
    r = tasseled_cap(df).first()
    assert r["tcb"] is None and r["tcg"] is None


def test_tasseled_cap_value(spark):
    df = spark.createDataFrame([(2000, 0, 0, 1000, 2000, 3000, 4000, 5000, 6000)],
                               "year int, x int, y int, " + ", ".join(f"{b} int" for b in BANDS))
    r = tasseled_cap(df).first()
    expect = (0.3037 * .1 + 0.2793 * .2 + 0.4743 * .3 + 0.5585 * .4 + 0.5082 * .5 + 0.1863 * .6)
    assert r["tcb"] == pytest.approx(expect, abs=1e-12)


def test_expected_pixels(spark):
    df = spark.createDataFrame([(1000.0, 600.0)], "w double, h double")
    assert df.select(P.expected_pixels("w", "h", 20)).first()[0] == 1500.0


def test_scene_order_does_not_matter(spark):
    rows = [(s, x, 0, [100 * s + x] * 6, 4) for s in range(1, 6) for x in range(3)]
    a = median_mosaic(stack(spark, rows)).orderBy("x").collect()
    b = median_mosaic(stack(spark, list(reversed(rows)))).orderBy("x").collect()
    assert a == b
    assert all(math.isfinite(r["blue"]) for r in a)


def test_classifier_halo_matches_whole_scene(spark):
    from pixtrend.operators.classify import classify_tiles

    def _neighbour_rule(arr):
        """class 1 where any pixel of the 3x3 neighbourhood is bright (needs context)."""
        import numpy as np

        bright = np.nan_to_num(arr.sum(axis=0), nan=0.0) > 9000
        p = np.pad(bright, 1)
        out = np.zeros_like(bright)
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                out |= p[1 + dy:1 + dy + bright.shape[0], 1 + dx:1 + dx + bright.shape[1]]
        return out.astype("int32")

    rows = [(1, x, y, [0, 0, 4000 if (x * 7 + y * 3) % 11 == 0 else 100, 0, 0, 0], 4)
            for x in range(12) for y in range(9)]
    df = stack(spark, rows).withColumn("green", F.col("red")).withColumn("nir", F.col("red"))
    tiled = {(r.x, r.y): r.cls for r in classify_tiles(df, _neighbour_rule, tile=4, halo=1).collect()}
    whole = {(r.x, r.y): r.cls for r in classify_tiles(df, _neighbour_rule, tile=64, halo=0).collect()}
    no_halo = {(r.x, r.y): r.cls for r in classify_tiles(df, _neighbour_rule, tile=4, halo=0).collect()}
    assert len(tiled) == 12 * 9 and tiled == whole
    assert no_halo != whole  # the context matters at tile edges


def test_align_to_grid_resamples_only_when_needed(spark):
    from pixtrend.operators.resample import align_to_grid

    rows = []
    # scene 1: a 10 m band on a 4x4 grid and a 20 m band on 2x2 -> upsampled
    rows += [(1, "blue", "10m", x, y, 100) for x in range(4) for y in range(4)]
    rows += [(1, "swir1", "20m", x, y, 800) for x in range(2) for y in range(2)]
    # scene 2: only 20 m bands -> the 20 m grid is the reference, untouched
    rows += [(2, "swir1", "20m", x, y, 10 * x + y) for x in range(2) for y in range(2)]
    df = spark.createDataFrame(rows, "scene_id int, band string, res string, sx int, sy int, v int")
    out = align_to_grid(df).collect()
    s1 = [r for r in out if r.scene_id == 1 and r.band == "swir1"]
    s2 = sorted((r.x, r.y, r.v) for r in out if r.scene_id == 2)
    assert len(s1) == 16 and all(r.v == 800.0 for r in s1)
    assert s2 == [(0, 0, 0.0), (0, 1, 1.0), (1, 0, 10.0), (1, 1, 11.0)]
    assert len([r for r in out if r.band == "blue"]) == 16


def test_sigma_mask_of_a_full_size_scene(spark):
    """4,000,000 pixels of one scene: the moments' products exceed 64 bits."""
    df = spark.range(4_000_000).select(
        F.lit(1).alias("scene_id"), *[F.when(F.col("id") == 17, 10000).otherwise(3000 + F.col("id") % 101).cast("int").alias(b) for b in BANDS])
    out = M.outlier_mask(df).agg(F.count("*").alias("n"), *[F.count(b).alias(b) for b in BANDS]).first()
    assert out["n"] == 4_000_000 and all(out[b] == 3_999_999 for b in BANDS)


def test_sigma_mask_of_fractional_bands(spark):
    rows = [(1, *[0.25 + 0.5 * (i % 2)] * 6) for i in range(40)] + [(1, *[99.5] * 6)]
    out = M.outlier_mask(spark.createDataFrame(rows, "scene_id int, " + ", ".join(f"{b} double" for b in BANDS))).collect()
    assert sorted(r["nir"] for r in out if r["nir"] is not None) == [0.25] * 20 + [0.75] * 20


def test_bilinear_stays_on_the_scene_grid_and_keeps_fractions(spark):
    rows = [(1, 5, 5, 100.75), (1, 6, 5, 100.75), (2, 0, 0, 1.5)]
    out = resample_bilinear(spark.createDataFrame(rows, "scene_id int, sx int, sy int, v double"), ["v"]).collect()
    one = {(r["x"], r["y"]) for r in out if r["scene_id"] == 1}
    assert one == {(x, y) for x in range(10, 14) for y in (10, 11)}
    assert {r["v"] for r in out if r["scene_id"] == 1} == {100.75}
    assert {(r["x"], r["y"]) for r in out if r["scene_id"] == 2} == {(0, 0), (0, 1), (1, 0), (1, 1)}


def test_alternates_of_odd_assets(spark):
    from pixtrend.sources.catalog import asset_status, prefer_s3_assets

    rows = [(1, '{"a":{"href":"h","alternate":{},"alternates":[{"href":"s3://x"}]}}'), (2, '{"a":{"href":"h","alternate":null,"alternates":{"s3":{"href":"s3://y"}}}}'),
            (3, '{"a":{"href":"h","alternate":[],"alternates":{"S3":{"href":"s3://z"}}}}'), (4, '{"a":'), (5, None), (6, "{}"), (7, '{"a":{"href":"h"}}')]
    df = spark.createDataFrame(rows, "item_id int, assets string")
    assert {r["item_id"]: r["href"] for r in prefer_s3_assets(df).collect()} == {1: "s3://x", 2: "s3://y", 3: "s3://z", 7: "h"}
    assert {r["item_id"]: r["status"] for r in asset_status(df).collect()} == {
        1: "ok", 2: "ok", 3: "ok", 4: "bad_json", 5: "bad_json", 6: "no_assets", 7: "ok"}


def test_product_query_has_no_silent_cap(spark):
    from pixtrend.sources.catalog import query_products

    df = spark.range(1500).selectExpr("id as item_id")
    assert query_products(df).count() == 1500 and query_products(df, top=10).count() == 10


def test_missing_years_can_be_required(spark):
    from pixtrend.sources.catalog import missing_years

    df = spark.createDataFrame([(y,) for y in (2000, 2001, 2001)], "year int")
    assert [r["year"] for r in missing_years(df, 2000, 2002, required=True).collect()] == [2002]
    with pytest.raises(ValueError):
        missing_years(df, 2000, 2001, required=True)


def test_nonzero_and_optional_masks(spark):
    rows = [(1, 0, 0, [5] * 6, 4), (1, 1, 0, [6] * 6, 8), (1, 2, 0, [7] * 6, None)]
    df = stack(spark, rows)
    cls = spark.createDataFrame([(1, 0, 0, 0), (1, 1, 0, 2)], "scene_id int, x int, y int, cls int")
    key = "scene_id" if "scene_id" in df.columns else None
    assert key
    df = df.withColumn("scene_id", F.lit(1))
    assert {r["x"]: r["blue"] for r in M.nonzero_mask(df, cls).collect()} == {0: 5, 1: None, 2: 7}
    assert {r["x"]: r["blue"] for r in M.scl_mask_optional(df).collect()} == {0: 5, 1: None, 2: None}
    none = df.withColumn("scl", F.lit(None).cast("int"))
    assert {r["x"]: r["blue"] for r in M.scl_mask_optional(none).collect()} == {0: 5, 1: 6, 2: 7}


def test_fixture_data_reach_every_rule(spark):
    """The stand-in data must make the rules bite; a green oracle alone would not show it."""
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.01"
    q = E.queries()
    status = {r["status"] for r in q["scene_status"](spark, sf).select("status").distinct().collect()}
    assert {"ok", "cloudy", "misaligned"} <= status
    assert {r[0] > 0 for r in q["run_summary"](spark, sf).select("n_ok").collect()} == {True} or \
        q["run_summary"](spark, sf).filter("n_ok > 0").count() > 0
    raw = fx_obs(spark, sf)
    assert raw.filter("scl is null").count() > 0
    zero = raw.filter(" and ".join(f"{b} = 0" for b in BANDS)).count()
    assert zero > 0 and q["all_zero_mask"](spark, sf).filter(M.all_missing(raw)).count() == zero
    cleared = raw.filter("blue <> 0").count() - q["outlier_mask"](spark, sf).filter("blue is not null").count()
    assert cleared > 0
    assert {r["status"] for r in q["asset_status"](spark, sf).select("status").distinct().collect()} == {"ok", "bad_json"}
