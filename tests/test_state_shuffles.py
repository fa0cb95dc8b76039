"""A state's median is found where its counts are summed."""

from pixtrend.constants import BANDS
from pixtrend.operators import pixelstate as PS
from pixtrend.operators.mosaic import PIXEL_KEYS, median_mosaic


def test_one_shuffle_by_pixel(spark, tmp_path):
    rows = [(2000 + s % 2, 1 + s, x, 0, *[None if (x + s) % 5 == 0 else (x * 7 + s * s) % 11 for _ in BANDS]) for s in range(9) for x in range(6)]
    rows += [(None, 3, None, 0, *[4] * 6), (2000, 4, 0, 0, *[9] * 6)]  # null keys, a pixel that comes twice
    obs = spark.createDataFrame(rows, "year int, scene_id int, x int, y int, " + ", ".join(f"{b} int" for b in BANDS))
    counts = PS.histogram(obs)
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    path = str(tmp_path)
    PS.write_batch(PS.histogram(obs.where("scene_id < 5")), path, "first")
    PS.write_batch(PS.histogram(obs.where("scene_id >= 5")), path, "late")
    got = PS.median_of(PS.read_state(spark, path, PS.HISTOGRAM_SUMS, by=PIXEL_KEYS))
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(str, got.collect())) == sorted(map(str, median_mosaic(obs).select(got.columns).collect()))
