"""Many scenes in one group of the stream's state: the same reports as by the batch rule."""

import datetime as dt
import random

from pixtrend.session import new_scratch_path
from pixtrend.streaming.completeness import LAYERS, last_status, release_scenes_stream, status_of_all

SCHEMA = "scene_id string, band string, ts timestamp"


def test_all_scenes_in_one_group(spark):
    rng = random.Random(8)
    start = [rng.randint(0, 3) for _ in range(30)]
    rows = [(f"s{s}", b, dt.datetime(2000, 1, 1) + dt.timedelta(hours=start[s] + rng.randint(0, 2 if s % 2 else 6))) for s in range(30) for b in LAYERS if rng.random() > 0.05 for _ in range(rng.choice([1, 2]))]
    clock = [("clock", None, dt.datetime(2001, 1, 1))]
    src, dst, ckpt = (new_scratch_path(spark, p) for p in ("arrive", "reports", "ckpt"))
    for wave in [*([r for r in rows if r[2].hour // 3 == w] for w in range(4)), clock, clock]:
        spark.createDataFrame(wave, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        release_scenes_stream(spark, src, dst, ckpt, SCHEMA, wait_s=3 * 3600, keep_s=100 * 3600, buckets=1)
    got, want = (sorted(map(tuple, df.collect())) for df in (last_status(spark.read.parquet(dst), "scene_id"), status_of_all(spark.createDataFrame(rows, SCHEMA), 3 * 3600)))
    assert got == want and {r[1] for r in got} == {"complete", "late", "incomplete"}
