"""Stateful completeness: late, repeated and missing layers; equal to the batch rule."""

import datetime as dt
import random

from pixtrend.session import new_scratch_path
from pixtrend.streaming.completeness import LAYERS, last_status, release_scenes_stream, status_of_all

SCHEMA = "scene_id long, band string, ts timestamp, note string"
HOUR = 3600


def _at(h):
    return dt.datetime(2000, 1, 1) + dt.timedelta(hours=h)


def _run(spark, waves, **how):
    src, dst, ckpt = (new_scratch_path(spark, p) for p in ("arrive", "reports", "ckpt"))
    for wave in waves:
        spark.createDataFrame([(s, b, _at(h), "x") for s, b, h in wave], SCHEMA).coalesce(1).write.mode("append").parquet(src)
        release_scenes_stream(spark, src, dst, ckpt, SCHEMA, wait_s=3 * HOUR, keep_s=100 * HOUR, **how)
    return spark.read.parquet(dst)


def _rows(df):
    return sorted((r["scene_id"], r["status"], r["n_layers"], r["missing"], r["at"]) for r in df.collect())


CLOCK = (-1, None, 1000)


def test_complete_incomplete_and_late(spark):
    first = [(s, b, 0) for s in (1, 2, 3) for b in LAYERS[:4]]
    waves = [first,
             [(1, b, 2) for b in LAYERS[3:]],                       # 1 is complete, one layer came twice
             [(1, "red", 5), (9, "thumbnail", 5)],                  # repeat after release; a layer nobody asked for
             [(2, b, 6) for b in LAYERS[4:]],                       # after 2 was reported incomplete
             [CLOCK], [CLOCK]]
    out = _run(spark, waves)
    assert _rows(out) == sorted([
        (1, "complete", 7, "", _at(2)), (2, "incomplete", 4, ",".join(LAYERS[4:]), _at(3)),
        (2, "late", 7, "", _at(6)), (3, "incomplete", 4, ",".join(LAYERS[4:]), _at(3))])
    assert [r[:2] for r in _rows(last_status(out))] == [(1, "complete"), (2, "late"), (3, "incomplete")]


def test_nulls_and_all_at_once(spark):
    wave = [(1, b, i / 4) for i, b in enumerate(LAYERS)] + [(None, "red", 0), (2, None, 0)]
    out = _run(spark, [wave, [CLOCK]])
    assert _rows(out) == [(1, "complete", 7, "", _at(1.5))]


def test_equal_to_the_batch_rule(spark):
    rng = random.Random(5)
    start = [rng.randint(0, 3) for _ in range(40)]
    rows = [(s, b, start[s] + rng.randint(0, 2 if s % 2 else 6)) for s in range(40) for b in LAYERS if rng.random() > 0.05 for _ in range(rng.choice([1, 1, 2]))]
    waves = [[r for r in rows if r[2] // 2 == w] for w in range(5)]
    out = last_status(_run(spark, [*waves, [CLOCK], [CLOCK]]))
    batch = status_of_all(spark.createDataFrame([(s, b, _at(h), "x") for s, b, h in rows], SCHEMA), 3 * HOUR)
    assert _rows(out) == _rows(batch)
    assert {r[1] for r in _rows(out)} == {"complete", "late", "incomplete"}
