"""Batches of tiles for the classifier: same answer for every batch size."""

import numpy as np
import pytest

from pixtrend.operators.classify import bright_surroundings, classify_batches

SCHEMA = "scene_id int, x int, y int, red int, green int, nir int, x_ string"


def _rows(seed=1, scenes=3, side=11):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(scenes):
        for y in range(-2, side):
            for x in range(-3, side):
                if rng.random() < 0.8:
                    v = [None if rng.random() < 0.05 else int(rng.integers(0, 6000)) for _ in range(3)]
                    rows.append((s, x, y, *v, "other"))
    return rows


def _brute(rows):
    v = {(s, x, y): None if None in (r, g, n) else r + g + n for s, x, y, r, g, n, _ in rows}
    out = {}
    for s, x, y in v:
        near = [v.get((s, x + i, y + j)) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        near = [n for n in near if n is not None]
        out[s, x, y] = int(sum(near) > 9000 * len(near))
    return out


def _got(df):
    rows = df.collect()
    out = {(r["scene_id"], r["x"], r["y"]): r["cls"] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("size", [1, 2, 7, 64])
@pytest.mark.parametrize("batch_rows", [3, 10000])
def test_same_for_every_batch_size(spark, size, batch_rows):
    rows = _rows()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        got = _got(classify_batches(spark.createDataFrame(rows, SCHEMA), bright_surroundings, tile=4, halo=1, batch_size=size))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _brute(rows)


def test_model_sees_full_batches_across_scenes(spark):
    def count(arr):
        return np.full((len(arr), *arr.shape[2:]), len(arr))

    rows = [(s, x, 0, 1, 1, 1, "") for s in range(6) for x in range(2)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = _got(classify_batches(df, count, tile=2, batch_size=4))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(got.values()) == [2] * 4 + [4] * 8


def test_repeats_missing_places_layers_and_empty(spark):
    def layers(arr):
        top = (np.nan_to_num(arr[:, 0]) > 3).astype(int)
        return np.stack([top * 0, top, top * 0], axis=1)

    rows = [(1, 0, 0, 1, 1, 1, ""), (1, 0, 0, 5, 1, 1, ""), (1, 0, 0, 5, 1, 1, ""), (None, 0, 0, 5, 1, 1, ""),
            (1, None, 0, 5, 1, 1, ""), (1, 1, None, 5, 1, 1, ""), (1, 1, 0, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(classify_batches(df, layers, tile=4)) == {(1, 0, 0): 1, (1, 1, 0): 0}
    assert classify_batches(df.limit(0), layers, tile=4).count() == 0
    with pytest.raises(ValueError):
        classify_batches(df, layers, tile=2, halo=3)
