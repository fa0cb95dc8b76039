"""The height of the stand-in grid comes from the part keys, not from the pixels."""

import pytest
from pyspark.sql import functions as F

from pixtrend.sources import fixtures as fx


@pytest.mark.parametrize("parts,top", [([3, 199, 200, 1401, None], 7), ([None], 0)])
def test_grid_top(spark, tmp_path, monkeypatch, parts, top):
    rows = [(k, p, 5, 10.5 * k) for k, p in enumerate(parts)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double").withColumn(
        "l_shipdate", F.timestamp_seconds(F.lit(800000000))).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert (fx.obs(spark, str(tmp_path)).agg(F.max("y")).first()[0] or 0) == top
    monkeypatch.setattr(fx, "obs", None)  # no pixels are built
    assert fx.grid_top(spark, str(tmp_path)) == top
