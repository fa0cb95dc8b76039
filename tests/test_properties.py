"""Property checks of the scalar pixel rules against plain Python."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from pixtrend.functions import pixel as P

vals = st.lists(st.one_of(st.none(), st.floats(-20000, 20000, allow_nan=False)), min_size=1, max_size=40)


def _pack(v):
    return 0 if v is None else int(max(0.0, min(10000.0, v)))


def _stretch(v):
    if v is None:
        return 0
    c = max(-0.3, min(0.3, v))
    return int((c + 0.3) / 0.6 * 255)


@settings(max_examples=15, deadline=None)
@given(vals)
def test_pack_matches_rule(spark, xs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(xs)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(P.pack_u16("v")).collect()]
    assert got == [_pack(v) for v in xs]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1, 1, allow_nan=False)), min_size=1, max_size=40))
def test_stretch_matches_rule(spark, xs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(xs)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(P.stretch_u8("v")).collect()]
    assert got == [_stretch(v) for v in xs]
    assert all(0 <= g <= 255 for g in got)


def test_expected_pixels_is_float():
    assert math.isclose(1000.0 / 20 * (600.0 / 20), 1500.0)
