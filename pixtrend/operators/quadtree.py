"""Joins of boxes by a quadtree of lon/lat cells.

A box is posted at the level whose cells are at least as large as it, where it
touches four cells at most, however large it is.  Two boxes that touch
share a cell at the coarser of their levels; so each side also posts the ancestors of
its cells, at those coarser levels only that the other side uses.  A pair is kept in
the one shared cell that holds the south-west corner of their intersection.

Cells with a large share of a side's rows are split: the rows are dealt over
numbered parts, which the other side's rows all visit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Finest level; cells of level l have a side of 360 / 2**l degrees.
MAX_LEVEL = 16
#: Rows that a part of a cell may hold.  A cell is split if it holds more, and more rows than
#: one in ``MOST_HOT`` of its side's boxes (of which each is posted a bounded number of times).
PART_ROWS, MOST_HOT = 2_000, 2_000

BOX = ("west", "south", "east", "north")


def side(level: Column) -> Column:
    return F.lit(360.0) / F.pow(F.lit(2.0), level)


def with_level(df: DataFrame, prefix: str) -> DataFrame:
    w, s, e, n = (F.col(f"{prefix}{c}") for c in BOX)
    size = F.greatest(e - w, n - s, F.lit(360.0 / 2 ** MAX_LEVEL))
    return df.withColumn(f"{prefix}level", F.greatest(F.floor(F.log2(F.lit(360.0) / size)), F.lit(0)).cast("int"))


def _cells(df: DataFrame, prefix: str, levels: Column) -> DataFrame:
    """One row per cell that the box touches at each of ``levels``."""
    w, s, e, n = (F.col(f"{prefix}{c}") for c in BOX)
    at = df.select("*", F.explode(levels).alias("_level")).withColumn("_side", side(F.col("_level")))
    at = at.select("*", F.explode(F.sequence(F.floor(w / F.col("_side")), F.floor(e / F.col("_side")))).alias("_cx"))
    return at.select("*", F.explode(F.sequence(F.floor(s / F.col("_side")), F.floor(n / F.col("_side")))).alias("_cy"))


KEY = ["_level", "_cx", "_cy"]


def _hot(rows: DataFrame, boxes: Column, parts: str, part_rows: int) -> DataFrame:
    """Cells to split, and into how many parts: a bounded number whatever the data."""
    counts = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where((F.col("_n") > part_rows) & (F.col("_n") * MOST_HOT > boxes)).select(*KEY, F.ceil(F.col("_n") / part_rows).cast("int").alias(parts))


def _dealt(rows: DataFrame, hot: DataFrame, parts: str, own: bool) -> DataFrame:
    """Each row in one part of its cell (``own``), or in all of them."""
    k = F.coalesce(F.col(parts), F.lit(1))
    at = F.array(F.pmod(F.xxhash64(*[c for c in rows.columns if c.endswith("_id")], *KEY), k).cast("int")) if own else F.sequence(F.lit(0), k - 1)
    return rows.join(F.broadcast(hot), KEY, "left").withColumn(f"{parts}_at", F.explode(at)).drop(parts)


PARTS = ["_pa_at", "_pb_at"]


def _sides(a: DataFrame, b: DataFrame, boxes: tuple[Column, Column], part_rows: int) -> tuple[DataFrame, DataFrame]:
    hot_a, hot_b = _hot(a, boxes[0], "_pa", part_rows), _hot(b, boxes[1], "_pb", part_rows)
    return _dealt(_dealt(a, hot_a, "_pa", True), hot_b, "_pb", False), _dealt(_dealt(b.drop("_side"), hot_a, "_pa", False), hot_b, "_pb", True)


def _joined(a: DataFrame, b: DataFrame, boxes: tuple[Column, Column], part_rows: int) -> DataFrame:
    left, right = _sides(a, b, boxes, part_rows)
    # few bytes may make many pairs: as many tasks as the session has, not as the bytes would fill
    n, key = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), [*KEY, *PARTS]
    return left.repartition(n, *key).join(right.repartition(n, *key), key)


def _posted(a: DataFrame, b: DataFrame, a_prefix: str, b_prefix: str) -> tuple[list[tuple[DataFrame, DataFrame]], tuple[Column, Column]]:
    """The rows of both sides by cell, as two pairs to join, and the numbers of boxes."""
    a, b = with_level(a, a_prefix), with_level(b, b_prefix)
    la, lb = f"{a_prefix}level", f"{b_prefix}level"
    used_a, used_b = (d.where(F.col(lv).isNotNull()).select(F.sort_array(F.collect_set(lv))).scalar() for d, lv in ((a, la), (b, lb)))
    own_a, own_b = _cells(a, a_prefix, F.array(la)), _cells(b, b_prefix, F.array(lb))
    up_a = _cells(a.withColumn("_used", used_b), a_prefix, F.filter("_used", lambda v: v < F.col(la))).drop("_used")
    up_b = _cells(b.withColumn("_used", used_a), b_prefix, F.filter("_used", lambda v: v <= F.col(lb))).drop("_used")
    return [(own_a, up_b), (up_a, own_b)], tuple(d.select(F.count(F.lit(1))).scalar() for d in (a, b))


def touching(a: DataFrame, b: DataFrame, a_prefix: str, b_prefix: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Pairs of rows whose boxes (``<prefix>west`` … ``<prefix>north``, degrees) touch,
    each once, with the columns of both.  Rows with a null in their box have no pair.
    Columns that end in ``_id`` deal the rows of a split cell."""
    (one, two), boxes = _posted(a, b, a_prefix, b_prefix)
    pairs = _joined(*one, boxes, part_rows).unionByName(_joined(*two, boxes, part_rows))
    (aw, as_, ae, an), (bw, bs, be, bn) = ([F.col(f"{p}{c}") for c in BOX] for p in (a_prefix, b_prefix))
    w, s, e, n = F.greatest(aw, bw), F.greatest(as_, bs), F.least(ae, be), F.least(an, bn)
    keep = (w <= e) & (s <= n) & (F.floor(w / F.col("_side")) == F.col("_cx")) & (F.floor(s / F.col("_side")) == F.col("_cy"))
    return pairs.where(keep).drop(*KEY, "_side", *PARTS, f"{a_prefix}level", f"{b_prefix}level")


def cell_groups(a: DataFrame, b: DataFrame, a_prefix: str, b_prefix: str, part_rows: int = PART_ROWS) -> DataFrame:
    """The rows of ``touching`` before they are paired: both sides in one table, those to be
    paired with each other (of one ``_cell``) one after another, the rows of ``a`` first (``_of_b`` is false).
    ``touching_rows`` pairs them inside the task that reads them."""
    halves, boxes = _posted(a, b, a_prefix, b_prefix)
    rows = []
    for k, (x, y) in enumerate(halves):
        for of_b, (d, prefix) in enumerate(zip(_sides(x, y, boxes, part_rows), (a_prefix, b_prefix), strict=True)):
            box = [F.col(f"{prefix}{c}").alias(c) for c in BOX]
            rest = [c for c in d.columns if c not in (*KEY, *PARTS, "_side", f"{prefix}level", *[f"{prefix}{c}" for c in BOX])]
            rows.append(d.select(F.xxhash64(F.lit(k), *KEY, *PARTS).alias("_cell"), F.lit(bool(of_b)).alias("_of_b"), side(F.col("_level")).alias("_side"), "_cx", "_cy", *box, *rest))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    n = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartition(n, "_cell").sortWithinPartitions("_cell", "_of_b")


#: Pairs of rows that a task looks at together.
PAIRS = 1 << 15


def touching_rows(a: np.ndarray, b: np.ndarray, cell: tuple[float, int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the rows of ``a`` and ``b`` (boxes, a row each, ``a`` by ascending south) that
    touch and have the south-west corner of their intersection in ``cell`` (side and numbers)."""
    side, cx, cy = cell
    low, high = a[:, 1].searchsorted(b[:, 1] - (a[:, 3] - a[:, 1]).max(initial=0.0) - 1e-6), a[:, 1].searchsorted(b[:, 3], "right")
    n = np.maximum(high - low, 0)
    end = np.cumsum(n)
    aw, as_, ae, an = a.T.copy()
    k = 0
    while k < len(b):
        before = end[k - 1] if k else 0
        m = max(k + 1, int(end.searchsorted(before + PAIRS, "right")))
        j = np.repeat(np.arange(k, m), n[k:m])
        i = np.arange(len(j)) + np.repeat(low[k:m] - (end[k:m] - n[k:m] - before), n[k:m])
        bw, bs, be, bn = (np.repeat(b[k:m, c], n[k:m]) for c in range(4))
        w, s = np.maximum(aw[i], bw), np.maximum(as_[i], bs)
        keep = np.flatnonzero((w <= ae[i]) & (w <= be) & (s <= an[i]) & (s <= bn))
        keep = keep[(np.floor(w[keep] / side) == cx) & (np.floor(s[keep] / side) == cy)]
        if len(keep):
            yield i[keep], j[keep]
        k = m
