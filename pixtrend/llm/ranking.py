"""Positions inside groups of any size, and joins with hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixtrend.llm.scratch import materialise

#: A key that holds more than this share of the rows is hot: no more than
#: ``HOT_PARTS`` keys can be, so their side of a join may be broadcast.
HOT_PARTS = 1000


def numbered(df: DataFrame, group: str, order: Sequence[str], pos: str = "pos") -> DataFrame:
    """``df`` with the row's position, from 0, in its ``group`` by ``order``
    (nulls first; rows equal in all of it in any order).

    Rows are dealt by ranges of (group, order), so a group of any size is cut
    into as many tasks as it needs; a row's position is the one in its range
    plus the rows of its group in the ranges before.  Only the group in which a
    range begins has such rows, so there is one offset a range at most.
    ``group`` must not be null.
    """
    rows = materialise(df.withColumn("_uid", F.monotonically_increasing_id()), "numbered-rows")
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_uid")]
    ranged = materialise(rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "numbered-ranges")
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
               .select(group, "_range", F.sum("_n").over(before).alias("_before")).where("_before > 0"))
    inside = Window.partitionBy(group, "_range").orderBy(*keys)
    return (ranged.withColumn("_row", F.row_number().over(inside).cast("long") - 1)
            .join(F.broadcast(offsets), [group, "_range"], "left")  # a row for each range at most
            .withColumn(pos, F.col("_row") + F.coalesce("_before", F.lit(0)))
            .drop("_uid", "_range", "_row", "_before"))


def left_join_skewed(rows: DataFrame, keyed: DataFrame, keys: Sequence[str], size: Column) -> DataFrame:
    """``rows`` left-joined with ``keyed`` (one row a key), where one key may
    hold a large share of ``rows``.

    ``size`` is a column of ``keyed``: no less than the rows that have the key.
    Keys of more than 1/``HOT_PARTS`` of all rows are few, whatever the data,
    and are broadcast; the other rows meet in a shuffle in which no key is
    large.  Both tables are read several times, so they should be written ones.
    """
    total = keyed.agg(F.sum(size)).first()[0] or 0
    limit = max(1, total // HOT_PARTS)
    hot = keyed.where(size > limit)
    value = [c for c in keyed.columns if c not in keys]
    near = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), list(keys), "left")
    done = near.where("_hot").drop("_hot")
    rest = near.where("_hot is null").drop("_hot", *value)
    return done.unionByName(rest.join(keyed.where(size <= limit), list(keys), "left"))
