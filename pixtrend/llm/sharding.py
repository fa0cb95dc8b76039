"""Sharding by rendezvous (highest-random-weight) hashing.

Every (key, shard) pair gets a pseudo-random score; a record goes to the shard
with the highest score.  The decision needs nothing but the key and the shard
list, so it is a pure projection (no shuffle), any executor repeats it after a
loss, and adding a shard moves only the records whose new score wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of md5 used for a score: 48 bits, exact in a double.
SCORE_DIGITS = 12


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard index for ``key`` among ``len(weights)`` weighted shards.

    Score of shard i: ``-ln(u_i) / w_i`` with ``u_i`` uniform in (0, 1) from
    md5(key '#' i); the smallest wins, which gives shard i a share of
    ``w_i / sum(w)``.  Ties go to the smaller index.  A null key counts as the
    empty key.  Weights must be positive.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    k = F.coalesce(key.cast("string"), F.lit(""))

    def score(i: int, w: float) -> Column:
        d = F.conv(F.substring(F.md5(F.concat(k, F.lit(f"#{i}"))), 1, SCORE_DIGITS), 16, 10).cast("double")
        return -F.log((d + 0.5) / float(16 ** SCORE_DIGITS)) / F.lit(float(w))

    best = F.array_min(F.array(*[F.struct(score(i, w).alias("score"), F.lit(i).alias("shard"))
                                 for i, w in enumerate(weights)]))
    return best["shard"]


def number_slots(df: DataFrame, shard: str, order: Sequence[str], buckets: int = 1024, slot: str = "slot") -> DataFrame:
    """Gapless positions 0.. inside each shard without gathering a shard.

    Rows fall into ``buckets`` hash buckets of the order columns per shard; the
    bucket counts (``shards * buckets`` rows, bounded by the parameters) give
    each bucket's offset, and rows are numbered inside their small bucket.
    Equal rows are counted first and unfolded afterwards, so a row repeated
    any number of times never fills a task.  Returns ``shard``, the order
    columns and ``slot``; the order is (bucket, order columns), nulls first.
    """
    keys = [shard, "_bucket", *order]
    counted = (df.select(shard, *order)
               .withColumn("_bucket", F.pmod(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]),
                                             F.lit(buckets)).cast("int"))
               .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    sizes = counted.groupBy(shard, "_bucket").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(shard, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = (counted.withColumn("_at", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
             .join(F.broadcast(offsets), [shard, "_bucket"]))  # at most shards * buckets rows
    return first.select(shard, *order, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("_k"),
                        (F.col("_offset") + F.col("_at")).alias("_base")) \
        .select(shard, *order, (F.col("_base") + F.col("_k")).cast("long").alias(slot))


def shard_documents(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Manifest of ``docs`` over weighted shards: key, size (UTF-8 bytes plus 1),
    CRC-32 of the text, shard, slot inside the shard, and the shard after one
    more shard of the mean weight is added.

    Null text counts as empty; null keys are the empty key; repeated rows each
    get a slot of their own; other columns are ignored; an empty table gives an
    empty manifest.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    grown = [*weights, sum(weights) / len(weights)]
    rows = docs.select(F.col(key), (F.length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
                       rendezvous_shard(F.col(key), weights).alias("shard"))
    out = number_slots(rows, "shard", [key, "size", "text_crc32"])
    return out.withColumn("grown_shard", rendezvous_shard(F.col(key), grown))
