"""Scenes released as soon as all their layers have come, by stateful streaming.

The batch rule (``quality.complete_scenes``) needs every layer on storage before
it is asked.  Here layers are rows of a stream, in any order, repeated or late;
the state of a scene is one row: when each of its layers first came, and whether
it was released.  A scene is reported once when it is
complete, and once, by a timer on the event time, when it is not complete in time.
State is dropped ``keep`` after that, so it grows with the scenes under
way, not with the archive.

Scenes are dealt over ``BUCKETS`` groups by a hash of their key.  A group's state is a table of
its scenes, and a batch brings all of them up to date at once, so a batch costs by the rows
and the groups, not a call of Python for every scene.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pixtrend.constants import BANDS

LAYERS = (*BANDS, "scl")
#: What a report can say, in the order in which a scene goes through them.
STATUSES = ("incomplete", "late", "complete")
STATE = "scenes binary"
NEVER = -1 << 62
#: Groups of scenes; fixed for the life of a checkpoint.
BUCKETS = 512


def release_complete(arrivals: DataFrame, wait_s: int, keep_s: int, layers=LAYERS, key: str = "scene_id",
                     layer: str = "band", ts: str = "ts", delay: str = "1 minute", buckets: int = BUCKETS) -> DataFrame:
    """Reports ``(key, status, n_layers, missing, at)`` of a stream of ``(key, layer, ts)`` rows.

    ``complete``: the last missing layer came at most ``wait_s`` seconds after the
    first; ``late``: after that; ``incomplete``: the watermark has passed that time and
    layers had not come by then (listed in ``missing``).  An incomplete scene whose layers come
    within another ``keep_s`` seconds is reported again as ``late``, so the last status of a scene does not
    depend on how its rows fall into batches.  ``at`` is when the
    deciding layer came, or the deadline.

    Repeated layers count once.  Rows of other layers (or null) only move the clock;
    rows without key or time are left out.  ``delay``: Spark drops rows that lie
    so far (or farther) behind the newest row of the batches before, and timers wait as
    long; where files carry times of their own, give the longest way they may take."""
    names = list(layers)
    wait, keep = wait_s * 1000, keep_s * 1000
    kind = dict(arrivals.dtypes)[key]
    out = f"{key} {kind}, status string, n_layers int, missing string, at timestamp"
    columns = [f"t{i}" for i in range(len(names))]

    def stored(scenes: pd.DataFrame) -> tuple[bytes]:
        table = pa.Table.from_pandas(scenes.reset_index(drop=True), preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as w:
            w.write_table(table)
        return (sink.getvalue().to_pybytes(),)

    def reported(scenes: pd.DataFrame, status, until: np.ndarray, at: np.ndarray) -> pd.DataFrame:
        times = scenes[columns].to_numpy()
        gone = (times == NEVER) | (times > until[:, None])
        missing = [",".join(b for b, g in zip(names, row, strict=True) if g) for row in gone.tolist()]
        return pd.DataFrame({key: scenes[key].array, "status": status, "n_layers": len(names) - gone.sum(axis=1), "missing": missing,
                             "at": pd.to_datetime(at, unit="ms")})

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        clock = state.getCurrentWatermarkMs()
        scenes = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else None
        rows = pd.concat(list(frames)) if not state.hasTimedOut else pd.DataFrame(columns=[key, "layer"])
        asked, rows = rows[key], rows[rows["layer"].notna()]
        if len(rows):
            now = rows.groupby([key, "layer"], sort=False)["ms"].min().unstack("layer").reindex(columns=names).fillna(NEVER)
            now = now.astype("int64").set_axis(columns, axis=1).reset_index()
            if scenes is not None:  # those that are known already: the earlier time of each layer
                both = pd.concat([scenes[[key, *columns]], now])
                both[columns] = both[columns].where(both[columns] != NEVER, -NEVER)
                first = both.groupby(key, sort=False)[columns].min()
                times = first.where(first != -NEVER, NEVER).reset_index()
                scenes = times.merge(scenes.drop(columns=columns), on=key, how="left")
            else:
                scenes = now.assign(done=None, told=None, timer=np.nan)
            scenes = scenes.assign(**{c: scenes[c].eq(True) for c in ("done", "told")}, timer=scenes["timer"].fillna(NEVER).astype("int64"))
        if scenes is None:
            return
        fresh = scenes[key].isin(asked).to_numpy()
        times = scenes[columns].to_numpy()
        due, newest = np.where(times == NEVER, -NEVER, times).min(axis=1) + wait, times.max(axis=1)
        done, told, timer = (scenes[c].to_numpy(copy=True) for c in ("done", "told", "timer"))
        # as a stream of one scene each: a scene with new rows is asked for its layers, any other for its time
        over = ~fresh & (timer < clock)
        drop, late = over & (done | told), over & ~(done | told)
        whole = fresh & (times != NEVER).all(axis=1) & ~done
        if late.any():
            yield reported(scenes[late], "incomplete", due[late], due[late])
        if whole.any():
            yield reported(scenes[whole], np.where((newest <= due) & ~told, "complete", "late")[whole], newest[whole], newest[whole])
        told, done = told | late, done | whole
        timer = np.where(fresh | late, np.maximum(due + np.where(done | told, keep, 0), clock + 1), timer)
        if drop.all():
            state.remove()
            return
        state.update(stored(scenes.assign(done=done, told=told, timer=timer)[~drop]))
        state.setTimeoutTimestamp(max(int(timer[~drop].min()), clock + 1))

    known = F.when(F.col(layer).isin(names), F.col(layer))
    rows = (arrivals.select(F.col(key), known.alias("layer"), F.col(ts).cast("timestamp").alias("ts"))
            .withWatermark("ts", delay)
            .select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket"), key, "layer", "ts", F.unix_millis("ts").alias("ms")))
    return rows.filter(F.col(key).isNotNull() & F.col("ts").isNotNull()).groupBy("_bucket").applyInPandasWithState(
        step, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def release_scenes_stream(spark: SparkSession, src: str, dst: str, checkpoint: str, schema, wait_s: int, keep_s: int, **how) -> None:
    """Read the arrivals that are new under ``src`` and append the reports to ``dst``
    (Parquet; with ``checkpoint`` each report is written exactly once)."""
    arrivals = spark.readStream.schema(schema).parquet(src)
    query = (release_complete(arrivals, wait_s, keep_s, **how).writeStream.format("parquet").outputMode("append")
             .option("path", dst).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def last_status(reports: DataFrame, key: str = "scene_id") -> DataFrame:
    """One row a scene: its last report."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status"))
    cols = [c for c in reports.columns if c != key]
    return reports.groupBy(key).agg(F.max_by(F.struct(*cols), rank).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def status_of_all(arrivals: DataFrame, wait_s: int, layers=LAYERS, key: str = "scene_id", layer: str = "band", ts: str = "ts") -> DataFrame:
    """The last status of every scene from all arrivals at once: the same columns without a stream."""
    per = arrivals.filter(F.col(layer).isin(list(layers)) & F.col(key).isNotNull() & F.col(ts).isNotNull()) \
        .groupBy(key, layer).agg(F.min(F.col(ts).cast("timestamp")).alias("_t"))
    first = F.min("_t").over(Window.partitionBy(key))      # at most one row a layer
    due = F.timestamp_millis(F.unix_millis("_a") + wait_s * 1000)
    g = per.withColumn("_a", first).groupBy(key, "_a").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_t").alias("_b"), F.collect_set(F.when(F.col("_t") <= due, F.col(layer))).alias("_have"))
    whole = F.col("_n") == len(layers)
    status = F.when(~whole, "incomplete").when(F.col("_b") <= due, "complete").otherwise("late")
    missing = F.filter(F.array(*[F.lit(b) for b in layers]), lambda b: ~whole & ~F.array_contains("_have", b))
    return g.select(key, status.alias("status"), (F.lit(len(layers)) - F.size(missing)).cast("int").alias("n_layers"),
                    F.array_join(missing, ",").alias("missing"), F.when(whole, F.col("_b")).otherwise(due).alias("at"))
