"""Nearest neighbours by multi-index hashing of learned binary codes.

Vectors are centred, turned by rotations learned for small quantisation loss
(alternating sign codes and orthogonal Procrustes), and cut to their signs.
A code is split into substrings; each has its own table from substring value to
rows.  By the pigeonhole principle a code within radius ``r`` has a substring
within ``r // m`` (less one for all but the first ``r % m + 1``), so probing
those buckets retrieves every code within the radius; the survivors are ranked
by their exact Euclidean distance.  The radius comes from exact neighbours of
a small set of queries over all rows, and grows for a query that finds too few.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixtrend.llm import words as W
from pixtrend.llm.scratch import materialise

BITS = 256
SUB_BITS = 16
#: Rows that the rotations are fitted on, and queries whose exact neighbours set the radius.
FIT_ROWS = 20_000
RADIUS_QUERIES = 64
#: Share of exact neighbours that the radius must hold.
RADIUS_RECALL = 0.985
#: Rows of one index shard, and queries sent to all shards at once.
SHARD_ROWS = 16_384
QUERY_BLOCK = 2_048

POP16 = np.bitwise_count(np.arange(1 << SUB_BITS, dtype=np.uint16))
BY_WEIGHT = np.argsort(POP16, kind="stable").astype(np.uint16)  # all masks, lightest first
BALL = [sum(comb(SUB_BITS, i) for i in range(a + 1)) for a in range(SUB_BITS + 1)]


class Codes:
    """Learned rotations and their sign codes."""

    def __init__(self, sample: np.ndarray, bits: int = BITS, rounds: int = 30, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.centre = sample.mean(0)
        y = sample - self.centre
        width = min(y.shape[1], 64)
        _, _, axes = np.linalg.svd(y, full_matrices=False) if len(y) >= width else (0, 0, np.eye(y.shape[1]))
        y = y @ axes[:width].T
        turns = []
        for _ in range(-(-bits // width)):
            r = np.linalg.qr(rng.normal(size=(width, width)))[0]
            for _ in range(rounds):
                u, _, vt = np.linalg.svd(np.where(y @ r >= 0, 1.0, -1.0).T @ y)
                r = (u @ vt).T
            turns.append(axes[:width].T @ r)
        self.turn = np.concatenate(turns, 1)[:, :bits]

    def of(self, x: np.ndarray) -> np.ndarray:
        """Packed codes, one row of 16-bit substrings per vector."""
        return np.packbits((x - self.centre) @ self.turn >= 0, axis=1, bitorder="little").view(np.uint16)


class Tables:
    """The substring tables of one shard."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.wide = np.ascontiguousarray(codes).view(np.uint64)
        self.rows, self.keys, self.at = [], [], []
        for t in range(codes.shape[1]):
            order = np.argsort(codes[:, t], kind="stable")
            keys, first = np.unique(codes[order, t], return_index=True)
            self.rows.append(order)
            self.keys.append(keys)
            self.at.append(np.append(first, len(order)))

    def within(self, q: np.ndarray, r: int) -> np.ndarray:
        """Rows whose code is within Hamming distance ``r`` of ``q``."""
        m = len(q)
        mark = np.zeros(len(self.codes), bool)
        for t in range(m):
            a = min(r // m - (t > r % m), SUB_BITS)
            if a < 0:
                continue
            keys = self.keys[t]
            if BALL[a] < len(keys):  # probe the ball's values
                want = q[t] ^ BY_WEIGHT[:BALL[a]]
                k = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                k = k[keys[k] == want]
            else:  # fewer buckets than values in the ball: test the buckets
                k = np.flatnonzero(POP16[keys ^ q[t]] <= a)
            first, size = self.at[t][k], self.at[t][k + 1] - self.at[t][k]
            ends = np.cumsum(size)
            if len(ends):
                mark[self.rows[t][np.arange(ends[-1]) + np.repeat(first - ends + size, size)]] = True
        rows = np.flatnonzero(mark)
        far = np.bitwise_count(self.wide[rows] ^ np.ascontiguousarray(q).view(np.uint64)).sum(1)
        return rows[far <= r]


def nearest(ids: np.ndarray, x: np.ndarray, rows: np.ndarray, own: int, q: np.ndarray, k: int):
    """The ``k`` nearest ids of ``rows`` by (distance, id), without the query's
    own; an id that several rows have stands with its nearest."""
    rows = rows[ids[rows] != own]
    d = np.sqrt(((x[rows] - q) ** 2).sum(1))
    if len(rows) > 4 * k:
        near = d <= np.partition(d, k - 1)[k - 1]
        if len(np.unique(ids[rows[near]])) >= k:
            rows, d = rows[near], d[near]
    order = np.lexsort((ids[rows], d))
    order = order[np.sort(np.unique(ids[rows[order]], return_index=True)[1])[:k]]
    return ids[rows[order]], d[order]


def usable_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): rows with an id and a finite vector that is not zero."""
    v = F.col(vector).cast("array<double>")
    ok = (F.col(key).isNotNull() & v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
          & F.exists(v, lambda c: c != 0))
    return df.where(ok).select(F.col(key).cast("long").alias("vec_id"), v.alias("v"))


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _exact(df: DataFrame, queries: tuple[np.ndarray, np.ndarray], k: int) -> DataFrame:
    """Exact neighbours of a few broadcast queries, by brute force over all rows."""
    shared = df.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            out = [(own, i, d) for own, q in zip(*shared.value, strict=True)
                   for i, d in zip(*nearest(ids, x, np.arange(len(ids)), own, q, k), strict=True)] if len(ids) else []
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                                             names=["query_id", "vec_id", "score"])

    return _best(df.select("vec_id", "v").mapInArrow(W.releasing(run), "query_id long, vec_id long, score double"), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(df: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding", report: dict | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for every
    row that ``is_query`` selects, nearest first, ties to the smaller id.

    Every other row is a candidate and stands in the index, equal ones once.  A
    neighbour is an id: one that several rows have takes one of the ``k`` places,
    with the score of its nearest row.  Rows without an
    id, and vectors that are null, zero, of unusual length or hold null or
    non-finite components, take no part.  Rows that repeat an id are one query,
    and no candidate of it.  Other columns are ignored; an empty table gives no
    rows.  ``report`` receives the radius and its sample recall."""
    spark = df.sparkSession
    all_rows = usable_vectors(df, key, vector)
    common = all_rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    all_rows = all_rows.where(F.size("v") == common["n"])
    order = F.xxhash64("vec_id")
    sample = all_rows.orderBy(order).limit(FIT_ROWS).select("v").toArrow().column(0).combine_chunks()
    codes = Codes(_matrix(sample))
    queries = all_rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = materialise(queries, "queries")

    # the radius that holds the exact neighbours of some queries over all rows
    some = queries.orderBy(order).limit(RADIUS_QUERIES).collect()
    if not some:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    probe = (np.array([r["vec_id"] for r in some]), np.array([r["v"] for r in some], np.float64))
    truth = _exact(all_rows, probe, k).select("query_id", F.col("vec_id")).join(all_rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vec_id").collect()
    at = {int(i): n for n, i in enumerate(probe[0])}
    own = codes.of(probe[1]).view(np.uint64)
    far = (np.bitwise_count(codes.of(np.array([r["v"] for r in truth], np.float64)).view(np.uint64) ^ own[[at[r["query_id"]] for r in truth]]).sum(1)
           if truth else np.zeros(1))
    radius = int(np.quantile(far, RADIUS_RECALL))
    if report is not None:
        report |= {"radius": radius, "bits": codes.turn.shape[1], "sample_recall": float((far <= radius).mean())}

    shared = spark.sparkContext.broadcast(codes)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), _matrix(b.column(1))) for b in batches if b.num_rows]
        if parts:
            ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (ids, x, shared.value.of(x))], names=["ids", "vectors", "codes"])

    shards = -(-all_rows.count() // SHARD_ROWS)
    index = materialise(all_rows.distinct().repartition(shards, "vec_id", "v").mapInArrow(W.releasing(build), "ids binary, vectors binary, codes binary"), "index")

    blocks = -(-queries.count() // QUERY_BLOCK)
    found = None
    for b in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("vec_id", F.lit(b"block")), F.lit(blocks)) == b).collect()  # about QUERY_BLOCK rows
        if not rows:
            continue
        block = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in rows]), np.array([r["v"] for r in rows], np.float64)))

        def look(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            qid, qv = block.value
            qc = shared.value.of(qv)
            for batch in batches:
                for n in range(batch.num_rows):
                    ids, x, c = (np.frombuffer(batch.column(i)[n].as_buffer(), t) for i, t in enumerate((np.int64, np.float64, np.uint16)))
                    x, tables = x.reshape(len(ids), -1), Tables(c.reshape(len(ids), -1))
                    single = len(np.unique(ids))
                    out: list[tuple] = []
                    for own, q, code in zip(qid, qv, qc, strict=True):
                        r = radius
                        near = tables.within(code, r)
                        while (len(near) if single == len(ids) else len(np.unique(ids[near]))) < min(k + 1, single):  # too few here: widen
                            r += SUB_BITS
                            near = tables.within(code, r)
                        out += [(own, i, d) for i, d in zip(*nearest(ids, x, near, own, q, k), strict=True)]
                    cols = list(zip(*out, strict=True)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                                                     names=["query_id", "vec_id", "score"])

        part = index.mapInArrow(W.releasing(look), "query_id long, vec_id long, score double")
        found = part if found is None else found.unionByName(part)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
