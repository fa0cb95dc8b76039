"""Exact set-similarity join on word shingles by T-occurrence search.

Documents with equal shingle sets form a class; only classes are compared.

1. *Short lists.*  Shingles are ordered by rarity (document counts over hash
   buckets, a table of fixed size), and every class posts its rarest
   ``n - ceil(t n) + l`` shingles.  Two sets that reach the similarity share
   ``l`` of these, so merging the short lists finds every candidate.
2. *Stars first.*  In each list, sets of like size are paired with the smallest
   class only; verified links are joined into components.  A group of many
   near copies thus costs a number of pairs linear in its size.
3. *The rest.*  Pairs of a list that are not yet connected are paired as well, so no link
   between components is lost.  Size and bitmap filters thin out both kinds.
4. *Verification.*  Pairs are grouped by query set; a block of at most
   ``BLOCK`` sets forms an inverted index, and DivideSkip answers the query:
   the short lists are merged with a heap, sets whose count can still reach the
   required overlap are looked up in the long lists by binary search.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixtrend.llm import words as W
from pixtrend.llm.components import connected_components
from pixtrend.llm.groups import group_starts, sorted_groups
from pixtrend.llm.scratch import materialise

CLASS = W.WordClass(W.SPACE)
BATCH_BYTES = 1 << 20
#: Buckets of the rarity table (8 bytes each where it is used); fixed, whatever the corpus.
RARITY_BUCKETS = 1 << 20
RARITY_CHUNK = 1 << 12
#: Bits of a set's parity bitmap, as columns of 64.  Copies that just miss the similarity
#: are told apart up to some 3 sets' elements a bit; with fewer bits those of long texts are all paired.
BITS = 1024
SIGNATURE = tuple(f"s{i}" for i in range(BITS // 64))
#: A table of wanted classes up to so many rows (24 bytes each) is broadcast to
#: the scan of the texts; beyond, the texts are shuffled to it.
BROADCAST_ROWS = 1_000_000
#: Sets in one inverted index.
BLOCK = 256
#: DivideSkip's mu: how dear a binary search is against a heap step.
MU = 0.02


class Threshold:
    """Similarity as an exact fraction: Jaccard >= num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    @staticmethod
    def shared(n):
        """How many rare shingles a set of size n must share: grows with the
        set, so that long texts do not meet on a few chance shingles."""
        return 1 + n // 50

    @staticmethod
    def shared_sql(n: str):
        return F.floor(F.col(n) / 50) + 1

    def prefix(self, n):
        """Length of the posted prefix: sets that reach the similarity share
        ``shared(n)`` elements of their prefixes, n the smaller size."""
        return min(n, n - -(-self.num * n // self.den) + self.shared(n))

    def overlap(self, a, b):
        """Smallest intersection of sets of sizes a and b that reaches it."""
        return -(-self.num * (a + b) // (self.num + self.den))


# --------------------------------------------------------------------------- sets
def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer than ``k``
    words has its whole word sequence as the only shingle, one without words none."""
    data, off = W.buffers(texts)
    starts, _, first = W.split_words(data, off, CLASS)
    h = W.hash_words(data, starts, CLASS)
    sh, at = W.shingle_hashes(h, first, k)
    lo = np.searchsorted(at, first)
    out = []
    for i in range(len(first) - 1):
        n = first[i + 1] - first[i]
        if n >= k:
            out.append(np.unique(sh[lo[i]:lo[i + 1]]))
        elif n:
            whole, _ = W.shingle_hashes(h[first[i]:first[i + 1]], np.array([0, n]), int(n))
            out.append(W.mix64(whole + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def class_of(s: np.ndarray) -> int:
    """64-bit id of a set: equal sets have equal ids."""
    return int(W.mix64(W.mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True) + np.uint64(len(s)))[0].astype(np.int64))


def signature(s: np.ndarray) -> list[int]:
    """Parity bitmap: sets at symmetric difference d differ in at most d bits."""
    bits = np.bincount((W.mix64(s) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


SETS = f"doc_id long, rid long, same long, cid long, n long, {', '.join(f'{s} long' for s in SIGNATURE)}, chunk int, counts binary"


def _sets_pass(docs: DataFrame, k: int) -> DataFrame:
    """One row per document (class, size, bitmap) and, behind each task's
    documents, its shingle counts per rarity bucket in chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("same", pa.int64()), ("cid", pa.int64()), ("n", pa.int64()), *[(s, pa.int64()) for s in SIGNATURE],
                            ("chunk", pa.int32()), ("counts", pa.binary())])
        counts = np.zeros(RARITY_BUCKETS, np.uint32)
        for batch in batches:
            for part in W.slices(batch, "text", BATCH_BYTES):
                sets = shingle_sets(part.column(3), k)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                np.add.at(counts, (flat % np.uint64(RARITY_BUCKETS)).astype(np.int64), np.uint32(1))
                rows = [(class_of(s), len(s), *signature(s)) if len(s) else (None, 0, *[0] * len(SIGNATURE)) for s in sets]
                cols = list(zip(*rows, strict=True))
                none = pa.nulls(len(sets))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *[pa.array(c, pa.int64()) for c in cols],
                                                  none.cast(pa.int32()), none.cast(pa.binary())], schema=schema)
        used = [c for c in range(RARITY_BUCKETS // RARITY_CHUNK) if counts[c * RARITY_CHUNK:(c + 1) * RARITY_CHUNK].any()]
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([none] * (5 + len(SIGNATURE)) + [pa.array(used, pa.int32()), pa.array(
            [counts[c * RARITY_CHUNK:(c + 1) * RARITY_CHUNK].tobytes() for c in used], pa.binary())], schema=schema)

    return docs.select("doc_id", "rid", "same", "text").mapInArrow(W.releasing(run), SETS)


def _rarity(sets: DataFrame) -> np.ndarray:
    """Document counts per bucket, summed on the executors; the driver gets the
    fixed-size table."""
    import pandas as pd

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, np.uint32).astype(np.uint64) for b in pdf["counts"])
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "counts": [total.tobytes()]})

    out = np.zeros(RARITY_BUCKETS, np.uint64)
    summed = sets.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInPandas(add, "chunk int, counts binary")
    for r in summed.collect():
        out[r["chunk"] * RARITY_CHUNK:(r["chunk"] + 1) * RARITY_CHUNK] = np.frombuffer(r["counts"], np.uint64)
    return np.minimum(out, np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _prefix_pass(docs: DataFrame, k: int, t: Threshold, rarity: np.ndarray) -> DataFrame:
    """(shingle, class, size) for the rarest shingles of every class; a class is
    posted once per batch however many copies it has."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for part in W.slices(batch, "text", BATCH_BYTES):
                g, cid, n = [], [], []
                for s in shingle_sets(part.column(0), k):
                    if not len(s) or (c := class_of(s)) in seen:
                        continue
                    seen.add(c)
                    p = t.prefix(len(s))
                    count = shared.value[(s % np.uint64(RARITY_BUCKETS)).astype(np.int64)]
                    rarest = np.lexsort((s, count))[:p]
                    g.append(s[rarest])
                    cid.append(np.full(p, c, np.int64))
                    n.append(np.full(p, len(s), np.int64))
                if g:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(g).view(np.int64)), pa.array(np.concatenate(cid)),
                                                      pa.array(np.concatenate(n))], names=["g", "cid", "n"])

    return docs.select("text").mapInArrow(W.releasing(run), "g long, cid long, n long")


# --------------------------------------------------------------------------- DivideSkip
def divide_skip(query: np.ndarray, sets: list[np.ndarray], need: list[int]) -> list[int]:
    """Numbers of the ``sets`` that share at least ``need[i]`` elements with ``query``."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = np.minimum(np.searchsorted(query, flat), len(query) - 1)
    hit = query[at] == flat
    order = np.argsort(at[hit], kind="stable")  # owners stay ascending inside a list
    members, element = owner[hit][order].tolist(), at[hit][order]
    cut = np.flatnonzero(np.diff(element, prepend=-1)).tolist() + [len(members)]
    lists = sorted((members[i:j] for i, j in zip(cut, cut[1:], strict=False)), key=len)
    if not lists:
        return []
    least = max(1, min(need))
    n_long = min(int(least / (MU * log2(max(2, len(lists[-1]))) + 1)), least - 1, len(lists))
    short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
    found = []
    for i, same in groupby(heapq.merge(*short)):
        have, left = sum(1 for _ in same), len(long)
        for ids in long:
            if have >= need[i] or have + left < need[i]:
                break
            left -= 1
            k = bisect_left(ids, i)
            have += k < len(ids) and ids[k] == i
        if have >= need[i]:
            found.append(i)
    return found


def _verify(pairs: DataFrame, texts: DataFrame, k: int, t: Threshold) -> DataFrame:
    """The ``(q, x)`` of ``pairs`` whose sets reach the similarity.

    Sets travel as texts (smaller than their hashes).  A query with many
    partners is answered in blocks, each with its own copy of the query."""
    blocks = pairs.groupBy("q").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = pairs.join(blocks, "q").select("q", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int").alias("block"), "x")
    queries = blocks.select("q", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("q").alias("x"))
    rows = members.unionByName(queries).join(texts, F.col("x") == F.col("cid")).select("q", "block", "x", "text")
    rows = rows.repartition("q", "block").sortWithinPartitions("q", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in sorted_groups(batches, ["q", "block"]):
            sets = [s for b in block.to_batches() for part in W.slices(b, "text", BATCH_BYTES) for s in shingle_sets(part.column(3), k)]
            q, x = block.column("q").to_numpy(), block.column("x").to_numpy()
            starts = [*group_starts(block, ["q", "block"]).tolist(), len(q)]
            left, right = [], []
            for i, j in zip(starts, starts[1:], strict=False):
                own = next(r for r in range(i, j) if x[r] == q[i])
                rest = [r for r in range(i, j) if r != own]
                if rest:
                    need = [t.overlap(len(sets[own]), len(sets[r])) for r in rest]
                    good = divide_skip(sets[own], [sets[r] for r in rest], need)
                    left += [int(q[i])] * len(good)
                    right += [int(x[rest[g]]) for g in good]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["q", "x"])

    return rows.mapInArrow(W.releasing(run), "q long, x long")


def may_reach(t: Threshold, a: str, b: str):
    """Size and bitmap filters: false only for pairs that cannot reach ``t``."""
    c = lambda side, name: F.col(f"{side}.{name}")
    differ = sum((F.bit_count(c(a, s).bitwiseXOR(c(b, s))) for s in SIGNATURE), F.lit(0))
    return ((F.least(c(a, "n"), c(b, "n")) * t.den >= F.greatest(c(a, "n"), c(b, "n")) * t.num)
            & (differ * (t.num + t.den) <= (c(a, "n") + c(b, "n")) * (t.den - t.num)))


# --------------------------------------------------------------------------- operator
def similar_groups(docs: DataFrame, k: int = 3, similarity: tuple[int, int] = (9, 10), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest key reachable by links (Jaccard of the
    distinct ``k``-word shingle sets at or above ``similarity``), the row's own
    key included.  Null, empty and wordless texts have 0 shingles and no link.
    Null keys are never the smallest unless all are null; rows that repeat a key
    are each returned; other columns are ignored.  Elements are 64-bit hashes.
    """
    t = Threshold(*similarity)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    same = F.xxhash64("text")  # with the key, finds a text again
    docs = docs.select("doc_id", F.coalesce("doc_id", same).alias("rid"), same.alias("same"), "text")
    sets = materialise(_sets_pass(docs, k), "shingle-sets")
    per_doc = sets.where("chunk is null").drop("chunk", "counts")
    per_class = per_doc.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("first"), F.min(F.struct("rid", "same")).alias("at"), F.first("n").alias("n"), *[F.first(s).alias(s) for s in SIGNATURE])

    # every list with at least two classes
    w = Window.partitionBy("g")
    posted = _prefix_pass(docs, k, t, _rarity(sets))
    lists = materialise(posted.withColumns({"lo": F.min("cid").over(w), "hi": F.max("cid").over(w)})
                        .where("lo < hi").select("g", "cid", "n").distinct(), "short-lists")

    def texts(pairs: DataFrame) -> DataFrame:
        """(class, text) of the classes in ``pairs``, one text each."""
        paired = pairs.select(F.col("q").alias("cid")).union(pairs.select("x")).distinct()
        wanted = materialise(per_class.select("cid", "at.rid", "at.same").join(paired, "cid"), "wanted")
        if wanted.count() <= BROADCAST_ROWS:
            wanted = F.broadcast(wanted)
        found = docs.select("rid", "same", "text").join(wanted, ["rid", "same"])
        return found.groupBy("cid").agg(F.max("text").alias("text"))  # repeated rows only

    # stars: sets of like size against the smallest class of their list
    step = float(np.log(t.den / t.num))
    sized = lists.withColumn("size", F.floor(F.log("n") / F.lit(step)))
    centre = sized.groupBy("g", "size").agg(F.min("cid").alias("q"))
    # a pair with few shared shingles here may share more in lists of another centre; it is left to the rest
    star = (sized.join(centre, ["g", "size"]).where("cid <> q").groupBy("q", F.col("cid").alias("x"))
            .agg(F.count(F.lit(1)).alias("lists"), F.min("n").alias("n")).where(F.col("lists") >= t.shared_sql("n")).select("q", "x"))
    about = per_class.select("cid", "n", *SIGNATURE)
    star = materialise(star.join(about.alias("a"), F.col("q") == F.col("a.cid")).join(about.alias("b"), F.col("x") == F.col("b.cid"))
                       .where(may_reach(t, "a", "b")).select("q", "x"), "star-pairs")
    linked = materialise(_verify(star, texts(star), k, t), "star-links")
    comp = connected_components(linked, "q", "x")

    # the rest: pairs of a list in different components
    marked = lists.join(comp.withColumnRenamed("v", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    open_lists = marked.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("g")
    # bitmaps join the open lists alone
    marked = materialise(materialise(marked.join(open_lists, "g"), "open-lists").join(per_class.drop("first", "at", "n"), "cid"), "open-bitmaps")
    a, b = marked.alias("a"), marked.alias("b")
    fits = (F.col("a.cid") < F.col("b.cid")) & (F.col("a.root") != F.col("b.root")) & may_reach(t, "a", "b")
    rest = (a.join(b, (F.col("a.g") == F.col("b.g")) & fits)
            .groupBy(F.col("a.cid").alias("q"), F.col("b.cid").alias("x"))
            .agg(F.count(F.lit(1)).alias("lists"), F.min(F.least("a.n", "b.n")).alias("n")).where(F.col("lists") >= t.shared_sql("n")).select("q", "x"))
    rest = materialise(rest.join(star, ["q", "x"], "left_anti").join(star.select(F.col("q").alias("x"), F.col("x").alias("q")), ["q", "x"], "left_anti"), "other-pairs")
    more = materialise(_verify(rest, texts(rest), k, t), "other-links")

    roots = connected_components(linked.unionByName(more), "q", "x").withColumnRenamed("v", "cid")
    small = (per_class.select("cid", "first").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    least = small.groupBy("root").agg(F.min("first").alias("component_id"))
    named = small.join(least, "root").select("cid", "component_id")
    return (per_doc.select("doc_id", F.col("n").alias("n_shingles"), "cid").join(named, "cid", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
