"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of documents inside one scan partition (bounded by
``SHARD_BYTES``), so building and searching need no shuffle.  Per shard:

1. words become ids of the benchmark's vocabulary; every run of words outside
   it collapses into one separator, as does each document's end (no test phrase
   can cross either, so nothing is lost),
2. a suffix array by prefix doubling, the Burrows-Wheeler transform, and a
   wavelet matrix over it answering ``rank`` and ``access``,
3. all test phrases step backwards through the index together (numpy vectors
   over phrases),
4. their rows are located by walking to sampled suffix positions,
5. overlapping and touching hits are merged into removal spans per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixtrend.llm import words as W

CLASS = W.WordClass(W.NON_ALNUM)
WINDOW = 10
#: Bytes of text in one shard; its index takes about ten times that while it is built.
SHARD_BYTES = 2 << 20
#: Bytes of benchmark text that one broadcast block may hold; a larger
#: benchmark is searched in several blocks.
BLOCK_BYTES = 32 << 20
SAMPLE = 16
HIT_COLUMNS = ("n_words", "n_hit", "hit_words", "items", "clean_text")


# --------------------------------------------------------------------------- phrases
class Phrases:
    """Windows of the benchmark items as rows of vocabulary ids (1..), padded with 0."""

    def __init__(self, item_ids: list, texts: list, window: int = WINDOW):
        data, off = W.buffers(pa.array(texts, pa.large_string()))
        starts, _, first = W.split_words(data, off, CLASS)
        h = W.hash_words(data, starts, CLASS)
        self.vocab = np.unique(h)
        ids = np.searchsorted(self.vocab, h).astype(np.int64) + 1
        rows, owner = [], []
        for k, item in enumerate(item_ids):
            seq = ids[first[k]:first[k + 1]]
            if len(seq):
                m = min(window, len(seq))
                view = np.lib.stride_tricks.sliding_window_view(seq, m)
                rows.append(np.pad(view, ((0, 0), (window - m, 0))))  # left-padded: the last word is last
                owner += [item] * len(view)
        block = np.concatenate(rows) if rows else np.zeros((0, window), np.int64)
        self.rows, self.of = np.unique(block, axis=0, return_inverse=True) if len(block) else (block, np.zeros(0, np.int64))
        self.length = (self.rows > 0).sum(1)
        # items of each distinct window, as one flat list with offsets
        order = np.argsort(self.of, kind="stable")
        self.owner = [owner[i] for i in order]
        self.owner_at = np.searchsorted(np.asarray(self.of)[order], np.arange(len(self.rows) + 1))


# --------------------------------------------------------------------------- index
def suffix_array(sym: np.ndarray) -> np.ndarray:
    """Suffix array of ``sym`` (0 = separator, each smaller than any word and
    ordered by position; the last symbol must be 0), by prefix doubling that
    sorts only suffixes not yet told apart."""
    n = len(sym)
    sep = sym == 0
    n_sep = int(sep.sum())
    rank = np.where(sep, np.cumsum(sep) - 1, sym + n_sep).astype(np.int64)
    ahead = lambda a, h: np.concatenate([a[h:], np.zeros(min(h, n), np.int64)])[:n]
    top = int(rank.max()) + 1
    if top < 1 << 21:
        key, h = (rank << 42) | (ahead(rank, 1) << 21) | ahead(rank, 2), 3
    else:
        key, h = (rank << 32) | ahead(rank, 1), 2
    # a separator is unique by itself: what follows it must not matter
    key = np.where(sep, rank << (42 if h == 3 else 32), key)
    sa = np.argsort(key)
    slots, key = np.arange(n), key[sa]
    rank = np.empty(n, np.int64)
    while True:
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        start = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[sa[slots]] = start
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots = slots[~alone]
        if not len(slots):
            return sa
        at = sa[slots]
        key = (rank[at] << 32) | rank[np.minimum(at + h, n - 1)]
        order = np.argsort(key)
        sa[slots], key = at[order], key[order]
        h *= 2


class WaveletMatrix:
    """Bit planes of a symbol sequence with block counts: rank and access in
    one pass over the planes, vectorised over positions."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.n, self.planes = len(seq), []
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            b = (seq >> bit) & 1
            packed = np.packbits(b.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            zeros = self.n - int(b.sum())
            self.planes.append((bit, packed, ones, zeros))
            seq = np.concatenate([seq[b == 0], seq[b == 1]])

    @staticmethod
    def _ones(packed, ones, i):
        word, low = i >> 6, (i & 63).astype(np.uint64)
        return ones[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << low) - np.uint64(1)))

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol ``c`` occurs before position ``i``."""
        lo, hi = np.zeros_like(i), i
        for bit, packed, ones, zeros in self.planes:
            one = ((c >> bit) & 1).astype(bool)
            a, b = self._ones(packed, ones, lo), self._ones(packed, ones, hi)
            lo, hi = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b)
        return hi - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros_like(i)
        for bit, packed, ones, zeros in self.planes:
            one = ((packed[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            a = self._ones(packed, ones, i)
            c |= one.astype(np.int64) << bit
            i = np.where(one, zeros + a, i - a)
        return c


class FMIndex:
    """FM-index of a symbol sequence that ends with a separator (0)."""

    def __init__(self, sym: np.ndarray, sigma: int, sample: int = SAMPLE):
        n = len(sym)
        sa = suffix_array(sym)
        bwt = sym[sa - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(sym, minlength=sigma))]).astype(np.int64)
        self.wavelet = WaveletMatrix(bwt, sigma)
        # walks never step over a separator: rows whose preceding symbol is one are sampled too
        kept = (sa % sample == 0) | (bwt == 0)
        self.kept = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
        self.samples = sa[kept]
        self.n = n

    def ranges(self, rows: np.ndarray):
        """Suffix-array ranges of left-padded phrases, all stepping together."""
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), self.n, np.int64)
        live = np.arange(len(rows))
        for j in range(rows.shape[1] - 1, -1, -1):
            step = live[rows[live, j] > 0]
            c = rows[step, j]
            lo[step] = self.before[c] + self.wavelet.rank(c, lo[step])
            hi[step] = self.before[c] + self.wavelet.rank(c, hi[step])
            live = live[lo[live] < hi[live]]
        found = np.zeros(len(rows), bool)
        found[live] = True
        hi[~found] = lo[~found]
        return lo, hi

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text position of each suffix-array row."""
        pos, steps, row = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64), row.copy()
        live = np.arange(len(row))
        while len(live):
            r = row[live]
            kept = self.kept[r + 1] > self.kept[r]
            done = live[kept]
            pos[done] = self.samples[self.kept[row[done]]] + steps[done]
            live = live[~kept]
            c = self.wavelet.access(row[live])
            row[live] = self.before[c] + self.wavelet.rank(c, row[live])
            steps[live] += 1
        return pos


def find(h: np.ndarray, first: np.ndarray, phrases: Phrases):
    """All occurrences of the phrases in texts given by word hashes: word
    start, length and phrase number of each."""
    n_docs = len(first) - 1
    none = np.zeros(0, np.int64)
    if not len(phrases.rows) or not len(h):
        return none, none, none
    at = np.minimum(np.searchsorted(phrases.vocab, h), len(phrases.vocab) - 1)
    sym = np.where(phrases.vocab[at] == h, at + 1, 0)
    # one separator for each run of foreign words and one behind each text
    last = np.unique(first[1:])
    full = np.insert(sym, last[last <= len(h)], 0)
    back = np.insert(np.arange(len(h)), last, -1)
    keep = full > 0
    sep = ~keep
    sep[1:] &= keep[:-1]
    keep |= sep
    full, back = full[keep], back[keep]
    if full[-1]:
        full, back = np.append(full, 0), np.append(back, -1)
    if not n_docs or len(full) == 1:
        return none, none, none
    index = FMIndex(full, len(phrases.vocab) + 1)
    lo, hi = index.ranges(phrases.rows)
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    row = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(which))
    return back[index.locate(row)], phrases.length[which], which


# --------------------------------------------------------------------------- operator
def _shard_hits(texts: pa.Array, phrases: Phrases):
    data, off = W.buffers(texts)
    starts, ends, first = W.split_words(data, off, CLASS)
    h = W.hash_words(data, starts, CLASS)
    pos, length, which = find(h, first, phrases)
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, pos, 1)
    np.add.at(cover, pos + length, -1)
    hit = np.cumsum(cover[:-1]) > 0
    doc = np.searchsorted(first, pos, "right") - 1
    pairs = np.unique(np.stack([doc, which]), axis=1) if len(doc) else np.zeros((2, 0), np.int64)
    return data, off, starts, ends, first, hit, pairs


def _merge_hits(batch: pa.RecordBatch, text: str, phrases: Phrases) -> pa.RecordBatch:
    """Adds the hit columns, or extends those that an earlier block has left."""
    col = batch.column(batch.schema.get_field_index(text))
    data, off, starts, ends, first, hit, pairs = _shard_hits(col, phrases)
    n = batch.num_rows
    items: list[set] = [set() for _ in range(n)]
    for d, p in pairs.T.tolist():
        items[d].update(phrases.owner[phrases.owner_at[p]:phrases.owner_at[p + 1]])
    if "hit_words" in batch.schema.names:  # from an earlier block of the benchmark
        for d, old in enumerate(batch.column(batch.schema.get_field_index("hit_words")).to_pylist()):
            for span in old:
                hit[first[d] + span["start"]:first[d] + span["end"]] = True
        for d, old in enumerate(batch.column(batch.schema.get_field_index("items")).to_pylist()):
            items[d].update(old)
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[first[1:]] - total[first[:-1]]
    spans: list[list] = [[] for _ in range(n)]
    clean = col.to_pylist() if n_hit.any() else None
    for d in np.flatnonzero(n_hit):
        x = np.concatenate([[False], hit[first[d]:first[d + 1]], [False]])
        a, b = np.flatnonzero(x[1:] & ~x[:-1]), np.flatnonzero(~x[1:] & x[:-1])
        spans[d] = list(zip(a.tolist(), b.tolist(), strict=True))
        left, parts = off[d], []
        for i, j in spans[d]:
            parts.append(data[left:starts[first[d] + i]].tobytes())
            left = ends[first[d] + j - 1]
        parts.append(data[left:off[d + 1]].tobytes())
        clean[d] = b"".join(parts).decode()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    flat = [{"start": a, "end": b} for s in spans for a, b in s]
    ends_at = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int32))
    return W.with_columns(batch, {
        "n_words": pa.array(np.diff(first)), "n_hit": pa.array(n_hit.astype(np.int64)),
        "hit_words": pa.ListArray.from_arrays(ends_at, pa.array(flat, span.value_type)),
        "items": pa.array([sorted(s) for s in items], pa.list_(pa.string())),
        "clean_text": pa.array(clean, pa.string()) if clean is not None else col,
    })


def benchmark_blocks(bench: DataFrame, item: str, text: str, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark split by hash into parts of about ``block_bytes`` (one
    part for the usual benchmark), each small enough to send to every task."""
    b = bench.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    total = b.agg(F.coalesce(F.sum(F.length(F.col("text").cast("binary")) + 8), F.lit(0)).alias("n")).first()["n"]
    parts = -(-int(total) // block_bytes) or 1
    if parts == 1:
        return [b]
    return [b.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == i) for i in range(parts)]


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", bench_text: str = "text",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Mark every word of ``docs`` inside an occurrence of a benchmark window.

    Keeps all columns of ``docs`` and appends ``n_words``, ``n_hit`` (hit
    words), ``hit_words`` (merged removal spans as word ranges), ``items`` (ids
    of the items found, as strings, sorted) and ``clean_text`` (the text without
    the spans; null stays null).  Columns of these names are replaced.  Null and
    empty texts have no words; null or wordless items have no window; items
    sharing a window are all reported, a null item id as "null"; repeated rows
    are each marked; empty tables give empty or unmarked results.
    """
    spark = docs.sparkSession
    docs = docs.drop(*HIT_COLUMNS)
    out = docs
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
             T.StructField("hit_words", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
             T.StructField("items", T.ArrayType(T.StringType())), T.StructField("clean_text", T.StringType())]
    schema = T.StructType([*docs.schema.fields, *added])
    for block in benchmark_blocks(bench, item, bench_text, block_bytes):
        rows = block.collect()  # bounded by block_bytes
        phrases = Phrases(["null" if r["item"] is None else r["item"] for r in rows], [r["text"] for r in rows], window)
        shared = spark.sparkContext.broadcast(phrases)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in W.slices(batch, text, SHARD_BYTES):
                    yield _merge_hits(part, text, shared.value)

        out = out.mapInArrow(W.releasing(search), schema)
    return out


def items_digest(items: list[str]) -> str:
    """Lowercase hex SHA-256 of the comma-joined item ids."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
