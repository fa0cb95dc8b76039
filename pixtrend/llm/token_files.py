"""Token-id files: ids of whole documents, entropy-coded in independent blocks.

A file set is a folder of Parquet parts; a row is a *segment* of whole
documents with its ids in blocks of at most ``BLOCK`` ids.  Every block starts
from an empty model, carries the CRC-32 of its ids, and decodes alone.

The model of a block predicts each id from the two ids before it (order 2),
from the one before it (order 1), and from all ids of the block so far
(order 0).  The shares of the three orders adapt to their record in the block,
kept apart by what the higher orders propose (nothing, one id, two ids, the
same id twice); order 0 adapts its frequencies at doubling positions and leaves
room for ids not seen yet.  The predictions drive a 64-bit carry-less range
coder.  Many blocks step through the coder together as numpy lanes.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pixtrend.llm import words as W

BLOCK = 8192
#: Ids after which a segment is closed (whole documents; a longer one has a segment of its own).
SEGMENT = 16 * BLOCK
#: Blocks that are coded together; the model of one takes about 200 KB.
LANES = 512
#: Text bytes of one part.
PART_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
CACHE_WORDS = 300_000
MAGIC = b"TIDS1\0"

NONE = 0xFFFF  # no prediction; ids are below
SLOTS1, SLOTS2 = 1 << 12, 1 << 13
GATE_BITS, ZERO_BITS, RAW_BITS = 12, 14, 16
EPOCHS = [256 << i for i in range(5)]
TOP = np.uint64(1 << 48)
LOW48 = np.uint64((1 << 48) - 1)
WORD = np.uint64(16)


# --------------------------------------------------------------------------- model
def slots(a: np.ndarray, b: np.ndarray, lane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order-1 and order-2 tables for the ids before (``a``) and before that (``b``)."""
    a, b = a.astype(np.int32), b.astype(np.int32)
    return lane * SLOTS1 + ((a * 40503 >> 4) & (SLOTS1 - 1)), lane * SLOTS2 + ((a * 40503 + b * 60493 >> 3) & (SLOTS2 - 1))


def proposal(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """What the higher orders propose: 0 nothing, 1 order 1 only, 2 two ids, 3 the same id."""
    has2 = p2 != NONE
    return (p1 != NONE).astype(np.uint8) + has2 + (has2 & (p1 == p2))


def shares(wins: np.ndarray) -> np.ndarray:
    """Ends of the three orders' shares, per lane and proposal, in 1 / 2**GATE_BITS.
    Where nothing is proposed, order 0 is certain."""
    w = wins.reshape(-1, 4, 3) + np.array([2, 1, 1])
    f = 1 + w * ((1 << GATE_BITS) - 3) // w.sum(2, keepdims=True)
    f[:, :, 0] += (1 << GATE_BITS) - f.sum(2)
    f[:, 0] = [1 << GATE_BITS, 0, 0]
    return np.concatenate([np.zeros((len(f), 4, 1), np.int64), np.cumsum(f, 2)], 2).astype(np.uint64).ravel()


class OrderZero:
    """Frequencies of the ids that each lane has seen, with room for the others."""

    def __init__(self, seen: np.ndarray):
        t, n = seen.shape
        keys, count = np.unique((np.arange(n, dtype=np.int64)[:, None] << 16 | seen.T).ravel(), return_counts=True)
        lane = keys >> 16
        edge = np.searchsorted(lane, np.arange(n + 1))
        freq = 1 + count * ((1 << ZERO_BITS) - 64 - np.diff(edge))[lane] // t
        total = np.concatenate([[0], np.cumsum(freq)])
        # per lane: entry 0 is the escape with the room that is left, then its ids ascending
        self.keys, self.edge = keys, edge
        self.base = edge[:-1] + np.arange(n)
        self.place = np.arange(len(keys)) + lane + 1
        self.number = np.arange(len(keys)) - edge[lane] + 1
        used = total[edge[1:]] - total[edge[:-1]]
        size = len(keys) + n
        self.freq, self.cum, self.sym = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.uint16)
        self.freq[self.place], self.cum[self.place], self.sym[self.place] = freq, total[:-1] - total[edge[lane]], keys & 0xFFFF
        self.freq[self.base], self.cum[self.base] = (1 << ZERO_BITS) - used, used

    def ranks(self, ids: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Entry numbers of ``ids`` (positions by lanes); 0 is the escape.
        ``table`` is an all-zero array of 65536 per lane, and is so again."""
        table[self.keys] = self.number
        out = table[(np.arange(ids.shape[1], dtype=np.int64) << 16) | ids]
        table[self.keys] = 0
        return out

    def values(self) -> np.ndarray:
        """Entry number of every value a decoder can meet, lane after lane."""
        size, n = len(self.freq), len(self.base)
        order, reps = np.zeros(size, np.uint16), np.zeros(size, np.int64)
        last = self.edge[1:] + np.arange(n)  # each lane: its ids, then the escape
        order[self.place - 1], reps[self.place - 1] = self.number, self.freq[self.place].astype(np.int64)
        reps[last] = self.freq[self.base].astype(np.int64)
        return np.repeat(order, reps)


def _refresh_points(length: int) -> set[int]:
    return {e for e in EPOCHS if e < length}


# --------------------------------------------------------------------------- coder
class Coder:
    """State of the carry-less range coder for ``n`` lanes."""

    def __init__(self, n: int):
        self.low = np.zeros(n, np.uint64)
        self.range = np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64)

    def narrow(self, n: int, cum: np.ndarray, freq: np.ndarray, bits: int) -> None:
        r = self.range[:n] >> np.uint64(bits)
        self.low[:n] += cum * r
        self.range[:n] = freq * r

    def settle(self, lanes: np.ndarray | slice):
        """Yield the lanes whose top word is decided, until none is."""
        low, rng = self.low[lanes], self.range[lanes]
        done = (low ^ (low + rng)) < TOP
        move = np.flatnonzero(done | (rng < TOP))
        lanes = move if isinstance(lanes, slice) else lanes[move]
        low, rng, done = low[move], rng[move], done[move]
        while len(lanes):
            rng = np.where(done, rng, (np.uint64(0) - low) & LOW48)
            yield lanes, low >> np.uint64(48)
            low, rng = low << WORD, rng << WORD
            self.low[lanes], self.range[lanes] = low, rng
            done = (low ^ (low + rng)) < TOP
            move = np.flatnonzero(done | (rng < TOP))
            lanes, low, rng, done = lanes[move], low[move], rng[move], done[move]


def _raw(coder: Coder, lanes: np.ndarray, ids: np.ndarray) -> None:
    r = coder.range[lanes] >> np.uint64(RAW_BITS)
    coder.low[lanes] += ids.astype(np.uint64) * r
    coder.range[lanes] = r


def _by_size(sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest blocks first: their order, sizes, and how many have an id at each position."""
    sizes = np.array(sizes)
    by = np.argsort(-sizes, kind="stable")
    return by, sizes[by], np.searchsorted(-sizes[by], -np.arange(sizes.max()), "left")


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Payload of each block of ids (0 to 65534); no block may be empty."""
    if not blocks:
        return []
    by, size, alive = _by_size([len(b) for b in blocks])
    length, n = int(size[0]), len(blocks)
    ids = np.zeros((length, n), np.uint16)
    for k, i in enumerate(by):
        ids[:size[k], k] = blocks[i]
    # the encoder knows all ids: everything but the tables of last followers is vectorised over time
    lane = np.arange(n, dtype=np.int32)
    a = np.concatenate([np.zeros((1, n), np.uint16), ids[:-1]])
    s1, s2 = slots(a, np.concatenate([np.zeros((1, n), np.uint16), a[:-1]]), lane)
    t1, t2 = np.full(n * SLOTS1, NONE, np.uint16), np.full(n * SLOTS2, NONE, np.uint16)
    p1, p2 = np.empty_like(ids), np.empty_like(ids)
    for t in range(length):
        i, j, x = s1[t], s2[t], ids[t]
        p1[t], p2[t] = t1[i], t2[j]
        t1[i] = x
        t2[j] = x
    del s1, s2, a
    kind = proposal(p1, p2)
    order = np.where((p2 == ids) & (p2 != NONE), 2, (p1 == ids) & (p1 != NONE)).astype(np.uint8)
    del p1, p2
    cell = lane * 12 + kind.astype(np.int32) * 3 + order
    start, width = np.empty(ids.shape, np.uint16), np.empty(ids.shape, np.uint16)
    low0, width0 = np.zeros(ids.shape, np.uint16), np.full(ids.shape, 1 << ZERO_BITS, np.uint16)
    new = order == 0
    wins, table = np.zeros(n * 12, np.int64), np.zeros(n * 65536, np.uint16)
    edges = [0, *sorted(_refresh_points(length)), length]
    for e, e2 in zip(edges, edges[1:], strict=False):
        k = int(alive[e])  # lanes with ids from here on; their earlier ids are complete
        gate = shares(wins)
        at = cell[e:e2, :k] // 3 * 4 + order[e:e2, :k]
        start[e:e2, :k], width[e:e2, :k] = gate[at], gate[at + 1] - gate[at]
        if e:
            zero = OrderZero(ids[:e, :k])
            rank = zero.ranks(ids[e:e2, :k], table)
            entry = zero.base[:k] + rank
            plain = order[e:e2, :k] == 0
            low0[e:e2, :k] = np.where(plain, zero.cum[entry], 0)
            width0[e:e2, :k] = np.where(plain, zero.freq[entry], 1 << ZERO_BITS)
            new[e:e2, :k] &= rank == 0
        wins += np.bincount(cell[e:e2, :k].ravel(), minlength=n * 12)
    c = Coder(n)
    out, pos = np.zeros((n, 2 * length + 16), np.uint16), np.zeros(n, np.int64)

    def emit(lanes) -> None:
        for which, word in c.settle(lanes):
            out[which, pos[which]] = word
            pos[which] += 1

    for t in range(length):
        k = int(alive[t])
        c.narrow(k, start[t, :k].astype(np.uint64), width[t, :k].astype(np.uint64), GATE_BITS)
        if t >= EPOCHS[0]:
            c.narrow(k, low0[t, :k].astype(np.uint64), width0[t, :k].astype(np.uint64), ZERO_BITS)
        emit(slice(0, k))
        fresh = np.flatnonzero(new[t, :k])
        if len(fresh):
            _raw(c, fresh, ids[t, fresh])
            emit(fresh)
    for _ in range(4):
        out[np.arange(n), pos] = c.low >> np.uint64(48)
        c.low <<= WORD
        pos += 1
    result = [b""] * n
    for k, i in enumerate(by):
        result[i] = out[k, :pos[k]].astype("<u2").tobytes()
    return result


def decode_blocks(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """Ids of each block."""
    if not payloads:
        return []
    by, size, alive = _by_size(sizes)
    length, n = int(size[0]), len(payloads)
    code = np.zeros((n, max(len(p) for p in payloads) // 2 + 8), np.uint16)
    for k, i in enumerate(by):
        p = np.frombuffer(payloads[i], "<u2")
        code[k, :len(p)] = p
    width = code.shape[1]
    code = code.ravel()
    c = Coder(n)
    value, pos = np.zeros(n, np.uint64), np.arange(n) * width + 4
    for j in range(4):
        value = (value << WORD) | code[j::width].astype(np.uint64)

    def take(lanes) -> None:
        for which, _ in c.settle(lanes):
            value[which] = (value[which] << WORD) | code[pos[which]]
            pos[which] += 1

    ids, lane = np.zeros((length, n), np.uint16), np.arange(n, dtype=np.int32)
    t1, t2 = np.full(n * SLOTS1, NONE, np.uint16), np.full(n * SLOTS2, NONE, np.uint16)
    a = b = np.zeros(n, np.uint16)
    cells, zero, values = np.zeros((length, n), np.int32), None, None
    wins, points, last = np.zeros(n * 12, np.int64), _refresh_points(length), 0
    gate = shares(wins)
    gate_top, zero_top = np.uint64((1 << GATE_BITS) - 1), np.uint64((1 << ZERO_BITS) - 1)
    for t in range(length):
        k = int(alive[t])
        if t in points:
            wins += np.bincount(cells[last:t, :k].ravel(), minlength=n * 12)
            gate, zero, last = shares(wins), OrderZero(ids[:t, :k]), t
            values = zero.values()
        i, j = slots(a[:k], b[:k], lane[:k])
        p1, p2 = t1[i], t2[j]
        kind = proposal(p1, p2)
        at = (lane[:k] * 4 + kind) * 4
        r = c.range[:k] >> np.uint64(GATE_BITS)
        v = np.minimum((value[:k] - c.low[:k]) // r, gate_top)
        order = (v >= gate[at + 1]).astype(np.int32) + (v >= gate[at + 2])
        at += order
        start = gate[at]
        c.low[:k] += start * r
        c.range[:k] = (gate[at + 1] - start) * r
        plain = order == 0
        x = np.where(order == 2, p2, p1)
        if zero is not None:
            r = c.range[:k] >> np.uint64(ZERO_BITS)
            v = np.minimum((value[:k] - c.low[:k]) // r, zero_top).astype(np.int64)
            rank = values[(np.arange(k) << ZERO_BITS) + v]
            entry = zero.base[:k] + rank
            c.low[:k] += np.where(plain, zero.cum[entry], 0).astype(np.uint64) * r
            c.range[:k] = np.where(plain, zero.freq[entry], 1 << ZERO_BITS).astype(np.uint64) * r
            x = np.where(plain, zero.sym[entry], x)
            fresh = np.flatnonzero(plain & (rank == 0))
        else:
            fresh = np.flatnonzero(plain)
        take(slice(0, k))
        if len(fresh):
            r = c.range[fresh] >> np.uint64(RAW_BITS)
            got = np.minimum((value[fresh] - c.low[fresh]) // r, np.uint64(0xFFFF))
            x[fresh] = got
            _raw(c, fresh, got)
            take(fresh)
        ids[t, :k] = x
        cells[t, :k] = (at - order) // 4 * 3 + order
        t1[i] = x
        t2[j] = x
        a, b = x, a
    result = [np.zeros(0, np.uint16)] * n
    for k, i in enumerate(by):
        result[i] = ids[:size[k], k].copy()
    return result


# --------------------------------------------------------------------------- segments
def pack_segments(segments: list[tuple[list, list[np.ndarray]]]) -> list[bytes]:
    """Bytes of segments, each given as document keys (integers or None) and ids."""
    blocks, cut = [], [0]
    for _, docs in segments:
        flat = np.concatenate([*docs, np.zeros(0, np.uint16)])
        blocks += [flat[i:i + BLOCK] for i in range(0, len(flat), BLOCK)]
        cut.append(len(blocks))
    payloads: list[bytes] = []
    for i in range(0, len(blocks), LANES):
        payloads += encode_blocks(blocks[i:i + LANES])
    out = []
    for (keys, docs), i, j in zip(segments, cut, cut[1:], strict=False):
        parts = [MAGIC, struct.pack("<II", len(keys), j - i), np.array([k is None for k in keys], np.uint8).tobytes(),
                 np.array([k or 0 for k in keys], "<i8").tobytes(), np.array([len(d) for d in docs], "<u8").tobytes()]
        for b, p in zip(blocks[i:j], payloads[i:j], strict=True):
            parts += [struct.pack("<III", len(b), len(p), zlib.crc32(b.astype("<u2").tobytes())), p]
        out.append(b"".join(parts))
    return out


def unpack_segments(data: list[bytes]) -> list[tuple[list, list[np.ndarray]]]:
    """Document keys and ids of segments; a block whose ids do not match its checksum raises."""
    heads, payloads, sizes, sums = [], [], [], []
    for d in data:
        if d[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token segment")
        at = len(MAGIC)
        n, m = struct.unpack_from("<II", d, at)
        at += 8
        null = np.frombuffer(d, np.uint8, n, at)
        keys = np.frombuffer(d, "<i8", n, at + n)
        length = np.frombuffer(d, "<u8", n, at + 9 * n).astype(np.int64)
        at += 17 * n
        for _ in range(m):
            size, width, crc = struct.unpack_from("<III", d, at)
            payloads.append(d[at + 12:at + 12 + width])
            sizes.append(size)
            sums.append(crc)
            at += 12 + width
        heads.append(([None if z else int(k) for z, k in zip(null, keys, strict=True)], length, m))
    blocks: list[np.ndarray] = []
    for i in range(0, len(payloads), LANES):
        blocks += decode_blocks(payloads[i:i + LANES], sizes[i:i + LANES])
    for b, crc in zip(blocks, sums, strict=True):
        if zlib.crc32(b.astype("<u2").tobytes()) != crc:
            raise ValueError("token block does not match its checksum")
    out, at = [], 0
    for keys, length, m in heads:
        flat = np.concatenate([*blocks[at:at + m], np.zeros(0, np.uint16)])
        at += m
        out.append((keys, np.split(flat, np.cumsum(length)[:-1]) if len(length) else []))
    return out


# --------------------------------------------------------------------------- tokens
class WordEncoder:
    """Ids of whole texts from a tokenizers file, one library call for all new
    words of a batch; known words come from a bounded cache.

    The vocabulary ends its words (``</w>``) and its pre-split never lets a word
    cross another, so a text's ids are those of its words.  Texts with special
    tokens, or characters whose normal form or case the plain rules might treat
    otherwise, go to the library whole."""

    PLAIN = re.compile(r"[\x00-\x1b\x20-\x7e¡-±´-¸º-»¿-įĲ-ɏ‐-‧‰-⁞]*")
    FIND = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

    def __init__(self, spec: str):
        import json

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        vocab = json.loads(spec)["model"]["vocab"]
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for s, i in vocab.items() if s.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        found: dict[int, list[str]] = {}
        for i, t in enumerate(texts):
            if "<|" in t or not self.PLAIN.fullmatch(t):
                out[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint16)
            else:
                found[i] = self.FIND.findall(unicodedata.normalize("NFC", t).lower())
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = list({w for ws in found.values() for w in ws if w not in self.known})
        if new:
            ids = np.array(self.library.encode(" ".join(new), add_special_tokens=False).ids, np.uint16)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(new):
                self.known.update(zip(new, (p.tobytes() for p in np.split(ids, ends[:-1])), strict=True))
            else:  # a word that the library splits further: one by one
                for w in new:
                    self.known[w] = np.array(self.library.encode(w, add_special_tokens=False).ids, np.uint16).tobytes()
        get = self.known.__getitem__
        for i, ws in found.items():
            out[i] = np.frombuffer(b"".join(map(get, ws)), np.uint16)
        return out


_held: list = [None, None]


def _encoder(spec: str) -> WordEncoder:
    """The worker's encoder: a worker is kept for many tasks, and with it the
    library's tables and the words it knows (about ``CACHE_WORDS``)."""
    if _held[0] != spec:
        _held[:] = [spec, WordEncoder(spec)]
    return _held[1]


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2, key: str = "doc_id", text: str = "text",
                      part_bytes: int = PART_BYTES) -> None:
    """Encode every whole text, append ``end_id``, and write the ids in
    ascending key order (null keys first) as token files under ``folder``.

    Null and empty texts are the end id alone; rows that repeat a key follow one
    another in the order of a hash of their texts; other columns are ignored."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = docs.agg(F.coalesce(F.sum(F.length(F.col("text").cast("binary")) + 16), F.lit(0)).alias("n")).first()["n"]
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    order = ["doc_id", F.xxhash64("text")]
    rows = docs.repartitionByRange(max(1, -(-int(total) // part_bytes)), *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(spec.value)
        part, first, seg = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[list, list[np.ndarray]]] = []
        keys: list = []
        ids: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal first, seg, held
            counts = [sum(map(len, d)) for _, d in held]
            at = first + np.concatenate([[0], np.cumsum(counts)])
            batch = pa.RecordBatch.from_arrays([pa.array([part] * len(held), pa.int32()), pa.array(range(seg, seg + len(held)), pa.int64()), pa.array(at[:-1], pa.int64()),
                                                pa.array(counts, pa.int64()), pa.array(pack_segments(held), pa.binary())],
                                               names=["part", "segment", "first", "n_ids", "data"])
            first, seg, held = int(at[-1]), seg + len(held), []
            return batch

        for batch in batches:
            for piece in W.slices(batch, "text", BATCH_BYTES):
                for k, x in zip(piece.column(0).to_pylist(), enc.encode(piece.column(1).to_pylist()), strict=True):
                    x = np.append(x, np.uint16(end_id))
                    if ids and size + len(x) > SEGMENT:
                        held.append((keys, ids))
                        keys, ids, size = [], [], 0
                        if sum(-(-sum(map(len, d)) // BLOCK) for _, d in held) >= LANES:
                            yield flush()
                    keys.append(k)
                    ids.append(x)
                    size += len(x)
        if ids:
            held.append((keys, ids))
        if held:
            yield flush()

    rows.mapInArrow(W.releasing(run), "part int, segment long, first long, n_ids long, data binary").write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: every document of the files, its ids
    (little-endian unsigned 32-bit) and the number of ids of all before it."""
    files = spark.read.schema("part int, segment long, first long, n_ids long, data binary").parquet(folder)
    sums = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                b = batch.slice(i, 64)
                part, first = b.column(0).to_pylist(), b.column(1).to_pylist()
                for p, f, (keys, ids) in zip(part, first, unpack_segments(b.column(2).to_pylist()), strict=True):
                    n = np.array([len(x) for x in ids], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([p] * len(keys), pa.int32()), pa.array(f + np.cumsum(n) - n), pa.array(n),
                                                      pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())],
                                                     names=["doc_id", "part", "at", "n_tokens", "ids"])

    found = files.select("part", "first", "data").mapInArrow(W.releasing(run), "doc_id long, part int, at long, n_tokens long, ids binary")
    return found.join(F.broadcast(offsets), "part").select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids")
