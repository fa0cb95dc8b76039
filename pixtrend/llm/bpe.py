"""Byte-level BPE encoding and decoding with a public vocabulary file.

Texts are cut into words by the vocabulary's pre-split pattern; each distinct
word is encoded once per task and kept in a bounded cache.  Inside a word the
part boundaries and the ranks of adjacent parts lie in contiguous arrays: scan
for the smallest rank, delete that boundary, refresh the two neighbouring
ranks, repeat.  Words beyond ``LONG_WORD`` bytes, where the scan would cost the
square of the length, take the same merges from a heap over linked parts.
"""

from __future__ import annotations

import heapq
import json
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pixtrend.llm import words as W

#: Fixed value: the split pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_WORD = 96
#: Words of a generation of the cache; the one before is kept beside it.
CACHE_WORDS = 120_000
BATCH_BYTES = 2 << 20
NO_RANK = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: printable
    Latin-1 bytes stand for themselves, the rest for U+0100 onwards in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Plain tables of a vocabulary file, small enough to broadcast (a few MB)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        vocab = d["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.byte_id = [vocab[c] for c in letters]
        self.pair_rank, self.merged = {}, []
        for rank, pair in enumerate(d["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.pair_rank[(vocab[a] << 32) | vocab[b]] = rank
            self.merged.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.token = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in vocab.items():
            self.token[i] = bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode()
        for s, i in self.special.items():
            self.token[i] = s.encode()


class Encoder(dict):
    """Maps a word to its ids as little-endian 32-bit integers; the mapping
    itself is the cache.  When it reaches ``CACHE_WORDS`` it becomes the old
    generation, out of which words that are met again are taken over, so that
    frequent words are never encoded anew."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary
        self.old: dict[str, bytes] = {}
        self.find_words = regex.compile(PATTERN).findall
        marks = sorted(vocabulary.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word)
        if out is None:
            raw = word.encode()
            parts = self.scan(raw) if len(raw) <= LONG_WORD else self.heap(raw)
            ids = array("I", parts)
            if sys.byteorder == "big":
                ids.byteswap()
            out = ids.tobytes()
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = out
        return out

    def scan(self, raw: bytes) -> list[int]:
        rank_of, merged = self.v.pair_rank.get, self.v.merged
        parts = [self.v.byte_id[b] for b in raw]
        # ranks[i] belongs to the boundary between parts i and i + 1
        ranks = [rank_of((a << 32) | b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            i = ranks.index(low)
            parts[i] = merged[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of((parts[i] << 32) | parts[i + 1], NO_RANK)
            if i:
                ranks[i - 1] = rank_of((parts[i - 1] << 32) | parts[i], NO_RANK)
        return parts

    def heap(self, raw: bytes) -> list[int]:
        rank_of, merged = self.v.pair_rank.get, self.v.merged
        parts = [self.v.byte_id[b] for b in raw]
        n = len(parts)
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        todo = [(r, i) for i in range(n - 1) if (r := rank_of((parts[i] << 32) | parts[i + 1], NO_RANK)) < NO_RANK]
        heapq.heapify(todo)
        while todo:
            r, i = heapq.heappop(todo)
            j = after[i] if parts[i] >= 0 else n
            if j >= n or rank_of((parts[i] << 32) | parts[j], NO_RANK) != r:
                continue  # the boundary has gone or changed since
            parts[i], parts[j] = merged[r], -1
            after[i] = k = after[j]
            if k < n:
                ahead[k] = i
                if (x := rank_of((parts[i] << 32) | parts[k], NO_RANK)) < NO_RANK:
                    heapq.heappush(todo, (x, i))
            h = ahead[i]
            if h >= 0 and (x := rank_of((parts[h] << 32) | parts[i], NO_RANK)) < NO_RANK:
                heapq.heappush(todo, (x, h))
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> bytes:
        """Ids of a text; strings of special tokens become their ids."""
        if self.marks is None or "<|" not in text:
            return b"".join(map(self.__getitem__, self.find_words(text)))
        out = []
        for k, part in enumerate(self.marks.split(text)):
            out.append(np.array([self.v.special[part]], "<u4").tobytes() if k % 2
                       else b"".join(map(self.__getitem__, self.find_words(part))))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.v.token.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_held: list = [None]


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """The worker's encoder for the broadcast tables: a worker is kept for many
    tasks, and with it the words it knows (at most twice ``CACHE_WORDS``)."""
    if _held[0] is None or _held[0].v is not vocabulary:
        _held[0] = Encoder(vocabulary)
    return _held[0]


def _apply(df: DataFrame, vocab_path: str, source: str, added: list[T.StructField], make) -> DataFrame:
    spark: SparkSession = df.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(vocab_path))
    names = [f.name for f in added]
    df = df.drop(*[n for n in names if n != source])
    schema = T.StructType([*[f for f in df.schema.fields if f.name not in names], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared.value)
        for batch in batches:
            at = batch.schema.get_field_index(source)
            parts = W.slices(batch, source, BATCH_BYTES) if pa.types.is_string(batch.schema.field(at).type) else [batch]
            for part in parts:
                yield W.with_columns(part, make(enc, part.column(at)))

    return df.mapInArrow(W.releasing(run), schema)


def _ids_of(enc: Encoder, texts: pa.Array) -> list[bytes]:
    return [enc.encode(t) if t else b"" for t in texts.to_pylist()]


def encode(docs: DataFrame, vocab_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append ``ids`` (binary, little-endian unsigned 32-bit) for every whole text.

    Null and empty texts get empty ids; repeated rows are each encoded; an
    existing column named ``ids`` is replaced, all others are kept."""
    return _apply(docs, vocab_path, text, [T.StructField(ids, T.BinaryType())],
                  lambda enc, col: {ids: pa.array(_ids_of(enc, col), pa.binary())})


def decode(df: DataFrame, vocab_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Append the text of an ``ids`` column (null ids: empty text)."""
    return _apply(df, vocab_path, ids, [T.StructField(text, T.StringType())],
                  lambda enc, col: {text: pa.array([enc.decode(b or b"") for b in col.to_pylist()], pa.string())})


def round_trip(docs: DataFrame, vocab_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the texts."""
    def make(enc: Encoder, col: pa.Array) -> dict[str, pa.Array]:
        coded = _ids_of(enc, col)
        return {ids: pa.array(coded, pa.binary()), decoded: pa.array([enc.decode(b) for b in coded], pa.string())}

    return _apply(docs, vocab_path, text, [T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.StringType())], make)
